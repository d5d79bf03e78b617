"""Exact duplicates against SQL and brute force; the index over several batches."""

from __future__ import annotations

import hashlib
import re
import uuid

from obsframe.llm import dedup
from tests.compare import compare
from tests.conftest import SMALL


def test_query(spark, con):
    assert compare(dedup.op2_exact_dedup(spark, SMALL), con, dedup.OP2_SQL) is None


ODD = [
    (1, "a b"), (2, "ab"), (3, " a\tb\n\r\x0b\x0c"), (4, "a b"), (5, None), (6, ""), (7, "  "), (None, "ab"),
    (8, "x"), (8, "x"), (9, "y" * 100_000), (10, "y" * 100_000 + " "), (None, "z"), (None, "z"), (11, "\U0001f600 q"), (12, "\U0001f600q  "),
]


def brute(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        plain = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(plain, []).append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for plain, members in groups.items():
        best = min(members)
        for m in members:
            keep = None if best[1] else best[2]
            out.append((rows[m[3]][0], keep, len(members), m == best, hashlib.sha256(plain.encode()).hexdigest()))
    return out


def key(row):
    return [str(v) for v in row]


def test_odd_rows(spark):
    df = spark.createDataFrame([(t, d, 1, 2) for d, t in ODD], "text string, doc_id long, digest int, row int")
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in dedup.exact_dedup(df).collect()]
    # which of rows repeated whole stays is not told apart
    assert sorted(got, key=key) == sorted(brute(ODD), key=key)
    stay = dedup.without_copies(df)
    assert stay.columns == df.columns
    assert sorted(str(r.doc_id) for r in stay.collect()) == sorted(str(d) for d, _, _, kept, _ in brute(ODD) if kept)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert dedup.exact_dedup(df).collect() == [] and dedup.without_copies(df).collect() == []


def test_batches(spark):
    name = f"batches_{uuid.uuid4().hex}"
    index = dedup.DigestIndex(spark, name, buckets=3)
    first = {r.doc_id: r for r in index.add(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a ")], "doc_id long, text string")).collect()}
    assert (first[1].keep_id, first[3].kept, first[2].kept) == (3, True, True)
    again = dedup.DigestIndex(spark, name, buckets=3)
    later = {r.doc_id: r for r in again.add(spark.createDataFrame([(4, "a   "), (5, "c"), (6, "c")], "doc_id long, text string")).collect()}
    assert (later[4].keep_id, later[4].kept, later[5].kept, later[6].keep_id) == (3, False, True, 5)
    assert spark.table(name).count() == 3
    plan = spark.table(name).hint("merge").join(spark.table(name).withColumnRenamed("keep_id", "k"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text  # read in bucket order on both sides
    spark.sql(f"DROP TABLE {name}")


def test_index_is_not_shuffled(spark):
    """The anti-join of a batch reads the index in bucket order."""
    name = f"plan_{uuid.uuid4().hex}"
    index = dedup.DigestIndex(spark, name, buckets=8)
    index.add(spark.createDataFrame([(1, "a")], "doc_id long, text string")).collect()
    groups = dedup.digests(spark.createDataFrame([(1, "a")], "doc_id long, text string")).groupBy("digest").count()
    text = groups.join(spark.table(name).hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(digest") == 1
    spark.sql(f"DROP TABLE {name}")


def test_answers_are_the_index(spark):
    """keep_id is what the index holds; a batch added again gets the same answer; nothing is left behind."""
    name = f"answers_{uuid.uuid4().hex}"
    df = spark.createDataFrame([(d, x) for d, x in ODD], "doc_id long, text string")
    index = dedup.DigestIndex(spark, name, buckets=3)
    answers = lambda f: sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, bytes(r.digest)) for r in f.collect())
    first = answers(index.add(df, "monday"))
    held = {bytes(r.digest): str(r.keep_id) for r in spark.table(name).collect()}
    assert all(held[d] == keep for _, keep, _, _, d in first) and len(held) == len({d for *_, d in first})
    assert answers(index.add(df, "monday")) == first and spark.table(name).count() == len(held)
    assert not any(kept for _, _, _, kept, _ in answers(index.add(df, "tuesday")))
    location = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first().data_type
    assert location.removeprefix("file:").startswith(dedup.shared_folder(spark).removeprefix("file:"))
    spark.sql(f"DROP TABLE {name}")
    before = spark.catalog.listTables()
    dedup.exact_dedup(df).collect()
    assert len(spark.catalog.listTables()) == len(before)
