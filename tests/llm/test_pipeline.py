"""The stages against their operators' decisions, on the whole small table and on odd rows."""

from __future__ import annotations

import pytest

import corpus_pipeline as pipeline
from obsframe.llm import packing, simhash, toxicity
from obsframe.llm.common import keep_rows, mark_of, stored
from tests.conftest import SMALL
from tests.llm.test_dedup import brute as copies
from tests.llm.test_packing import verify
from tests.llm.test_pii import brute as spans
from tests.llm.test_simhash import slow_components, slow_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def written(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), name)
        out.append(docs)
    return [d.collect() for d in out]


def test_stages(spark, written):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    clean, whole, apart, safe, packed = written
    scores = toxicity.score_toxicity(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
    assert {r.doc_id for r in clean} == {r.doc_id for r in scores if r.predicted == 0}
    rows = [(r.doc_id, r.text) for r in clean]
    assert sorted(r.doc_id for r in whole) == sorted(d for d, _, _, kept, _ in copies(rows) if kept)
    marks = [(r.doc_id, slow_fingerprint(r.text)) for r in whole]
    assert sorted(r.doc_id for r in apart) == sorted({c for _, c in slow_components(marks)})
    before = {r.doc_id: r for r in apart}
    assert {r.doc_id for r in safe} == set(before)
    for r in safe:
        assert (r.text == before[r.doc_id].text) == (not spans(before[r.doc_id].text)) or r.text != before[r.doc_id].text
        assert not spans(r.text) and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
    for kept in (clean, whole, apart, safe):
        assert kept[0].__fields__ == COLUMNS
    counts = packing.token_counts(spark.createDataFrame([(r.doc_id, r.text) for r in safe], "doc_id long, text string")).collect()
    verify(packed, [(r.doc_id, r.n_tokens) for r in counts], packing.CAPACITIES)


def test_run_is_the_stages(spark, written):
    got = pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.piece, r.length) for r in got.collect()) == sorted((r.doc_id, r.piece, r.length) for r in written[-1])


def test_keep_rows_with_repeats(spark):
    rows = [(1, "a", 7), (1, "a", 7), (1, "b", 8), (None, "a", 9), (None, None, 1), (2, "", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    marked = df.select("doc_id", mark_of().alias("mark"))
    for keep in ([1, 0, 1, 1, 0, 1], [1, 1, 0, 0, 1, 1], [0, 0, 0, 0, 0, 0]):
        decisions = [(r.doc_id, r.mark, bool(k)) for r, k in zip(marked.collect(), keep)]
        got = keep_rows(df, spark.createDataFrame(decisions, "doc_id long, mark long, kept boolean"))
        assert got.columns == df.columns
        assert sorted(map(str, got.collect())) == sorted(str(r) for r, k in zip(df.collect(), keep) if k)


def test_odd_rows_pass(spark):
    rows = [(1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "x y z", "en", None, 5), (None, "lonely words here", None, "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), name)
        if name == "simhash_near_dedup":
            assert docs.count() == 3
    assert {r.doc_id for r in docs.collect()} == {1, 2, None}
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in pipeline.STAGES:
        empty = stored(stage(spark, empty, SMALL), name)
    assert empty.collect() == []


def test_near_copies_of_a_crowd(spark):
    """Small components and one large one, with a limit so low that groups are dealt again."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[:i] + [f"new{i}"] + words[i + 1 :])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = dict(slow_components([(d, slow_fingerprint(t)) for d, t in rows]))
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(df, crowd=4).collect()} == want


def test_texts_go_to_python_in_light_batches(spark):
    docs = spark.createDataFrame([(i, "some words " * 100_000) for i in range(40)], "doc_id long, text string").coalesce(1)
    before = spark.conf.get(pipeline.BATCH_CONF)
    try:
        pipeline.lighter_batches(spark)
        size = docs.mapInArrow(lambda batches: (b.slice(0, 1).set_column(1, "n", [b.column("text").nbytes]) for b in batches), "doc_id long, n long")
        assert size.agg({"n": "max"}).first()[0] < 20 << 20
    finally:
        spark.conf.set(pipeline.BATCH_CONF, before)


def test_batches_to_python_hold_little_of_the_texts(spark):
    docs = spark.createDataFrame([(i, "some words " * 50_000) for i in range(40)], "doc_id long, text string").coalesce(1)
    before = spark.conf.get(pipeline.BATCH_CONF)
    try:
        pipeline.lighter_batches(spark)
        size = docs.mapInArrow(lambda batches: (b.slice(0, 1).set_column(1, "n", [b.column("text").nbytes]) for b in batches), "doc_id long, n long")
        assert size.agg({"n": "max"}).first()[0] < 5 << 20
    finally:
        spark.conf.set(pipeline.BATCH_CONF, before)
