"""Exact duplicates against a persistent digest index. DataFrame operations only.

The index is a table bucketed and sorted by digest with one row per distinct text: the digest, the document that
stands for it and the batch that brought it. A batch is reduced to its digests and anti-joined to the index by a
sort-merge join; the index side is read by buckets and not shuffled (Spark sorts each bucket again, as several batches
leave several files in it). What is new is appended, and every document's answer is then read from the index.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.llm.common import SPACE_CLASS, keep_rows, mark_of, stored, table, tasks, text_of
from obsframe.session import scratch_dir


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, mark, row (an id of the row), n_chars of the original, SHA-256 of the text without white space."""
    text = text_of()
    return docs.select(
        "doc_id",
        mark_of().alias("mark"),
        F.monotonically_increasing_id().alias("row"),
        F.length(text).cast("long").alias("n_chars"),
        F.unhex(F.sha2(F.regexp_replace(text, f"{SPACE_CLASS}+", ""), 256)).alias("digest"),
    )


def shared_folder(spark: SparkSession) -> str:
    """Where indexes lie: in the folder of ``spark.checkpoint.dir``, beside what single sessions write there."""
    return spark.conf.get("spark.checkpoint.dir", None) or scratch_dir(spark)


class DigestIndex:
    """``name`` is a catalogue table, kept for later batches; it is created when absent, its files below
    ``location`` or else in the shared folder."""

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None, location: str | None = None):
        self.spark, self.name, self.buckets = spark, name, buckets or tasks(spark)
        place = location or f"{shared_folder(spark)}/digest-index/{name}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, n_chars BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )

    def add(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Decide about each row of ``docs`` (doc_id, text) and append the texts not seen before.

        Returns doc_id, mark, row, keep_id, group_size (rows of this batch with the text), kept, digest. Of equal
        texts the longest original stays, then the smallest doc_id; a text known from an earlier batch is
        never kept again and names the document of that batch. Null text counts as empty; a null doc_id
        stays only if no other row has the text; of rows repeated whole exactly one stays. An empty batch
        gives no rows. A batch added again under its own name, as after a failure, gets the same answer.
        """
        batch = batch or uuid.uuid4().hex
        rows = stored(digests(docs), "digests")
        # smallest struct: most characters, then smallest doc_id, nulls last. Combined before the shuffle.
        order = F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")
        groups = stored(
            rows.groupBy("digest").agg(F.min(order).alias("best"), F.count("*").alias("group_size")), "groups"
        )
        fresh = stored(
            groups.join(self.spark.table(self.name).hint("merge"), "digest", "left_anti").select(
                "digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.less")).alias("n_chars"), F.lit(batch).alias("batch")
            ),
            "fresh",
        )
        (
            fresh.repartition(self.buckets, "digest")
            .write.format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .mode("append")
            .saveAsTable(self.name)
        )
        known = self.spark.table(self.name).hint("merge")
        own = F.col("batch") == batch
        decided = stored(
            groups.join(known, "digest").select(
                "digest", "group_size", "keep_id", F.when(own, F.col("best.row")).otherwise(F.lit(-1)).alias("keep_row")
            ),
            "decided",
        )
        # Plain shuffles on both sides, so that adaptive execution splits a digest that fills a partition.
        return rows.join(decided.hint("merge"), "digest").select(
            "doc_id", "mark", "row", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest"
        )


def exact_dedup(docs: DataFrame, index: str | None = None) -> DataFrame:
    """Decisions for one table; without a name the index starts empty and leaves the catalogue afterwards."""
    spark = docs.sparkSession
    name = index or f"digest_index_{uuid.uuid4().hex}"
    decided = DigestIndex(spark, name).add(docs)
    if index is None:  # the decisions are written, they do not read it again
        spark.sql(f"DROP TABLE {name}")
    return decided


def without_copies(docs: DataFrame, index: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; which rows do, and nulls, repeats and empty tables, as in
    :meth:`DigestIndex.add`."""
    return keep_rows(docs, stored(exact_dedup(docs, index), "decisions"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
