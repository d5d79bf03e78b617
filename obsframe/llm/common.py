"""Helpers that the corpus operators share."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsframe.session import broadcast_cells, scratch_dir

# The six ASCII characters that count as white space in every contract.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages neither recompute it nor
    lose it with an executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def blocks(total: float, per_block: float, least: int = 1) -> int:
    """How many blocks of a stated size hold ``total``."""
    return max(least, math.ceil((total or 0) / per_block))


def fits(small: DataFrame) -> bool:
    """Whether a stored frame is within the bound for a broadcast; counts no further than the bound."""
    rows = max(1, broadcast_cells(small.sparkSession) // max(1, len(small.columns)))
    return small.limit(rows + 1).count() <= rows


def mark_of(column: str = "text") -> Column:
    """Hash that, with the doc_id, tells rows apart; rows that share both are repeated whole."""
    return F.xxhash64(text_of(column))


def keep_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, ...) that ``decisions`` (doc_id, mark, kept: a row for each) keep.

    Texts stay where they are unless the rows to drop are too many for a broadcast. Of rows repeated whole
    as many stay as are kept.
    """
    per_row = decisions.groupBy("doc_id", "mark").agg(
        F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("stay")
    )
    touched = stored(per_row.where(F.col("stay") < F.col("n")).select("doc_id", "mark", "stay"), "dropped")
    side = touched.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), F.col("stay").alias("__stay"))
    side = F.broadcast(side) if fits(touched) else side
    columns = [F.col(f"`{c}`") for c in docs.columns]
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (mark_of() == F.col("__mark"))
    left = docs.join(side, same, "left").where("__stay is null or __stay > 0")
    if touched.where("stay > 0").isEmpty():
        return left.select(*columns)
    repeated = left.where("__stay > 0")
    numbered = repeated.withColumn(
        "__n", F.row_number().over(Window.partitionBy("__id", "__mark").orderBy(F.lit(1)))
    ).where("__n <= __stay")
    return left.where("__stay is null").select(*columns).union(numbered.select(*columns))
