"""Row selection and top-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsframe.binding import Binding


def ordered(df: DataFrame, b: Binding, descending: bool = False) -> DataFrame:
    cols = [F.col(c).desc() if descending else F.col(c).asc() for c in b.order]
    return df.orderBy(*cols)


def for_key(df: DataFrame, b: Binding, key) -> DataFrame:
    return df.where(F.col(b.key[0]) == F.lit(key))


def for_keys(df: DataFrame, b: Binding, keys: Sequence) -> DataFrame:
    return df.where(F.col(b.key[0]).isin(*keys))


def recent(df: DataFrame, b: Binding, key, as_of: Column, days: int = 7) -> DataFrame:
    """Rows of one key from the last ``days`` before ``as_of``, newest first."""
    since = as_of - F.make_interval(days=F.lit(days))
    return ordered(for_key(df, b, key).where(F.col(b.ts) >= since), b, descending=True)


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def latest(df: DataFrame, b: Binding, limit: int = 10) -> DataFrame:
    return ordered(df, b, descending=True).limit(limit)


def recent_per_key(df: DataFrame, b: Binding, n: int = 10) -> DataFrame:
    """The newest ``n`` rows of every key; Spark cuts each task's input to n per key first."""
    w = W.partitionBy(*b.key).orderBy(*[F.col(c).desc() for c in b.order])
    return df.withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= n)
