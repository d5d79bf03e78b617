"""Named queries with, where one exists, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.binding import Binding

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 8, only: tuple[str, ...] | None = None) -> DataFrame:
    """Round float columns so that summation order does not show; -0.0 becomes 0.0."""
    cols: list[Column] = []
    for field in df.schema.fields:
        if field.dataType.typeName() == "double" and (only is None or field.name in only):
            cols.append((F.round(field.name, digits) + F.lit(0.0)).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


EVENTS = Binding(key=("event_type",), ts="ts", values=("value",), id=("event_id",))
LINES = Binding(
    key=("l_returnflag",),
    ts="l_shipdate",
    values=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    id=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
)
ORDERS = Binding(key=("o_orderpriority",), ts="o_orderdate", values=("o_totalprice",), id=("o_orderkey",))
