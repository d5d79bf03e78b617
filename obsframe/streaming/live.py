"""Continuous forms of ingest, windowed statistics, latest values and scoring."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.binding import Binding
from obsframe.functions.scalar import ntz
from obsframe.operators.anomaly import zscore_flags
from obsframe.session import link, scratch_dir
from obsframe.sources.observations import Parsed, parse_payload


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a zoned timestamp."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def read_stream(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*", fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).format(fmt).load(path)


def ingest(raw: DataFrame, body: str = "body") -> Parsed:
    """Payload parsing is row-wise, so the batch operator serves the stream as it is."""
    return parse_payload(raw, body)


def unique_keys(stream: DataFrame, b: Binding, delay: str = "1 day") -> DataFrame:
    """Drop repeats of (key, ts) that arrive within the watermark."""
    timed = event_time(stream, b.ts).withWatermark(b.ts, delay)
    return timed.dropDuplicatesWithinWatermark([*b.key, b.ts])


def window_stats(df: DataFrame, b: Binding, width: str = "6 hours", slide: str | None = None, delay: str | None = None) -> DataFrame:
    """Count, mean, min and max per key and time window; batch or stream."""
    timed = event_time(df, b.ts)
    if delay:
        timed = timed.withWatermark(b.ts, delay)
    v = b.value
    out = timed.groupBy(*b.key, F.window(b.ts, width, slide)).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean_value"), F.min(v).alias("min_value"), F.max(v).alias("max_value")
    )
    return out.select(
        *b.key, ntz("window.start").alias("window_start"), ntz("window.end").alias("window_end"),
        "n", "mean_value", "min_value", "max_value",
    )


def latest_values(stream: DataFrame, b: Binding) -> DataFrame:
    """Newest non-null target per key."""
    has = F.col(b.value).isNotNull()
    return stream.groupBy(*b.key).agg(
        F.max(b.ts).alias("last_seen"),
        F.max_by(b.value, F.when(has, F.struct(*b.order))).alias(f"latest_{b.value}"),
    )


def online_zscore(stream: DataFrame, baseline: DataFrame, b: Binding, threshold: float = 3.0) -> DataFrame:
    """Score arriving rows against a stored baseline (stream-static join, null keys included)."""
    return zscore_flags(link(stream, baseline, b.key), b, threshold)


def run_available(stream: DataFrame) -> DataFrame:
    """Process everything there is now, then return the rows written.

    Files and progress live under the shared checkpoint folder, so that a lost
    executor or driver resumes from the last finished batch.
    """
    spark = stream.sparkSession
    base = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = stream.schema
    writer = stream.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{base}/progress")
    writer.format("parquet").start(f"{base}/rows").awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/rows")


def keep_latest(stream: DataFrame, out: str, progress: str) -> None:
    """Process everything there is now in update mode: only the keys a batch changed leave the state.

    Each batch owns one folder, named by its number and overwritten if the batch runs again, so a replay
    changes nothing. ``read_latest`` lets the newest row of a key replace the earlier ones.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", progress)
    writer.foreachBatch(put).start().awaitTermination()


def read_latest(spark: SparkSession, schema: T.StructType, key: Sequence[str], out: str) -> DataFrame:
    """The row of every key as of the last batch written to ``out``."""
    rest = [c for c in schema.names if c not in key]
    held = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(out)
    newest = held.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("__row"))
    return newest.select(*key, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*schema.names)


def latest_available(stream: DataFrame, b: Binding) -> DataFrame:
    """Newest target per key over everything there is now, by changed keys only."""
    spark = stream.sparkSession
    base = f"{scratch_dir(spark)}/latest-{uuid.uuid4().hex}"
    latest = latest_values(stream, b)
    keep_latest(latest, f"{base}/rows", f"{base}/progress")
    return read_latest(spark, latest.schema, b.key, f"{base}/rows")
