"""The observation table: schemas, payload parsing, readers and the duplicate-free sink."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.session import cut, same

OBSERVATIONS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), False),
        T.StructField("city_name", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("feels_like", T.DoubleType()),
        T.StructField("temp_min", T.DoubleType()),
        T.StructField("temp_max", T.DoubleType()),
        T.StructField("pressure", T.IntegerType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("wind_direction", T.IntegerType()),
        T.StructField("cloudiness", T.IntegerType()),
        T.StructField("weather_main", T.StringType()),
        T.StructField("weather_description", T.StringType()),
        T.StructField("visibility", T.IntegerType()),
        T.StructField("rain_1h", T.DoubleType()),
        T.StructField("snow_1h", T.DoubleType()),
    ]
)
STATIONS = T.StructType(
    [
        T.StructField("city_name", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
    ]
)
PAYLOAD = """main struct<temp: double, feels_like: double, temp_min: double, temp_max: double, pressure: int, humidity: int>,
    wind struct<speed: double, deg: int>, clouds struct<all: int>,
    weather array<struct<main: string, description: string>>, visibility int,
    rain struct<`1h`: double>, snow struct<`1h`: double>"""


@dataclass(frozen=True)
class Parsed:
    accepted: DataFrame
    rejected: DataFrame


def parse_payload(raw: DataFrame, body: str = "body") -> Parsed:
    """Flatten raw JSON text; a record without every required part is rejected.

    Other columns of ``raw`` (station, arrival time) pass through. ``rejected``
    keeps the original text with the first missing part as the reason.
    """
    # generated rather than projected: otherwise each path would parse the text anew
    p = raw.withColumn("__p", F.explode(F.array(F.from_json(body, PAYLOAD))))
    p = p.withColumn("__w", F.get(F.col("__p.weather"), F.lit(0)))
    required = {
        "temperature": "__p.main.temp",
        "feels_like": "__p.main.feels_like",
        "temp_min": "__p.main.temp_min",
        "temp_max": "__p.main.temp_max",
        "pressure": "__p.main.pressure",
        "humidity": "__p.main.humidity",
        "wind_speed": "__p.wind.speed",
        "cloudiness": "__p.clouds.all",
        "weather_main": "__w.main",
        "weather_description": "__w.description",
    }
    optional = {
        "wind_direction": ("__p.wind.deg", F.lit(0)),
        "visibility": ("__p.visibility", F.lit(0)),
        "rain_1h": ("__p.rain.1h", F.lit(0.0)),
        "snow_1h": ("__p.snow.1h", F.lit(0.0)),
    }
    reason = F.coalesce(*[F.when(F.col(path).isNull(), F.lit(name)) for name, path in required.items()])
    fields = {n: F.col(path) for n, path in required.items()} | {
        n: F.coalesce(F.col(path), default) for n, (path, default) in optional.items()
    }
    flat = p.withColumn("reason", reason)
    through = [c for c in raw.columns if c != body]
    order = [f.name for f in OBSERVATIONS.fields if f.name in fields]
    return Parsed(
        accepted=flat.where(F.col("reason").isNull()).select(*through, *[fields[n].alias(n) for n in order]),
        rejected=flat.where(F.col("reason").isNotNull()).select(*raw.columns, "reason"),
    )


def collect(raw: DataFrame, stations: DataFrame, station: str = "city_name", body: str = "body") -> Parsed:
    """Parse landed payloads and add the coordinates of their station.

    Spark broadcasts the station list by its own size check.
    """
    parsed = parse_payload(raw, body)
    return Parsed(parsed.accepted.join(stations, station), parsed.rejected)


def new_rows(batch: DataFrame, existing: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of ``batch`` whose key the target does not hold yet, one per key.

    Which of several equal-keyed rows stays is fixed: the least one by its
    columns, so that a retried task or a rerun writes the same row.
    """
    rest = [c for c in batch.columns if c not in keys]
    least = F.min(F.struct(*rest)).alias("__row") if rest else F.lit(None).alias("__row")
    unique = batch.groupBy(*keys).agg(least)
    unique = unique.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*batch.columns)
    held = existing.select(*[F.col(k).alias(f"__{k}") for k in keys])
    return unique.join(held, same(unique, held, {k: f"__{k}" for k in keys}), "left_anti")


#: Partitions of a batch that are named one by one in the filter on the target.
PARTITIONS_NAMED = 1000
#: Types whose file statistics skip; floats are left out, because NaN has no place in them.
SPANNED = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def near_batch(existing: DataFrame, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """The rows of ``existing`` that can share a key with ``batch``.

    One aggregate of the batch gives its partitions and the span of every other key. The partitions cut the folders
    that are listed, the spans reach the file footers. A batch of more than ``PARTITIONS_NAMED`` partitions is
    cut by span alone. Null keys are kept if the batch has any. An empty batch reads nothing.
    """
    kinds = {f.name: f.dataType for f in existing.schema.fields}
    spanned = [k for k in keys if isinstance(kinds[k], SPANNED)]
    # bounds travel as text or microseconds: exact, and free of the driver's time zone
    exact = lambda c, k: F.unix_micros(c) if isinstance(kinds[k], T.TimestampType) else c.cast("string")
    back = lambda v, k: F.timestamp_micros(F.lit(v)) if isinstance(kinds[k], T.TimestampType) else F.lit(v).cast(kinds[k])
    ends = [x for k in spanned for x in (F.min(k).alias(f"lo_{k}"), F.max(k).alias(f"hi_{k}"), F.count_if(F.col(k).isNull()).alias(f"no_{k}"))]
    spans = cut(batch.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("__n"), *ends))
    whole = [
        x
        for k in spanned
        for x in (exact(F.min(f"lo_{k}"), k).alias(f"lo_{k}"), exact(F.max(f"hi_{k}"), k).alias(f"hi_{k}"), F.sum(f"no_{k}").alias(f"no_{k}"))
    ]
    found = spans.agg(F.count(F.lit(1)).alias("__parts"), *whole).first()
    if not found["__parts"]:
        return existing.where(F.lit(False))
    for k in spanned:
        lo, hi = found[f"lo_{k}"], found[f"hi_{k}"]
        inside = F.lit(False) if lo is None else F.col(k).between(back(lo, k), back(hi, k))
        existing = existing.where(inside | F.col(k).isNull() if found[f"no_{k}"] else inside)
    if found["__parts"] <= PARTITIONS_NAMED:
        for p in partition_by:
            if isinstance(kinds[p], SPANNED):
                names = [r[0] for r in spans.select(exact(F.col(p), p)).distinct().collect()]
                named = F.col(p).isin(*[back(v, p) for v in names if v is not None])
                existing = existing.where(named | F.col(p).isNull() if None in names else named)
    return existing


def append_new(spark: SparkSession, batch: DataFrame, path: str, keys=("timestamp", "city_name"), partition_by=("city_name",)) -> int:
    """Append only unseen keys to a Parquet table and return how many were added.

    Of the target only the partitions and the span of keys that the batch has are read.
    """
    batch = cut(batch)
    existing = read_table(spark, path, batch.schema)
    # materialised before the write: the anti-join reads the folder that the write adds to
    fresh = cut(new_rows(batch, near_batch(existing, batch, keys, partition_by), tuple(keys)))
    added = fresh.count()
    if added:
        stamped = fresh.withColumn("created_at", F.current_timestamp())
        order = [c for c in keys if c not in partition_by]
        stamped.sortWithinPartitions(*partition_by, *order).write.mode("append").partitionBy(*partition_by).parquet(path)
    return added


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def read_table(spark: SparkSession, path: str, schema: T.StructType = OBSERVATIONS) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    # partition columns come last in the folder layout
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = OBSERVATIONS) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Add to a CSV folder, creating it on first use; each part file carries the header."""
    df.write.mode("append").option("header", True).csv(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
