"""Payload parsing, enrichment, duplicate-free append and streaming queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from obsframe.operators.anomaly import zscore_baseline
from obsframe.plans.registry import EVENTS, query, rounded, table
from obsframe.session import cut, scratch_dir
from obsframe.sources import observations as O
from obsframe.streaming import live


def payloads(spark, sf_dir):
    """Events as raw JSON texts, some of them with parts left out."""
    e = F.col("event_id")
    missing = lambda m, c: F.when(e % m != 0, c)
    user = F.col("user_id").cast("int")
    body = F.to_json(
        F.struct(
            missing(11, F.struct(
                F.col("value").alias("temp"), (F.col("value") - 1).alias("feels_like"),
                (F.col("value") - 2).alias("temp_min"), (F.col("value") + 2).alias("temp_max"),
                (F.lit(1000) + user % 50).alias("pressure"), missing(13, user % 101).alias("humidity"),
            )).alias("main"),
            F.struct((user % 20 / 2.0).alias("speed"), missing(3, user % 360).alias("deg")).alias("wind"),
            F.struct((user % 100).alias("all")).alias("clouds"),
            F.when(e % 17 == 0, F.array().cast("array<struct<main:string,description:string>>")).otherwise(
                F.array(F.struct(F.col("event_type").alias("main"), F.upper("event_type").alias("description")))
            ).alias("weather"),
            missing(5, F.get_json_object("props", "$.k").cast("int")).alias("visibility"),
            F.when(e % 7 == 0, F.struct((user % 10 / 4.0).alias("1h"))).alias("rain"),
        )
    )
    cut_off = F.when(e % 19 == 0, F.substring(body, 1, 20)).otherwise(body)
    return table(spark, sf_dir, "events").select("event_id", "ts", cut_off.alias("body"))


@query(
    "parse_payload",
    """SELECT event_id, ts, value AS temperature, value - 1 AS feels_like, value - 2 AS temp_min, value + 2 AS temp_max,
    CAST(1000 + user_id % 50 AS INTEGER) AS pressure, CAST(user_id % 101 AS INTEGER) AS humidity,
    (user_id % 20) / 2.0::DOUBLE AS wind_speed,
    CAST(CASE WHEN event_id % 3 <> 0 THEN user_id % 360 ELSE 0 END AS INTEGER) AS wind_direction,
    CAST(user_id % 100 AS INTEGER) AS cloudiness, event_type AS weather_main, upper(event_type) AS weather_description,
    CAST(CASE WHEN event_id % 5 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) ELSE 0 END AS INTEGER) AS visibility,
    CASE WHEN event_id % 7 = 0 THEN (user_id % 10) / 4.0::DOUBLE ELSE 0.0::DOUBLE END AS rain_1h, 0.0::DOUBLE AS snow_1h
    FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0""",
)
def parse_payload(spark, sf_dir):
    return O.parse_payload(payloads(spark, sf_dir)).accepted


@query(
    "reject_payload",
    """SELECT event_id, CASE WHEN event_id % 11 = 0 OR event_id % 19 = 0 THEN 'temperature' WHEN event_id % 13 = 0
    THEN 'humidity' ELSE 'weather_main' END AS reason FROM events
    WHERE event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0""",
)
def reject_payload(spark, sf_dir):
    return O.parse_payload(payloads(spark, sf_dir)).rejected.select("event_id", "reason")


@query(
    "enrich_dimension",
    """SELECT c_custkey, c_acctbal, n_name, r_name FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def enrich_dimension(spark, sf_dir):
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", "c_acctbal", "n_name", "r_name")
    )


@query(
    "dedup_append",
    """WITH held AS (SELECT * FROM orders WHERE o_orderstatus = 'F')
    SELECT * FROM held UNION ALL SELECT DISTINCT * FROM orders
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM held)""",
)
def dedup_append(spark, sf_dir):
    """The target holds the finished orders; the batch has all orders, and the urgent ones twice."""
    orders = table(spark, sf_dir, "orders")
    held = orders.where("o_orderstatus = 'F'")
    batch = orders.unionByName(orders.where("o_orderpriority = '1-URGENT'"))
    return held.unionByName(O.new_rows(batch, held, ("o_orderkey",)))


def window_sql(slide_hours: int) -> str:
    offsets = range(0, 6, slide_hours)
    parts = [
        f"""SELECT event_type, value, time_bucket(INTERVAL {slide_hours} HOUR, ts) - INTERVAL {o} HOUR AS window_start
        FROM events"""
        for o in offsets
    ]
    return f"""SELECT event_type, window_start, window_start + INTERVAL 6 HOUR AS window_end, count(value) AS n,
    round(avg(value), 10) AS mean_value, min(value) AS min_value, max(value) AS max_value
    FROM ({' UNION ALL '.join(parts)}) GROUP BY 1, 2"""


@query("tumbling_stats", window_sql(6))
def tumbling_stats(spark, sf_dir):
    return rounded(live.window_stats(table(spark, sf_dir, "events"), EVENTS), 10)


@query("sliding_stats", window_sql(1))
def sliding_stats(spark, sf_dir):
    return rounded(live.window_stats(table(spark, sf_dir, "events"), EVENTS, slide="1 hour"), 10)


def event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return live.read_stream(spark, sf_dir, schema, "events.parquet")


@query(
    "stream_tumbling",
    f"""WITH s AS ({window_sql(6)}) SELECT * FROM s
    WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
)
def stream_tumbling(spark, sf_dir):
    """Windows that the watermark has closed; their state is dropped once they are written."""
    stats = live.window_stats(event_stream(spark, sf_dir), EVENTS, delay="2 hours")
    return rounded(live.run_available(stats), 10)


@query("stream_unique", "SELECT event_id, ts, event_type, value FROM events")
def stream_unique(spark, sf_dir):
    """Every event arrives twice; each (type, time) is kept once."""
    stream = event_stream(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    # the file is one batch and not ordered by time: nothing may be late within it
    kept = live.run_available(live.unique_keys(twice, EVENTS, "60 days"))
    return kept.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "stream_latest",
    """SELECT event_type, max(ts) AS last_seen, arg_max(value, (ts, event_id)) AS latest_value FROM events GROUP BY 1""",
)
def stream_latest(spark, sf_dir):
    return live.latest_available(event_stream(spark, sf_dir), EVENTS)


@query(
    "stream_zscore",
    """SELECT event_id, ts, event_type, value, round((value - avg(value) OVER w) / stddev_samp(value) OVER w, 8) + 0.0
    AS z_score, abs((value - avg(value) OVER w) / stddev_samp(value) OVER w) > 3 AS is_anomaly
    FROM events WINDOW w AS (PARTITION BY event_type)""",
)
def stream_zscore(spark, sf_dir):
    # written once: otherwise every micro-batch would read all history again
    history = cut(zscore_baseline(table(spark, sf_dir, "events"), EVENTS))
    stream = event_stream(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    return rounded(live.run_available(live.online_zscore(stream, history, EVENTS)))


@query(
    "stream_ingest",
    """SELECT event_id, value AS temperature, CAST(user_id % 101 AS INTEGER) AS humidity FROM events
    WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0""",
)
def stream_ingest(spark, sf_dir):
    """Payload texts land as files; a stream parses them."""
    landed = f"{scratch_dir(spark)}/landed-{uuid.uuid4().hex}"
    raw = payloads(spark, sf_dir)
    raw.write.json(landed)
    parsed = live.ingest(live.read_stream(spark, landed, raw.schema, fmt="json")).accepted
    return live.run_available(parsed).select("event_id", "temperature", "humidity")
