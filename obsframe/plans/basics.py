"""Scans, filters, scalar projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsframe.functions import scalar as S
from obsframe.operators import filters
from obsframe.plans.registry import EVENTS, ORDERS, query, rounded, table


@query("scan_all", "SELECT * FROM orders")
def scan_all(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@query("scan_ordered", "SELECT * FROM events ORDER BY ts, event_id")
def scan_ordered(spark, sf_dir):
    return filters.ordered(table(spark, sf_dir, "events"), EVENTS)


@query("filter_key", "SELECT * FROM events WHERE event_type = 'click'")
def filter_key(spark, sf_dir):
    return filters.for_key(table(spark, sf_dir, "events"), EVENTS, "click")


@query(
    "filter_recent",
    """SELECT * FROM events WHERE event_type = 'click'
    AND ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY ORDER BY ts DESC, event_id DESC""",
)
def filter_recent(spark, sf_dir):
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return filters.recent(table(spark, sf_dir, "events"), EVENTS, "click", as_of, days=7)


@query("filter_isin", "SELECT * FROM events WHERE event_type IN ('click', 'purchase')")
def filter_isin(spark, sf_dir):
    return filters.for_keys(table(spark, sf_dir, "events"), EVENTS, ["click", "purchase"])


HOLED = """SELECT event_id, ts, event_type,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value,
    CASE WHEN event_id % 23 = 0 THEN NULL ELSE user_id END AS user_id FROM events"""


def with_holes(spark, sf_dir):
    """Events with nulls at fixed places, as the tables themselves have none."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "event_type",
        F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 23 != 0, F.col("user_id")).alias("user_id"),
    )


@query("dropna_any", f"SELECT * FROM ({HOLED}) WHERE value IS NOT NULL AND user_id IS NOT NULL")
def dropna_any(spark, sf_dir):
    return filters.complete_rows(with_holes(spark, sf_dir), ["value", "user_id"])


@query(
    "label_effect",
    """SELECT event_id, CASE WHEN abs(value - 20) / 20 < 0.2 THEN 'negligible'
    WHEN abs(value - 20) / 20 < 0.5 THEN 'small' WHEN abs(value - 20) / 20 < 0.8 THEN 'medium'
    ELSE 'large' END AS effect,
    CASE WHEN abs(value - 20) / 1000 < 0.01 THEN 'stable' WHEN value - 20 > 0 THEN 'increasing'
    ELSE 'decreasing' END AS direction,
    CASE WHEN value / 400 > 0.7 THEN 'strong' WHEN value / 400 > 0.3 THEN 'moderate'
    ELSE 'weak' END AS fit,
    CASE WHEN value / 400 > 0.6 THEN 'strong' WHEN value / 400 > 0.3 THEN 'moderate'
    ELSE 'weak' END AS component FROM events""",
)
def label_effect(spark, sf_dir):
    v = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        S.effect_label((v - 20) / 20).alias("effect"),
        S.direction_label((v - 20) / 1000).alias("direction"),
        S.fit_label(v / 400).alias("fit"),
        S.component_label(v / 400).alias("component"),
    )


@query("format_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS ts_text FROM events")
def format_ts(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.format_minute("ts").alias("ts_text"))


@query(
    "temporal_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
    CAST(month(ts) AS INTEGER) AS month, CAST(dayofyear(ts) AS INTEGER) AS day_of_year FROM events""",
)
def temporal_parts(spark, sf_dir):
    parts = S.calendar("ts")
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


CYCLE_SQL = ", ".join(
    f"round({fn}(2 * pi() * {part} / {period}), 8) + 0.0 AS {name}_{fn}"
    for name, part, period in [
        ("hour", "hour(ts)", 24),
        ("day_of_week", "(isodow(ts) - 1)", 7),
        ("month", "month(ts)", 12),
    ]
    for fn in ("sin", "cos")
)


@query("cyclical_features", f"SELECT event_id, {CYCLE_SQL} FROM events")
def cyclical_features(spark, sf_dir):
    parts = S.cyclical("ts")
    df = table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])
    return rounded(df)


@query(
    "binary_flags",
    """SELECT event_id, CASE WHEN isodow(ts) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour(ts) BETWEEN 6 AND 18 THEN 1 ELSE 0 END AS is_daytime FROM events""",
)
def binary_flags(spark, sf_dir):
    flags = S.day_flags("ts")
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in flags.items()])


@query(
    "interaction_features",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    round(l_extendedprice * l_quantity / 100.0, 6) AS interaction,
    round(l_extendedprice - l_quantity * 0.3, 6) AS wind_chill_index FROM lineitem""",
)
def interaction_features(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        S.interaction("l_extendedprice", "l_quantity").alias("interaction"),
        S.wind_chill("l_extendedprice", "l_quantity").alias("wind_chill_index"),
    )
    return rounded(df, 6)


@query(
    "heat_index",
    """SELECT event_id, round((0.5 * ((value * 9.0 / 5.0 + 32.0) + 61.0 + ((value * 9.0 / 5.0 + 32.0) - 68.0) * 1.2
    + (user_id % 101) * 0.094) - 32.0) * 5.0 / 9.0, 6) AS heat_index FROM events""",
)
def heat_index(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        "event_id", "value", (F.col("user_id") % 101).cast("double").alias("humidity")
    )
    return rounded(df.select("event_id", S.heat_index("value", "humidity").alias("heat_index")), 6)


@query("latest_n", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def latest_n(spark, sf_dir):
    return filters.latest(table(spark, sf_dir, "events"), EVENTS, 10)


@query(
    "raw_page",
    """SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100""",
)
def raw_page(spark, sf_dir):
    picked = filters.for_keys(table(spark, sf_dir, "orders"), ORDERS, ["1-URGENT", "2-HIGH"])
    return filters.latest(picked, ORDERS, 100)


@query(
    "recent_per_key",
    """SELECT event_type, event_id, ts, value, recency FROM (SELECT *, CAST(row_number() OVER
    (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS INTEGER) AS recency FROM events) WHERE recency <= 10""",
)
def recent_per_key(spark, sf_dir):
    df = filters.recent_per_key(table(spark, sf_dir, "events"), EVENTS, 10)
    return df.select("event_type", "event_id", "ts", "value", "recency")
