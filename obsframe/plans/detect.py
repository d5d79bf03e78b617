"""Anomaly detection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.operators import anomaly as N
from obsframe.plans.profiles import FEATURES
from obsframe.plans.registry import EVENTS, LINES, query, rounded, table

BASE_SQL = "event_id, ts, event_type, value"
Z_SQL = """z AS (SELECT event_id, ts, event_type, value, (value - avg(value) OVER w) / stddev_samp(value) OVER w AS z_score
    FROM events WINDOW w AS (PARTITION BY event_type))"""
FENCE_SQL = """f AS (SELECT event_type, quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75)
    - quantile_cont(value, 0.25)) AS lo, quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75)
    - quantile_cont(value, 0.25)) AS hi FROM events GROUP BY 1),
    q AS (SELECT event_id, ts, event_type, value, lo, hi, CASE WHEN value < lo THEN lo - value
    WHEN value > hi THEN value - hi ELSE 0.0 END AS score FROM events JOIN f USING (event_type))"""


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")


@query(
    "anomaly_zscore",
    f"WITH {Z_SQL} SELECT {BASE_SQL}, round(z_score, 8) + 0.0 AS z_score, abs(z_score) > 3 AS is_anomaly FROM z",
)
def anomaly_zscore(spark, sf_dir):
    return rounded(N.zscore(events(spark, sf_dir), EVENTS))


@query(
    "anomaly_iqr",
    f"""WITH {FENCE_SQL} SELECT {BASE_SQL}, round(lo, 8) + 0.0 AS lower_fence, round(hi, 8) AS upper_fence,
    round(score, 8) + 0.0 AS score, score > 0 AS is_anomaly FROM q""",
)
def anomaly_iqr(spark, sf_dir):
    return rounded(N.iqr(events(spark, sf_dir), EVENTS))


def holed_lines(spark, sf_dir):
    cols = [F.when(F.col("l_orderkey") % 13 != i, F.col(v)).alias(v) for i, v in enumerate(FEATURES)]
    return table(spark, sf_dir, "lineitem").select("l_returnflag", *LINES.id, *cols)


def scale_sql(v: str, i: int) -> str:
    return f"CASE WHEN l_orderkey % 13 <> {i} THEN {v} END AS {v}"


@query(
    "impute_scale",
    f"""WITH h AS (SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    {', '.join(scale_sql(v, i) for i, v in enumerate(FEATURES))} FROM lineitem),
    m AS (SELECT l_returnflag, {', '.join(f'median({v}) AS {v}_m' for v in FEATURES)} FROM h GROUP BY 1),
    c AS (SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    {', '.join(f'coalesce({v}, {v}_m) AS {v}' for v in FEATURES)} FROM h JOIN m USING (l_returnflag))
    SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    {', '.join(f'round(({v} - avg({v}) OVER w) / stddev_pop({v}) OVER w, 6) + 0.0 AS {v}_scaled' for v in FEATURES)}
    FROM c WINDOW w AS (PARTITION BY l_returnflag)""",
)
def impute_scale(spark, sf_dir):
    out = N.impute_scale(holed_lines(spark, sf_dir), LINES)
    return rounded(out.select("l_returnflag", *LINES.id, *[f"{v}_scaled" for v in FEATURES]), 6)


@query(
    "vote_consensus",
    f"""WITH {Z_SQL}, {FENCE_SQL}, u AS (SELECT event_type, event_id, 'zscore' AS method FROM z WHERE abs(z_score) > 3
    UNION ALL SELECT event_type, event_id, 'iqr' FROM q WHERE score > 0
    UNION ALL SELECT event_type, event_id, 'zscore_strict' FROM z WHERE abs(z_score) > 4)
    SELECT event_type, event_id, count(*) AS vote_count, string_agg(method, ',' ORDER BY method) AS methods,
    3 AS max_votes, round(100.0 * count(*) / 3, 8) AS vote_pct FROM u GROUP BY 1, 2 HAVING count(*) >= 2""",
)
def vote_consensus(spark, sf_dir):
    out = N.vote(sql_members(spark, sf_dir), EVENTS, threshold=2)
    return rounded(out.withColumn("methods", F.concat_ws(",", "methods")))


def sql_members(spark, sf_dir):
    df = events(spark, sf_dir)
    return {
        "zscore": N.zscore(df, EVENTS),
        "iqr": N.iqr(df, EVENTS),
        "zscore_strict": N.zscore(df, EVENTS, threshold=4.0),
    }


@query(
    "vote_distribution",
    f"""WITH {Z_SQL}, {FENCE_SQL}, u AS (SELECT event_type, event_id FROM z WHERE abs(z_score) > 3
    UNION ALL SELECT event_type, event_id FROM q WHERE score > 0
    UNION ALL SELECT event_type, event_id FROM z WHERE abs(z_score) > 4),
    v AS (SELECT event_type, event_id, count(*) AS vote_count FROM u GROUP BY 1, 2)
    SELECT event_type, vote_count, count(*) AS n_rows FROM v GROUP BY 1, 2""",
)
def vote_distribution(spark, sf_dir):
    return N.vote_distribution(sql_members(spark, sf_dir), EVENTS)


@query(
    "method_comparison",
    f"""WITH {Z_SQL}, {FENCE_SQL}, u AS (SELECT event_type, 'zscore' AS method, abs(z_score) > 3 AS hit FROM z
    UNION ALL SELECT event_type, 'iqr', score > 0 FROM q)
    SELECT event_type, method, count(*) FILTER (WHERE hit) AS anomalies, count(*) AS n, 'ok' AS status,
    round(100.0 * count(*) FILTER (WHERE hit) / count(*), 8) AS pct FROM u GROUP BY 1, 2""",
)
def method_comparison(spark, sf_dir):
    df = events(spark, sf_dir)
    return rounded(N.compare_methods({"zscore": N.zscore(df, EVENTS), "iqr": N.iqr(df, EVENTS)}, EVENTS))


@query(
    "consensus_share",
    f"""WITH {Z_SQL}, {FENCE_SQL}, u AS (SELECT event_type, event_id FROM z WHERE abs(z_score) > 3
    UNION ALL SELECT event_type, event_id FROM q WHERE score > 0
    UNION ALL SELECT event_type, event_id FROM z WHERE abs(z_score) > 4),
    v AS (SELECT event_type, event_id FROM u GROUP BY 1, 2 HAVING count(*) >= 2),
    c AS (SELECT event_type, count(*) AS hits FROM v GROUP BY 1),
    t AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
    SELECT event_type, n, coalesce(hits, 0) AS n_consensus, round(100.0 * coalesce(hits, 0) / n, 8) AS consensus_pct
    FROM t LEFT JOIN c USING (event_type)""",
)
def consensus_share(spark, sf_dir):
    consensus = N.vote(sql_members(spark, sf_dir), EVENTS, threshold=2)
    return rounded(N.consensus_share(events(spark, sf_dir), EVENTS, consensus))


@query(
    "anomaly_summary",
    f"""WITH {Z_SQL}, {FENCE_SQL}, a AS (SELECT event_type, count(*) AS n, count(*) FILTER (WHERE abs(z_score) > 3) AS z
    FROM z GROUP BY 1), b AS (SELECT event_type, count(*) FILTER (WHERE score > 0) AS q FROM q GROUP BY 1)
    SELECT event_type, n AS total_points, z AS zscore_anomalies, q AS iqr_outliers, round(100.0 * z / n, 8) AS zscore_pct,
    round(100.0 * q / n, 8) AS iqr_pct FROM a JOIN b USING (event_type)""",
)
def anomaly_summary(spark, sf_dir):
    return rounded(N.summary(events(spark, sf_dir), EVENTS))


def advice_sql(rows) -> str:
    return "[" + ", ".join(f"{{'method': '{m}', 'reason': '{r}', 'priority': '{p}'}}" for m, r, p in rows) + "]"


@query(
    "method_recommendation",
    f"""WITH g AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), e AS (SELECT o_custkey, n, unnest(
    CASE WHEN n < 30 THEN {advice_sql(N.SMALL_ADVICE + N.WIDE_ADVICE)}
    WHEN n < 100 THEN {advice_sql(N.MEDIUM_ADVICE + N.WIDE_ADVICE)}
    ELSE {advice_sql(N.LARGE_ADVICE + N.WIDE_ADVICE)} END) AS a FROM g)
    SELECT o_custkey, n AS n_samples, 4 AS n_features, n / 4.0::DOUBLE AS sample_to_feature_ratio, a.method AS method,
    a.reason AS reason, a.priority AS priority FROM e""",
)
def method_recommendation(spark, sf_dir):
    b = Binding(key=("o_custkey",), ts="o_orderdate", values=("a", "b", "c", "d"))
    return N.recommend(table(spark, sf_dir, "orders"), b)
