"""Aggregates, comparisons, rankings, extremes, quality, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsframe.operators import aggregates as A
from obsframe.operators.ordering import average_rank
from obsframe.plans.basics import HOLED, with_holes
from obsframe.plans.registry import EVENTS, LINES, ORDERS, query, rounded, table

FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("record_count", "SELECT count(*) AS records FROM lineitem")
def record_count(spark, sf_dir):
    return A.record_count(table(spark, sf_dir, "lineitem"))


@query("distinct_keys", "SELECT DISTINCT event_type FROM events")
def distinct_keys(spark, sf_dir):
    return A.distinct_keys(table(spark, sf_dir, "events"), EVENTS)


@query(
    "target_stats",
    """SELECT event_type, CAST(grouping(event_type) AS INTEGER) AS is_total, round(avg(value), 8) AS avg_value,
    min(value) AS min_value, max(value) AS max_value, count(value) AS n FROM events GROUP BY ROLLUP (event_type)""",
)
def target_stats(spark, sf_dir):
    return rounded(A.target_stats(table(spark, sf_dir, "events"), EVENTS))


def profile_sql(v: str) -> str:
    return f"""SELECT l_returnflag, '{v}' AS variable, count({v}) AS "count", round(avg({v}), 6) AS mean,
    round(stddev_samp({v}), 6) AS std, min({v}) AS "min", round(quantile_cont({v}, 0.25), 6) AS q25,
    round(quantile_cont({v}, 0.5), 6) AS q50, round(quantile_cont({v}, 0.75), 6) AS q75, max({v}) AS "max",
    round(var_samp({v}), 4) AS variance, round(skewness({v}), 6) + 0.0 AS skewness,
    round(kurtosis({v}), 6) AS kurtosis, round(max({v}) - min({v}), 6) AS "range",
    round(quantile_cont({v}, 0.75) - quantile_cont({v}, 0.25), 6) AS iqr,
    round(stddev_samp({v}) / avg({v}) * 100, 6) AS cv_pct FROM lineitem GROUP BY 1"""


@query("descriptive_stats", " UNION ALL ".join(profile_sql(v) for v in FEATURES))
def descriptive_stats(spark, sf_dir):
    df = A.descriptive_stats(table(spark, sf_dir, "lineitem"), LINES)
    return rounded(rounded(df, 4, ("variance",)), 6)


@query(
    "key_comparison",
    """WITH g AS (SELECT l_suppkey, avg(l_quantity) AS l_quantity_mean, min(l_quantity) AS l_quantity_min,
    max(l_quantity) AS l_quantity_max, stddev_samp(l_quantity) AS l_quantity_std,
    avg(l_extendedprice) AS l_extendedprice_mean, stddev_samp(l_extendedprice) AS l_extendedprice_std,
    avg(l_discount) AS l_discount_mean, max(l_discount) AS l_discount_max,
    avg(l_tax) AS l_tax_mean, stddev_samp(l_tax) AS l_tax_std FROM lineitem GROUP BY 1)
    SELECT l_suppkey, round(l_quantity_mean, 6) AS l_quantity_mean, l_quantity_min, l_quantity_max,
    round(l_quantity_std, 6) AS l_quantity_std, round(l_extendedprice_mean, 6) AS l_extendedprice_mean,
    round(l_extendedprice_std, 6) AS l_extendedprice_std, round(l_discount_mean, 6) AS l_discount_mean,
    l_discount_max, round(l_tax_mean, 6) AS l_tax_mean, round(l_tax_std, 6) AS l_tax_std,
    rank() OVER (ORDER BY l_quantity_mean DESC)
    + (count(*) OVER (PARTITION BY l_quantity_mean) - 1) / 2.0 AS l_quantity_rank FROM g""",
)
def key_comparison(spark, sf_dir):
    b = LINES.__class__(key=("l_suppkey",), ts="l_shipdate", values=FEATURES)
    return rounded(A.key_comparison(table(spark, sf_dir, "lineitem"), b), 6)


@query(
    "compare_keys",
    """SELECT o_orderpriority, count(o_totalprice) AS "count", round(avg(o_totalprice), 6) AS mean,
    round(median(o_totalprice), 6) AS median, round(stddev_samp(o_totalprice), 6) AS std,
    min(o_totalprice) AS "min", max(o_totalprice) AS "max",
    round(quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25), 6) AS iqr FROM orders GROUP BY 1""",
)
def compare_keys(spark, sf_dir):
    return rounded(A.compare_keys(table(spark, sf_dir, "orders"), ORDERS), 6)


@query(
    "overview_means",
    "SELECT l_returnflag, "
    + ", ".join(f"round(avg({v}), 6) AS avg_{v}" for v in FEATURES)
    + " FROM lineitem GROUP BY 1",
)
def overview_means(spark, sf_dir):
    return rounded(A.overview_means(table(spark, sf_dir, "lineitem"), LINES), 6)


@query(
    "latest_by_key",
    f"""SELECT event_type, max(ts) AS last_seen,
    arg_max(value, (ts, event_id)) FILTER (WHERE value IS NOT NULL) AS latest_value,
    arg_max(user_id, (ts, event_id)) FILTER (WHERE user_id IS NOT NULL) AS latest_user_id
    FROM ({HOLED}) GROUP BY 1""",
)
def latest_by_key(spark, sf_dir):
    return A.latest_by_key(with_holes(spark, sf_dir), EVENTS, ["value", "user_id"])


@query(
    "pair_compare",
    " UNION ALL ".join(
        f"""SELECT '{v}' AS variable, round(avg({v}) FILTER (WHERE l_returnflag = 'A'), 6) AS mean_a,
        round(avg({v}) FILTER (WHERE l_returnflag = 'R'), 6) AS mean_b,
        round(avg({v}) FILTER (WHERE l_returnflag = 'A') - avg({v}) FILTER (WHERE l_returnflag = 'R'), 6) + 0.0
        AS difference FROM lineitem"""
        for v in FEATURES
    ),
)
def pair_compare(spark, sf_dir):
    return rounded(A.pair_compare(table(spark, sf_dir, "lineitem"), LINES, "A", "R"), 6)


def box_sql(v: str) -> str:
    return f"""SELECT l_returnflag, '{v}' AS variable, min(x) FILTER (WHERE x BETWEEN lo AND hi) AS low_whisker,
    round(min(q1), 6) AS q25, round(min(q2), 6) AS median, round(min(q3), 6) AS q75,
    max(x) FILTER (WHERE x BETWEEN lo AND hi) AS high_whisker,
    count(*) FILTER (WHERE x NOT BETWEEN lo AND hi) AS outliers
    FROM (SELECT l_returnflag, {v} AS x, q1, q2, q3, q1 - (q3 - q1) * 1.5 AS lo, q3 + (q3 - q1) * 1.5 AS hi
    FROM lineitem JOIN (SELECT l_returnflag, quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS q2,
    quantile_cont({v}, 0.75) AS q3 FROM lineitem GROUP BY 1) USING (l_returnflag)) GROUP BY 1"""


@query("box_summary", " UNION ALL ".join(box_sql(v) for v in FEATURES[:3]))
def box_summary(spark, sf_dir):
    return rounded(A.box_summary(table(spark, sf_dir, "lineitem"), LINES.on(*FEATURES[:3])), 6)


@query(
    "collection_summary",
    """SELECT count(*) AS records, round(avg(value), 8) AS mean_value, min(value) AS min_value,
    (SELECT event_type FROM events ORDER BY value, ts, event_id LIMIT 1) AS min_key, max(value) AS max_value,
    (SELECT event_type FROM events ORDER BY value DESC, ts, event_id LIMIT 1) AS max_key FROM events""",
)
def collection_summary(spark, sf_dir):
    return rounded(A.collection_summary(table(spark, sf_dir, "events"), EVENTS))


LINE_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query(
    "find_extremes",
    " UNION ALL ".join(
        f"""(SELECT '{v}' AS variable, '{e}' AS extreme, {LINE_ORDER}, l_returnflag, {v} AS extreme_value
        FROM lineitem ORDER BY {v} {d}, {LINE_ORDER} LIMIT 1)"""
        for v in FEATURES
        for e, d in (("max", "DESC"), ("min", "ASC"))
    ),
)
def find_extremes(spark, sf_dir):
    cols = [*LINES.order, "l_returnflag", *FEATURES]
    out = A.find_extremes(table(spark, sf_dir, "lineitem"), LINES, cols)
    value = F.coalesce(*[F.when(F.col("variable") == v, F.col(v)) for v in FEATURES])
    return out.withColumn("extreme_value", value).drop(*FEATURES)


SUMMARY_SQL = """SELECT count(*) AS total_records, count(DISTINCT event_type) AS keys, min(ts) AS start_ts,
    max(ts) AS end_ts, CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000) AS BIGINT) AS duration_days,
    round(avg(value), 6) AS overall_mean, round(stddev_samp(value), 6) AS overall_std, min(value) AS overall_min,
    max(value) AS overall_max, round(max(value) - min(value), 6) AS value_range FROM events"""


@query("dataset_summary", SUMMARY_SQL)
def dataset_summary(spark, sf_dir):
    return rounded(A.dataset_summary(table(spark, sf_dir, "events"), EVENTS), 6)


@query(
    "key_rankings",
    """WITH g AS (SELECT l_returnflag, avg(l_quantity) AS m0, avg(l_extendedprice) AS m1 FROM lineitem GROUP BY 1)
    SELECT (SELECT l_returnflag FROM g ORDER BY m0 DESC LIMIT 1) AS highest_key, round(max(m0), 6) AS highest_mean,
    (SELECT l_returnflag FROM g ORDER BY m0 LIMIT 1) AS lowest_key, round(min(m0), 6) AS lowest_mean,
    (SELECT l_returnflag FROM g ORDER BY m1 DESC LIMIT 1) AS highest_second_key,
    round(max(m1), 6) AS highest_second_mean FROM g""",
)
def key_rankings(spark, sf_dir):
    return rounded(A.key_rankings(table(spark, sf_dir, "lineitem"), LINES), 6)


@query(
    "data_quality",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,
        round(100.0 * (count(event_id) + count(ts) + count(event_type) + count(value) + count(user_id))
        / (count(*) * 5), 6) AS completeness_pct FROM ({HOLED})"""
        for c in ("event_id", "ts", "event_type", "value", "user_id")
    ),
)
def data_quality(spark, sf_dir):
    return rounded(A.data_quality(with_holes(spark, sf_dir)), 6)


REPORT_COLS = ["l_returnflag", "l_shipdate", *FEATURES]


@query(
    "summary_report",
    """WITH s AS (SELECT count(*) AS n, count(DISTINCT l_returnflag) AS k, min(l_shipdate) AS a, max(l_shipdate) AS z,
    avg(l_quantity) AS m, stddev_samp(l_quantity) AS sd, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
    g AS (SELECT l_returnflag AS f, avg(l_quantity) AS m0, avg(l_extendedprice) AS m1 FROM lineitem GROUP BY 1),
    c AS ("""
    + " UNION ALL ".join(
        f"SELECT '{x}~{y}' AS metric, corr({x}, {y}) AS r FROM lineitem"
        for i, x in enumerate(FEATURES)
        for y in FEATURES[i + 1 :]
    )
    + """)
    SELECT 'dataset' AS section, unnest(['total_records', 'keys', 'start_ts', 'end_ts', 'duration_days',
    'overall_mean', 'overall_std', 'overall_min', 'overall_max', 'value_range']) AS metric,
    unnest([CAST(n AS VARCHAR), CAST(k AS VARCHAR), strftime(a, '%Y-%m-%d %H:%M:%S'), strftime(z, '%Y-%m-%d %H:%M:%S'),
    CAST(date_diff('day', a, z) AS VARCHAR), printf('%.8f', m), printf('%.8f', sd), printf('%.8f', lo),
    printf('%.8f', hi), printf('%.8f', hi - lo)]) AS value FROM s
    UNION ALL SELECT 'rankings', unnest(['highest_key', 'highest_mean', 'lowest_key', 'lowest_mean',
    'highest_second_key', 'highest_second_mean']), unnest([(SELECT f FROM g ORDER BY m0 DESC LIMIT 1),
    printf('%.8f', max(m0)), (SELECT f FROM g ORDER BY m0 LIMIT 1), printf('%.8f', min(m0)),
    (SELECT f FROM g ORDER BY m1 DESC LIMIT 1), printf('%.8f', max(m1))]) FROM g
    UNION ALL SELECT 'missing_values', unnest(['l_returnflag', 'l_shipdate', 'l_quantity', 'l_extendedprice',
    'l_discount', 'l_tax']), unnest([CAST(count(*) - count(l_returnflag) AS VARCHAR),
    CAST(count(*) - count(l_shipdate) AS VARCHAR), CAST(count(*) - count(l_quantity) AS VARCHAR),
    CAST(count(*) - count(l_extendedprice) AS VARCHAR), CAST(count(*) - count(l_discount) AS VARCHAR),
    CAST(count(*) - count(l_tax) AS VARCHAR)]) FROM lineitem
    UNION ALL SELECT 'data_quality', 'completeness_pct', printf('%.8f', 100.0 * (count(l_returnflag)
    + count(l_shipdate) + count(l_quantity) + count(l_extendedprice) + count(l_discount) + count(l_tax))
    / (count(*) * 6)) FROM lineitem
    UNION ALL SELECT 'correlations', metric, printf('%.8f', r) FROM c WHERE abs(round(r, 3)) >= 0.6""",
)
def summary_report(spark, sf_dir):
    return A.summary_report(table(spark, sf_dir, "lineitem"), LINES, REPORT_COLS)


@query(
    "avg_rank",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC)
    + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS quantity_rank FROM lineitem""",
)
def avg_rank(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_returnflag", *LINES.id, "l_quantity")
    return average_rank(df, ("l_returnflag",), "l_quantity", "quantity_rank", descending=True).drop("l_quantity")
