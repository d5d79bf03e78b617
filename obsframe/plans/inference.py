"""Correlation, trend, hypothesis tests, residual diagnostics."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.functions import special
from obsframe.operators import correlate as C
from obsframe.operators import hypothesis as H
from obsframe.plans.profiles import FEATURES
from obsframe.plans.registry import EVENTS, LINES, query, rounded, table

KINDS = ("click", "error", "purchase", "signup", "view")
PAIRS = tuple(combinations(KINDS, 2))
PAIRS_SQL = "pairs AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{z}')" for a, z in PAIRS) + ") p(key_a, key_b))"


@query(
    "corr_pearson",
    " UNION ALL ".join(
        f"""SELECT l_returnflag, '{x}' AS var1, '{y}' AS var2, round(corr({x}, {y}), 8) + 0.0 AS r, count(*) AS n
        FROM lineitem GROUP BY 1"""
        for x, y in combinations(FEATURES, 2)
    ),
)
def corr_pearson(spark, sf_dir):
    return rounded(C.pearson(table(spark, sf_dir, "lineitem"), LINES))


RANKS = ", ".join(
    f"""rank() OVER (PARTITION BY l_returnflag ORDER BY {v})
    + (count(*) OVER (PARTITION BY l_returnflag, {v}) - 1) / 2.0 AS {v}"""
    for v in FEATURES
)


@query(
    "corr_spearman",
    f"WITH k AS (SELECT l_returnflag, {RANKS} FROM lineitem) "
    + " UNION ALL ".join(
        f"""SELECT l_returnflag, '{x}' AS var1, '{y}' AS var2, round(corr({x}, {y}), 8) + 0.0 AS r, count(*) AS n
        FROM k GROUP BY 1"""
        for x, y in combinations(FEATURES, 2)
    ),
)
def corr_spearman(spark, sf_dir):
    return rounded(C.spearman(table(spark, sf_dir, "lineitem"), LINES))


@query(
    "corr_kendall",
    """WITH p AS (SELECT a.event_type, sum(sign(a.value - b.value) * sign(a.user_id - b.user_id)) AS s,
    sum(CAST(a.value <> b.value AS INTEGER)) AS nx, sum(CAST(a.user_id <> b.user_id AS INTEGER)) AS ny
    FROM events a JOIN events b ON a.event_type = b.event_type AND a.event_id < b.event_id GROUP BY 1),
    c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
    SELECT event_type, 'value' AS var1, 'user_id' AS var2,
    round(s / (sqrt(CAST(nx AS DOUBLE)) * sqrt(CAST(ny AS DOUBLE))), 8) + 0.0 AS r, n FROM p JOIN c USING (event_type)""",
)
def corr_kendall(spark, sf_dir):
    return rounded(C.kendall(table(spark, sf_dir, "events"), EVENTS.on("value", "user_id")))


@query(
    "kendall_score",
    """WITH p AS (SELECT sum(sign(a.value - b.value) * sign(a.user_id - b.user_id)) AS s
    FROM events a JOIN events b ON a.event_id < b.event_id),
    x AS (SELECT count(*) AS t FROM events GROUP BY value), y AS (SELECT count(*) AS t FROM events GROUP BY user_id),
    c AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM events),
    vx AS (SELECT sum(t * (t - 1) * (2 * t + 5)) AS v, sum(t * (t - 1)) AS a, sum(t * (t - 1) * (t - 2)) AS b FROM x),
    vy AS (SELECT sum(t * (t - 1) * (2 * t + 5)) AS v, sum(t * (t - 1)) AS a, sum(t * (t - 1) * (t - 2)) AS b FROM y)
    SELECT 'value' AS var1, 'user_id' AS var2, CAST(n AS BIGINT) AS n,
    round(s / sqrt((n * (n - 1) * (2 * n + 5) - vx.v - vy.v) / 18 + CAST(vx.a AS DOUBLE) * vy.a / (2 * n * (n - 1))
    + CAST(vx.b AS DOUBLE) * vy.b / (9 * n * (n - 1) * (n - 2))), 6) + 0.0 AS statistic FROM p, c, vx, vy""",
)
def kendall_score(spark, sf_dir):
    b = EVENTS.on("value", "user_id")
    df = C.strong_correlations(table(spark, sf_dir, "events"), b, threshold=0.0, method="kendall")
    return rounded(df.select("var1", "var2", "n", "statistic"), 6)


DERIVED = ("l_quantity", "l_extendedprice", "revenue", "charge")
DERIVED_SQL = """d AS (SELECT l_quantity, l_extendedprice, l_extendedprice * (1 - l_discount) AS revenue,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem)"""


@query(
    "strong_correlations",
    f"WITH {DERIVED_SQL}, c AS ("
    + " UNION ALL ".join(
        f"SELECT '{x}' AS var1, '{y}' AS var2, corr({x}, {y}) AS r, count(*) AS n FROM d"
        for x, y in combinations(DERIVED, 2)
    )
    + """) SELECT var1, var2, round(r, 8) AS r, n, round(r * sqrt((n - 2) / (1 - r * r)), 4) AS statistic,
    CASE WHEN r > 0 THEN 'strong positive' ELSE 'strong negative' END AS strength, 'pearson' AS method
    FROM c WHERE abs(round(r, 3)) >= 0.7""",
)
def strong_correlations(spark, sf_dir):
    df = C.strong_correlations(derived(spark, sf_dir), LINES.on(*DERIVED)).drop("p_value", "is_significant")
    return rounded(rounded(df, 4, ("statistic",)))


def derived(spark, sf_dir):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select(
        "l_quantity", "l_extendedprice", net.alias("revenue"), (net * (1 + F.col("l_tax"))).alias("charge")
    )


@query("strong_correlation_p")
def strong_correlation_p(spark, sf_dir):
    parts = [
        C.strong_correlations(table(spark, sf_dir, "lineitem"), LINES, threshold=0.0, method=m)
        for m in ("pearson", "spearman")
    ]
    return parts[0].unionByName(parts[1]).select("method", "var1", "var2", "r", "p_value", "is_significant")


POS_SQL = """pos AS (SELECT event_id, event_type, ts, value, CAST(row_number() OVER (PARTITION BY event_type
    ORDER BY ts, event_id) - 1 AS DOUBLE) AS x FROM events)"""
FIT_SQL = f"""{POS_SQL}, fit AS (SELECT event_type, count(*) AS n, regr_slope(value, x) AS slope,
    regr_intercept(value, x) AS intercept, regr_r2(value, x) AS r2, regr_sxx(value, x) AS sxx,
    regr_syy(value, x) AS syy FROM pos GROUP BY 1)"""
RES_SQL = f"""{FIT_SQL}, res AS (SELECT event_id, event_type, ts, n, x, value - (intercept + slope * x) AS e
    FROM pos JOIN fit USING (event_type))"""


@query(
    "linear_trend",
    f"""WITH {FIT_SQL}, s AS (SELECT *, sqrt((1 - r2) * syy / (sxx * (n - 2))) AS se FROM fit)
    SELECT event_type, n, round(slope, 8) + 0.0 AS slope, round(intercept, 8) AS intercept, round(r2, 8) AS r_squared,
    round(se, 8) AS std_error, round(slope / se, 6) + 0.0 AS t_statistic,
    CASE WHEN abs(slope) < 0.01 THEN 'stable' WHEN slope > 0 THEN 'increasing' ELSE 'decreasing' END AS trend_direction,
    abs(slope) >= 0.01 AS is_practically_significant FROM s""",
)
def linear_trend(spark, sf_dir):
    df = H.linear_trend(table(spark, sf_dir, "events"), EVENTS).drop("p_value", "is_significant", "interpretation")
    return rounded(rounded(df, 6, ("t_statistic",)))


@query("linear_trend_p")
def linear_trend_p(spark, sf_dir):
    df = H.linear_trend(table(spark, sf_dir, "events"), EVENTS)
    return df.select("event_type", "p_value", "is_significant", "interpretation")


def critical_t(df: str) -> str:
    """Two-sided 5% point of t for large df, by the expansion around the normal point."""
    z = 1.959963984540054
    first, second = (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96
    return f"({z!r} + {first!r} / {df} + {second!r} / ({df} * {df}))"


@query(
    "trend_significance",
    f"""WITH {FIT_SQL} SELECT event_type, abs(slope / sqrt((1 - r2) * syy / (sxx * (n - 2)))) > {critical_t('(n - 2)')}
    AS is_significant FROM fit""",
)
def trend_significance(spark, sf_dir):
    return linear_trend_p(spark, sf_dir).select("event_type", "is_significant")


@query(
    "durbin_watson",
    f"""WITH {RES_SQL}, l AS (SELECT event_type, e, e - lag(e) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS d
    FROM res) SELECT event_type, round(sum(d * d) / sum(e * e), 8) AS durbin_watson,
    sum(d * d) / sum(e * e) > 1.5 AND sum(d * d) / sum(e * e) < 2.5 AS is_independent FROM l GROUP BY 1""",
)
def durbin_watson(spark, sf_dir):
    return rounded(H.durbin_watson(H.trend_residuals(table(spark, sf_dir, "events"), EVENTS), EVENTS))


@query(
    "levene_halves",
    f"""WITH {RES_SQL}, h AS (SELECT event_type, e, x < floor(n / 2) AS half FROM res),
    m AS (SELECT event_type, half, median(e) AS med FROM h GROUP BY 1, 2),
    z AS (SELECT event_type, half, abs(e - med) AS z FROM h JOIN m USING (event_type, half)),
    g AS (SELECT event_type, half, count(*) AS n, avg(z) AS zm, var_pop(z) AS zv FROM z GROUP BY 1, 2),
    a AS (SELECT event_type, count(*) AS k, sum(n) AS n, sum(n * zv) AS w,
    sum(n * zm * zm) - sum(n * zm) * sum(n * zm) / sum(n) AS b FROM g GROUP BY 1)
    SELECT event_type, CAST(n AS BIGINT) AS n, round((n - k) * b / ((k - 1) * w), 6) AS levene_w FROM a""",
)
def levene_halves(spark, sf_dir):
    df = H.levene_halves(H.trend_residuals(table(spark, sf_dir, "events"), EVENTS), EVENTS)
    return rounded(df.drop("p_value"), 6)


@query(
    "residual_diagnostics",
    f"""WITH {RES_SQL}, l AS (SELECT event_type, e, lag(e) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS p
    FROM res) SELECT event_type, count(e) AS n, round(avg(e), 6) + 0.0 AS mean_residual,
    round(stddev_pop(e), 8) AS std_residual, round(corr(e, p), 8) + 0.0 AS lag_1_acf,
    abs(avg(e)) < 0.1 * stddev_pop(e) AS is_zero_mean, abs(corr(e, p)) < 0.2 AS is_white_noise FROM l GROUP BY 1""",
)
def residual_diagnostics(spark, sf_dir):
    df = H.residual_diagnostics(H.trend_residuals(table(spark, sf_dir, "events"), EVENTS), EVENTS)
    return rounded(rounded(df, 6, ("mean_residual",)))


def weights_sql(source: str, key: str, p: str = "") -> str:
    """CTEs up to ``w``: Shapiro-Wilk W of column x of ``source`` per key, by ranks and weights;
    ``p`` goes before the names of the CTEs."""
    near = f"q * {special.ratio_sql('(0.180625 - q * q)', special.NEAR)}"
    far = f"sign(q) * {special.ratio_sql('(t - 1.6)', special.FAR)}"
    farthest = f"sign(q) * {special.ratio_sql('(t - 5.0)', special.FARTHEST)}"
    edge = lambda c: " + ".join(f"{v!r} * pow(1 / sqrt(n), {i})" for i, v in enumerate(c))
    return f"""{p}r AS (SELECT {key}, x, row_number() OVER (PARTITION BY {key} ORDER BY x) AS i,
    count(*) OVER (PARTITION BY {key}) AS n, avg(x) OVER (PARTITION BY {key}) AS centre FROM {source}),
    {p}q AS (SELECT *, (i - 0.375) / (n + 0.25) - 0.5 AS q FROM {p}r),
    {p}t AS (SELECT *, sqrt(-ln(0.5 - abs(q))) AS t FROM {p}q),
    {p}m AS (SELECT *, CASE WHEN abs(q) <= 0.425 THEN {near} WHEN t <= 5 THEN {far} ELSE {farthest} END AS m FROM {p}t),
    {p}s AS (SELECT {key}, n, sum(m * m) AS ss, max(m) FILTER (WHERE i = n) AS m1, max(m) FILTER (WHERE i = n - 1) AS m2
    FROM {p}m WHERE n >= 3 GROUP BY 1, 2),
    {p}a AS (SELECT *, CASE WHEN n = 3 THEN sqrt(0.5) ELSE m1 / sqrt(ss) + {edge(H.LAST_WEIGHT)} END AS a1,
    CASE WHEN n > 5 THEN m2 / sqrt(ss) + {edge(H.NEXT_WEIGHT)} END AS a2 FROM {p}s),
    {p}f AS (SELECT *, (ss - 2 * m1 * m1 - CASE WHEN n > 5 THEN 2 * m2 * m2 ELSE 0 END)
    / (1 - 2 * a1 * a1 - coalesce(2 * a2 * a2, 0)) AS phi FROM {p}a),
    {p}g AS (SELECT m.{key}, m.n, x - centre AS off, sign(m) * CASE WHEN least(i - 1, m.n - i) = 0 THEN a1
    WHEN least(i - 1, m.n - i) = 1 AND a2 IS NOT NULL THEN a2 WHEN m = 0 THEN 0 ELSE abs(m) / sqrt(phi) END AS a
    FROM {p}m m JOIN {p}f f ON m.{key} = f.{key}),
    {p}w AS (SELECT {key}, n, round(least(pow(sum(a * off), 2) / sum(off * off), 1.0), 6) AS w FROM {p}g GROUP BY 1, 2)"""


@query("shapiro")
def shapiro(spark, sf_dir):
    return H.shapiro(table(spark, sf_dir, "events"), EVENTS.key, "value")


@query(
    "shapiro_w",
    f"""WITH v AS (SELECT event_type, value AS x FROM events), {weights_sql('v', 'event_type')} SELECT * FROM w""",
)
def shapiro_w(spark, sf_dir):
    return rounded(shapiro(spark, sf_dir).select("event_type", "n", "w"), 6)


@query(
    "shapiro_w_by_customer",
    f"""WITH v AS (SELECT o_custkey, o_totalprice AS x FROM orders), {weights_sql('v', 'o_custkey')} SELECT * FROM w""",
)
def shapiro_w_by_customer(spark, sf_dir):
    return rounded(shapiro_by_customer(spark, sf_dir).where("w is not null").select("o_custkey", "n", "w"), 6)


@query(
    "residual_checks",
    f"""WITH {RES_SQL}, v AS (SELECT event_type, e AS x FROM res), {weights_sql('v', 'event_type')},
    l AS (SELECT event_type, e, lag(e) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS p FROM res),
    d AS (SELECT event_type, round(sum((e - p) * (e - p)) / sum(e * e), 6) AS durbin_watson,
    round(stddev_pop(e), 6) AS std_residual, abs(corr(e, p)) < 0.2 AS is_white_noise FROM l GROUP BY 1)
    SELECT event_type, n, w, durbin_watson, std_residual, is_white_noise FROM d JOIN w USING (event_type)""",
)
def residual_checks(spark, sf_dir):
    df = H.residual_checks(H.trend_residuals(table(spark, sf_dir, "events"), EVENTS), EVENTS)
    return rounded(df.select("event_type", "n", "w", "durbin_watson", "std_residual", "is_white_noise"), 6)


@query("shapiro_by_customer")
def shapiro_by_customer(spark, sf_dir):
    return H.shapiro(table(spark, sf_dir, "orders"), ("o_custkey",), "o_totalprice")


MOMENTS_SQL = f"""{PAIRS_SQL}, m AS (SELECT event_type AS k, count(value) AS n, avg(value) AS mean,
    var_samp(value) AS var FROM events GROUP BY 1), s AS (SELECT key_a, key_b, a.n AS na, b.n AS nb, a.mean AS ma,
    b.mean AS mb, a.var AS va, b.var AS vb, ((a.n - 1) * a.var + (b.n - 1) * b.var) / (a.n + b.n - 2) AS pooled
    FROM pairs JOIN m a ON key_a = a.k JOIN m b ON key_b = b.k)"""


def t_frame(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return H.t_tests(H.side_by_side(H.moments(df, EVENTS), EVENTS, H.pair_list(df, EVENTS, PAIRS)))


@query(
    "ttest_pair",
    f"""WITH {MOMENTS_SQL} SELECT key_a, key_b, round(ma - mb, 8) + 0.0 AS difference,
    round((ma - mb) / sqrt(pooled * (1.0 / na + 1.0 / nb)), 8) + 0.0 AS student_t,
    CAST(na + nb - 2 AS DOUBLE) AS student_df FROM s""",
)
def ttest_pair(spark, sf_dir):
    return rounded(t_frame(spark, sf_dir).select("key_a", "key_b", "difference", "student_t", "student_df"))


@query(
    "welch_pair",
    f"""WITH {MOMENTS_SQL} SELECT key_a, key_b, round((ma - mb) / sqrt(va / na + vb / nb), 8) + 0.0 AS welch_t,
    round((va / na + vb / nb) * (va / na + vb / nb)
    / (va / na * va / na / (na - 1) + vb / nb * vb / nb / (nb - 1)), 6) AS welch_df FROM s""",
)
def welch_pair(spark, sf_dir):
    df = t_frame(spark, sf_dir).select("key_a", "key_b", "welch_t", "welch_df")
    return rounded(rounded(df, 6, ("welch_df",)))


@query(
    "mean_diff_se",
    f"""WITH {MOMENTS_SQL} SELECT key_a, key_b, round(ma - mb, 8) + 0.0 AS difference,
    round(sqrt(va / na + vb / nb), 8) AS diff_se FROM s""",
)
def mean_diff_se(spark, sf_dir):
    return rounded(t_frame(spark, sf_dir).select("key_a", "key_b", "difference", "diff_se"))


@query(
    "levene_pair",
    f"""WITH {PAIRS_SQL}, md AS (SELECT event_type, median(value) AS med FROM events GROUP BY 1),
    z AS (SELECT event_type, abs(value - med) AS z FROM events JOIN md USING (event_type)),
    p AS (SELECT key_a, key_b, event_type, count(*) AS n, avg(z) AS zm, var_pop(z) AS zv
    FROM z JOIN pairs ON event_type IN (key_a, key_b) GROUP BY 1, 2, 3),
    a AS (SELECT key_a, key_b, sum(n) AS n, sum(n * zv) AS w,
    sum(n * zm * zm) - sum(n * zm) * sum(n * zm) / sum(n) AS b FROM p GROUP BY 1, 2)
    SELECT key_a, key_b, round((n - 2) * b / w, 6) AS levene_w FROM a""",
)
def levene_pair(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return rounded(H.levene_pairs(df, EVENTS, H.pair_list(df, EVENTS, PAIRS)).drop("levene_p"), 6)


RANK_SQL = """r AS (SELECT key_a, key_b, event_type, value,
    rank() OVER (PARTITION BY key_a, key_b ORDER BY value)
    + (count(*) OVER (PARTITION BY key_a, key_b, value) - 1) / 2.0 AS rk,
    count(*) OVER (PARTITION BY key_a, key_b, value) AS t
    FROM events JOIN pairs ON event_type IN (key_a, key_b)),
    w AS (SELECT key_a, key_b, sum(rk) FILTER (WHERE event_type = key_a) AS ra,
    CAST(count(*) FILTER (WHERE event_type = key_a) AS DOUBLE) AS na,
    CAST(count(*) FILTER (WHERE event_type = key_b) AS DOUBLE) AS nb,
    CAST(sum(t * t - 1) AS DOUBLE) AS ties FROM r GROUP BY 1, 2),
    u AS (SELECT *, ra - na * (na + 1) / 2 AS u, sqrt(na * nb / 12 * (na + nb + 1 - ties / ((na + nb) * (na + nb - 1))))
    AS sd FROM w)"""
U_SQL = f"{PAIRS_SQL}, {RANK_SQL}"


@query(
    "mannwhitney_pair",
    f"""WITH {U_SQL} SELECT key_a, key_b, u, round((greatest(u, na * nb - u) - na * nb / 2 - 0.5) / sd, 8) AS z,
    'asymptotic' AS p_method FROM u""",
)
def mannwhitney_pair(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return rounded(H.mann_whitney(df, EVENTS, H.pair_list(df, EVENTS, PAIRS)))


def effect_sql(c: str) -> str:
    return (
        f"CASE WHEN abs({c}) < 0.2 THEN 'negligible' WHEN abs({c}) < 0.5 THEN 'small' "
        f"WHEN abs({c}) < 0.8 THEN 'medium' ELSE 'large' END"
    )


@query(
    "effect_size",
    f"""WITH {MOMENTS_SQL}, {RANK_SQL},
    e AS (SELECT s.key_a, s.key_b, (ma - mb) / sqrt(pooled) AS d, 1 - 2 * u / (u.na * u.nb) AS b
    FROM s JOIN u ON s.key_a = u.key_a AND s.key_b = u.key_b)
    SELECT key_a, key_b, round(d, 8) + 0.0 AS cohen_d, round(b, 8) + 0.0 AS rank_biserial,
    {effect_sql('d')} AS cohen_label, {effect_sql('b')} AS rank_label FROM e""",
)
def effect_size(spark, sf_dir):
    return rounded(H.effect_size(table(spark, sf_dir, "events"), EVENTS, PAIRS))


@query("two_sample_auto")
def two_sample_auto(spark, sf_dir):
    return H.two_sample(table(spark, sf_dir, "events"), EVENTS, PAIRS)


def polynomial(x: str, coefficients) -> str:
    return "(" + " + ".join(f"{c!r} * pow({x}, {i})" for i, c in enumerate(coefficients)) + ")"


# normal and equal-variance by the 5% points of their statistics, for samples of more than 11 values
CHOICE_SQL = f"""WITH {MOMENTS_SQL}, {RANK_SQL}, v AS (SELECT event_type, value AS x FROM events),
    {weights_sql('v', 'event_type', 'w')},
    c AS (SELECT event_type, x - avg(x) OVER (PARTITION BY event_type) AS o FROM v),
    j AS (SELECT event_type, count(*) / 6.0 * (pow(avg(pow(o, 3)) / pow(avg(o * o), 1.5), 2)
    + pow(avg(pow(o, 4)) / pow(avg(o * o), 2) - 3, 2) / 4) AS jb FROM c GROUP BY 1),
    e AS (SELECT event_type, CASE WHEN ww.n > {H.ROYSTON_MOST} THEN exp(-jb / 2) > 0.05
    ELSE (ln(1 - ww.w) - {polynomial('ln(ww.n)', H.LARGE_MEAN)}) / exp({polynomial('ln(ww.n)', H.LARGE_LOG_SD)})
    < 1.6448536269514722 END AS normal FROM ww JOIN j USING (event_type)),
    md AS (SELECT event_type, median(value) AS med FROM events GROUP BY 1),
    z AS (SELECT event_type, abs(value - med) AS z FROM events JOIN md USING (event_type)),
    lp AS (SELECT key_a, key_b, event_type, count(*) AS n, avg(z) AS zm, var_pop(z) AS zv
    FROM z JOIN pairs ON event_type IN (key_a, key_b) GROUP BY 1, 2, 3),
    l AS (SELECT key_a, key_b, sum(n) - 2 AS d2, (sum(n) - 2) * (sum(n * zm * zm) - sum(n * zm) * sum(n * zm) / sum(n))
    / sum(n * zv) AS levene FROM lp GROUP BY 1, 2),
    k AS (SELECT s.*, u.u, CASE WHEN NOT (ea.normal AND eb.normal) THEN 'mann_whitney'
    WHEN levene < pow({critical_t('d2')}, 2) THEN 'student' ELSE 'welch' END AS test_used
    FROM s JOIN u ON s.key_a = u.key_a AND s.key_b = u.key_b JOIN l ON s.key_a = l.key_a AND s.key_b = l.key_b
    JOIN e ea ON s.key_a = ea.event_type JOIN e eb ON s.key_b = eb.event_type)
    SELECT key_a, key_b, na AS n_a, nb AS n_b, test_used, round(CASE test_used WHEN 'mann_whitney' THEN u
    WHEN 'student' THEN (ma - mb) / sqrt(pooled * (1.0 / na + 1.0 / nb)) ELSE (ma - mb) / sqrt(va / na + vb / nb) END, 6)
    + 0.0 AS statistic, CASE test_used WHEN 'mann_whitney' THEN 'rank_biserial' ELSE 'cohen_d' END AS effect_type FROM k"""


@query("two_sample_choice", CHOICE_SQL)
def two_sample_choice(spark, sf_dir):
    """Which test every pair of event types gets, and its statistic."""
    df = two_sample_auto(spark, sf_dir)
    return rounded(df.select("key_a", "key_b", "n_a", "n_b", "test_used", "statistic", "effect_type"), 6)


@query("two_sample_priorities")
def two_sample_priorities(spark, sf_dir):
    b = Binding(key=("o_orderpriority",), ts="o_orderdate", values=("o_totalprice",), id=("o_orderkey",))
    return H.two_sample(table(spark, sf_dir, "orders"), b, [("1-URGENT", "5-LOW"), ("2-HIGH", "3-MEDIUM")])
