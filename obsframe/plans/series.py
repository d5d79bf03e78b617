"""Window features, resampling, decomposition, grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.operators import resample as R
from obsframe.operators import windows as X
from obsframe.operators.stl import stl as decompose_stl
from obsframe.plans.basics import CYCLE_SQL
from obsframe.plans.registry import EVENTS, query, rounded, table
from obsframe.session import cut

WIN = "OVER (PARTITION BY event_type ORDER BY ts, event_id"
GRID = Binding(key=("event_type",), ts="slot", values=("value",))


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "user_id", "value")


def hourly(spark, sf_dir):
    """Gap-free hourly mean of the event value per event type."""
    return cut(R.regular_series(table(spark, sf_dir, "events"), EVENTS))


def frame(sql: str, rows: str) -> str:
    return f"{sql} {WIN} ROWS BETWEEN {rows})"


@query(
    "moving_average",
    "SELECT event_id, ts, event_type, user_id, value, "
    + ", ".join(
        f"""CASE WHEN {frame('count(value)', '1 PRECEDING AND 1 FOLLOWING')} = 3
        THEN round({frame(f'{fn}(value)', '1 PRECEDING AND 1 FOLLOWING')}, 10) END AS value_ma_{name}"""
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
    )
    + " FROM events",
)
def moving_average(spark, sf_dir):
    return rounded(X.moving_average(events(spark, sf_dir), EVENTS, 3), 10)


def lag_sql(v: str, lags, over: str = WIN) -> str:
    return ", ".join(f"lag({v}, {n}) {over}) AS {v}_lag_{n}" for n in lags)


def rolling_sql(back: int, ahead: int, v: str = "value", over: str = WIN) -> str:
    """Trailing statistics; ``back`` = 1 includes the current row, ``ahead`` = -1 ends before it."""
    out = []
    for n in X.ROLLING:
        rows = f"ROWS BETWEEN {n - back} PRECEDING AND {'CURRENT ROW' if ahead == 0 else '1 PRECEDING'}"
        out.append(f"round(avg({v}) {over} {rows}), 10) AS {v}_rolling_mean_{n}")
        out.append(f"round(stddev_samp({v}) {over} {rows}), 6) AS {v}_rolling_std_{n}")
    return ", ".join(out)


def rounded_std(df, digits: int = 10):
    std = tuple(c for c in df.columns if "_std_" in c)
    return rounded(rounded(df, 6, std), digits, tuple(c for c in df.columns if c not in std))


BASE = "event_id, ts, event_type, user_id, value"


@query(
    "lag_features",
    f"SELECT {BASE}, {lag_sql('value', X.FEATURE_LAGS)}, {lag_sql('user_id', X.FEATURE_LAGS)} FROM events",
)
def lag_features(spark, sf_dir):
    return X.lag_features(events(spark, sf_dir), EVENTS.on("value", "user_id"))


@query("rolling_features", f"SELECT {BASE}, {rolling_sql(1, 0)} FROM events")
def rolling_features(spark, sf_dir):
    return rounded_std(X.rolling_features(events(spark, sf_dir), EVENTS))


@query(
    "rate_of_change",
    f"SELECT {BASE}, round(value - lag(value, 1) {WIN}), 10) + 0.0 AS value_change_1, "
    f"round(value - lag(value, 3) {WIN}), 10) + 0.0 AS value_change_3 FROM events",
)
def rate_of_change(spark, sf_dir):
    return rounded(X.rate_of_change(events(spark, sf_dir), EVENTS), 10)


PARTS_SQL = """CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
    CAST(month(ts) AS INTEGER) AS month, CAST(dayofyear(ts) AS INTEGER) AS day_of_year,
    CASE WHEN isodow(ts) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour(ts) BETWEEN 6 AND 18 THEN 1 ELSE 0 END AS is_daytime"""


@query(
    "engineer_features",
    f"""SELECT {BASE}, {lag_sql('value', X.FEATURE_LAGS)}, {lag_sql('user_id', X.FEATURE_LAGS)},
    {rolling_sql(1, 0)}, round(value - lag(value, 1) {WIN}), 10) + 0.0 AS value_change_1,
    round(value - lag(value, 3) {WIN}), 10) + 0.0 AS value_change_3, {PARTS_SQL}, {CYCLE_SQL.replace(', 8)', ', 10)')},
    round(value * user_id / 100.0, 10) AS interaction,
    round((0.5 * ((value * 9.0 / 5.0 + 32.0) + 61.0 + ((value * 9.0 / 5.0 + 32.0) - 68.0) * 1.2
    + user_id * 0.094) - 32.0) * 5.0 / 9.0, 10) AS heat_index,
    round(value - user_id * 0.3, 10) + 0.0 AS wind_chill_index FROM events""",
)
def engineer_features(spark, sf_dir):
    df = X.engineer_features(events(spark, sf_dir), EVENTS.on("value", "user_id", "user_id"))
    return rounded_std(df)


HOURS = """slots AS (SELECT event_type, date_trunc('hour', ts) AS slot, avg(value) AS value FROM events GROUP BY 1, 2),
    ahead AS (SELECT *, lead(slot) OVER w AS nslot, lead(value) OVER w AS nvalue FROM slots
    WINDOW w AS (PARTITION BY event_type ORDER BY slot)),
    gaps AS (SELECT *, coalesce(date_diff('hour', slot, nslot), 1) AS n FROM ahead),
    filled AS (SELECT *, unnest(range(n)) AS i FROM gaps),
    hours AS (SELECT event_type, slot + to_hours(CAST(i AS INTEGER)) AS slot,
    value + coalesce((nvalue - value) * i / n, 0.0) AS value, i > 0 AS is_filled FROM filled)"""


@query(
    "resample_hourly",
    "SELECT event_type, date_trunc('hour', ts) AS slot, round(avg(value), 10) AS value FROM events GROUP BY 1, 2",
)
def resample_hourly(spark, sf_dir):
    return rounded(R.resample(table(spark, sf_dir, "events"), EVENTS), 10)


@query(
    "resample_six_hourly",
    "SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS slot, round(avg(value), 10) AS value FROM events GROUP BY 1, 2",
)
def resample_six_hourly(spark, sf_dir):
    return rounded(R.resample(table(spark, sf_dir, "events"), EVENTS, 6 * R.HOUR), 10)


@query("interpolate_linear", f"WITH {HOURS} SELECT event_type, slot, round(value, 10) AS value, is_filled FROM hours")
def interpolate_linear(spark, sf_dir):
    return rounded(hourly(spark, sf_dir), 10)


def parts_sql(model: str) -> str:
    loose, seasonal, resid = (
        ("value - trend", "s - avg(s) OVER w", "value - trend - seasonal")
        if model == "additive"
        else ("value / trend", "s / avg(s) OVER w", "value / (trend * seasonal)")
    )
    return f"""{HOURS}, t AS (SELECT event_type, slot, value, is_filled, CAST(epoch(slot) / 3600 AS BIGINT) % 24 AS phase,
    CASE WHEN count(value) OVER (PARTITION BY event_type ORDER BY slot ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) = 25
    THEN (sum(value) OVER (PARTITION BY event_type ORDER BY slot ROWS BETWEEN 11 PRECEDING AND 11 FOLLOWING)
    + (lag(value, 12) OVER (PARTITION BY event_type ORDER BY slot)
    + lead(value, 12) OVER (PARTITION BY event_type ORDER BY slot)) / 2) / 24 END AS trend FROM hours),
    ph AS (SELECT event_type, phase, avg({loose}) AS s FROM t GROUP BY 1, 2),
    sea AS (SELECT event_type, phase, {seasonal} AS seasonal FROM ph WINDOW w AS (PARTITION BY event_type)),
    parts AS (SELECT event_type, slot, value, is_filled, trend, seasonal, {resid} AS resid
    FROM t JOIN sea USING (event_type, phase))"""


PARTS_OUT = """SELECT event_type, slot, is_filled, round(value, 10) AS value, round(trend, 10) AS trend,
    round(seasonal, 10) + 0.0 AS seasonal, round(resid, 10) + 0.0 AS resid FROM parts"""


@query("decompose_additive", f"WITH {parts_sql('additive')} {PARTS_OUT}")
def decompose_additive(spark, sf_dir):
    return rounded(R.decompose(hourly(spark, sf_dir), EVENTS), 10)


@query("decompose_multiplicative", f"WITH {parts_sql('multiplicative')} {PARTS_OUT}")
def decompose_multiplicative(spark, sf_dir):
    return rounded(R.decompose(hourly(spark, sf_dir), EVENTS, model="multiplicative"), 10)


@query("stl")
def stl(spark, sf_dir):
    return decompose_stl(hourly(spark, sf_dir), EVENTS)


@query("stl_strength")
def stl_strength(spark, sf_dir):
    return R.component_strength(decompose_stl(hourly(spark, sf_dir), EVENTS), EVENTS)


@query(
    "stl_identity",
    f"""WITH {HOURS} SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean_value,
    round(stddev_samp(value), 6) AS std_value FROM hours GROUP BY 1""",
)
def stl_identity(spark, sf_dir):
    """The three parts of each slot add up to its value, so their sums have the values' moments."""
    parts = decompose_stl(hourly(spark, sf_dir), EVENTS)
    whole = F.col("trend") + F.col("seasonal") + F.col("resid")
    out = parts.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg(whole).alias("mean_value"), F.stddev_samp(whole).alias("std_value")
    )
    return rounded(out, 6)


def strength_label(c: str) -> str:
    return f"CASE WHEN {c} > 0.6 THEN 'strong' WHEN {c} > 0.3 THEN 'moderate' ELSE 'weak' END"


@query(
    "component_strength",
    f"""WITH {parts_sql('additive')}, g AS (SELECT event_type, count(resid) AS n,
    greatest(0.0, 1 - var_samp(resid) / (var_samp(trend + resid) FILTER (WHERE resid IS NOT NULL))) AS ts,
    greatest(0.0, 1 - var_samp(resid) / (var_samp(seasonal + resid) FILTER (WHERE resid IS NOT NULL))) AS ss,
    stddev_samp(resid) AS sd, (max(seasonal) - min(seasonal)) / 2 AS half,
    arg_max(trend, slot) FILTER (WHERE trend IS NOT NULL) > arg_min(trend, slot) FILTER (WHERE trend IS NOT NULL) AS up
    FROM parts GROUP BY 1)
    SELECT event_type, n, round(ts, 6) AS trend_strength, round(ss, 6) AS seasonal_strength,
    round(sd, 6) AS residual_std, round(half, 6) AS seasonal_half_range,
    CASE WHEN up THEN 'increasing' ELSE 'decreasing' END AS trend_direction,
    {strength_label('ts')} AS trend_label, {strength_label('ss')} AS seasonal_label FROM g""",
)
def component_strength(spark, sf_dir):
    parts = R.decompose(hourly(spark, sf_dir), EVENTS)
    return rounded(R.component_strength(parts, EVENTS), 6)


@query(
    "decomposition_sentence",
    f"""WITH {parts_sql('additive')}, g AS (SELECT event_type,
    greatest(0.0, 1 - var_samp(resid) / (var_samp(trend + resid) FILTER (WHERE resid IS NOT NULL))) AS ts,
    greatest(0.0, 1 - var_samp(resid) / (var_samp(seasonal + resid) FILTER (WHERE resid IS NOT NULL))) AS ss,
    stddev_samp(resid) AS sd, (max(seasonal) - min(seasonal)) / 2 AS half,
    CASE WHEN arg_max(trend, slot) FILTER (WHERE trend IS NOT NULL) > arg_min(trend, slot)
    FILTER (WHERE trend IS NOT NULL) THEN 'increasing' ELSE 'decreasing' END AS way FROM parts GROUP BY 1),
    l AS (SELECT *, {strength_label('ts')} AS tl, {strength_label('ss')} AS sl FROM g)
    SELECT event_type, concat_ws('; ', CASE WHEN tl = 'weak' THEN printf('hardly any trend (%.2f)', ts)
    ELSE printf('a %s %s trend (%.2f)', tl, way, ts) END, CASE WHEN sl = 'weak' THEN 'hardly any season'
    ELSE printf('a %s season of %.1f either way', sl, half) END, printf('noise of %.2f', sd)) AS interpretation FROM l""",
)
def decomposition_sentence(spark, sf_dir):
    strengths = R.component_strength(R.decompose(hourly(spark, sf_dir), EVENTS), EVENTS)
    return R.decomposition_sentence(strengths).select("event_type", "interpretation")


HWIN = "OVER (PARTITION BY event_type ORDER BY slot"


@query(
    "forecast_lags",
    f"""WITH {HOURS}, f AS (SELECT event_type, slot, value, {lag_sql('value', X.FORECAST_LAGS, HWIN)} FROM hours)
    SELECT event_type, slot, round(value, 10) AS value, """
    + ", ".join(f"round(value_lag_{n}, 10) AS value_lag_{n}" for n in X.FORECAST_LAGS)
    + " FROM f",
)
def forecast_lags(spark, sf_dir):
    return rounded(X.forecast_lags(hourly(spark, sf_dir).drop("is_filled"), GRID), 10)


@query(
    "forecast_rolling",
    f"""WITH {HOURS} SELECT event_type, slot, round(value, 10) AS value,
    {rolling_sql(0, -1, over=HWIN)} FROM hours""",
)
def forecast_rolling(spark, sf_dir):
    return rounded_std(X.forecast_rolling(hourly(spark, sf_dir).drop("is_filled"), GRID))


def supervised_sql() -> str:
    cyc = ", ".join(
        f"round({fn}(2 * pi() * {part}(slot) / {period}), 10) + 0.0 AS {part}_{fn}"
        for part, period in (("hour", 24), ("month", 12))
        for fn in ("sin", "cos")
    )
    lags = ", ".join(f"round(lag(value, {n}) {HWIN}), 10) AS value_lag_{n}" for n in X.FORECAST_LAGS)
    return f"""f AS (SELECT event_type, slot, round(value, 10) AS value, {lags}, {rolling_sql(0, -1, over=HWIN)},
    {PARTS_SQL.replace('(ts)', '(slot)')}, {cyc} FROM hours)"""


@query("forecast_features", f"WITH {HOURS}, {supervised_sql()} SELECT * FROM f WHERE value_lag_24 IS NOT NULL")
def forecast_features(spark, sf_dir):
    return rounded_std(X.forecast_features(hourly(spark, sf_dir).drop("is_filled"), GRID))


@query(
    "holdout_split",
    """WITH p AS (SELECT event_id, event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1
    AS position, count(*) OVER (PARTITION BY event_type) AS n_rows FROM events)
    SELECT *, CASE WHEN position < floor(CAST(0.8 AS DOUBLE) * n_rows) THEN 'train' ELSE 'test' END AS split FROM p""",
)
def holdout_split(spark, sf_dir):
    df = X.holdout_split(events(spark, sf_dir), EVENTS)
    return df.select("event_id", "event_type", "value", "position", "n_rows", "split")


@query(
    "validate_series",
    """WITH h AS (SELECT o_custkey, o_totalprice, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS v
    FROM orders), g AS (SELECT o_custkey, count(*) AS n, 100.0 * (count(*) - count(v)) / count(*) AS missing_pct
    FROM h GROUP BY 1)
    SELECT o_custkey, n, round(missing_pct, 10) AS missing_pct, CASE WHEN n < 10 THEN 'insufficient'
    WHEN missing_pct > 20 THEN 'warning' ELSE 'ok' END AS status FROM g""",
)
def validate_series(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    df = df.select("o_custkey", "o_orderdate", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("v"))
    b = Binding(key=("o_custkey",), ts="o_orderdate", values=("v",))
    return rounded(R.validate_series(df, b, min_points=10), 10)


@query(
    "future_grid",
    f"""WITH {HOURS}, l AS (SELECT event_type, max(slot) AS last_ts FROM hours GROUP BY 1),
    g AS (SELECT *, unnest(range(1, 25)) AS i FROM l)
    SELECT event_type, CAST(i AS INTEGER) AS step, last_ts + to_hours(CAST(i AS INTEGER)) AS ts FROM g""",
)
def future_grid(spark, sf_dir):
    return R.future_grid(hourly(spark, sf_dir), GRID, steps=24)
