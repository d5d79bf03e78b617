"""Forecast evaluation and ensembles over forecasts that SQL can also make."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsframe.operators import evaluate as E
from obsframe.operators import windows as X
from obsframe.plans.registry import query, rounded
from obsframe.plans.series import GRID, HOURS, hourly
from obsframe.session import cut

MODELS = ("naive", "seasonal_naive", "moving_mean")
WIN = "OVER (PARTITION BY event_type ORDER BY slot"
WIDE_SQL = f"""{HOURS}, wide AS (SELECT event_type, slot, value, lag(value, 1) {WIN}) AS naive,
    lag(value, 24) {WIN}) AS seasonal_naive, avg(value) {WIN} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS moving_mean,
    row_number() {WIN}) - 1 AS position, count(*) OVER (PARTITION BY event_type) AS n_rows FROM hours)"""
TALL_SQL = f"""{WIDE_SQL}, tall AS (
    {' UNION ALL '.join(f'''SELECT event_type, slot, position, '{m}' AS model, value AS actual, {m} AS forecast,
    position >= floor(CAST(0.8 AS DOUBLE) * n_rows) AS test FROM wide''' for m in MODELS)})"""
SCORE_SQL = f"""{TALL_SQL}, scores AS (SELECT event_type, model, avg(abs(forecast - actual)) AS mae,
    sqrt(avg((forecast - actual) ** 2)) AS rmse,
    100 * avg(abs((forecast - actual) / CASE WHEN actual <> 0 THEN actual ELSE 1.0 END)) AS mape,
    100 * avg(2 * abs(forecast - actual) / (abs(actual) + abs(forecast))) AS smape,
    1 - sum((forecast - actual) ** 2) / (var_pop(actual) * count(*)) AS r2, avg(forecast - actual) AS bias,
    count(*) AS n_points FROM tall WHERE test AND forecast IS NOT NULL GROUP BY 1, 2)"""


def wide_frame(spark, sf_dir):
    return E.baseline_columns(hourly(spark, sf_dir).drop("is_filled"), GRID)


def tall_frame(spark, sf_dir):
    """One row per slot and model, marked train or test."""
    split = X.holdout_split(wide_frame(spark, sf_dir), GRID, 0.8)
    return E.to_tall(split, ("event_type", "slot", "split"), "value", MODELS)


def scores(spark, sf_dir):
    return E.metrics(tall_frame(spark, sf_dir).where("split = 'test'"), ("event_type", "model"))


SCORE_OUT = """event_type, model, round(mae, 8) AS mae, round(rmse, 8) AS rmse, round(mape, 6) AS mape,
    round(smape, 6) AS smape, round(r2, 8) + 0.0 AS r2, round(bias, 8) + 0.0 AS bias, n_points"""


@query("forecast_metrics", f"WITH {SCORE_SQL} SELECT {SCORE_OUT} FROM scores")
def forecast_metrics(spark, sf_dir):
    return rounded(rounded(scores(spark, sf_dir), 6, ("mape", "smape")))


@query(
    "model_leaderboard",
    f"""WITH {SCORE_SQL} SELECT {SCORE_OUT},
    CAST(row_number() OVER (PARTITION BY event_type ORDER BY rmse, model) AS INTEGER) AS rank,
    {', '.join(f"first_value(model) OVER (PARTITION BY event_type ORDER BY {g}, model) AS best_{m}" for m, g in (('mae', 'mae'), ('rmse', 'rmse'), ('mape', 'mape'), ('smape', 'smape'), ('r2', 'r2 DESC'), ('bias', 'abs(bias)')))}
    FROM scores""",
)
def model_leaderboard(spark, sf_dir):
    return rounded(rounded(E.leaderboard(scores(spark, sf_dir), GRID), 6, ("mape", "smape")))


@query(
    "forecast_vs_actual",
    f"""WITH {WIDE_SQL}, cutoff AS (SELECT *, position - CAST(floor(CAST(0.8 AS DOUBLE) * n_rows) AS BIGINT) + 1 AS step FROM wide),
    last AS (SELECT event_type, value AS forecast FROM cutoff WHERE step = 0)
    SELECT event_type, CAST(step AS INTEGER) AS step, round(value, 10) AS actual, round(forecast, 10) AS forecast,
    round(value - forecast, 8) + 0.0 AS error FROM cutoff JOIN last USING (event_type) WHERE step >= 1""",
)
def forecast_vs_actual(spark, sf_dir):
    """The last training value carried forward, matched with the held-out rows by step."""
    split = cut(X.holdout_split(hourly(spark, sf_dir).drop("is_filled"), GRID, 0.8))
    first = F.floor(F.lit(0.8) * F.col("n_rows"))
    steps = split.withColumn("step", (F.col("position") - first + 1).cast("int"))
    test = steps.where("split = 'test'").select("event_type", "step", F.col("value").alias("actual"))
    last = steps.where("step = 0").select("event_type", F.col("value").alias("forecast"))
    carried = test.select("event_type", "step").join(last, "event_type")
    out = E.match_actuals(carried, test, GRID).withColumn("error", F.col("actual") - F.col("forecast"))
    return rounded(rounded(out, 8, ("error",)), 10, ("actual", "forecast"))


@query(
    "prediction_band",
    f"""WITH {TALL_SQL}, s AS (SELECT event_type, model, stddev_pop(actual - forecast) AS sd FROM tall
    WHERE NOT test AND forecast IS NOT NULL GROUP BY 1, 2)
    SELECT event_type, model, slot, round(forecast, 10) AS forecast, round(forecast - 1.96 * sd, 10) + 0.0 AS lower,
    round(forecast + 1.96 * sd, 10) + 0.0 AS upper FROM tall JOIN s USING (event_type, model) WHERE test""",
)
def prediction_band(spark, sf_dir):
    tall = cut(tall_frame(spark, sf_dir))
    spread = E.residual_spread(tall.where("split = 'train'"), ("event_type", "model"))
    out = E.with_band(tall.where("split = 'test'"), spread, ("event_type", "model"), z=1.96)
    return rounded(out.select("event_type", "model", "slot", "forecast", "lower", "upper"), 10)


WEIGHT_SQL = f"""{SCORE_SQL}, weights AS (SELECT event_type, model, rmse, (1 / (rmse + 1e-6))
    / sum(1 / (rmse + 1e-6)) OVER (PARTITION BY event_type) AS weight FROM scores)"""


@query(
    "performance_weights",
    f"WITH {WEIGHT_SQL} SELECT event_type, model, round(rmse, 10) AS rmse, round(weight, 10) AS weight FROM weights",
)
def performance_weights(spark, sf_dir):
    return rounded(E.performance_weights(scores(spark, sf_dir), GRID), 10)


@query(
    "ensemble_weighted",
    f"""WITH {WEIGHT_SQL} SELECT event_type, slot, count(*) AS n_models,
    round(sum(weight * forecast) / sum(weight), 10) AS forecast FROM tall JOIN weights USING (event_type, model)
    WHERE forecast IS NOT NULL GROUP BY 1, 2""",
)
def ensemble_weighted(spark, sf_dir):
    tall = cut(tall_frame(spark, sf_dir))
    weights = E.performance_weights(E.metrics(tall.where("split = 'test'"), ("event_type", "model")), GRID)
    return rounded(E.weighted(tall, weights, ("event_type", "slot"), ("event_type",)), 10)


@query(
    "ensemble_equal",
    f"""WITH {TALL_SQL} SELECT event_type, slot, count(*) AS n_models, round(avg(forecast), 10) AS forecast FROM tall
    WHERE forecast IS NOT NULL GROUP BY 1, 2""",
)
def ensemble_equal(spark, sf_dir):
    tall = tall_frame(spark, sf_dir)
    return rounded(E.weighted(tall, E.equal_weights(MODELS), ("event_type", "slot"), ("event_type",)), 10)


def dynamic_sql() -> str:
    errors = ", ".join(f"({m} - value) ** 2 AS e_{m}" for m in MODELS)
    means = ", ".join(
        f"sqrt(avg(e_{m}) OVER (PARTITION BY event_type ORDER BY p ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)) AS r_{m}"
        for m in MODELS
    )
    inv = {m: f"1 / (b.r_{m} + 1e-6)" for m in MODELS}
    total = " + ".join(inv.values())
    weights = ", ".join(
        f"CASE WHEN b.r_naive IS NULL THEN 1.0::DOUBLE / 3 ELSE ({inv[m]}) / ({total}) END AS weight_{m}" for m in MODELS
    )
    out = ", ".join(f"round(weight_{m}, 10) AS weight_{m}" for m in MODELS)
    mix = " + ".join(f"weight_{m} * {m}" for m in MODELS)
    return f"""WITH {WIDE_SQL}, c AS (SELECT *, row_number() {WIN}) - 1 AS p, {errors} FROM wide
    WHERE seasonal_naive IS NOT NULL), r AS (SELECT event_type, p, {means} FROM c),
    w AS (SELECT c.event_type, c.slot, c.naive, c.seasonal_naive, c.moving_mean, {weights} FROM c
    JOIN r b ON c.event_type = b.event_type AND b.p = c.p - c.p % 6)
    SELECT event_type, slot, {out}, round({mix}, 10) AS forecast FROM w"""


@query("ensemble_dynamic", dynamic_sql())
def ensemble_dynamic(spark, sf_dir):
    out = E.dynamic(wide_frame(spark, sf_dir), GRID, "value", MODELS)
    return rounded(out.select("event_type", "slot", *[f"weight_{m}" for m in MODELS], "forecast"), 10)
