"""Fitted forecast models and ensembles of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsframe.operators import models as M
from obsframe.operators import stationarity
from obsframe.plans.registry import query, rounded, table
from obsframe.plans.series import GRID, HOURS, hourly

ROUNDS = TREES = 100


def series(spark, sf_dir):
    return hourly(spark, sf_dir).drop("is_filled")


@query("adf_stationarity")
def adf_stationarity(spark, sf_dir):
    return stationarity.adf(series(spark, sf_dir), GRID)


@query(
    "dickey_fuller_zero",
    f"""WITH {HOURS}, l AS (SELECT event_type, value - lag(value) OVER w AS d, lag(value) OVER w AS x FROM hours
    WINDOW w AS (PARTITION BY event_type ORDER BY slot)), f AS (SELECT event_type, regr_count(d, x) AS n,
    regr_slope(d, x) AS gamma, regr_sxx(d, x) AS sxx, regr_syy(d, x) AS syy, regr_r2(d, x) AS r2 FROM l GROUP BY 1)
    SELECT event_type, CAST(n AS BIGINT) AS n, round(gamma, 8) AS gamma,
    round(gamma / sqrt((1 - r2) * syy / (n - 2) / sxx), 6) AS statistic FROM f""",
)
def dickey_fuller_zero(spark, sf_dir):
    df = stationarity.dickey_fuller_zero(hourly(spark, sf_dir).drop("is_filled"), GRID)
    return rounded(rounded(df, 6, ("statistic",)))


@query("forecast_seasonal")
def forecast_seasonal(spark, sf_dir):
    return M.SeasonalModel().fit(series(spark, sf_dir), GRID).predict(24)


@query("forecast_seasonal_multiplicative")
def forecast_seasonal_multiplicative(spark, sf_dir):
    return M.SeasonalModel("multiplicative").fit(series(spark, sf_dir), GRID).predict(24)


@query("forecast_arima")
def forecast_arima(spark, sf_dir):
    return M.ArimaModel().fit(series(spark, sf_dir), GRID).predict(24)


@query("arima_orders")
def arima_orders(spark, sf_dir):
    return M.ArimaModel().fit(series(spark, sf_dir), GRID).orders()


@query("forecast_gbt")
def forecast_gbt(spark, sf_dir):
    return M.boosted(ROUNDS).fit(series(spark, sf_dir), GRID).predict(24)


@query("forecast_gbt_wide")
def forecast_gbt_wide(spark, sf_dir):
    return M.boosted_wide(ROUNDS).fit(series(spark, sf_dir), GRID).predict(24)


@query(
    "arima_first_order",
    f"""WITH {HOURS}, l AS (SELECT event_type, value, lag(value) OVER w AS before, row_number() OVER w AS i FROM hours
    WINDOW w AS (PARTITION BY event_type ORDER BY slot))
    SELECT event_type, count(*) AS n, round(regr_intercept(value, before), 6) AS constant,
    round(regr_slope(value, before), 6) AS phi FROM l WHERE i > 12 GROUP BY 1""",
)
def arima_first_order(spark, sf_dir):
    """An autoregression of order one is a plain regression on the value before."""
    orders = M.ArimaModel(order=(1, 0, 0)).fit(series(spark, sf_dir), GRID).orders()
    beta = lambda i: F.element_at("beta", i)
    return rounded(orders.select("event_type", "n", beta(1).alias("constant"), beta(2).alias("phi")), 6)


@query("forecast_rf")
def forecast_rf(spark, sf_dir):
    return M.forest(TREES).fit(series(spark, sf_dir), GRID).predict(24)


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return M.forest(TREES).fit(series(spark, sf_dir), GRID).feature_importance()


@query("model_evaluation")
def model_evaluation(spark, sf_dir):
    """All model kinds on the same held-out part."""
    models = M.default_ensemble(rounds=ROUNDS, trees=TREES).models
    return M.E.leaderboard(M.evaluate([*models, M.SeasonalModel("multiplicative")], series(spark, sf_dir), GRID), GRID)


USERS = GRID.__class__(key=("user_id",), ts="ts", values=("value",), id=("event_id",))


@query(
    "model_status",
    """WITH e AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
    SELECT user_id, 'arima' AS model, n, 0.0::DOUBLE AS missing_pct,
    CASE WHEN n >= 14 THEN 'ok' ELSE 'insufficient' END AS status FROM e""",
)
def model_status(spark, sf_dir):
    """Short series stay in sight: ten lags, a difference and two more lags need fourteen values."""
    model = M.ArimaModel(order=(1, 1, 1)).fit(table(spark, sf_dir, "events"), USERS)
    return model.status()


@query("ensemble_stacking")
def ensemble_stacking(spark, sf_dir):
    return M.default_ensemble("stacking", ROUNDS, TREES).fit(series(spark, sf_dir), GRID).predict(24)


@query("ensemble_performance")
def ensemble_performance(spark, sf_dir):
    return M.default_ensemble("weighted", ROUNDS, TREES).fit(series(spark, sf_dir), GRID).predict(24)


@query("ensemble_dynamic_models")
def ensemble_dynamic_models(spark, sf_dir):
    return M.default_ensemble("dynamic", ROUNDS, TREES).fit(series(spark, sf_dir), GRID).predict(24)


@query("ensemble_dynamic_renewal")
def ensemble_dynamic_renewal(spark, sf_dir):
    """Five members over the held-out part, their weights renewed every six hours."""
    return M.default_ensemble("dynamic", ROUNDS, TREES).follow(series(spark, sf_dir), GRID)


@query(
    "ensemble_status",
    """WITH e AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
    SELECT user_id, 'weighted' AS model, n, 0.0::DOUBLE AS missing_pct,
    CASE WHEN n >= 14 THEN 'ok' ELSE 'partial' END AS status, CASE WHEN n >= 14 THEN '' ELSE 'arima' END AS missing FROM e""",
)
def ensemble_status(spark, sf_dir):
    """Keys too short for one member are served by the other."""
    members = [M.SeasonalModel(), M.ArimaModel(order=(1, 1, 1))]
    out = M.WeightedEnsemble(members).fit(table(spark, sf_dir, "events"), USERS).own_status()
    return out.withColumn("missing", F.array_join("missing", ","))
