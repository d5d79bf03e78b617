"""Forecast accuracy, leaderboards, bands and the combination of several forecasts.

Predictions are tall frames: key columns, ``model``, a step or time column,
``actual`` where known, ``forecast`` and optionally ``lower`` / ``upper``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.operators.ordering import numbered, over_order, same_rows
from obsframe.session import attach, link

METRICS = ("mae", "rmse", "mape", "smape", "r2", "bias")
TINY = 1e-6  # keeps the inverse of a perfect score finite


def baseline_columns(series: DataFrame, b: Binding, period: int = 24) -> DataFrame:
    """Three forecasts that need no fit: last value, last season's value, mean of the last season."""
    v = b.value

    def build(w):
        return [
            F.lag(v, 1).over(w).alias("naive"),
            F.lag(v, period).over(w).alias("seasonal_naive"),
            F.avg(v).over(w.rowsBetween(-period, -1)).alias("moving_mean"),
        ]

    return over_order(series, b.key, b.order, build, before=period)


def to_tall(wide: DataFrame, keep: Sequence[str], actual: str, models: Sequence[str]) -> DataFrame:
    entries = [F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias("forecast")) for m in models]
    out = wide.select(*keep, F.col(actual).alias("actual"), F.explode(F.array(*entries)).alias("__e"))
    return out.select(*keep, "__e.model", "actual", "__e.forecast")


def match_actuals(forecasts: DataFrame, actuals: DataFrame, b: Binding) -> DataFrame:
    """Line forecasts up with what happened, by key and step."""
    return link(forecasts, actuals.select(*b.key, "step", "actual"), (*b.key, "step"), "inner")


def metrics(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Accuracy per group; pairs with a missing side are left out."""
    y, f = F.col("actual"), F.col("forecast")
    e = f - y
    size = F.abs(y) + F.abs(f)
    ok = pairs.where(y.isNotNull() & f.isNotNull() & ~F.isnan(y) & ~F.isnan(f))
    n = F.count(F.lit(1))
    return ok.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (100 * F.avg(F.abs(e / F.when(y != 0, y).otherwise(1.0)))).alias("mape"),
        (100 * F.avg(F.when(size == 0, 0.0).otherwise(F.try_divide(2 * F.abs(e), size)))).alias("smape"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * n)).alias("r2"),
        F.avg(e).alias("bias"),
        n.alias("n_points"),
    )


def leaderboard(scores: DataFrame, b: Binding) -> DataFrame:
    """Models of each key by RMSE, best first, and who wins each metric."""
    key = W.partitionBy(*b.key)  # one row per model
    rank = F.row_number().over(key.orderBy(F.col("rmse").asc_nulls_last(), "model"))
    low = ("mae", "rmse", "mape", "smape")

    def winner(metric: str) -> Column:
        goal = F.col(metric) if metric in low else -F.col("r2") if metric == "r2" else F.abs(metric)
        best = F.min_by("model", F.when(F.col(metric).isNotNull(), F.struct(goal.alias("g"), "model")))
        return best.over(key).alias(f"best_{metric}")

    return scores.select("*", rank.alias("rank"), *[winner(m) for m in METRICS])


def z_value(level: float) -> float:
    return NormalDist().inv_cdf(0.5 + level / 2)


def with_band(forecasts: DataFrame, spread: DataFrame, on: Sequence[str], z: float, column: str = "resid_std") -> DataFrame:
    """Symmetric band of z residual deviations around each forecast."""
    out = attach(forecasts, spread.select(*on, column), tuple(on))
    half = F.col(column) * F.lit(z)
    return out.withColumn("lower", F.col("forecast") - half).withColumn("upper", F.col("forecast") + half)


def residual_spread(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    return pairs.groupBy(*by).agg(F.stddev_pop(F.col("actual") - F.col("forecast")).alias("resid_std"))


def equal_weights(models: Sequence[str]) -> dict[str, float]:
    return {m: 1.0 / len(models) for m in models}


def performance_weights(scores: DataFrame, b: Binding) -> DataFrame:
    """Weights in proportion to 1 / RMSE; a model without a score gets none."""
    inverse = F.coalesce(1 / (F.col("rmse") + F.lit(TINY)), F.lit(0.0))
    total = F.sum(inverse).over(W.partitionBy(*b.key))
    return scores.select(*b.key, "model", "rmse", F.try_divide(inverse, total).alias("weight"))


def weighted(forecasts: DataFrame, weights: DataFrame | Mapping[str, float], by: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Weighted mean of the forecasts present at each step."""
    if isinstance(weights, DataFrame):
        rows = attach(forecasts, weights.select(*key, "model", "weight"), (*key, "model"), "inner")
    else:
        pick = F.coalesce(*[F.when(F.col("model") == m, F.lit(float(w))) for m, w in weights.items()])
        rows = forecasts.withColumn("weight", pick).where(F.col("weight").isNotNull())
    rows = rows.where(F.col("forecast").isNotNull())
    values = [c for c in ("forecast", "lower", "upper") if c in rows.columns]
    total = F.sum("weight")
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_models"),
        *[F.try_divide(F.sum(F.col("weight") * F.col(c)), total).alias(c) for c in values],
    )


def dynamic(
    wide: DataFrame, b: Binding, actual: str, models: Sequence[str], window: int = 24, every: int = 6
) -> DataFrame:
    """Combine one-step forecasts by their recent accuracy.

    Weights follow the RMSE over the last ``window`` rows and are renewed every
    ``every`` rows; before the first renewal all models weigh the same.
    """
    complete = same_rows(wide, wide.dropna(subset=[actual, *models]))
    placed = numbered(complete, b.key, b.order, "position")
    phase = F.col("position") % every

    def build(w):
        out = []
        for m in models:
            sq = F.pow(F.col(m) - F.col(actual), F.lit(2.0))
            # the frame ends where the current block of ``every`` rows begins
            at = [F.when(phase == j, F.avg(sq).over(w.rowsBetween(-(window + j), -(1 + j)))) for j in range(every)]
            out.append(F.sqrt(F.coalesce(*at)).alias(f"__rmse_{m}"))
        return out

    scored = over_order(placed, b.key, ("position",), build, before=window + every)
    inverse = {m: 1 / (F.col(f"__rmse_{m}") + F.lit(TINY)) for m in models}
    total = sum(inverse.values(), F.lit(0.0))
    first = F.col(f"__rmse_{models[0]}").isNull()
    weights = {
        f"weight_{m}": F.when(first, F.lit(1.0 / len(models))).otherwise(inverse[m] / total) for m in models
    }
    out = scored.withColumns(weights)
    mix = sum((F.col(f"weight_{m}") * F.col(m) for m in models), F.lit(0.0))
    return out.withColumn("forecast", mix).drop(*[f"__rmse_{m}" for m in models])
