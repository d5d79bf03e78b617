"""Augmented Dickey-Fuller test for every key."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.functions.special import normal_cdf_value
from obsframe.operators.least_squares import gram, ols, solve_rows, square
from obsframe.operators.ordering import largest_group, numbered, over_order, same_rows
from obsframe.session import cut, link

# MacKinnon (1994) response surface, constant only, one series
TAU_LOW, TAU_STAR, TAU_HIGH = -18.83, -1.61, 2.74
TAU_SMALL = (2.1659, 1.4412, 0.038269)
TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)


def dickey_fuller_p(tau: float) -> float:
    if tau > TAU_HIGH:
        return 1.0
    if tau < TAU_LOW:
        return 0.0
    coefficients = TAU_SMALL if tau <= TAU_STAR else TAU_LARGE
    return normal_cdf_value(sum(c * tau**i for i, c in enumerate(coefficients)))


def default_lags(n: int) -> int:
    return max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))


def regression_row(v: list[float], t: int, lags: int) -> list[float]:
    """[1, level before, differences before, difference now] at position t."""
    d = [v[i] - v[i - 1] for i in range(t - lags, t + 1)]
    return [1.0, v[t - 1], *reversed(d[:-1]), d[-1]]


def adf(series: DataFrame, b: Binding, alpha: float = 0.05) -> DataFrame:
    """Unit-root test with a constant; the lag order is the one of least AIC.

    All lag orders are fitted from one cross-product matrix per key. The few
    first rows, which shorter lag orders use as well, travel as a small array.
    """
    v = b.value
    rows = numbered(series.where(F.col(v).isNotNull()).select(*b.key, *b.order, v), b.key, b.order, "t", "n")
    rows = same_rows(rows, cut(rows))
    top = default_lags(largest_group(rows, b.key))

    def build(w):
        step = [F.lag(v, i).over(w) for i in range(top + 2)]
        diffs = [step[i] - step[i + 1] for i in range(1, top + 1)]
        return [F.array(F.lit(1.0), step[1], *diffs, F.col(v) - step[1]).alias("__x")]

    lagged = over_order(rows, b.key, ("t",), build, before=top + 1)
    lagged = same_rows(rows, lagged.where(F.col("t") > top))
    sums = gram(lagged, b.key, F.col("__x"))
    early = rows.where(F.col("t") <= top).groupBy(*b.key).agg(
        F.max("n").alias("n"),
        F.transform(F.array_sort(F.collect_list(F.struct("t", F.col(v).cast("double").alias("v")))), lambda s: s.v).alias("early"),
    )

    def solve(r: dict):
        n = int(r["n"])
        lags = default_lags(n)
        first = [float(x) for x in r["early"]]
        g = square(r["g"]) if r["g"] is not None else np.zeros((top + 3, top + 3))
        target = top + 2
        if n < 6:
            yield {"n": n, "lags": None, "statistic": None, "p_value": None, "is_stationary": False}
            return

        def plus_early(g: np.ndarray, used: int, lo: int, hi: int) -> np.ndarray:
            g = g.copy()
            at = [0, 1, *range(2, 2 + used), target]
            for t in range(lo, min(hi, len(first) - 1) + 1):
                x = np.asarray(regression_row(first, t, used))
                g[np.ix_(at, at)] += np.outer(x, x)
            return g

        # the rows every candidate can use, then the best of them on all its rows
        common = plus_early(g, lags, lags + 1, top)
        count = n - 1 - lags

        def aic(k: int) -> float:
            _, ssr = ols(common, [0, 1, *range(2, 2 + k)], target)
            return count * math.log(max(ssr, 1e-300) / count) + 2 * (k + 2)

        best = min(range(lags + 1), key=aic)
        own = plus_early(g, best, best + 1, top)
        cols = [0, 1, *range(2, 2 + best)]
        beta, ssr = ols(own, cols, target)
        df = n - 1 - best - len(cols)
        try:
            se = math.sqrt(ssr / df * np.linalg.inv(own[np.ix_(cols, cols)])[1, 1])
            tau = float(beta[1] / se)
            p = dickey_fuller_p(tau)
        except (np.linalg.LinAlgError, ZeroDivisionError, ValueError):
            tau, p = None, None
        yield {"n": n, "lags": best, "statistic": tau, "p_value": p, "is_stationary": p is not None and p < alpha}

    return solve_rows(
        link(early, sums, b.key),
        b.key,
        solve,
        "n bigint, lags int, statistic double, p_value double, is_stationary boolean",
    )


def dickey_fuller_zero(series: DataFrame, b: Binding) -> DataFrame:
    """The lag-0 statistic in closed form from regression aggregates."""
    v = b.value
    rows = over_order(series, b.key, b.order, lambda w: [F.lag(v).over(w).cast("double").alias("__x")], before=1)
    d = F.col(v) - F.col("__x")
    fit = rows.groupBy(*b.key).agg(
        F.regr_count(d, "__x").alias("n"),
        F.regr_slope(d, "__x").alias("gamma"),
        F.regr_sxx(d, "__x").alias("__sxx"),
        F.regr_syy(d, "__x").alias("__syy"),
        F.regr_r2(d, "__x").alias("__r2"),
    )
    se = F.sqrt((1 - F.col("__r2")) * F.col("__syy") / (F.col("n") - 2) / F.col("__sxx"))
    return fit.select(*b.key, "n", "gamma", F.try_divide("gamma", se).alias("statistic"))
