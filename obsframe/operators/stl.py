"""Seasonal-trend decomposition by local regression (Cleveland et al. 1990), per key.

All smoothers are local, so a long series is cut into chunks that overlap by the
reach of one outer round; only the robustness scale, a median per key, is
global, and it is an exact quantile over all rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.operators.least_squares import fields
from obsframe.operators.ordering import chunked, fits_one_task, positions, quantiles
from obsframe.operators.resample import grid_binding
from obsframe.session import attach, cut, group_rows, spread

BLOCK = 20_000


def next_odd(x: float) -> int:
    n = math.ceil(x)
    return n if n % 2 else n + 1


def loess(y: np.ndarray, weight: np.ndarray, q: int, at: np.ndarray) -> np.ndarray:
    """Local linear fit with tricube weights over the q nearest of equally spaced points."""
    n, size = len(y), min(q, len(y))
    out = np.empty(len(at))
    for start in range(0, len(at), BLOCK):
        x0 = at[start : start + BLOCK, None].astype(float)
        first = np.clip(at[start : start + BLOCK] - (size - 1) // 2, 0, n - size)
        idx = first[:, None] + np.arange(size)
        d = np.abs(idx - x0)
        h = np.maximum(d[:, :1], d[:, -1:]) + (q - size) // 2
        h = np.where(h > 0, h, 1.0)
        w = np.where(d <= 0.999 * h, (1 - np.minimum(d / h, 1.0) ** 3) ** 3, 0.0)
        w = np.where(d <= 0.001 * h, 1.0, w) * weight[idx]
        total = w.sum(axis=1, keepdims=True)
        safe = np.where(total > 0, total, 1.0)
        w = w / safe
        centre = (w * idx).sum(axis=1, keepdims=True)
        spread = (w * (idx - centre) ** 2).sum(axis=1, keepdims=True)
        # a fit without spread has no slope; judged within the span, whatever the series length
        tilt = np.where(np.sqrt(spread) > 0.001 * size, (x0 - centre) / np.where(spread > 0, spread, 1.0), 0.0)
        fit = (w * (1 + tilt * (idx - centre)) * y[idx]).sum(axis=1)
        near = y[np.clip(at[start : start + BLOCK], 0, n - 1)]
        out[start : start + BLOCK] = np.where(total[:, 0] > 0, fit, near)
    return out


def moving_mean(x: np.ndarray, n: int) -> np.ndarray:
    run = np.concatenate([[0.0], np.cumsum(x)])
    return (run[n:] - run[:-n]) / n


def inner_round(y: np.ndarray, trend: np.ndarray, rho: np.ndarray, period: int, spans: tuple[int, int, int]):
    seasonal_span, low_span, trend_span = spans
    n = len(y)
    cycle = np.empty(n + 2 * period)
    loose = y - trend
    for phase in range(period):
        part = loose[phase::period]
        fit = loess(part, rho[phase::period], seasonal_span, np.arange(-1, len(part) + 1))
        cycle[phase :: period][: len(fit)] = fit
    low = moving_mean(moving_mean(moving_mean(cycle, period), period), 3)
    low = loess(low, np.ones(n), low_span, np.arange(n))
    seasonal = cycle[period : period + n] - low
    return seasonal, loess(y - seasonal, rho, trend_span, np.arange(n))


def robust_weights(resid: np.ndarray, scale: float) -> np.ndarray:
    u = np.abs(resid) / scale if scale > 0 else np.zeros(len(resid))
    w = np.where(u <= 0.001, 1.0, (1 - np.minimum(u, 1.0) ** 2) ** 2)
    return np.where(u >= 0.999, 0.0, w)


def stl(
    series: DataFrame,
    b: Binding,
    period: int = 24,
    seasonal: int | None = None,
    robust: bool = True,
    inner: int = 2,
    outer: int = 15,
) -> DataFrame:
    """Trend, seasonal part and residual of a regular series; null for keys below two periods.

    ``seasonal`` is the span of the seasonal smoother in periods; unless given,
    the odd number next to the period.
    """
    seasonal = next_odd(period) if seasonal is None else seasonal
    if seasonal % 2 == 0 or seasonal < 3:
        raise ValueError("the seasonal span must be odd and at least 3")
    spans = (seasonal, next_odd(period + 1), next_odd(1.5 * period / (1 - 1.5 / seasonal)))
    rounds = outer + 1 if robust else 1
    g = grid_binding(b)
    key = list(g.key)
    rows = series.where(F.col("value").isNotNull()).select(*key, "slot", "value")
    if fits_one_task(rows, key):
        return whole_series(rows, key, period, spans, inner, rounds)
    return chunked_series(rows, key, period, spans, inner, rounds)


def whole_series(rows, key, period, spans, inner, rounds) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot")
        y = pdf["value"].to_numpy(dtype=float)
        if len(y) < 2 * period:
            return pdf.assign(trend=np.nan, seasonal=np.nan, resid=np.nan).astype({"trend": float})
        trend, season, rho = np.zeros(len(y)), np.zeros(len(y)), np.ones(len(y))
        for _ in range(rounds):
            for _ in range(inner):
                season, trend = inner_round(y, trend, rho, period, spans)
            resid = y - season - trend
            rho = robust_weights(resid, 6 * float(np.median(np.abs(resid))))
        return pdf.assign(trend=trend, seasonal=season, resid=resid)

    schema = ", ".join([*fields(rows, [*key, "slot", "value"]), "trend double, seasonal double, resid double"])
    out = spread(rows, *key).groupBy(*key).applyInPandas(run, schema)
    return with_nulls(out)


def with_nulls(out: DataFrame) -> DataFrame:
    return out.withColumns({c: F.nanvl(c, F.lit(None)) for c in ("trend", "seasonal", "resid")})


def chunked_series(rows, key, period, spans, inner, rounds) -> DataFrame:
    seasonal_span, low_span, trend_span = spans
    # how far one inner pass looks: a few cycles, the low-pass filter, the trend smoother
    reach = (seasonal_span + 1) * period + 2 * period + low_span + trend_span
    halo = inner * reach
    width = max(group_rows(rows.sparkSession), halo, 2 * period)
    placed = positions(rows, key, ["slot"], "pos", "n")
    state = cut(placed.withColumn("trend", F.lit(0.0)).withColumn("rho", F.lit(1.0)))
    kept = [*key, "slot", "value", "pos", "n"]
    schema = ", ".join([*fields(state, kept), "trend double, seasonal double"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        mine = (pdf["__own"] == pdf["__chunk"]).to_numpy()
        y, rho, trend = (pdf[c].to_numpy(dtype=float) for c in ("value", "rho", "trend"))
        season = np.full(len(y), np.nan)
        if pdf["n"].iloc[0] < 2 * period:
            trend = season
        elif mine.any():
            for _ in range(inner):
                season, trend = inner_round(y, trend, rho, period, spans)
        return pdf.assign(trend=trend, seasonal=season)[mine][[*kept, "trend", "seasonal"]]

    for i in range(rounds):
        pieces = chunked(state, "pos", width, halo, halo)
        fitted = spread(pieces, *key, "__chunk").groupBy(*key, "__chunk").applyInPandas(run, schema)
        fitted = cut(fitted.withColumn("resid", F.col("value") - F.col("trend") - F.col("seasonal")))
        if i + 1 < rounds:
            size = fitted.withColumn("__a", F.abs(F.nanvl("resid", F.lit(None))))
            scale = quantiles(size, key, [F.count(F.lit(1)).alias("__n")], {"__h": ("__a", 0.5)}).drop("__n")
            u = F.try_divide(F.abs("resid"), 6 * F.col("__h"))
            rho = F.when(u >= 0.999, 0.0).when(u <= 0.001, 1.0).otherwise((1 - u * u) * (1 - u * u))
            state = attach(fitted, scale, tuple(key)).withColumn("rho", F.coalesce(rho, F.lit(1.0)))
            state = cut(state.drop("__h", "seasonal", "resid"))
    return with_nulls(fitted.select(*key, "slot", "value", "trend", "seasonal", "resid"))
