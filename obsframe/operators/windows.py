"""Row-window features: moving statistics, lags, differences, feature frames, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.functions import scalar as S
from obsframe.operators.ordering import numbered, over_order

FEATURE_LAGS = (1, 3, 6, 12, 24)
FORECAST_LAGS = (1, 2, 3, 6, 12, 24)
ROLLING = (3, 6, 12, 24)


def moving_average(df: DataFrame, b: Binding, window: int = 3) -> DataFrame:
    """Centred statistics, null where fewer than ``window`` values are in the frame."""
    back, ahead = window // 2, (window - 1) // 2
    v = b.value

    def build(w: WindowSpec) -> list[Column]:
        frame = w.rowsBetween(-back, ahead)
        full = F.count(v).over(frame) == window
        stats = {"mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}
        return [F.when(full, s.over(frame)).alias(f"{v}_ma_{name}") for name, s in stats.items()]

    return over_order(df, b.key, b.order, build, back, ahead)


def lag_columns(w: WindowSpec, v: str, lags: Sequence[int]) -> list[Column]:
    return [F.lag(v, n).over(w).alias(f"{v}_lag_{n}") for n in lags]


def trailing_columns(w: WindowSpec, v: str, windows: Sequence[int]) -> list[Column]:
    """Statistics of the last n values, the current one included."""
    out = []
    for n in windows:
        frame = w.rowsBetween(-(n - 1), 0)
        out += [
            F.avg(v).over(frame).alias(f"{v}_rolling_mean_{n}"),
            F.stddev_samp(v).over(frame).alias(f"{v}_rolling_std_{n}"),
        ]
    return out


def past_columns(w: WindowSpec, v: str, windows: Sequence[int]) -> list[Column]:
    """Statistics of the n values before the current one, so none sees its target."""
    out = []
    for n in windows:
        frame = w.rowsBetween(-n, -1)
        out += [
            F.avg(v).over(frame).alias(f"{v}_rolling_mean_{n}"),
            F.stddev_samp(v).over(frame).alias(f"{v}_rolling_std_{n}"),
        ]
    return out


def difference_columns(w: WindowSpec, v: str, steps: Sequence[int] = (1, 3)) -> list[Column]:
    return [(F.col(v) - F.lag(v, n).over(w)).alias(f"{v}_change_{n}") for n in steps]


def lag_features(df: DataFrame, b: Binding, lags: Sequence[int] = FEATURE_LAGS) -> DataFrame:
    def build(w):
        return [c for v in b.values for c in lag_columns(w, v, lags)]

    return over_order(df, b.key, b.order, build, before=max(lags))


def rolling_features(df: DataFrame, b: Binding, windows: Sequence[int] = ROLLING) -> DataFrame:
    return over_order(df, b.key, b.order, lambda w: trailing_columns(w, b.value, windows), before=max(windows))


def rate_of_change(df: DataFrame, b: Binding, steps: Sequence[int] = (1, 3)) -> DataFrame:
    return over_order(df, b.key, b.order, lambda w: difference_columns(w, b.value, steps), before=max(steps))


def engineer_features(df: DataFrame, b: Binding) -> DataFrame:
    """The full feature frame; every window column shares one sort.

    ``b.values`` are target, humidity-like and optionally wind-like variables.
    """
    target, second = b.values[:2]
    cal = S.calendar(b.ts)
    row = {
        **cal,
        **S.cyclical(b.ts),
        **S.day_flags(b.ts),
        "interaction": S.interaction(target, second),
        "heat_index": S.heat_index(target, second),
    }
    if len(b.values) > 2:
        row["wind_chill_index"] = S.wind_chill(target, b.values[2])

    def build(w):
        return [
            *lag_columns(w, target, FEATURE_LAGS),
            *lag_columns(w, second, FEATURE_LAGS),
            *trailing_columns(w, target, ROLLING),
            *difference_columns(w, target),
        ]

    out = over_order(df, b.key, b.order, build, before=max(FEATURE_LAGS))
    return out.withColumns(row)


def forecast_lags(df: DataFrame, b: Binding, lags: Sequence[int] = FORECAST_LAGS) -> DataFrame:
    return over_order(df, b.key, b.order, lambda w: lag_columns(w, b.value, lags), before=max(lags))


def forecast_rolling(df: DataFrame, b: Binding, windows: Sequence[int] = ROLLING) -> DataFrame:
    return over_order(df, b.key, b.order, lambda w: past_columns(w, b.value, windows), before=max(windows))


def forecast_features(df: DataFrame, b: Binding) -> DataFrame:
    """The supervised frame: past values, past statistics and calendar; incomplete rows dropped."""

    def build(w):
        return [*lag_columns(w, b.value, FORECAST_LAGS), *past_columns(w, b.value, ROLLING)]

    out = over_order(df, b.key, b.order, build, before=max(FORECAST_LAGS))
    return out.withColumns(calendar_features(b.ts)).dropna()


def calendar_features(ts: str) -> dict[str, Column]:
    return {**S.calendar(ts), **S.cyclical(ts, ("hour", "month")), **S.day_flags(ts)}


def feature_names(v: str) -> list[str]:
    """The model inputs of :func:`forecast_features`, in a fixed order."""
    return [
        *[f"{v}_lag_{n}" for n in FORECAST_LAGS],
        *[f"{v}_rolling_{s}_{n}" for n in ROLLING for s in ("mean", "std")],
        *["hour", "day_of_week", "month", "day_of_year"],
        *["hour_sin", "hour_cos", "month_sin", "month_cos"],
        *["is_weekend", "is_daytime"],
    ]


def holdout_split(df: DataFrame, b: Binding, fraction: float = 0.8) -> DataFrame:
    """Mark the first int(fraction * n) rows of every key ``train``, the rest ``test``."""
    out = numbered(df, b.key, b.order, "position", "n_rows")
    first = F.floor(F.lit(fraction) * F.col("n_rows"))
    return out.withColumn("split", F.when(F.col("position") < first, "train").otherwise("test"))
