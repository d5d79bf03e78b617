"""Regular grids and classical decomposition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.functions import scalar as S
from obsframe.operators.ordering import over_order
from obsframe.session import attach, cut

HOUR = 3600
BLOCK = 1024  # slots generated from one array


def grid_binding(b: Binding) -> Binding:
    return Binding(key=b.key, ts="slot", values=("value",))


def resample(df: DataFrame, b: Binding, seconds: int = HOUR) -> DataFrame:
    """Mean of the target per key and fixed-width slot."""
    return df.groupBy(*b.key, S.slot(b.ts, seconds).alias("slot")).agg(F.avg(b.value).alias("value"))


def expand(df: DataFrame, count: str, name: str) -> DataFrame:
    """Repeat each row ``count`` times with ``name`` = 0..count-1; long runs go in two steps."""
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / BLOCK))
    first = F.col("__block") * BLOCK
    inner = F.sequence(first, F.least(first + BLOCK - 1, F.col(count) - 1))
    return df.withColumn("__block", F.explode(blocks)).withColumn(name, F.explode(inner)).drop("__block")


def interpolate(slots: DataFrame, b: Binding, seconds: int = HOUR) -> DataFrame:
    """Fill the empty slots between a key's first and last by linear interpolation.

    Each occupied slot looks one row ahead and writes its own gap, so no grid is
    joined and a series of any length needs a reach of one row only.
    """
    b = grid_binding(b)
    known = slots.where(F.col("value").isNotNull())

    def build(w):
        return [F.lead("slot").over(w).alias("__next_slot"), F.lead("value").over(w).alias("__next")]

    ahead = over_order(known, b.key, b.order, build, after=1)
    gap = (S.epoch_seconds("__next_slot") - S.epoch_seconds("slot")) / seconds
    rows = expand(ahead.withColumn("__n", F.coalesce(gap.cast("long"), F.lit(1))), "__n", "__i")
    value = F.col("value") + F.coalesce(
        (F.col("__next") - F.col("value")) * F.col("__i") / F.col("__n"), F.lit(0.0)
    )
    at = F.timestamp_seconds(S.epoch_seconds("slot") + F.col("__i") * seconds).cast("timestamp_ntz")
    return rows.select(*b.key, at.alias("slot"), value.alias("value"), (F.col("__i") > 0).alias("is_filled"))


def regular_series(df: DataFrame, b: Binding, seconds: int = HOUR) -> DataFrame:
    """Resample, then fill: the regular series that decomposition and forecasting take."""
    # the slots are few next to the raw rows, and every later size check reads them
    return interpolate(cut(resample(df, b, seconds)), b, seconds)


def decompose(series: DataFrame, b: Binding, period: int = 24, model: str = "additive", seconds: int = HOUR) -> DataFrame:
    """Classical trend, seasonal and residual parts of a regular series.

    The trend is the centred moving average of one period; the seasonal part is
    the mean detrended value of each phase, centred over the phases. Keys with
    fewer than two periods get null parts.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError(f"unknown model {model!r}")
    g = grid_binding(b)
    half = period // 2
    value = F.col("value")

    def build(w):
        if period % 2:
            frame = w.rowsBetween(-half, half)
            return [F.when(F.count("value").over(frame) == period, F.avg("value").over(frame)).alias("trend")]
        inner = w.rowsBetween(-(half - 1), half - 1)
        ends = F.lag("value", half).over(w) + F.lead("value", half).over(w)
        total = F.sum("value").over(inner) + ends / 2
        return [F.when(F.count("value").over(w.rowsBetween(-half, half)) == period + 1, total / period).alias("trend")]

    parts = over_order(series, g.key, g.order, build, half, half)
    parts = parts.withColumn("__phase", F.pmod(S.epoch_seconds("slot") / seconds, F.lit(period)).cast("int"))
    additive = model == "additive"
    loose = value - F.col("trend") if additive else F.try_divide(value, F.col("trend"))
    phases = parts.groupBy(*g.key, "__phase").agg(F.avg(loose).alias("__s"), F.count(F.lit(1)).alias("__n"))
    w = W.partitionBy(*g.key)  # at most ``period`` rows per key
    centre = F.avg("__s").over(w)
    seasonal = F.col("__s") - centre if additive else F.try_divide(F.col("__s"), centre)
    phases = phases.select(
        *g.key, "__phase", F.when(F.sum("__n").over(w) >= 2 * period, seasonal).alias("seasonal")
    )
    out = attach(parts, phases, (*g.key, "__phase")).drop("__phase")
    if additive:
        resid = value - F.col("trend") - F.col("seasonal")
    else:
        resid = F.try_divide(value, F.col("trend") * F.col("seasonal"))
    return out.withColumn("resid", resid)


def component_strength(parts: DataFrame, b: Binding) -> DataFrame:
    """How much of the variance trend and season explain, per key, with labels."""
    known = F.col("resid").isNotNull() & F.col("trend").isNotNull()
    r = F.when(known, F.col("resid"))

    def strength(component: str):
        whole = F.var_samp(F.when(known, F.col(component) + F.col("resid")))
        share = 1 - F.try_divide(F.var_samp(r), whole)
        return F.when(share < 0, 0.0).otherwise(share)

    has = F.col("trend").isNotNull()
    out = parts.groupBy(*b.key).agg(
        F.count("resid").alias("n"),
        strength("trend").alias("trend_strength"),
        strength("seasonal").alias("seasonal_strength"),
        F.stddev_samp(r).alias("residual_std"),
        (F.max_by("trend", F.when(has, F.col("slot"))) > F.min_by("trend", F.when(has, F.col("slot")))).alias("__up"),
        ((F.max("seasonal") - F.min("seasonal")) / 2).alias("seasonal_half_range"),
    )
    return out.select(
        *b.key,
        "n",
        "trend_strength",
        "seasonal_strength",
        "residual_std",
        "seasonal_half_range",
        F.when(F.col("__up"), "increasing").otherwise("decreasing").alias("trend_direction"),
        S.component_label(F.col("trend_strength")).alias("trend_label"),
        S.component_label(F.col("seasonal_strength")).alias("seasonal_label"),
    )


def decomposition_sentence(strengths: DataFrame) -> DataFrame:
    """``strengths`` with a sentence about trend, season and noise of each key."""
    trend = F.when(
        F.col("trend_label") == "weak", F.format_string("hardly any trend (%.2f)", "trend_strength")
    ).otherwise(F.format_string("a %s %s trend (%.2f)", "trend_label", "trend_direction", "trend_strength"))
    season = F.when(F.col("seasonal_label") == "weak", "hardly any season").otherwise(
        F.format_string("a %s season of %.1f either way", "seasonal_label", "seasonal_half_range")
    )
    noise = F.format_string("noise of %.2f", "residual_std")
    return strengths.withColumn("interpretation", F.concat_ws("; ", trend, season, noise))


def validate_series(df: DataFrame, b: Binding, min_points: int = 30, max_missing_pct: float = 20.0) -> DataFrame:
    """Whether each key can be modelled: enough points, not too many missing."""
    n = F.count(F.lit(1))
    pct = 100.0 * F.count_if(F.col(b.value).isNull()) / n
    out = df.groupBy(*b.key).agg(n.alias("n"), pct.alias("missing_pct"))
    status = (
        F.when(F.col("n") < min_points, "insufficient")
        .when(F.col("missing_pct") > max_missing_pct, "warning")
        .otherwise("ok")
    )
    return out.withColumn("status", status)


def spacing(df: DataFrame, b: Binding, fallback: int = HOUR) -> DataFrame:
    """Last timestamp and inferred spacing in seconds per key: the most frequent step if there is one."""
    steps = over_order(
        df.select(*b.key, *b.order),
        b.key,
        b.order,
        lambda w: [(S.epoch_seconds(b.ts) - S.epoch_seconds_of(F.lag(b.ts).over(w))).alias("__step")],
        before=1,
    )
    counts = steps.groupBy(*b.key, "__step").agg(F.count(F.lit(1)).alias("__n"), F.max(b.ts).alias("__last"))
    has = F.col("__step").isNotNull() & (F.col("__step") > 0)
    least = F.max_by("__step", F.when(has, F.struct("__n", -F.col("__step"))))
    most = F.max_by("__step", F.when(has, F.struct("__n", F.col("__step"))))
    out = counts.groupBy(*b.key).agg(
        F.max("__last").alias("last_ts"), F.when(least == most, least).alias("__mode")
    )
    return out.select(*b.key, "last_ts", F.coalesce("__mode", F.lit(fallback)).cast("long").alias("spacing"))


def future_grid(df: DataFrame, b: Binding, steps: int = 24) -> DataFrame:
    """``steps`` timestamps after the last one of every key, at its own spacing."""
    at = spacing(df, b).withColumn("__n", F.lit(steps).cast("long"))
    grid = expand(at, "__n", "__i")
    step = F.col("__i") + 1
    ts = F.timestamp_seconds(S.epoch_seconds("last_ts") + step * F.col("spacing")).cast("timestamp_ntz")
    return grid.select(*b.key, step.cast("int").alias("step"), ts.alias("ts"))
