"""Trend regression, two-sample tests and residual diagnostics, for all keys at once."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.functions import scalar as S
from obsframe.functions import special
from obsframe.operators.ordering import numbered, over_order, quantiles, same_rows
from obsframe.session import attach, bounded, cut, group_rows, link

ALPHA = 0.05
ROYSTON_MOST = 5000  # largest sample that the approximation of p was fitted for


# ---------------------------------------------------------------- trend


def linear_fit(df: DataFrame, b: Binding) -> tuple[DataFrame, DataFrame]:
    """Rows with their position in the series, and the regression of the target on it."""
    rows = numbered(df.where(F.col(b.value).isNotNull()), b.key, b.order, "position")
    y, x = F.col(b.value), F.col("position").cast("double")
    fit = rows.groupBy(*b.key).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r_squared"),
        F.regr_sxx(y, x).alias("__sxx"),
        F.regr_syy(y, x).alias("__syy"),
    )
    return rows, fit


def linear_trend(df: DataFrame, b: Binding, practical: float = 0.01) -> DataFrame:
    """Least-squares trend per key with its significance; null statistics below three rows."""
    _, fit = linear_fit(df, b)
    enough = F.col("n") >= 3
    stderr = F.sqrt(F.try_divide((1 - F.col("r_squared")) * F.col("__syy"), F.col("__sxx") * (F.col("n") - 2)))
    out = fit.withColumn("std_error", F.when(enough, stderr))
    out = out.withColumn("t_statistic", F.try_divide("slope", "std_error"))
    p = special.t_two_sided(F.col("t_statistic"), (F.col("n") - 2).cast("double"))
    out = out.withColumn("p_value", F.when(enough, F.when(F.col("std_error") == 0, 0.0).otherwise(p)))
    significant = F.col("p_value") < ALPHA
    direction = F.when(F.col("slope") > 0, "increasing").otherwise("decreasing")
    return out.select(
        *b.key,
        "n",
        *[F.when(enough, F.col(c)).alias(c) for c in ("slope", "intercept", "r_squared")],
        "std_error",
        "t_statistic",
        "p_value",
        F.when(enough, S.direction_label(F.col("slope"), practical)).otherwise("insufficient").alias("trend_direction"),
        significant.alias("is_significant"),
        (F.abs("slope") >= practical).alias("is_practically_significant"),
        F.when(
            significant,
            F.format_string(
                "The series is %s beyond chance; a straight line is a %s description of it (R² %.3f)",
                direction,
                S.fit_label(F.col("r_squared")),
                F.col("r_squared"),
            ),
        )
        .otherwise("The slope may well be chance")
        .alias("interpretation"),
    )


def trend_residuals(df: DataFrame, b: Binding) -> DataFrame:
    """Rows with ``residual`` from the key's trend line, ``position`` and the series length ``n``."""
    rows, fit = linear_fit(df, b)
    placed, rows = rows, attach(rows, fit.select(*b.key, "n", "slope", "intercept"), b.key)
    line = F.col("intercept") + F.col("slope") * F.col("position")
    return same_rows(placed, rows.withColumn("residual", F.col(b.value) - line).drop("slope", "intercept"))


def durbin_watson(residuals: DataFrame, b: Binding, column: str = "residual") -> DataFrame:
    lagged = over_order(residuals, b.key, b.order, lambda w: [F.lag(column).over(w).alias("__prev")], before=1)
    e, prev = F.col(column), F.col("__prev")
    out = lagged.groupBy(*b.key).agg(F.try_divide(F.sum((e - prev) * (e - prev)), F.sum(e * e)).alias("durbin_watson"))
    d = F.col("durbin_watson")
    return out.withColumn("is_independent", (d > 1.5) & (d < 2.5))


def residual_diagnostics(residuals: DataFrame, b: Binding, column: str = "residual") -> DataFrame:
    """Zero mean and lag-1 correlation of residuals; null below three."""
    rows = same_rows(residuals, residuals.where(F.col(column).isNotNull()))
    lagged = over_order(rows, b.key, b.order, lambda w: [F.lag(column).over(w).alias("__prev")], before=1)
    out = lagged.groupBy(*b.key).agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean_residual"),
        F.stddev_pop(column).alias("std_residual"),
        F.corr(column, "__prev").alias("lag_1_acf"),
    )
    out = out.withColumn("lag_1_acf", F.when(~F.isnan("lag_1_acf") & (F.col("n") >= 3), F.col("lag_1_acf")))
    return out.withColumn("is_zero_mean", F.abs("mean_residual") < 0.1 * F.col("std_residual")).withColumn(
        "is_white_noise", F.abs("lag_1_acf") < 0.2
    )


# ---------------------------------------------------------------- variance


def deviations(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Per group: size, mean and spread of the absolute deviations from the group median."""
    rows = df.where(F.col(value).isNotNull())
    medians = quantiles(rows, key, [F.count(F.lit(1)).alias("__n")], {"__median": (value, 0.5)}).drop("__n")
    z = F.abs(F.col(value) - F.col("__median"))
    away = attach(rows, medians, tuple(key)).withColumn("__z", z)
    return away.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.avg("__z").alias("z_mean"), F.var_pop("__z").alias("z_var")
    )


def levene(df: DataFrame, key: Sequence[str], group: str, value: str) -> DataFrame:
    """Median-centred Levene test over the groups of each key."""
    spread = deviations(df, (*key, group), value)
    n, z = F.col("n"), F.col("z_mean")
    out = spread.groupBy(*key).agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("n").alias("n"),
        F.sum(n * F.col("z_var")).alias("__within"),
        # between-group sum of squares as a weighted variance of the group means
        (F.sum(n * z * z) - F.sum(n * z) * F.sum(n * z) / F.sum(n)).alias("__between"),
    )
    d1, d2 = F.col("groups") - 1, F.col("n") - F.col("groups")
    out = out.withColumn("levene_w", F.try_divide(d2 * F.col("__between"), d1 * F.col("__within")))
    p = special.f_upper(F.col("levene_w"), d1.cast("double"), d2.cast("double"))
    return out.withColumn("p_value", p).drop("__within", "__between")


def levene_halves(residuals: DataFrame, b: Binding, column: str = "residual") -> DataFrame:
    """Constant variance: first half of a series against its second half, from four rows on."""
    half = F.col("position") < F.floor(F.col("n") / 2)
    rows = residuals.where(F.col("n") >= 4).select(*b.key, column, half.alias("__half"))
    return levene(rows, b.key, "__half", column).drop("groups")


# ---------------------------------------------------------------- normality

# Royston (1995): polynomials in 1/sqrt(n) that correct the two outermost weights
LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056)
NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
# Royston (1995): normalising polynomials, in n up to 11 and in log(n) above
SMALL_GAMMA = (-2.273, 0.459)
SMALL_MEAN = (0.5440, -0.39978, 0.025054, -0.0006714)
SMALL_LOG_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_LOG_SD = (-0.4803, -0.082676, 0.0030302)


def poly(x: Column, coefficients: Sequence[float]) -> Column:
    out = F.lit(0.0)
    for c in reversed(coefficients):
        out = out * x + F.lit(c)
    return out


def shapiro(df: DataFrame, key: Sequence[str], value: str, skip_from: int | None = None) -> DataFrame:
    """Shapiro-Wilk W per key, at every size, and whether the values pass for normal.

    p follows Royston's approximation up to the 5,000 values it was fitted for; beyond that it is the
    large-sample one of skewness and kurtosis (Jarque-Bera, chi-square with two degrees of freedom), as
    ``p_method`` says. ``skip_from`` takes keys of that size or more as normal without a test. Keys below three
    values or without spread have no W and no p.
    """
    rows = df.where(F.col(value).isNotNull()).select(*key, F.col(value).cast("double").alias("x"))
    placed = numbered(rows, key, ("x",), "i", "n").withColumn("i", F.col("i") + 1)
    rows = cut(placed.withColumn("m", special.normal_score((F.col("i") - 0.375) / (F.col("n") + 0.25))))
    n = F.col("n")
    m_at = lambda back: F.max(F.when(F.col("i") == n - back, F.col("m")))
    shape = rows.groupBy(*key).agg(
        F.sum(F.col("m") * F.col("m")).alias("ss"), m_at(0).alias("m1"), m_at(1).alias("m2"),
        F.first("n").alias("size"), F.avg("x").alias("centre"),
        F.skewness("x").alias("__skew"), F.kurtosis("x").alias("__excess"),
    )
    u, root = 1 / F.sqrt("size"), F.sqrt("ss")
    a1 = F.try_divide(F.col("m1"), root) + poly(u, LAST_WEIGHT)
    a2 = F.try_divide(F.col("m2"), root) + poly(u, NEXT_WEIGHT)
    shape = shape.withColumn("a1", F.when(F.col("size") == 3, math.sqrt(0.5)).otherwise(a1)).withColumn(
        "a2", F.when(F.col("size") > 5, a2)
    )
    taken = 2 * F.col("a1") * F.col("a1") + F.coalesce(2 * F.col("a2") * F.col("a2"), F.lit(0.0))
    lost = 2 * F.col("m1") * F.col("m1") + F.when(F.col("size") > 5, 2 * F.col("m2") * F.col("m2")).otherwise(0.0)
    shape = cut(shape.withColumn("phi", F.try_divide(F.col("ss") - lost, 1 - taken)).drop("ss", "m1", "m2"))
    rows = attach(rows.where(n >= 3), shape.drop("size", "__skew", "__excess"), tuple(key))
    edge = F.least(F.col("i") - 1, n - F.col("i"))
    size = F.when(edge == 0, F.col("a1")).when((edge == 1) & F.col("a2").isNotNull(), F.col("a2"))
    middle = F.when(F.col("m") == 0, 0.0).otherwise(F.abs("m") / F.sqrt("phi"))
    weight = F.signum("m") * F.coalesce(size, middle)
    off = F.col("x") - F.col("centre")
    w = rows.groupBy(*key).agg(F.try_divide(F.pow(F.sum(weight * off), 2), F.sum(off * off)).alias("w"))
    sizes = shape.select(*key, F.col("size").alias("n"), "__skew", "__excess")
    out = link(sizes, w, tuple(key)).withColumn("w", F.when(F.col("w") > 1, 1.0).otherwise(F.col("w")))
    log_n = F.log(n)
    tail = F.log1p(-F.when(F.col("w") < 1, F.col("w")))
    z_small = (-F.log(poly(n, SMALL_GAMMA) - tail) - poly(n, SMALL_MEAN)) / F.exp(poly(n, SMALL_LOG_SD))
    z_large = (tail - poly(log_n, LARGE_MEAN)) / F.exp(poly(log_n, LARGE_LOG_SD))
    three = F.greatest(6 / math.pi * (F.asin(F.sqrt("w")) - math.asin(math.sqrt(0.75))), F.lit(0.0))
    out = out.withColumn("__z", F.when(n <= 11, z_small).otherwise(z_large))
    moments = n / 6 * (F.col("__skew") * F.col("__skew") + F.col("__excess") * F.col("__excess") / 4)
    p = F.when(n == 3, three).when(n > ROYSTON_MOST, F.exp(-moments / 2)).when(F.col("w") == 1, 1.0)
    p = p.otherwise(special.normal_upper(F.col("__z")))
    skipped = F.lit(False) if skip_from is None else n >= skip_from
    tested = F.col("w").isNotNull() & ~skipped
    out = out.withColumn("normality_tested", tested)
    out = out.withColumn("p_value", F.when(tested, p).when(skipped, 1.0))
    method = F.when(n > ROYSTON_MOST, "moments").otherwise("royston")
    out = out.withColumn("p_method", F.when(tested, method))
    return out.withColumn("is_normal", F.col("p_value") > ALPHA).drop("__z", "__skew", "__excess")


def residual_checks(residuals: DataFrame, b: Binding, column: str = "residual") -> DataFrame:
    """Mean, lag-1 correlation, independence, equal variance and normality of residuals, a row per key."""
    out = residual_diagnostics(residuals, b, column)
    normal = shapiro(residuals, b.key, column).select(*b.key, "w", F.col("p_value").alias("normal_p"), "is_normal")
    halves = levene_halves(residuals, b, column).select(*b.key, "levene_w", F.col("p_value").alias("levene_p"))
    for part in (durbin_watson(residuals, b, column), halves, normal):
        out = link(out, part, b.key)
    return out.withColumn("is_homoscedastic", F.col("levene_p") > ALPHA)


# ---------------------------------------------------------------- two samples


def moments(df: DataFrame, b: Binding) -> DataFrame:
    v = b.value
    return df.groupBy(*b.key).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.var_samp(v).alias("var")
    )


def pair_list(df: DataFrame, b: Binding, pairs: Sequence[tuple]) -> DataFrame:
    """The pairs to test, given by the caller, as a frame."""
    kind = df.schema[b.key[0]].dataType.simpleString()
    return df.sparkSession.createDataFrame(list(pairs), f"key_a {kind}, key_b {kind}")


def side_by_side(stats: DataFrame, b: Binding, pairs: DataFrame) -> DataFrame:
    """Per-key statistics of both members of each pair, suffixed _a and _b."""
    small = bounded(cut(stats))
    out = pairs
    for side in ("a", "b"):
        named = small.select(
            F.col(b.key[0]).alias(f"key_{side}"),
            *[F.col(c).alias(f"{c}_{side}") for c in stats.columns if c not in b.key],
        )
        out = link(out, named, (f"key_{side}",), "inner")
    return out


def t_tests(pairs: DataFrame) -> DataFrame:
    """Student and Welch t of mean differences, with degrees of freedom."""
    na, nb = F.col("n_a"), F.col("n_b")
    va, vb = F.col("var_a") / na, F.col("var_b") / nb
    diff = F.col("mean_a") - F.col("mean_b")
    pooled = ((na - 1) * F.col("var_a") + (nb - 1) * F.col("var_b")) / (na + nb - 2)
    welch_df = F.try_divide((va + vb) * (va + vb), va * va / (na - 1) + vb * vb / (nb - 1))
    return pairs.select(
        "*",
        diff.alias("difference"),
        F.sqrt(pooled).alias("pooled_std"),
        F.try_divide(diff, F.sqrt(pooled * (1 / na + 1 / nb))).alias("student_t"),
        (na + nb - 2).cast("double").alias("student_df"),
        F.try_divide(diff, F.sqrt(va + vb)).alias("welch_t"),
        welch_df.alias("welch_df"),
        F.sqrt(va + vb).alias("diff_se"),
    )


def mann_whitney(df: DataFrame, b: Binding, pairs: DataFrame) -> DataFrame:
    """U of the first sample of each pair with its tie-corrected normal score.

    All pairs are answered from one table of value counts per key, cut into ranges of the value: neither rows nor
    counts are copied or sorted per pair. A range gives each pair the U of its own values; those of the first
    sample also beat all of the second's in earlier ranges, which the counts per key and range tell. Values are
    compared as doubles; a null key is a key; pairs with an empty side have no row.
    """
    spark, pair = df.sparkSession, ("key_a", "key_b")
    kind = df.schema[b.key[0]].dataType.simpleString()
    # the pairs are the caller's own arguments
    asked = [tuple(r) for r in pairs.select(*pair).distinct().collect()]
    number = {k: i for i, k in enumerate(dict.fromkeys(k for p in asked for k in p))}
    sides = spark.createDataFrame([(k, i) for k, i in number.items()], f"__k {kind}, side int")
    wanted = spark.createDataFrame([(a, z, number[a], number[z]) for a, z in asked], f"key_a {kind}, key_b {kind}, a int, b int")
    rows = df.select(F.col(b.key[0]).alias("__k"), F.col(b.value).cast("double").alias("x")).where("x is not null")
    counts = cut(link(rows, bounded(sides), ("__k",), "inner").groupBy("side", "x").agg(F.count(F.lit(1)).alias("c")))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-counts.count() // group_rows(spark)))
    # equal values of all keys share a range; each has a single row per key, so none is hot
    counts = cut(counts.repartitionByRange(ranges, "x").withColumn("part", F.spark_partition_id()))
    near = counts.mapInPandas(within_range([(number[a], number[z]) for a, z in asked]), "a int, b int, u double, shared double")
    near = near.groupBy("a", "b").agg(F.sum("u").alias("u"), F.sum("shared").alias("shared"))

    c = F.col("c").cast("double")
    held = cut(counts.groupBy("side", "part").agg(F.sum(c).alias("n"), F.sum(c * c * c - c).alias("ties")))
    total = held.groupBy("side").agg(F.sum("n").alias("m"), F.sum("ties").alias("ties"))
    # a row per key and range, also where the key has no values there
    every = sides.select("side").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))))
    every = link(every, held.drop("ties"), ("side", "part")).fillna(0.0, ["n"])
    before = F.coalesce(F.sum("n").over(W.partitionBy("side").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    every = cut(every.withColumn("before", before))
    first = every.select(F.col("side").alias("a"), "part", F.col("n").alias("n_a"))
    second = every.select(F.col("side").alias("b"), "part", F.col("before").alias("b_before"))
    far = link(link(wanted.select("a", "b"), first, ("a",), "inner"), second, ("b", "part"), "inner")
    far = far.groupBy("a", "b").agg(F.sum(F.col("n_a") * F.col("b_before")).alias("far"))

    out = link(link(wanted, near, ("a", "b")), far, ("a", "b"))
    for side in ("a", "b"):
        out = link(out, total.select(F.col("side").alias(side), F.col("m").alias(f"m_{side}"), F.col("ties").alias(f"ties_{side}")), (side,), "inner")
    ma, mb = F.col("m_a"), F.col("m_b")
    n = ma + mb
    ties = F.col("ties_a") + F.col("ties_b") + F.coalesce("shared", F.lit(0.0))
    sd = F.sqrt(ma * mb / 12 * (n + 1 - F.try_divide(ties, n * (n - 1))))
    out = out.withColumn("u", F.coalesce("u", F.lit(0.0)) + F.coalesce("far", F.lit(0.0)))
    z = F.try_divide(F.greatest(F.col("u"), ma * mb - F.col("u")) - ma * mb / 2 - 0.5, sd)
    return out.withColumn("z", z).select(*pair, "u", "z", F.lit("asymptotic").alias("p_method"))


def within_range(asked: Sequence[tuple[int, int]]):
    """Function for mapInPandas on the counts of a range of values: each pair's U inside it, and what values held
    by both sides add to the sum of t^3 - t over ties."""

    def run(batches):
        frames = [pdf for pdf in batches if len(pdf)]
        if not frames:
            return
        pdf = pd.concat(frames).sort_values("x", kind="stable")
        held = {s: (g["x"].to_numpy(), g["c"].to_numpy(dtype=float)) for s, g in pdf.groupby("side")}
        out = []
        for a, b in asked:
            if a not in held or b not in held:
                continue
            (x, c), (y, d) = held[a], held[b]
            lo, hi = np.searchsorted(y, x, side="left"), np.searchsorted(y, x, side="right")
            run_d = np.concatenate([[0.0], np.cumsum(d)])
            tied = run_d[hi] - run_d[lo]
            out.append((a, b, float((c * (run_d[lo] + tied / 2)).sum()), float((3 * c * tied * (c + tied)).sum())))
        yield pd.DataFrame(out, columns=["a", "b", "u", "shared"])

    return run


def levene_pairs(df: DataFrame, b: Binding, pairs: DataFrame) -> DataFrame:
    """Levene W of each pair, from the per-key deviations."""
    sides = side_by_side(deviations(df, b.key, b.value), b, pairs)
    na, nb = F.col("n_a"), F.col("n_b")
    total = na + nb
    grand = (na * F.col("z_mean_a") + nb * F.col("z_mean_b")) / total
    between = na * F.pow(F.col("z_mean_a") - grand, 2) + nb * F.pow(F.col("z_mean_b") - grand, 2)
    within = na * F.col("z_var_a") + nb * F.col("z_var_b")
    w = F.try_divide((total - 2) * between, within)
    out = sides.select("key_a", "key_b", w.alias("levene_w"), (total - 2).cast("double").alias("__d2"))
    return out.withColumn("levene_p", special.f_upper("levene_w", F.lit(1.0), F.col("__d2"))).drop("__d2")


def two_sample(df: DataFrame, b: Binding, pairs: Sequence[tuple]) -> DataFrame:
    """Pick and run the fitting test for every pair: t, Welch or Mann-Whitney.

    Samples below three values give status ``insufficient`` and null statistics.
    """
    wanted = pair_list(df, b, pairs)
    base = moments(df, b)
    normal = shapiro(df, b.key, b.value).select(*b.key, F.col("p_value").alias("normal_p"), "normality_tested")
    both = t_tests(side_by_side(link(base, normal, b.key), b, wanted))
    pair = ("key_a", "key_b")
    both = link(link(both, levene_pairs(df, b, wanted), pair), mann_whitney(df, b, wanted), pair)
    return decide(cut(both))


def decide(both: DataFrame) -> DataFrame:
    enough = (F.col("n_a") >= 3) & (F.col("n_b") >= 3)
    normal = (F.col("normal_p_a") > ALPHA) & (F.col("normal_p_b") > ALPHA)
    equal = F.col("levene_p") > ALPHA
    test = F.when(normal & equal, "student").when(normal, "welch").otherwise("mann_whitney")
    out = both.withColumn("test_used", F.when(enough, test))
    t = F.when(F.col("test_used") == "student", F.col("student_t")).otherwise(F.col("welch_t"))
    deg = F.when(F.col("test_used") == "student", F.col("student_df")).otherwise(F.col("welch_df"))
    ranked = F.col("test_used") == "mann_whitney"
    out = out.withColumn("statistic", F.when(enough, F.when(ranked, F.col("u")).otherwise(t)))
    out = out.withColumn("__t", t).withColumn("__df", deg)
    # the continuity correction can push the score of equal samples below zero
    p_rank = F.when(F.col("z") < 0, 1.0).otherwise(special.normal_two_sided("z"))
    p = F.when(ranked, p_rank).otherwise(special.t_two_sided("__t", "__df"))
    out = out.withColumn("p_value", F.when(enough, p))
    out = out.withColumn("effect_size", F.when(ranked, rank_biserial()).otherwise(cohen_d()))
    half = special.t_quantile(F.lit(1 - ALPHA / 2), F.col("student_df"))
    out = out.withColumn("__half", half * F.col("diff_se"))
    significant = F.col("p_value") < ALPHA
    return out.select(
        "key_a", "key_b", "n_a", "n_b", "mean_a", "std_a", "mean_b", "std_b", "difference",
        (F.col("difference") - F.col("__half")).alias("ci_lower"),
        (F.col("difference") + F.col("__half")).alias("ci_upper"),
        "test_used", "statistic", "p_value", significant.alias("is_significant"),
        "normal_p_a", "normal_p_b", "normality_tested_a", "normality_tested_b", "levene_w", "levene_p",
        "effect_size",
        F.when(ranked, "rank_biserial").otherwise("cohen_d").alias("effect_type"),
        S.effect_label(F.col("effect_size")).alias("effect_label"),
        F.when(enough, "ok").otherwise("insufficient").alias("status"),
        sentence(significant).alias("interpretation"),
    )


def sentence(significant: Column) -> Column:
    """The result in words; the size of the effect has its own column."""
    above = F.when(F.col("difference") > 0, "above").otherwise("below")
    names = [F.col("key_a").cast("string"), F.col("key_b").cast("string")]
    told = F.format_string("Mean of %s is %.2f %s that of %s (p = %.4f)", names[0], F.abs("difference"), above, names[1], F.col("p_value"))
    return F.when(significant, told).otherwise(
        F.format_string("No difference shown between %s and %s (p = %.4f)", *names, F.col("p_value"))
    )


def cohen_d() -> Column:
    return F.when(F.col("pooled_std") > 0, F.col("difference") / F.col("pooled_std")).otherwise(0.0)


def rank_biserial() -> Column:
    return 1 - 2 * F.col("u") / (F.col("n_a") * F.col("n_b"))


def effect_size(df: DataFrame, b: Binding, pairs: Sequence[tuple]) -> DataFrame:
    """Both effect sizes with their labels for every pair."""
    wanted = pair_list(df, b, pairs)
    both = t_tests(side_by_side(moments(df, b), b, wanted))
    both = link(both, mann_whitney(df, b, wanted), ("key_a", "key_b"))
    out = both.select("key_a", "key_b", cohen_d().alias("cohen_d"), rank_biserial().alias("rank_biserial"))
    return out.withColumn("cohen_label", S.effect_label(F.col("cohen_d"))).withColumn(
        "rank_label", S.effect_label(F.col("rank_biserial"))
    )
