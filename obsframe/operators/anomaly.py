"""Threshold detectors, voting, method comparison and recommendation."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.operators.ordering import quantiles, same_rows
from obsframe.session import attach, cut, link

MIN_ZSCORE, MIN_IQR = 3, 4
TOGETHER = 3  # detectors that run side by side for a vote


def check_contamination(contamination: float) -> float:
    if not 0 < contamination < 0.5:
        raise ValueError("contamination must lie between 0 and 0.5")
    return contamination


def zscore_baseline(df: DataFrame, b: Binding) -> DataFrame:
    v = b.value
    return df.groupBy(*b.key).agg(
        F.count(v).alias("__n"), F.avg(v).alias("__mean"), F.stddev_samp(v).alias("__std")
    )


def zscore_flags(rows: DataFrame, b: Binding, threshold: float) -> DataFrame:
    """Score rows that already carry their key's baseline."""
    usable = (F.col("__n") >= MIN_ZSCORE) & (F.col("__std") > 0)
    z = F.when(usable, (F.col(b.value) - F.col("__mean")) / F.col("__std"))
    out = rows.withColumn("z_score", z)
    out = out.withColumn("is_anomaly", F.coalesce(F.abs("z_score") > threshold, F.lit(False)))
    return out.drop("__n", "__mean", "__std")


def zscore(df: DataFrame, b: Binding, threshold: float = 3.0) -> DataFrame:
    return zscore_flags(attach(df, zscore_baseline(df, b), b.key), b, threshold)


def iqr(df: DataFrame, b: Binding, multiplier: float = 1.5) -> DataFrame:
    """Flag values outside the quartile fences; the score is the distance past the fence."""
    v = F.col(b.value)
    fences = quantiles(df, b.key, [F.count(b.value).alias("__n")], {"__q1": (b.value, 0.25), "__q3": (b.value, 0.75)})
    reach = (F.col("__q3") - F.col("__q1")) * multiplier
    usable = F.col("__n") >= MIN_IQR
    fences = fences.select(
        *b.key,
        F.when(usable, F.col("__q1") - reach).alias("lower_fence"),
        F.when(usable, F.col("__q3") + reach).alias("upper_fence"),
    )
    rows = attach(df, fences, b.key)
    past = F.when(v < F.col("lower_fence"), F.col("lower_fence") - v).when(
        v > F.col("upper_fence"), v - F.col("upper_fence")
    )
    score = F.when(F.col("lower_fence").isNotNull() & v.isNotNull(), F.coalesce(past, F.lit(0.0)))
    return rows.withColumn("score", score).withColumn("is_anomaly", F.coalesce(F.col("score") > 0, F.lit(False)))


def impute_scale(df: DataFrame, b: Binding, suffix: str = "_scaled") -> DataFrame:
    """Median for missing, then zero mean and unit population deviation, per key.

    The moments of the imputed column follow from those of the present values,
    the median and the two counts, so one pass over the data is enough.
    """
    aggs = [F.count(F.lit(1)).cast("double").alias("__n")]
    wanted = {}
    for v in b.values:
        aggs += [
            F.count(v).cast("double").alias(f"__c_{v}"),
            F.avg(v).alias(f"__m_{v}"),
            F.var_pop(v).alias(f"__v_{v}"),
        ]
        wanted[f"__med_{v}"] = (v, 0.5)
    stats = quantiles(df, b.key, aggs, wanted)
    keep = []
    for v in b.values:
        n, c = F.col("__n"), F.col(f"__c_{v}")
        med, mean = F.col(f"__med_{v}"), F.col(f"__m_{v}")
        whole = mean + (n - c) / n * (med - mean)
        var = c / n * F.col(f"__v_{v}") + c * (n - c) / (n * n) * (med - mean) * (med - mean)
        keep += [
            med.alias(f"__med_{v}"),
            whole.alias(f"__mean_{v}"),
            F.when(var > 0, F.sqrt(var)).otherwise(1.0).alias(f"__sd_{v}"),
        ]
    rows = attach(df, stats.select(*b.key, F.col("__n").alias("__rows"), *keep), b.key)
    scaled = {
        f"{v}{suffix}": (F.coalesce(F.col(v), F.col(f"__med_{v}")) - F.col(f"__mean_{v}")) / F.col(f"__sd_{v}")
        for v in b.values
    }
    return same_rows(df, rows.withColumns(scaled).drop(*[f"__{s}_{v}" for s in ("med", "mean", "sd") for v in b.values]))


def flags(scored: DataFrame, b: Binding, method: str) -> DataFrame:
    return scored.where(F.col("is_anomaly")).select(*b.key, *b.id, F.lit(method).alias("method"))


def vote(flagged: Mapping[str, DataFrame], b: Binding, threshold: int = 2) -> DataFrame:
    """Rows that at least ``threshold`` of the methods flagged, with their votes.

    Only flagged rows are shuffled to be counted.
    """
    union = reduce(DataFrame.unionByName, [flags(s, b, m) for m, s in flagged.items()])
    votes = union.groupBy(*b.key, *b.id).agg(
        F.count(F.lit(1)).alias("vote_count"), F.array_sort(F.collect_set("method")).alias("methods")
    )
    return votes.where(F.col("vote_count") >= threshold).select(
        "*", F.lit(len(flagged)).alias("max_votes"), (100.0 * F.col("vote_count") / len(flagged)).alias("vote_pct")
    )


def run_together(detectors: Mapping[str, Callable[[DataFrame], DataFrame]], df: DataFrame) -> dict[str, DataFrame]:
    """What each detector makes of ``df``, in the detectors' order.

    A detector is a row of jobs, many of them short; some side by side leave fewer cores idle.
    """
    with ThreadPoolExecutor(TOGETHER) as pool:
        started = {method: pool.submit(inheritable_thread_target(df.sparkSession)(detect), df) for method, detect in detectors.items()}
        return {method: run.result() for method, run in started.items()}


def vote_distribution(flagged: Mapping[str, DataFrame], b: Binding) -> DataFrame:
    """How many rows of each key got 1, 2, ... votes."""
    votes = vote(flagged, b, threshold=1)
    return votes.groupBy(*b.key, "vote_count").agg(F.count(F.lit(1)).alias("n_rows"))


def consensus_share(df: DataFrame, b: Binding, consensus: DataFrame) -> DataFrame:
    total = df.groupBy(*b.key).agg(F.count(F.lit(1)).alias("n"))
    hit = consensus.groupBy(*b.key).agg(F.count(F.lit(1)).alias("n_consensus"))
    out = attach(total, hit, b.key).na.fill(0, ["n_consensus"])
    return out.withColumn("consensus_pct", 100.0 * F.col("n_consensus") / F.col("n"))


SCORES = ("score", "z_score", "lof")  # what the detectors call their score


def compare_methods(scored: Mapping[str, DataFrame], b: Binding, df: DataFrame | None = None) -> DataFrame:
    """Flagged count and share per key and method; unscored keys are ``insufficient``.

    Detectors leave out keys that are too short for them: with ``df``, the rows they were given,
    those keys are reported too.
    """
    parts = []
    for method, frame in scored.items():
        score = next(c for c in SCORES if c in frame.columns)
        parts.append(
            frame.groupBy(*b.key).agg(
                F.lit(method).alias("method"),
                F.count_if(F.col("is_anomaly")).alias("anomalies"),
                F.count(F.lit(1)).alias("n"),
                F.when(F.count(score) > 0, "ok").otherwise("insufficient").alias("status"),
            )
        )
    out = reduce(DataFrame.unionByName, parts)
    if df is not None:
        methods = F.explode(F.array(*map(F.lit, scored))).alias("method")
        every = df.groupBy(*b.key).agg(F.count(F.lit(1)).alias("__n")).select("*", methods)
        out = link(every, out, (*b.key, "method"))
        out = out.select(
            *b.key, "method", F.coalesce("anomalies", F.lit(0)).alias("anomalies"),
            F.coalesce("n", "__n").alias("n"), F.coalesce("status", F.lit("insufficient")).alias("status"),
        )
    return out.withColumn("pct", 100.0 * F.col("anomalies") / F.col("n"))


def timed_comparison(detectors: Mapping[str, Callable[[DataFrame], DataFrame]], df: DataFrame, b: Binding) -> DataFrame:
    """Run each detector over ``df`` and compare them, with the seconds each one took."""
    scored, seconds = {}, {}
    for method, detect in detectors.items():
        start = time.perf_counter()
        scored[method] = cut(detect(df))
        seconds[method] = time.perf_counter() - start
    taken = F.coalesce(*[F.when(F.col("method") == m, F.lit(s)) for m, s in seconds.items()])
    return compare_methods(scored, b, df).withColumn("elapsed_seconds", taken)


def summary(df: DataFrame, b: Binding) -> DataFrame:
    """Counts and shares of both threshold detectors per key, from one scored frame."""
    scored = zscore(df, b).withColumnRenamed("is_anomaly", "__z")
    scored = iqr(scored, b)
    out = scored.groupBy(*b.key).agg(
        F.count(F.lit(1)).alias("total_points"),
        F.count_if(F.col("__z")).alias("zscore_anomalies"),
        F.count_if(F.col("is_anomaly")).alias("iqr_outliers"),
    )
    return out.withColumn("zscore_pct", 100.0 * F.col("zscore_anomalies") / F.col("total_points")).withColumn(
        "iqr_pct", 100.0 * F.col("iqr_outliers") / F.col("total_points")
    )


# Fixed texts: (method, reason, priority) by size of the series
SMALL_ADVICE = (("Z-Score or IQR", "Small dataset - use simple statistical methods", "High"),)
MEDIUM_ADVICE = (
    ("Isolation Forest", "Medium dataset - efficient and robust ML method", "High"),
    ("Local Outlier Factor", "Good for detecting local anomalies in medium datasets", "Medium"),
)
LARGE_ADVICE = (
    (
        "Ensemble (Isolation Forest + LOF + Z-Score)",
        "Large dataset - combine multiple ML methods for robust detection",
        "High",
    ),
    ("Isolation Forest", "Scales well to large datasets, fast execution", "High"),
)
WIDE_ADVICE = (
    ("PCA + Isolation Forest", "Multiple features - dimensionality reduction may help", "Low"),
)


def recommend(df: DataFrame, b: Binding) -> DataFrame:
    """Which detectors suit each key, by its row count and the number of features."""
    p = len(b.values)
    extra = WIDE_ADVICE if p >= 4 else ()

    def entries(advice: Sequence[tuple[str, str, str]]) -> Column:
        rows = [
            F.struct(F.lit(m).alias("method"), F.lit(r).alias("reason"), F.lit(q).alias("priority"))
            for m, r, q in (*advice, *extra)
        ]
        return F.array(*rows)

    n = F.col("n_samples")
    advice = (
        F.when(n < 30, entries(SMALL_ADVICE)).when(n < 100, entries(MEDIUM_ADVICE)).otherwise(entries(LARGE_ADVICE))
    )
    out = df.groupBy(*b.key).agg(F.count(F.lit(1)).alias("n_samples"))
    out = out.withColumn("n_features", F.lit(p)).withColumn("sample_to_feature_ratio", n / p)
    return out.withColumn("__e", F.explode(advice)).select("*", "__e.*").drop("__e")


def contamination_flags(scored: DataFrame, b: Binding, score: str, contamination: float) -> DataFrame:
    """Flag the rows whose score exceeds their key's (1 - contamination) quantile.

    The scored rows are materialised once: both the cut and the flags read them.
    """
    check_contamination(contamination)
    scored = same_rows(scored, cut(scored))
    at = quantiles(scored, b.key, [F.count(F.lit(1)).alias("__n")], {"score_cut": (score, 1 - contamination)}).drop("__n")
    out = attach(scored, at, b.key)
    return out.withColumn("is_anomaly", F.coalesce(F.col(score) > F.col("score_cut"), F.lit(False)))
