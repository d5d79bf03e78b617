"""Profiles, comparisons, extremes and the summary report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.functions.scalar import missing
from obsframe.operators.ordering import average_rank, quantiles
from obsframe.session import attach, cut, link


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("records"))


def distinct_keys(df: DataFrame, b: Binding) -> DataFrame:
    return df.select(*b.key).distinct()


def target_stats(df: DataFrame, b: Binding) -> DataFrame:
    """Mean, min, max and count of the target for every key and overall, in one scan."""
    v = b.value
    return (
        df.rollup(*b.key)
        .agg(
            F.grouping_id().cast("int").alias("is_total"),
            F.avg(v).alias("avg_value"),
            F.min(v).alias("min_value"),
            F.max(v).alias("max_value"),
            F.count(v).alias("n"),
        )
    )


def bias_corrected_skew(v: str) -> Column:
    n = F.count(v)
    g = F.skewness(v) * F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
    return F.when(F.stddev_pop(v) > 0, g)


def bias_corrected_kurtosis(v: str) -> Column:
    n = F.count(v)
    scale = (n - 1) / F.when(n > 3, (n - 2) * (n - 3))
    return F.when(F.stddev_pop(v) > 0, scale * ((n + 1) * F.kurtosis(v) + 6))


PROFILE = (
    "count", "mean", "std", "min", "q25", "q50", "q75", "max",
    "variance", "skewness", "kurtosis", "range", "iqr", "cv_pct",
)


def tall(df: DataFrame, key: Sequence[str], labels: Sequence[str], fields: Sequence[str], label: str) -> DataFrame:
    """Turn wide columns ``<label>__<field>`` into one row per label."""
    entries = [
        F.struct(F.lit(x).alias(label), *[F.col(f"{x}__{f}").alias(f) for f in fields]) for x in labels
    ]
    return df.select(*key, F.explode(F.array(*entries)).alias("__e")).select(*key, "__e.*")


def descriptive_stats(df: DataFrame, b: Binding) -> DataFrame:
    """Fourteen statistics per key and variable; one wide aggregate, unpivoted after."""
    aggs, wanted = [], {}
    for v in b.values:
        mean, std = F.avg(v), F.stddev_samp(v)
        aggs += [
            F.count(v).alias(f"{v}__count"),
            mean.alias(f"{v}__mean"),
            std.alias(f"{v}__std"),
            F.min(v).cast("double").alias(f"{v}__min"),
            F.max(v).cast("double").alias(f"{v}__max"),
            F.var_samp(v).alias(f"{v}__variance"),
            bias_corrected_skew(v).alias(f"{v}__skewness"),
            bias_corrected_kurtosis(v).alias(f"{v}__kurtosis"),
            (F.max(v) - F.min(v)).cast("double").alias(f"{v}__range"),
            F.try_divide(std, mean).alias(f"{v}__cv"),
        ]
        wanted |= {f"{v}__q{int(q * 100)}": (v, q) for q in (0.25, 0.5, 0.75)}
    wide = quantiles(df, b.key, aggs, wanted)
    for v in b.values:
        wide = wide.withColumn(f"{v}__iqr", F.col(f"{v}__q75") - F.col(f"{v}__q25")).withColumn(
            f"{v}__cv_pct", F.col(f"{v}__cv") * 100
        )
    return tall(wide, b.key, b.values, PROFILE, "variable")


def key_comparison(df: DataFrame, b: Binding) -> DataFrame:
    """Per-key statistics of four variables and the rank of the first one's mean."""
    first, second, third, fourth = b.values[:4]
    means = df.groupBy(*b.key).agg(
        F.avg(first).alias(f"{first}_mean"),
        F.min(first).alias(f"{first}_min"),
        F.max(first).alias(f"{first}_max"),
        F.stddev_samp(first).alias(f"{first}_std"),
        F.avg(second).alias(f"{second}_mean"),
        F.stddev_samp(second).alias(f"{second}_std"),
        F.avg(third).alias(f"{third}_mean"),
        F.max(third).alias(f"{third}_max"),
        F.avg(fourth).alias(f"{fourth}_mean"),
        F.stddev_samp(fourth).alias(f"{fourth}_std"),
    )
    # cut: ranking counts its input, which would run the scan a second time
    ranked = average_rank(cut(means), (), f"{first}_mean", f"{first}_rank", descending=True)
    return ranked.orderBy(F.col(f"{first}_mean").desc())


def compare_keys(df: DataFrame, b: Binding) -> DataFrame:
    v = b.value
    aggs = [
        F.count(v).alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    ]
    wanted = {"median": (v, 0.5), "q25": (v, 0.25), "q75": (v, 0.75)}
    out = quantiles(df, b.key, aggs, wanted).withColumn("iqr", F.col("q75") - F.col("q25"))
    return out.drop("q25", "q75").orderBy(F.col("mean").desc())


def overview_means(df: DataFrame, b: Binding) -> DataFrame:
    return df.groupBy(*b.key).agg(*[F.avg(v).alias(f"avg_{v}") for v in b.values])


def latest_by_key(df: DataFrame, b: Binding, columns: Sequence[str]) -> DataFrame:
    """For every column its newest non-null value per key, which need not be one row."""
    at = F.struct(*b.order)
    picks = [F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"latest_{c}") for c in columns]
    return df.groupBy(*b.key).agg(F.max(b.ts).alias("last_seen"), *picks)


def pair_compare(df: DataFrame, b: Binding, key_a, key_b) -> DataFrame:
    """Means of every variable for two keys side by side, with their difference."""
    k = F.col(b.key[0])
    aggs = []
    for v in b.values:
        a = F.avg(F.when(k == F.lit(key_a), F.col(v)))
        z = F.avg(F.when(k == F.lit(key_b), F.col(v)))
        aggs += [a.alias(f"{v}__mean_a"), z.alias(f"{v}__mean_b"), (a - z).alias(f"{v}__difference")]
    wide = df.where(k.isin(key_a, key_b)).agg(*aggs)
    return tall(wide, (), b.values, ("mean_a", "mean_b", "difference"), "variable")


def box_summary(df: DataFrame, b: Binding, whisker: float = 1.5) -> DataFrame:
    """Five-number summary with whiskers at the last value inside the fences."""
    wanted = {
        f"{v}__{name}": (v, q) for v in b.values for name, q in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))
    }
    boxes = quantiles(df, b.key, [F.count(F.lit(1)).alias("__n")], wanted).drop("__n")
    joined = attach(df.select(*b.key, *b.values), boxes, b.key)
    aggs = []
    for v in b.values:
        q1, q3 = F.col(f"{v}__q25"), F.col(f"{v}__q75")
        reach = (q3 - q1) * whisker
        inside = F.when(F.col(v).between(q1 - reach, q3 + reach), F.col(v))
        outside = F.col(v).isNotNull() & ~F.col(v).between(q1 - reach, q3 + reach)
        aggs += [
            F.min(inside).alias(f"{v}__low_whisker"),
            F.max(inside).alias(f"{v}__high_whisker"),
            F.count_if(outside).alias(f"{v}__outliers"),
            *[F.first(f"{v}__{q}").alias(f"{v}__{q}") for q in ("q25", "median", "q75")],
        ]
    fields = ("low_whisker", "q25", "median", "q75", "high_whisker", "outliers")
    return tall(joined.groupBy(*b.key).agg(*aggs), b.key, b.values, fields, "variable")


def collection_summary(df: DataFrame, b: Binding, name: str | None = None) -> DataFrame:
    """Mean, min and max of the target and the key that holds each extreme."""
    v, k = b.value, name or b.key[0]
    has = F.col(v).isNotNull()
    low = F.struct(F.col(v), *b.order)
    high = F.struct((-F.col(v)).alias("v"), *b.order)
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.avg(v).alias("mean_value"),
        F.min(v).alias("min_value"),
        F.min_by(F.col(k), F.when(has, low)).alias("min_key"),
        F.max(v).alias("max_value"),
        F.min_by(F.col(k), F.when(has, high)).alias("max_key"),
    )


def find_extremes(df: DataFrame, b: Binding, columns: Sequence[str]) -> DataFrame:
    """The full row at the maximum and minimum of each variable; ties go to the first row in time."""
    row = F.struct(*columns)
    picks, names = [], []
    for v in b.values:
        has = F.col(v).isNotNull()
        # the order columns are ascending, so the first of equal maxima has the least order
        top = F.struct((-F.col(v)).alias("v"), *b.order)
        low = F.struct(F.col(v).alias("v"), *b.order)
        picks += [
            F.min_by(row, F.when(has, top)).alias(f"{v}__max"),
            F.min_by(row, F.when(has, low)).alias(f"{v}__min"),
        ]
        names += [(v, "max"), (v, "min")]
    entries = [
        F.struct(F.lit(v).alias("variable"), F.lit(e).alias("extreme"), F.col(f"{v}__{e}").alias("row"))
        for v, e in names
    ]
    wide = df.agg(*picks).select(F.explode(F.array(*entries)).alias("__e"))
    return wide.select("__e.variable", "__e.extreme", "__e.row.*")


def dataset_summary(df: DataFrame, b: Binding) -> DataFrame:
    first, *rest = dataset_aggs(b)
    return df.agg(first, F.countDistinct(*b.key).alias("keys"), *rest)


def dataset_aggs(b: Binding) -> list[Column]:
    """What is told of a whole dataset, but for the number of its keys."""
    v, t = b.value, b.ts
    micros = F.unix_micros(F.max(F.col(t)).cast("timestamp")) - F.unix_micros(F.min(F.col(t)).cast("timestamp"))
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.min(t).alias("start_ts"),
        F.max(t).alias("end_ts"),
        F.floor(micros / 86_400_000_000).cast("long").alias("duration_days"),
        F.avg(v).alias("overall_mean"),
        F.stddev_samp(v).alias("overall_std"),
        F.min(v).cast("double").alias("overall_min"),
        F.max(v).cast("double").alias("overall_max"),
        (F.max(v) - F.min(v)).cast("double").alias("value_range"),
    ]


def key_rankings(df: DataFrame, b: Binding) -> DataFrame:
    """Keys with the highest and lowest mean of the target and the highest mean of the second variable."""
    return ranked_means(df.groupBy(*b.key).agg(*ranking_aggs(b)), b.key[0])


def ranking_aggs(b: Binding) -> list[Column]:
    return [F.avg(b.values[0]).alias("__m0"), F.avg(b.values[1]).alias("__m1")]


def ranked_means(means: DataFrame, k: str) -> DataFrame:
    up0, up1 = F.struct((-F.col("__m0")).alias("m"), k), F.struct((-F.col("__m1")).alias("m"), k)
    return means.agg(
        F.min_by(k, up0).alias("highest_key"),
        F.max("__m0").alias("highest_mean"),
        F.min_by(k, F.struct("__m0", k)).alias("lowest_key"),
        F.min("__m0").alias("lowest_mean"),
        F.min_by(k, up1).alias("highest_second_key"),
        F.max("__m1").alias("highest_second_mean"),
    )


def data_quality(df: DataFrame) -> DataFrame:
    """Null count per column and the completeness of the frame, in one pass."""
    return quality_rows(df.agg(*quality_aggs(df)), df.columns)


def quality_aggs(df: DataFrame) -> list[Column]:
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    nulls = [F.count_if(missing(c) if c in floats else F.col(c).isNull()).alias(f"{c}__nulls") for c in df.columns]
    return [F.count(F.lit(1)).alias("__rows"), *nulls]


def quality_rows(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = F.col("__rows") * len(columns)
    nulls = reduce(lambda x, y: x + y, [F.col(f"{c}__nulls") for c in columns])
    wide = wide.withColumn("completeness_pct", F.try_divide(100.0 * (cells - nulls), cells))
    return tall(wide, ("completeness_pct",), columns, ("nulls",), "column_name").withColumnRenamed("nulls", "null_count")


def summary_report(df: DataFrame, b: Binding, columns: Sequence[str], threshold: float = 0.6) -> DataFrame:
    """The report as rows (section, metric, value as text).

    One scan: every section is read off one aggregate with a row per key and one for the whole.
    """
    from obsframe.operators.correlate import pair_aggs, pair_rows, strongest

    def text(frame: DataFrame, section: str) -> DataFrame:
        cells = [
            F.struct(
                F.lit(c).alias("metric"),
                (F.format_string("%.8f", F.col(c)) if t == "double" else F.col(c).cast("string")).alias("value"),
            )
            for c, t in [(f.name, f.dataType.typeName()) for f in frame.schema.fields]
        ]
        return frame.select(F.lit(section).alias("section"), F.explode(F.array(*cells)).alias("e")).select(
            "section", "e.metric", "e.value"
        )

    asked = [*dataset_aggs(b), *quality_aggs(df.select(*columns)), *pair_aggs(b.values), *ranking_aggs(b)]
    wide = cut(df.groupingSets([list(b.key), []], *b.key).agg(F.grouping_id().alias("__level"), *asked))
    by_key = wide.where("__level = 0")
    named = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in b.key])
    # an empty table has no row for the whole: its counts are zero, the rest is null
    whole = link(df.sparkSession.range(1).select(), wide.where("__level > 0").drop(*b.key), ())
    whole = link(whole, by_key.agg(F.count_if(named).alias("keys")), ())
    whole = cut(whole.fillna(0, [c for c, t in whole.dtypes if t == "bigint"]))
    told = [f.name for f in df.limit(0).agg(*dataset_aggs(b)).schema.fields]
    quality = quality_rows(whole, columns)
    strong = strongest(pair_rows(whole, (), b.values), threshold)
    parts = [
        text(whole.select(told[0], "keys", *told[1:]), "dataset"),
        text(ranked_means(by_key, b.key[0]), "rankings"),
        quality.select(
            F.lit("missing_values").alias("section"),
            F.col("column_name").alias("metric"),
            F.col("null_count").cast("string").alias("value"),
        ),
        quality.agg(F.first("completeness_pct").alias("completeness_pct")).transform(lambda d: text(d, "data_quality")),
        strong.select(
            F.lit("correlations").alias("section"),
            F.concat_ws("~", "var1", "var2").alias("metric"),
            F.format_string("%.8f", F.col("r")).alias("value"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
