"""Correlation of column pairs: Pearson, Spearman, Kendall tau-b."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.functions import special
from obsframe.functions.scalar import sign_label
from obsframe.operators.aggregates import tall
from obsframe.operators.ordering import average_rank, largest_group, positions
from obsframe.session import attach, cut, group_rows, link


def pearson(df: DataFrame, b: Binding, key: Sequence[str] | None = None) -> DataFrame:
    """All pairs in one aggregate; a pair uses the rows where both are present."""
    key = b.key if key is None else key
    return pair_rows(df.groupBy(*key).agg(*pair_aggs(b.values)), key, b.values)


def pair_aggs(values: Sequence[str]) -> list[Column]:
    """Pearson's r and the rows it rests on, for every pair of columns."""
    aggs = []
    for x, y in combinations(values, 2):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        aggs += [
            F.count_if(both).alias(f"{x}~{y}__n"),
            F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"{x}~{y}__r"),
        ]
    return aggs


def pair_rows(wide: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    labels = [f"{x}~{y}" for x, y in combinations(values, 2)]
    out = tall(wide, key, labels, ("r", "n"), "pair")
    names = F.split("pair", "~")
    # a constant column has no correlation
    r = F.when(~F.isnan("r"), F.col("r"))
    return out.select(*key, names[0].alias("var1"), names[1].alias("var2"), r.alias("r"), "n")


def spearman(df: DataFrame, b: Binding, key: Sequence[str] | None = None) -> DataFrame:
    """Pearson on mean-tie ranks, the ranks taken over the rows complete in the pair."""
    key = b.key if key is None else tuple(key)
    complete = df.select(*key, *b.values).dropna(subset=list(b.values))
    if complete_everywhere(df, b.values):
        ranked = complete
        for v in b.values:
            ranked = average_rank(ranked, key, v, f"__rank_{v}")
        ranked = ranked.select(*key, *[F.col(f"__rank_{v}").alias(v) for v in b.values])
        return pearson(ranked, b, key)
    out = None
    for x, y in combinations(b.values, 2):
        pair = df.select(*key, x, y).dropna()
        pair = average_rank(average_rank(pair, key, x, "__x"), key, y, "__y")
        pair = pair.select(*key, F.col("__x").alias(x), F.col("__y").alias(y))
        part = pearson(pair, b.on(x, y), key)
        out = part if out is None else out.unionByName(part)
    return out


def complete_everywhere(df: DataFrame, columns: Sequence[str]) -> bool:
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return not any(nulls)


def kendall(df: DataFrame, b: Binding, key: Sequence[str] | None = None, scores: bool = False) -> DataFrame:
    """Kendall tau-b per key for every pair of columns, without forming row pairs; ``scores`` adds its
    normal score z, corrected for ties."""
    key = b.key if key is None else tuple(key)
    out = None
    for x, y in combinations(b.values, 2):
        rows = df.select(*key, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
        part = tau_b(rows, key).select(
            *key, F.lit(x).alias("var1"), F.lit(y).alias("var2"), "r", "n", *(["z"] if scores else [])
        )
        out = part if out is None else out.unionByName(part)
    return out


# runs per axis: a key's table of run cells has at most (2 * CHUNKS) ** 2 rows
CHUNKS = 500


def pairs_of(n):
    return n * (n - 1) / 2.0


def tau_b(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    cells = cut(rows.groupBy(*key, "x", "y").agg(F.count(F.lit(1)).alias("c")))

    def ties(cols: list[str], name: str) -> DataFrame:
        counts = cells.groupBy(*key, *cols).agg(F.sum("c").alias("t")) if cols != ["x", "y"] else cells.withColumnRenamed("c", "t")
        t = F.col("t").cast("double")
        return counts.groupBy(*key).agg(
            F.sum(pairs_of(t)).alias(name),
            F.sum(t * (t - 1) * (t - 2)).alias(f"{name}_3"),
            F.sum(t * (t - 1) * (2 * t + 5)).alias(f"{name}_v"),
        )

    total = cells.groupBy(*key).agg(F.sum("c").alias("n"))
    for cols, name in ((["x"], "tx"), (["y"], "ty"), (["x", "y"], "txy")):
        total = link(total, ties(cols, name), tuple(key))
    disc = discordant(cells.withColumnRenamed("c", "w"), key)
    out = link(total, disc, tuple(key))
    n0 = pairs_of(F.col("n"))
    # concordant + discordant = all pairs not tied in x or in y
    untied = n0 - F.col("tx") - F.col("ty") + F.col("txy")
    diff = untied - 2.0 * F.coalesce(F.col("d"), F.lit(0.0))
    scale = F.sqrt(n0 - F.col("tx")) * F.sqrt(n0 - F.col("ty"))
    # variance of the difference where ties are given
    n = F.col("n").cast("double")
    base = (n * (n - 1) * (2 * n + 5) - F.col("tx_v") - F.col("ty_v")) / 18
    pairs = F.try_divide(4 * F.col("tx") * F.col("ty"), 2 * n * (n - 1))
    triples = F.try_divide(F.col("tx_3") * F.col("ty_3"), 9 * n * (n - 1) * (n - 2))
    var = base + F.coalesce(pairs, F.lit(0.0)) + F.coalesce(triples, F.lit(0.0))
    return out.withColumn("r", F.try_divide(diff, scale)).withColumn("z", F.try_divide(diff, F.sqrt(var)))


def discordant(points: DataFrame, key: Sequence[str]) -> DataFrame:
    """Weight of the pairs with x smaller and y greater, per key; points are (x, y, w).

    A small key counts by merging in one task. A large key is cut into at most
    ``CHUNKS`` runs along x and along y. Two points differ in both runs (counted
    on the table of run cells), share the x run, or share the y run only; the
    last two are the same question on smaller groups. No pair is materialised.
    """
    key = list(key)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema.fields if f.name in key]
    schema = ", ".join([*fields, "d double"])

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        d = weighted_discordant(pdf["x"].to_numpy(), pdf["y"].to_numpy(), pdf["w"].to_numpy())
        return pd.DataFrame({k: [pdf[k].iloc[0]] for k in key} | {"d": [d]})

    largest, limit = largest_group(points, key), group_rows(points.sparkSession)
    if largest <= limit:
        return points.groupBy(*key).applyInPandas(count, schema)
    width = max(limit // 2, -(-largest // CHUNKS), 1)
    for c in ("x", "y"):
        placed = positions(points, key, [c], "__p")
        runs = placed.groupBy(*key, c).agg(F.min("__p").alias("__first"), F.count(F.lit(1)).alias("__len"))
        # one value longer than a run gets its own (odd) run: nothing inside it is discordant
        runs = runs.select(
            *key, c, (2 * F.floor(F.col("__first") / width) + (F.col("__len") >= width).cast("int")).alias(f"__c{c}")
        )
        points = attach(placed.drop("__p"), runs, (*key, c), "inner")
    points = cut(points)
    depth = len(key)
    same_x, same_y = f"__gx{depth}", f"__gy{depth}"
    in_x = points.where(F.col("__cx") % 2 == 0).select(*key, F.col("__cx").alias(same_x), "x", "y", "w")
    in_y = points.where(F.col("__cy") % 2 == 0).select(
        *key, F.col("__cy").alias(same_y), F.col("__cx").cast("double").alias("x"), "y", "w"
    )
    cells = points.groupBy(*key, F.col("__cx").alias("x"), F.col("__cy").alias("y")).agg(F.sum("w").alias("w"))
    parts = [
        cells.groupBy(*key).applyInPandas(count, schema),
        discordant(in_x, [*key, same_x]).select(*key, "d"),
        discordant(in_y, [*key, same_y]).select(*key, "d"),
    ]
    return reduce(DataFrame.unionByName, parts).groupBy(*key).agg(F.sum("d").alias("d"))


def weighted_discordant(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Weight of pairs with x smaller and y greater, by bottom-up merging."""
    order = np.lexsort((y, x))
    y, w = np.unique(y[order], return_inverse=True)[1].astype(np.int64), w[order].astype(float)
    n, total, width = len(y), 0.0, 1
    base = n + 1
    while width < n:
        block = np.arange(n) // (2 * width)
        right = (np.arange(n) // width) % 2 == 1
        keyed = block * base + y
        at = np.argsort(keyed[~right], kind="stable")
        left, run = keyed[~right][at], np.concatenate([[0.0], np.cumsum(w[~right][at])])
        lo = np.searchsorted(left, keyed[right], side="right")
        end = np.searchsorted(left, (block[right] + 1) * base, side="left")
        total += float(((run[end] - run[lo]) * w[right]).sum())
        width *= 2
    return total


METHODS = {"pearson": pearson, "spearman": spearman, "kendall": kendall}


def with_p_value(pairs: DataFrame, method: str) -> DataFrame:
    """Two-sided p of r: t for Pearson and Spearman, normal approximation for Kendall."""
    n, r = F.col("n"), F.col("r")
    if method == "kendall":
        named = pairs.withColumnRenamed("z", "statistic")
        return named.withColumn("p_value", special.normal_two_sided(F.col("statistic")))
    t = F.when(F.abs(r) < 1, r * F.sqrt((n - 2) / (1 - r * r)))
    p = F.when(F.abs(r) >= 1, F.lit(0.0)).otherwise(special.t_two_sided(F.col("statistic"), n - 2))
    return pairs.withColumn("statistic", t).withColumn("p_value", p)


def strong_correlations(
    df: DataFrame, b: Binding, threshold: float = 0.7, method: str = "pearson", key: Sequence[str] = ()
) -> DataFrame:
    """Pairs whose correlation, rounded to three places, reaches the threshold; strongest first."""
    pairs = kendall(df, b, key, scores=True) if method == "kendall" else METHODS[method](df, b, key)
    return strongest(pairs, threshold, method)


def strongest(pairs: DataFrame, threshold: float, method: str = "pearson") -> DataFrame:
    kept = pairs.where(F.abs(F.round("r", 3)) >= threshold)
    out = with_p_value(kept, method)
    return out.select(
        "*",
        (F.col("p_value") < 0.05).alias("is_significant"),
        sign_label(F.col("r")).alias("strength"),
        F.lit(method).alias("method"),
    ).orderBy(F.abs("r").desc())
