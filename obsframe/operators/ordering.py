"""Order inside a series, without ever placing a whole large series in one task.

Everything that depends on the order of the rows of a key goes through one of
two forms. While the largest key is known (counted) to be small, a plain window
per key is the cheapest plan. Otherwise rows get an exact position from a range
sort that ignores key boundaries, positions are cut into chunks of bounded
length, and each chunk receives copies of the few neighbouring rows its frames
reach into.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsframe.operators.order_statistics import SUMMARIES, at_share, order_statistics, summarised_statistics
from obsframe.session import attach, bounded, bounded_rows, cut, group_rows, link


def largest_group(df: DataFrame, key: Sequence[str]) -> int:
    """Row count of the largest key; a column-pruned, map-side combined count."""
    known = getattr(df, "_largest_group", {})
    if tuple(key) in known:
        return known[tuple(key)]
    if not key:
        return df.count()
    row = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()
    size = row[0] or 0
    df._largest_group = {**known, tuple(key): size}
    return size


def same_rows(source: DataFrame, result: DataFrame) -> DataFrame:
    """Note that ``result`` has no more rows per key than ``source``, whose sizes then need no recount."""
    known = getattr(source, "_largest_group", {})
    if known:
        result._largest_group = {**known}
    return result


def fits_one_task(df: DataFrame, key: Sequence[str]) -> bool:
    return largest_group(df, key) <= group_rows(df.sparkSession)


def positions(
    df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "pos", size: str | None = None
) -> DataFrame:
    """Number the rows of every key 0..n-1 in ``order``; ``size`` also adds n.

    One range shuffle on (key, order) spreads a hot key over many tasks. Within
    a sorted partition a generated id is a running row number, so the position
    needs only the row counts of the earlier partitions of the same key.
    """
    # a row tag as last sort field lets a long run of equal order values be split
    spread = df.withColumn("__tag", F.monotonically_increasing_id())
    sort = [*key, *order, "__tag"]
    ranged = cut(
        spread.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .drop("__tag")
        .withColumn("__at", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__at", 33))
    )
    counts = ranged.groupBy(*key, "__part").agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    # at most one row per (key, partition)
    w = W.partitionBy(*key).orderBy("__part")
    before = F.coalesce(
        F.sum("__n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    counts = counts.withColumn("__before", before)
    if size:
        counts = counts.withColumn(size, F.sum("__n").over(W.partitionBy(*key)))
    out = attach(ranged, counts.drop("__n"), (*key, "__part"), "inner")
    pos = F.col("__at") - F.col("__first") + F.col("__before")
    return out.withColumn(name, pos.cast("long")).drop("__at", "__part", "__first", "__before")


def numbered(
    df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "pos", size: str | None = None
) -> DataFrame:
    """Like :func:`positions`, by a plain window when every key fits one task."""
    if not fits_one_task(df, key):
        return same_rows(df, positions(df, key, order, name, size))
    w = W.partitionBy(*key)
    out = df.withColumn(name, (F.row_number().over(w.orderBy(*order)) - 1).cast("long"))
    return same_rows(df, out.withColumn(size, F.count(F.lit(1)).over(w)) if size else out)


def over_order(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    build: Callable[[WindowSpec], Sequence[Column]],
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Add the columns ``build(window)`` returns; their frames may reach ``before``
    rows back and ``after`` rows ahead, no further."""
    if fits_one_task(df, key):
        return same_rows(df, df.select("*", *build(W.partitionBy(*key).orderBy(*order))))
    placed = positions(df, key, order, "__pos")
    width = max(group_rows(df.sparkSession), before, after, 1)
    copies = chunked(placed, "__pos", width, before, after)
    w = W.partitionBy(*key, "__chunk").orderBy("__pos")
    own = copies.select("*", *build(w)).where(F.col("__chunk") == F.col("__own"))
    return same_rows(df, own.drop("__pos", "__own", "__chunk"))


def chunked(placed: DataFrame, pos: str, width: int, before: int, after: int) -> DataFrame:
    """Cut numbered rows into chunks (``__chunk``) of ``width``, each with copies of the
    ``before`` rows ahead of it and the ``after`` rows behind it; ``__own`` is a row's home."""
    within = F.col(pos) % width
    own = F.floor(F.col(pos) / width)
    homes = F.filter(
        F.array(
            own,
            F.when(within >= width - before, own + 1),
            F.when((within < after) & (own > 0), own - 1),
        ),
        lambda c: c.isNotNull(),
    )
    return placed.withColumn("__own", own).withColumn("__chunk", F.explode(homes))


def quantiles(
    df: DataFrame,
    key: Sequence[str],
    aggs: Sequence[Column],
    wanted: dict[str, tuple[str, float]],
) -> DataFrame:
    """Group by ``key`` with ``aggs`` plus exact linear-interpolated quantiles.

    ``wanted`` maps an output name to (column, q). Keys that fit a task use the built-in aggregate in the same
    pass; the ranks of larger ones are closed in on by counts, without moving their rows.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    asked = {c: [q for k, q in wanted.values() if k == c] for c in columns}
    # one buffer per column serves all of its quantiles
    packed = [F.percentile(c, F.array(*map(F.lit, qs))).alias(f"__p_{c}") for c, qs in asked.items()]
    picks = [F.col(f"__p_{c}")[asked[c].index(q)].alias(name) for name, (c, q) in wanted.items()]
    if fits_one_task(df, key):
        out = df.groupBy(*key).agg(*aggs, *packed)
        return out.select(*[c for c in out.columns if not c.startswith("__p_")], *picks)
    out = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    large = F.col("__rows") > group_rows(df.sparkSession)
    out = cut(out)
    few = bounded(out.where(large).select(*key))
    rows = df.select(*key, *columns)
    places = {n: (c, at_share(q)) for n, (c, q) in wanted.items()}
    keys, others = out.agg(F.count_if(large), F.count_if(~large)).first()
    doubles = all(df.schema[c].dataType.typeName() == "double" for c in columns)
    if doubles and keys * len(wanted) <= SUMMARIES:
        placed = summarised_statistics(rows, key, few, places)
    else:
        placed = order_statistics(link(rows, few, tuple(key), "inner"), key, places)
    if key and others:
        rest = link(rows, few.withColumn("__large", F.lit(True)), tuple(key)).where(F.col("__large").isNull())
        rest = rest.groupBy(*key).agg(*packed).select(*key, *picks)
        placed = placed.unionByName(rest)
    return link(out.drop("__rows"), placed, tuple(key))


def running_total(df: DataFrame, key: Sequence[str], order: Sequence[str], weight: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows of the key that come earlier; ``order`` must be unique in the key.

    Beyond the group limit a range sort spreads a key over partitions. Each adds up its own rows and starts
    from the sums of the earlier partitions, of which there is a row per key and partition.
    """
    earlier = lambda w: F.coalesce(F.sum(weight).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    if fits_one_task(df, key):
        return same_rows(df, df.withColumn(name, earlier(W.partitionBy(*key).orderBy(*order))))
    ranged = cut(df.repartitionByRange(*key, *order).withColumn("__part", F.spark_partition_id()))
    sums = ranged.groupBy(*key, "__part").agg(F.sum(weight).alias(weight))
    sums = sums.withColumn("__before", earlier(W.partitionBy(*key).orderBy("__part"))).drop(weight)
    out = ranged.withColumn(name, earlier(W.partitionBy(*key, "__part").orderBy(*order)))
    out = attach(out, sums, (*key, "__part"), "inner")
    return same_rows(df, out.withColumn(name, F.col(name) + F.col("__before")).drop("__part", "__before"))


def average_rank(df: DataFrame, key: Sequence[str], value: str, name: str, descending: bool = False) -> DataFrame:
    """Rank of ``value`` inside ``key`` from 1, equal values sharing their mean rank.

    Beyond the group limit ranks come from the counts of the distinct values, added up map-side; rows are not
    sorted. Values that alone exceed the limit are few and broadcast, so no join key is hot.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    if fits_one_task(df, key):
        w = W.partitionBy(*key).orderBy(order)
        # a range of no width holds the ties, in the same sort as the rank
        ties = F.count(F.lit(1)).over(w.rangeBetween(W.currentRow, W.currentRow))
        return same_rows(df, df.withColumn(name, F.rank().over(w) + (ties - 1) / 2.0))
    at = (*key, value)
    counts = cut(df.groupBy(*at).agg(F.count(F.lit(1)).alias("__c")))
    signed = counts.withColumn("__s", -F.col(value) if descending else F.col(value))
    ranks = running_total(signed, key, ["__s"], "__c", "__below").withColumn(name, F.col("__below") + (F.col("__c") + 1) / 2.0)
    ranks = cut(ranks.select(*at, "__c", name))
    if bounded_rows(ranks):
        return same_rows(df, link(df, F.broadcast(ranks.drop("__c")), at, "inner"))
    hot = F.col("__c") > group_rows(df.sparkSession)
    common = bounded(ranks.where(hot).select(*at, F.col(name).alias("__hot")))
    marked = link(df, common, at)
    placed = marked.where(F.col("__hot").isNotNull()).withColumnRenamed("__hot", name)
    rest = link(marked.where(F.col("__hot").isNull()).drop("__hot"), ranks.where(~hot).drop("__c"), at, "inner")
    return same_rows(df, placed.unionByName(rest))
