"""Exact nearest neighbours inside a key, and the local outlier factor built on them.

Equal points are folded into one weighted point. Each key's points are cut into
cells of bounded size along quantiles, one feature after the other. A point
first looks in its own cell; the distance found there bounds the ball it has to
search, and it visits only those other cells that the ball reaches. Cells to
visit are found by walking down the cell tree, so neither points nor cells are
paired with all others.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.operators.anomaly import contamination_flags, impute_scale
from obsframe.operators.least_squares import fields
from obsframe.operators.ordering import largest_group, same_rows
from obsframe.session import attach, cut, link, spread

CELL_CONF = "spark.obsframe.maxCellPoints"
CELL_DEFAULT = 4096
FAN_OUT = 8
LOT = 64  # points that are compared with others together
FIRST = 8  # lots that give the first bound on a distance
WHOLE = 1024  # up to so many members all are compared,
TOGETHER = 128  # with so many points at a time


def cell_points(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(CELL_CONF, str(CELL_DEFAULT)))


def fold(df: DataFrame, key: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """Distinct points of each key with their multiplicity and a number."""
    points = df.groupBy(*key, *dims).agg(F.count(F.lit(1)).alias("w"))
    return cut(points.withColumn("pid", F.monotonically_increasing_id()))


def cells(points: DataFrame, key: Sequence[str], dims: Sequence[str]) -> tuple[DataFrame, int]:
    """Give each point a cell path, one digit per level; cells stay below the bound."""
    limit, depth, idle = cell_points(points), 0, 0
    points = points.withColumn("cell", F.lit(""))
    size = largest_group(points, [*key, "cell"])
    shares = F.array(*[F.lit(i / FAN_OUT) for i in range(1, FAN_OUT)])
    while size > limit and idle < len(dims):
        d = dims[depth % len(dims)]
        bounds = points.groupBy(*key, "cell").agg(
            F.when(F.count(F.lit(1)) > limit, F.percentile_approx(d, shares, 10_000)).alias("__b")
        )
        points = attach(points, bounds, (*key, "cell"))
        # rows are compared with stored bounds, so the bounds being approximate only shifts sizes
        digit = F.size(F.filter(F.coalesce("__b", F.array().cast("array<double>")), lambda b: F.col(d) > b))
        points = cut(points.withColumn("cell", F.concat("cell", digit.cast("string"))).drop("__b"))
        depth += 1
        smaller = largest_group(points, [*key, "cell"])
        idle = idle + 1 if smaller == size else 0
        size = smaller
    return points, depth


def leaves(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Numbers of the points in lots of up to ``size`` that lie together, halved along the widest feature."""
    todo, out = [np.arange(len(x))], []
    while todo:
        at = todo.pop()
        if len(at) <= size:
            out.append(at)
            continue
        part = x[at]
        wide = part[:, np.argmax(np.fmax.reduce(part) - np.fmin.reduce(part))]
        order, half = np.argpartition(wide, len(at) // 2), len(at) // 2
        todo += [at[order[half:]], at[order[:half]]]
    return out


def kth_least(values: np.ndarray, k: int, room: np.ndarray) -> np.ndarray:
    """The k-th least value of each row, infinite where there are fewer; NaN does not count. ``room`` is overwritten."""
    if values.shape[1] < k:
        return np.full(len(values), np.inf)
    room = room[: values.size].reshape(values.shape)
    np.copyto(room, values)
    room.partition(k - 1, axis=1)
    kth = room[:, k - 1]
    return np.where(np.isnan(kth), np.inf, kth)


def nearest(x: np.ndarray, m: np.ndarray, w: np.ndarray, k: int, reach: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """For each row of x its members within the k-th neighbour distance, ties included.

    ``w`` is how often each row of m counts. ``reach`` bounds the distances; without it m is x, and a point is no
    neighbour of itself (its copies count one less). Squared distances as matrix products, less the most they can be
    off, sort out most members; the others' are worked out exactly. Of many members only the lots whose box
    lies within the bound are looked at. Returns (row of x, row of m, distance, weight) as arrays.
    """
    own = reach is None
    lots = leaves(m, LOT) if len(m) > WHOLE else [np.arange(len(m))]
    many = len(lots) > 1
    if many:
        low, high = (np.stack([f.reduce(m[p]) for p in lots]) for f in (np.fmin, np.fmax))
    middle = (np.fmin.reduce(m) + np.fmax.reduce(m)) / 2
    xc, mc = x - middle, m - middle
    xx, mm = (xc * xc).sum(axis=1), (mc * mc).sum(axis=1)
    left, right = np.column_stack([-2 * xc, np.ones(len(x)), xx]), np.column_stack([mc, mm, np.ones(len(m))]).T.copy()
    off = 1e-13 * (np.fmax.reduce(xx, initial=0.0) + np.fmax.reduce(mm, initial=0.0))
    asking = lots if own and many else leaves(x, LOT if many else TOGETHER)
    # arrays of this size cost more to make anew than to fill
    products, room = np.empty((2, max(map(len, asking), default=0) * len(m)))
    found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0, w.dtype))]

    def multiplied(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        shape = len(rows), columns.shape[1]
        return np.matmul(left[rows], columns, out=products[: shape[0] * shape[1]].reshape(shape))

    for rows in asking:
        members = lots[0]
        limit = None if own else reach[rows] ** 2 * (1 + 1e-12)
        if many:
            gap = np.fmax(np.fmax(low - np.fmax.reduce(x[rows]), np.fmin.reduce(x[rows]) - high), 0.0)
            gap = (gap * gap).sum(axis=1)
            if own:
                close = np.concatenate([lots[i] for i in np.argsort(gap, kind="stable")[:FIRST]])
                limit = kth_least(multiplied(rows, right[:, close]), k + 1, room) + off
            near = np.flatnonzero(gap <= limit.max() * (1 + 1e-12))
            members = np.concatenate([lots[i] for i in near]) if len(near) else np.zeros(0, int)
        rough = multiplied(rows, right[:, members] if many else right)
        if limit is None:  # the point itself is one more
            limit = kth_least(rough, k + 1, room) + off
        p, q = np.divmod(np.flatnonzero(rough <= (limit + off)[:, None]), max(len(members), 1))
        p, q = rows[p], members[q]
        if own:
            others = (p != q) | (w[q] > 1)
            p, q = p[others], q[others]
        sq = np.zeros(len(p))
        for j in range(m.shape[1]):
            sq += (x[p, j] - m[q, j]) ** 2
        d = np.sqrt(sq)
        order = np.lexsort((d, p))
        if not own:
            order = order[d[order] <= reach[p[order]]]
        p, q, d = p[order], q[order], d[order]
        weight = w[q] - (p == q) if own else w[q]
        # members behind k nearer ones are none; those level with the k-th are
        changed = np.flatnonzero(np.diff(p, prepend=-1))
        level = np.flatnonzero((np.diff(p, prepend=-1) != 0) | (np.diff(d, prepend=-1.0) != 0))
        nearer = np.cumsum(weight) - weight
        first = np.repeat(nearer[changed], np.diff(changed, append=len(p)))
        kept = np.repeat(nearer[level], np.diff(level, append=len(p))) - first < k
        found.append((p[kept], q[kept], d[kept], weight[kept]))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def edges_frame(head: dict, pid: np.ndarray, member: np.ndarray, found: tuple[np.ndarray, ...] | None) -> pd.DataFrame:
    p, q, d, w = found or (np.zeros(0, int),) * 4
    out = {name: pd.Series([value] * len(p), dtype=object) for name, value in head.items()}
    return pd.DataFrame(out | {"pid": pid[p].astype("int64"), "qid": member[q].astype("int64"), "d": d.astype("float64"), "qw": w.astype("int64")})


def box_gap(lo: str, hi: str, other_lo: str, other_hi: str) -> Column:
    """Squared distance between two boxes (a point is a box of no size)."""
    gap = F.zip_with(
        F.zip_with(lo, other_hi, lambda a, b: a - b),
        F.zip_with(other_lo, hi, lambda a, b: a - b),
        lambda a, b: F.greatest(a, b, F.lit(0.0)),
    )
    return F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g)


def factors(x: np.ndarray, w: np.ndarray, k: int) -> np.ndarray:
    """The factor of every point of a key."""
    p, q, d, qw = nearest(x, x, w, k)
    reach = np.zeros(len(x))
    np.maximum.at(reach, p, d)
    weight = np.bincount(p, qw, len(x))
    # the small constant keeps the density of a pile of copies finite
    density = 1 / (np.bincount(p, qw * np.maximum(d, reach[q]), len(x)) / weight + 1e-10)
    return np.bincount(p, qw * density[q], len(x)) / weight / density


def whole_key_factor(points: DataFrame, key: Sequence[str], dims: Sequence[str], k: int) -> DataFrame:
    """The factor of every point where each key is one cell: no edge leaves its task."""
    key, dims = list(key), list(dims)

    def factor(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[[*key, *dims]].assign(lof=factors(pdf[dims].to_numpy(dtype=float), pdf["w"].to_numpy(), k))

    return spread(points, *key).groupBy(*key).applyInPandas(factor, ", ".join([*fields(points, [*key, *dims]), "lof double"]))


def small_key_scores(scaled: DataFrame, b: Binding, dims: Sequence[str], k: int) -> DataFrame:
    """Rows with their factor where the rows of each key, copies included, are no more than a cell holds.

    Copies are folded in the task, so neither points nor factors are shuffled besides the rows.
    """
    kept, dims = [*b.key, *b.id], list(dims)

    def score(rows: pa.Table) -> pa.Table:
        x = np.stack([rows.column(d).to_numpy() for d in dims], axis=1)
        points, at, w = np.unique(x, axis=0, return_inverse=True, return_counts=True)
        lof = factors(points, w, k)[at.ravel()]
        return rows.select(kept).append_column("lof", pa.array(lof, from_pandas=True))

    numbers = reduce(lambda a, c: a & c, [~F.coalesce(F.isnan(d), F.lit(False)) for d in dims])
    rows = spread(scaled.where(numbers).select(*kept, *dims), *b.key)
    return rows.groupBy(*b.key).applyInArrow(score, ", ".join([*fields(scaled, kept), "lof double"]))


def roomy_ancestors(points: DataFrame, depth: int, key: Sequence[str], dims: Sequence[str], k: int) -> DataFrame:
    """For every cell with no more than ``k`` points its nearest ancestor with more: ``a_lo``, ``a_hi`` (its box).

    Only cells are counted and joined: a row per cell and level, added up to the nodes of the tree.
    """
    low, high = [F.min(d).alias(f"lo_{d}") for d in dims], [F.max(d).alias(f"hi_{d}") for d in dims]
    held = cut(points.groupBy(*key, "cell").agg(F.sum("w").alias("w"), *low, *high))
    above = F.explode(F.sequence(F.lit(depth - 1), F.lit(0), F.lit(-1))).alias("level")
    node = F.col("cell").substr(F.lit(1), F.col("level")).alias("node")
    boxes = [*[F.min(f"lo_{d}").alias(f"lo_{d}") for d in dims], *[F.max(f"hi_{d}").alias(f"hi_{d}") for d in dims]]
    tree = held.select("*", above).select("*", node).groupBy(*key, "level", "node").agg(F.sum("w").alias("w"), *boxes)
    roomy = tree.where(F.col("w") > k).drop("w")
    thin = held.where(F.col("w") <= k).select(*key, "cell", above).select("*", node)
    found = link(thin, roomy, (*key, "level", "node"), "inner")
    corner = lambda side: F.array(*[F.col(f"{side}_{d}") for d in dims])
    box = F.max_by(F.struct(corner("lo").alias("lo"), corner("hi").alias("hi")), "level").alias("box")
    return found.groupBy(*key, "cell").agg(box).select(*key, "cell", F.col("box.lo").alias("a_lo"), F.col("box.hi").alias("a_hi"))


def first_reach(points: DataFrame, local: DataFrame, depth: int, key: Sequence[str], dims: Sequence[str], k: int) -> DataFrame:
    """Points with their place ``x`` and a distance ``r`` within which k neighbours lie for sure.

    It is the distance of the k-th in the point's own cell; where the cell holds too few, that to the far corner of
    the nearest ancestor that holds enough.
    """
    reach = local.groupBy(*key, "pid").agg(F.when(F.sum("qw") >= k, F.max("d")).alias("r"))
    placed = link(points, reach, (*key, "pid")).withColumn("x", F.array(*dims))
    placed = attach(placed, roomy_ancestors(points, depth, key, dims, k), (*key, "cell"))
    away = F.zip_with(
        F.zip_with("x", "a_lo", lambda a, b: a - b), F.zip_with("a_hi", "x", lambda a, b: a - b), lambda a, b: F.greatest(a, b)
    )
    # a trifle more than the corner, so that rounding leaves out no point that lies there
    far = F.sqrt(F.aggregate(away, F.lit(0.0), lambda s, g: s + g * g)) * (1 + 1e-12)
    return placed.withColumn("r", F.coalesce("r", far, F.lit(float("inf")))).drop("a_lo", "a_hi")


def neighbours(points: DataFrame, depth: int, key: Sequence[str], dims: Sequence[str], k: int) -> DataFrame:
    """Edges (pid, qid, d, qw) to every neighbour within the k-th distance, ties included."""
    key, dims = list(key), list(dims)
    schema = ", ".join([*fields(points, key), "pid bigint, qid bigint, d double, qw bigint"])

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf[dims].to_numpy(dtype=float)
        pid, w = pdf["pid"].to_numpy(), pdf["w"].to_numpy()
        head = {c: pdf[c].iloc[0] for c in key}
        return edges_frame(head, pid, pid, nearest(x, x, w, k))

    local = spread(points, *key, "cell").groupBy(*key, "cell").applyInPandas(inside, schema)
    local = cut(local)
    placed = cut(first_reach(points, local, depth, key, dims, k))
    low = F.array(*[F.min(d) for d in dims])
    high = F.array(*[F.max(d) for d in dims])
    todo = placed.groupBy(*key, "cell").agg(low.alias("lo"), high.alias("hi"), F.max("r").alias("r"))
    todo = todo.withColumn("to", F.lit(""))
    for level in range(1, depth + 1):
        node = F.substring("cell", 1, level)
        nodes = points.groupBy(*key, node.alias("node")).agg(low.alias("nlo"), high.alias("nhi"))
        nodes = nodes.withColumn("to", F.substring("node", 1, level - 1))
        todo = link(todo, nodes, (*key, "to"), "inner")
        todo = todo.where(box_gap("lo", "hi", "nlo", "nhi") <= F.col("r") * F.col("r"))
        todo = todo.withColumn("to", F.col("node")).select(*key, "cell", "lo", "hi", "r", "to", "nlo", "nhi")
        todo = cut(todo.drop("nlo", "nhi") if level < depth else todo)
    visits = todo.where(F.col("to") != F.col("cell")).select(*key, "cell", "to", "nlo", "nhi")
    guests = link(placed.select(*key, "cell", "pid", "x", "r"), visits, (*key, "cell"), "inner")
    guests = guests.where(box_gap("x", "x", "nlo", "nhi") <= F.col("r") * F.col("r"))
    guests = cut(guests.select(*key, F.col("to").alias("cell"), "pid", "x", "r"))
    # a cell many points look into is copied, its guests are spread over the copies
    limit = cell_points(points)
    copies = guests.groupBy(*key, "cell").agg(F.ceil(F.count(F.lit(1)) / (4 * limit)).alias("__n"))
    copies = cut(copies)
    guests = attach(guests, copies, (*key, "cell"), "inner")
    guests = guests.withColumn("__salt", F.pmod(F.xxhash64("pid"), F.col("__n"))).drop("__n")
    hosts = link(points, copies, (*key, "cell"), "inner")
    hosts = hosts.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))).drop("__n")

    def visit(guest: pd.DataFrame, host: pd.DataFrame) -> pd.DataFrame:
        if guest.empty or host.empty:
            return edges_frame({c: None for c in key}, np.zeros(0, int), np.zeros(0, int), None)
        x = np.stack(guest["x"].to_numpy())
        m = host[[f"h_{d}" for d in dims]].to_numpy(dtype=float)
        head = {c: guest[c].iloc[0] for c in key}
        found = nearest(x, m, host["h_w"].to_numpy(), k, guest["r"].to_numpy())
        return edges_frame(head, guest["pid"].to_numpy(), host["h_pid"].to_numpy(), found)

    group = [*key, "cell", "__salt"]
    hosts = hosts.select([F.col(c).alias(f"h_{c}") for c in hosts.columns])
    by_host = spread(hosts, *[f"h_{c}" for c in group]).groupBy(*[f"h_{c}" for c in group])
    away = spread(guests, *group).groupBy(*group).cogroup(by_host).applyInPandas(visit, schema)
    # per point at most k neighbours and ties from each visited cell remain to be merged
    every = local.unionByName(away)
    w = W.partitionBy(*key, "pid")
    nearer = F.sum("qw").over(w.orderBy("d").rangeBetween(W.unboundedPreceding, W.currentRow))
    level = F.sum("qw").over(W.partitionBy(*key, "pid", "d"))
    return every.withColumn("__c", nearer - level).where(F.col("__c") < k).drop("__c")


def local_outlier_factor(df: DataFrame, b: Binding, n_neighbors: int = 20, contamination: float = 0.1) -> DataFrame:
    """Rows with their local outlier factor and whether it is among the key's top share.

    Neighbourhoods follow the original definition: all points up to the k-th
    distance. Keys with no more than ``n_neighbors`` rows get no score.
    """
    key = list(b.key)
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"))
    rows = attach(df, sizes, b.key).where(F.col("__rows") > n_neighbors).drop("__rows")
    scaled = impute_scale(rows.select(*key, *b.id, *b.values), b)
    scaled = same_rows(scaled, cut(scaled))
    dims = [f"{v}_scaled" for v in b.values]
    if largest_group(scaled, key) <= cell_points(df):
        return contamination_flags(small_key_scores(scaled, b, dims, n_neighbors), b, "lof", contamination)
    points = fold(scaled, key, dims)
    points, depth = cells(points, key, dims)
    if depth == 0:
        factor = whole_key_factor(points, key, dims, n_neighbors)
        scored = link(scaled, factor, (*key, *dims), "inner")
        return contamination_flags(same_rows(scaled, scored.select(*key, *b.id, "lof")), b, "lof", contamination)
    edges = cut(neighbours(points, depth, key, dims, n_neighbors))
    reach = edges.groupBy(*key, "pid").agg(F.max("d").alias("k_distance"))
    joined = link(edges, reach.withColumnRenamed("pid", "qid"), (*key, "qid"), "inner")
    far = F.greatest("d", "k_distance")
    density = joined.groupBy(*key, "pid").agg((1 / (F.sum(F.col("qw") * far) / F.sum("qw") + 1e-10)).alias("lrd"))
    density = cut(density)
    joined = link(edges, density.select(*key, F.col("pid").alias("qid"), F.col("lrd").alias("q_lrd")), (*key, "qid"), "inner")
    around = joined.groupBy(*key, "pid").agg((F.sum(F.col("qw") * F.col("q_lrd")) / F.sum("qw")).alias("around"))
    factor = link(around, density, (*key, "pid"), "inner")
    factor = link(points, factor.withColumn("lof", F.col("around") / F.col("lrd")), (*key, "pid"), "inner")
    scored = link(scaled, factor.select(*key, *dims, "lof"), (*key, *dims), "inner")
    return contamination_flags(same_rows(scaled, scored.select(*key, *b.id, "lof")), b, "lof", contamination)
