"""Search bounds of points in cells that hold too few neighbours."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.operators import neighbours as N

K, DIMS = 10, ["p", "q"]


@pytest.fixture(scope="module")
def clusters(spark):
    """Thirty clumps far apart, some points repeated, and one key of a single clump."""
    rng = np.random.default_rng(3)
    middles = rng.uniform(-1000, 1000, (30, 2))
    x = np.concatenate([m + rng.normal(size=(30, 2)) for m in middles])
    x = np.concatenate([x, x[:40], x[:40]])
    pdf = pd.DataFrame(x, columns=DIMS).assign(k="many")
    return pd.concat([pdf, pd.DataFrame(rng.normal(size=(60, 2)), columns=DIMS).assign(k="one")], ignore_index=True)


def test_thin_cells_have_a_bound(spark, monkeypatch, clusters):
    monkeypatch.setattr(N, "cell_points", lambda _: 6)  # every cell holds fewer than K others
    points, depth = N.cells(N.fold(spark.createDataFrame(clusters), ["k"], DIMS), ["k"], DIMS)
    empty = spark.createDataFrame([], "k string, pid bigint, qid bigint, d double, qw bigint")
    got = N.first_reach(points, empty, depth, ["k"], DIMS, K).toPandas()
    boxes = points.groupBy("k", "cell").agg(F.array(*[F.min(d) for d in DIMS]).alias("lo"), F.array(*[F.max(d) for d in DIMS]).alias("hi")).toPandas()
    visits = 0
    for k, part in got.groupby("k"):
        whole = clusters.loc[clusters.k == k, DIMS].to_numpy()
        own = boxes[boxes.k == k]
        lo, hi = np.stack(own.lo), np.stack(own.hi)
        for x, r in zip(part[DIMS].to_numpy(), part.r):
            kth = np.sort(np.sqrt(((whole - x) ** 2).sum(axis=1)))[K]  # the first is the point itself
            assert kth <= r < np.inf
            gap = np.maximum(np.maximum(lo - x, x - hi), 0)
            visits += ((gap**2).sum(axis=1) <= r * r).sum()
    # without a bound every point of a key would visit all of its cells
    everything = sum((got.k == k).sum() * (boxes.k == k).sum() for k in ("many", "one"))
    assert boxes.shape[0] > 150 and visits < everything / 4, (visits, everything)


def test_neighbours_of_thin_cells_are_exact(spark, monkeypatch, clusters):
    monkeypatch.setattr(N, "cell_points", lambda _: 6)
    points, depth = N.cells(N.fold(spark.createDataFrame(clusters), ["k"], DIMS), ["k"], DIMS)
    edges = N.neighbours(points, depth, ["k"], DIMS, K).groupBy("k", "pid").agg(F.max("d").alias("d"), F.sum("qw").alias("n"))
    got = points.join(edges, ["k", "pid"]).toPandas()
    assert len(got) == points.count()
    for k, part in got.groupby("k"):
        whole = clusters.loc[clusters.k == k, DIMS].to_numpy()
        for x, d, n in zip(part[DIMS].to_numpy(), part.d, part.n):
            dist = np.sort(np.sqrt(((whole - x) ** 2).sum(axis=1)))[1:]
            assert d == pytest.approx(dist[K - 1], rel=1e-12) and n == (dist <= dist[K - 1] * (1 + 1e-12)).sum()


def brute(x, w, k):
    """Edges of each distinct point by all distances, copies repeated."""
    found = set()
    for i in range(len(x)):
        d = np.sqrt(((x[i] - x) ** 2).sum(axis=1))
        left = w - (np.arange(len(x)) == i)
        kth = np.sort(np.repeat(d, left))[: k][-1]
        found |= {(i, int(j), d[j], int(left[j])) for j in np.flatnonzero((d <= kth) & (left > 0))}
    return found


@pytest.mark.parametrize("whole", [10_000, 100])
@pytest.mark.parametrize("most", [1, 5])
def test_nearest_is_exact_by_lots(monkeypatch, whole, most):
    monkeypatch.setattr(N, "WHOLE", whole)
    rng = np.random.default_rng(7)
    # a lattice, so that many distances are level
    x = np.unique(np.stack([rng.integers(0, 40, 900) / 7, rng.integers(0, 9, 900) / 3, rng.integers(0, 5, 900) * 1e3], axis=1), axis=0)
    rng.shuffle(x)
    w = rng.integers(1, most + 1, len(x))
    expected = brute(x, w, K)
    assert set(zip(*[c.tolist() for c in N.nearest(x, x, w, K)])) == expected
    # as guests of their own cell, each with the distance found there as reach, and the point itself a member
    reach = np.zeros(len(x))
    for i, _, d, _ in expected:
        reach[i] = max(reach[i], d)
    got = set(zip(*[c.tolist() for c in N.nearest(x, x, w, K, reach)]))
    inside = {(i, j) for i, j, d, _ in got}
    assert all(d <= reach[i] for i, _, d, _ in got) and {(i, i) for i in range(len(x))} <= inside


def test_nearest_compares_few_members(monkeypatch):
    x, sizes, plain = np.random.default_rng(5).uniform(size=(4000, 2)), [], N.kth_least
    monkeypatch.setattr(N, "kth_least", lambda values, *a: sizes.append(values.size) or plain(values, *a))
    p, q, _, _ = N.nearest(x, x, np.ones(len(x), int), K)
    assert len(p) == K * len(x)
    assert sum(sizes) < len(x) * len(x) / 4


def test_rows_of_small_keys_are_not_folded(spark, monkeypatch):
    """Each row gets its factor in its key's task; large and null ids stay as they are."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(90, 2)).round(1)
    x = np.concatenate([x, x[:30]])
    rows = [("a" if i % 2 else None, None if i == 5 else 2**60 + i, float(p), float(q)) for i, (p, q) in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, id long, p double, q double")
    b = Binding(key=("k",), ts="id", values=("p", "q"), id=("id",))
    monkeypatch.setattr(N, "cell_points", lambda _: 30)  # fewer than a key has
    split = {(r["k"], r["id"]): r["lof"] for r in N.local_outlier_factor(df, b, K).collect()}
    monkeypatch.undo()
    monkeypatch.setattr(N, "fold", None)
    whole = {(r["k"], r["id"]): r["lof"] for r in N.local_outlier_factor(df, b, K).collect()}
    assert set(whole) == set(split) == {r[:2] for r in rows}
    assert all(lof == pytest.approx(split[at], rel=1e-9) for at, lof in whole.items())
