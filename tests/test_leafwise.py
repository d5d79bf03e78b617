"""Trees grown leaf by leaf, against a plain loop that splits one leaf after the other."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from obsframe.operators import leafwise
from obsframe.operators import models as M
from obsframe.operators.leafwise import LeafwiseBooster

SHAPE = "x array<double>, label double"


def made(spark, x: np.ndarray, y: np.ndarray, parts: int = 3):
    rows = [(list(map(float, a)), None if b is None else float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, SHAPE).repartition(parts)
    return df.select(array_to_vector("x").alias("features"), "label", F.lit(1).alias("bins"), F.lit("a").alias("node"))


def plain(x, y, edges, rounds, leaves, rate, min_leaf):
    """Predictions for the rows themselves, one leaf split at a time, every sum taken anew."""
    bins = leafwise.bin_numbers(x, edges)
    out = np.full(len(y), y.mean())

    def split_of(rows, resid):
        found, own = (0.0, 0, 0), resid[rows].sum() ** 2 / len(rows)
        for f in range(x.shape[1]):
            for c in range(len(edges[f])):
                low = bins[rows, f] <= c
                if min(low.sum(), (~low).sum()) < min_leaf:
                    continue
                gain = resid[rows][low].sum() ** 2 / low.sum() + resid[rows][~low].sum() ** 2 / (~low).sum() - own
                if gain > found[0] + 1e-7:
                    found = (gain, f, c)
        return found

    for _ in range(rounds):
        resid = y - out
        parts = [np.arange(len(y))]
        gains = [split_of(parts[0], resid)]
        while len(parts) < leaves:
            k = max(range(len(parts)), key=lambda i: gains[i][0])
            gain, f, c = gains[k]
            if gain <= 1e-6:
                break
            rows = parts.pop(k)
            gains.pop(k)
            for side in (rows[bins[rows, f] <= c], rows[bins[rows, f] > c]):
                parts.append(side)
                gains.append(split_of(side, resid))
        for rows in parts:
            out[rows] += rate * resid[rows].mean()
    return out


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 6, 400), rng.uniform(size=400)])
    # a chain of steps at one end, so that the best order is deep and lopsided
    y = np.where(x[:, 0] > 1.2, 40 * x[:, 2], 0) + np.where(x[:, 0] > 0.5, 9.0, x[:, 1]) + rng.normal(size=400) * 0.1
    return x, y


@pytest.mark.parametrize("leaves, whole, direct", [(2, 1000, 16), (12, 1000, 16), (7, 0, 16), (12, 0, 0)])
def test_equals_splitting_one_leaf_at_a_time(spark, monkeypatch, sample, leaves, whole, direct):
    """In one task, in passes, and in passes whose histograms tasks add."""
    monkeypatch.setattr(leafwise, "WHOLE", whole)
    monkeypatch.setattr(leafwise, "DIRECT", direct)
    monkeypatch.setattr(leafwise, "PENDING", 2)
    x, y = sample
    df = made(spark, x, y)
    model = LeafwiseBooster(rounds=3, leaves=leaves, rate=0.3, bins=32, min_leaf=5).fit(df)
    assert all((t.left == np.arange(len(t.left))).sum() <= leaves for t in model.binned)
    got = model.transform(df).select("features", "prediction").toPandas()
    expected = dict(zip(map(tuple, x), plain(x, y, model.edges, 3, leaves, 0.3, 5)))
    np.testing.assert_allclose(got["prediction"], [expected[tuple(v.toArray())] for v in got["features"]], rtol=1e-6)
    # node lists over the inputs themselves say the same
    rows = np.stack([v.toArray() for v in got["features"]])
    np.testing.assert_allclose(M.Trees.of(model).predict(rows), got["prediction"], rtol=1e-12)


def test_trees_do_not_depend_on_partitions(spark, sample, monkeypatch):
    x, y = sample

    def fit(parts, whole):
        monkeypatch.setattr(leafwise, "WHOLE", whole)
        return LeafwiseBooster(rounds=3, leaves=9, bins=32).fit(made(spark, x, y, parts)).nodes()

    one, many = fit(1, 1000), fit(7, 0)
    assert one[1:] and [[n[:4] for n in t] for t in one] == [[n[:4] for n in t] for t in many]
    for a, b in zip(one, many):
        np.testing.assert_allclose([n[4] for n in a], [n[4] for n in b], rtol=1e-9)


def test_takes_as_many_passes_as_levels(spark, sample, monkeypatch):
    x, y = sample
    passes, counted = [], LeafwiseBooster.histograms
    monkeypatch.setattr(leafwise, "WHOLE", 0)
    monkeypatch.setattr(LeafwiseBooster, "histograms", lambda self, *a: passes.append(len(a[-1])) or counted(self, *a))
    model = LeafwiseBooster(rounds=1, leaves=12, bins=32, min_leaf=5).fit(made(spark, x, y))
    tree = model.binned[0]
    splits = int((tree.left != np.arange(len(tree.left))).sum())
    assert splits == 11 and len(passes) < splits


def test_edges(spark, sample):
    x, y = sample
    empty = LeafwiseBooster(rounds=2).fit(made(spark, x, y).where("label is null"))
    scored = empty.transform(made(spark, x[:3], y[:3])).select("prediction").collect()
    assert [r.prediction for r in scored] == [0.0] * 3 and M.Trees.of(empty).predict(x[:3]).tolist() == [0.0] * 3
    same = LeafwiseBooster(rounds=2).fit(made(spark, x, np.full(len(x), 3.25)))
    assert M.Trees.of(same).predict(x).tolist() == [3.25] * len(x)
    few = LeafwiseBooster(rounds=2, min_leaf=20).fit(made(spark, x[:39], y[:39]))
    np.testing.assert_allclose(M.Trees.of(few).predict(x[:39]), y[:39].mean())
    # rows without a label count for nothing, a missing input lies above every cut
    holes = [None if i % 4 == 0 else v for i, v in enumerate(y)]
    kept = [i for i in range(len(y)) if i % 4]
    some, whole = (LeafwiseBooster(rounds=2, bins=16).fit(made(spark, x[r], np.array(v, object)[r])) for r, v in ((np.arange(len(y)), holes), (kept, y)))
    np.testing.assert_allclose(M.Trees.of(some).predict(x), M.Trees.of(whole).predict(x), rtol=1e-9)
    gap = x.copy()
    gap[::5, 0] = math.nan
    top = np.where(np.isnan(gap), 1e9, gap)
    model = LeafwiseBooster(rounds=3, bins=16).fit(made(spark, gap, y))
    np.testing.assert_allclose(M.Trees.of(model).predict(gap), M.Trees.of(model).predict(top))
    for wrong in ({"bins": 300}, {"leaves": 1}, {"rate": 0.0}):
        with pytest.raises(ValueError):
            LeafwiseBooster(**wrong)
