"""Search against all scores; ties, equal vectors, odd vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from obsframe.llm import topk
from tests.compare import compare
from tests.conftest import SMALL


def test_query(spark, con):
    assert compare(topk.op5_topk(spark, SMALL), con, topk.OP5_SQL) is None


def brute(rows, queries, k):
    out = []
    for q, x in queries:
        scores = sorted((-sum(a * b for a, b in zip(x, y)), v) for v, y in rows if v != q and len(y) == len(x))
        out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("lists,dims,n,k", [(2, 5, 60, 3), (3, 4, 40, 5), (1, 3, 10, 20), (4, 2, 30, 2)])
def test_small_tiles(spark, monkeypatch, lists, dims, n, k):
    monkeypatch.setattr(topk, "TILE_ROWS", 16)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(n)
    rows = [(i, rng.integers(-3, 4, dims).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(8)]  # equal vectors
    queries = rows[::6]
    shape = "vec_id long, x array<long>"
    got = topk.top_k(spark.createDataFrame(queries, shape), spark.createDataFrame(rows, shape), k, lists).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, queries, k)


def test_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 2.0]), (50, [0.5, -1.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []),
        (6, [1.0]), (7, [0.5, 0.5]), (7, [0.5, 0.5]), (None, [1.0, 1.0]), (8, [1e6, -1e6]), (100, []),
    ]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, x int")
    vectors = topk.quantised(df)
    whole = [(i, [math.floor(256 * c) for c in v]) for i, v in rows[:2] + rows[6:9] + rows[11:]]
    assert sorted((r.vec_id, list(r.x)) for r in vectors.collect()) == sorted(whole)
    got = topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, 5).collect()
    want = brute(whole, [w for w in whole if w[0] % 50 == 0], 5)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want
    empty = vectors.limit(0)
    assert topk.top_k(empty, vectors).collect() == [] and topk.top_k(vectors, empty).collect() == []


def test_products_beyond_floats():
    big = np.array([[3_000_000_000, 1]], dtype=np.int64)
    assert topk._scores(big, big)[0, 0] == 9_000_000_000_000_000_001
