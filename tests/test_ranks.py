"""Ranks and two-sample scores from value counts against numpy: ties, hot values, null keys, split forms."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.operators import hypothesis as H
from obsframe.operators import ordering

B = Binding(key=("k",), ts="t", values=("v",))


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(5)
    n = 1500
    pdf = pd.DataFrame({"id": np.arange(n), "k": rng.choice(["a", "b", "c", None], n, p=[0.5, 0.3, 0.15, 0.05])})
    pdf["v"] = np.where(rng.random(n) < 0.4, 2.0, rng.normal(size=n).round(2))  # one value is two fifths of all rows
    df = spark.createDataFrame(pdf.astype({"k": object}).where(pdf.notna(), None), "id long, k string, v double")
    return pdf, df.unionByName(df.limit(3).withColumn("v", F.lit(None).cast("double")).withColumn("id", F.lit(-1).cast("long")))


def limits(spark, monkeypatch, rows, cells):
    from obsframe import session

    monkeypatch.setattr(session, "broadcast_cells", lambda _: cells)
    for module in (session, ordering, H):
        monkeypatch.setattr(module, "group_rows", lambda _: rows)


@pytest.mark.parametrize("rows,cells", [(10**6, 10**6), (100, 10**6), (100, 8), (20, 8)])
@pytest.mark.parametrize("descending", [False, True])
def test_average_rank(spark, monkeypatch, sample, rows, cells, descending):
    pdf, df = sample
    limits(spark, monkeypatch, rows, cells)
    got = ordering.average_rank(df.where("v is not null"), ("k",), "v", "r", descending).toPandas().set_index("id")["r"]
    want = pdf.assign(k=pdf.k.fillna("none")).groupby("k")["v"].rank(ascending=not descending)
    assert len(got) == len(pdf) and np.array_equal(got.sort_index(), want)


def brute(x, y):
    u = (x[:, None] > y[None, :]).sum() + (x[:, None] == y[None, :]).sum() / 2
    t = np.unique(np.concatenate([x, y]), return_counts=True)[1].astype(float)
    n = len(x) + len(y)
    sd = np.sqrt(len(x) * len(y) / 12 * (n + 1 - (t**3 - t).sum() / (n * (n - 1))))
    return u, (max(u, len(x) * len(y) - u) - len(x) * len(y) / 2 - 0.5) / sd


@pytest.mark.parametrize("rows,cells", [(10**6, 10**6), (50, 8)])
def test_mann_whitney(spark, monkeypatch, sample, rows, cells):
    pdf, df = sample
    limits(spark, monkeypatch, rows, cells)
    pairs = [("a", "b"), ("b", "a"), ("a", "c"), ("c", None), ("b", "b"), ("a", "absent")]
    got = {(r.key_a, r.key_b): (r.u, r.z) for r in H.mann_whitney(df, B, H.pair_list(df, B, pairs)).collect()}
    values = {k: pdf.loc[pdf.k.isna() if k is None else pdf.k == k, "v"].to_numpy() for k in ("a", "b", "c", None)}
    assert set(got) == set(pairs) - {("a", "absent")}
    for (a, b), found in got.items():
        assert found == pytest.approx(brute(values[a], values[b]), rel=1e-12), (a, b)


def test_mann_whitney_of_nothing(spark, sample):
    df = sample[1].where("false")
    assert H.mann_whitney(df, B, H.pair_list(df, B, [("a", "b")])).count() == 0


@pytest.mark.parametrize("rows", [10**6, 30])
def test_running_total(spark, monkeypatch, rows):
    limits(spark, monkeypatch, rows, 8)
    pdf = pd.DataFrame({"k": ["hot"] * 200 + ["b"] * 5, "o": [*range(200), *range(5)], "w": np.arange(205) % 7})
    got = ordering.running_total(spark.createDataFrame(pdf).repartition(3), ("k",), ["o"], "w", "s").toPandas()
    want = pdf.groupby("k")["w"].cumsum() - pdf["w"]
    assert list(got.sort_values(["k", "o"])["s"]) == list(pdf.assign(s=want).sort_values(["k", "o"])["s"])
