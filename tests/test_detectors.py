"""Detectors against brute force and planted outliers, whole and split."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.operators import anomaly as N
from obsframe.operators import correlate as C
from obsframe.operators import detectors as D
from obsframe.operators import multivariate as P
from obsframe.operators.neighbours import CELL_CONF, local_outlier_factor

B = Binding(key=("k",), ts="id", values=("x", "y"), id=("id",))


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(3)
    n = 500
    pdf = pd.DataFrame({"k": ["hot"] * 380 + ["b"] * 120, "id": range(n), "x": rng.normal(size=n), "y": rng.normal(size=n)})
    pdf.loc[20:120, ["x", "y"]] = [0.1, 0.2]  # a pile of copies
    pdf.loc[[5, 400], ["x", "y"]] = [9.0, -9.0]  # planted outliers
    return pdf, spark.createDataFrame(pdf).cache()


def brute_lof(g: pd.DataFrame, k: int) -> pd.Series:
    x = g[["x", "y"]].to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    kd = np.sort(d, 1)[:, k - 1]
    near = d <= kd[:, None] + 1e-12
    reach = np.where(near, np.maximum(d, kd[None, :]), 0.0)
    lrd = 1 / (reach.sum(1) / near.sum(1) + 1e-10)
    return pd.Series((near * lrd[None]).sum(1) / near.sum(1) / lrd, index=g["id"])


@pytest.mark.parametrize("cell", ["4096", "50", "12"])
def test_lof_is_exact(spark, cloud, cell):
    pdf, df = cloud
    spark.conf.set(CELL_CONF, cell)
    try:
        got = local_outlier_factor(df, B, 15).toPandas().set_index("id")["lof"].sort_index()
    finally:
        spark.conf.unset(CELL_CONF)
    want = pd.concat([brute_lof(g, 15) for _, g in pdf.groupby("k")]).sort_index()
    np.testing.assert_allclose(got, want, rtol=1e-6)


DETECTORS = {
    "forest": lambda df: D.isolation_forest(df, B, trees=20, sample=64),
    "envelope": lambda df: D.elliptic_envelope(df, B, rounds=4),
    "svm": lambda df: D.one_class_svm(df, B, rounds=4),
    "svm_linear": lambda df: D.one_class_svm(df, B, kernel="linear", rounds=4),
}


@pytest.mark.parametrize("name", DETECTORS)
@pytest.mark.parametrize("limit", ["1000000", "100"])
def test_detectors_find_outliers(spark, cloud, name, limit):
    _, df = cloud
    spark.conf.set("spark.obsframe.maxGroupRows", limit)
    try:
        out = DETECTORS[name](df).toPandas()
    finally:
        spark.conf.unset("spark.obsframe.maxGroupRows")
    assert len(out) == 500
    share = out.groupby("k")["is_anomaly"].mean()
    assert (share <= 0.1 + 1e-9).all() and (share > 0.02).all()
    if name != "svm_linear":
        assert out.set_index("id").loc[[5, 400], "is_anomaly"].all()


@pytest.mark.parametrize("name", ["envelope", "svm", "svm_linear"])
def test_flags_do_not_depend_on_the_group_limit(spark, cloud, name):
    _, df = cloud
    found = []
    for limit in ("1000000", "100"):
        spark.conf.set("spark.obsframe.maxGroupRows", limit)
        try:
            found.append(DETECTORS[name](df).toPandas().set_index("id").sort_index())
        finally:
            spark.conf.unset("spark.obsframe.maxGroupRows")
    assert (found[0].is_anomaly == found[1].is_anomaly).all()
    np.testing.assert_allclose(found[0].score, found[1].score, rtol=1e-6, atol=1e-9)


def test_pool_is_the_least_hashes(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").alias("k"), "id", F.col("id").cast("double").alias("x"))
    b = Binding(key=("k",), ts="id", values=("x",), id=("id",))
    got = D.seeded_pool(df.repartition(6), b, 40).toPandas()
    rows = df.select("k", "id", F.xxhash64(F.lit(D.SEED), "id").alias("h")).toPandas()
    for k in ("hot", None):
        part = rows[rows.k.isna() if k is None else rows.k == k]
        mine = got[got.k.isna() if k is None else got.k == k].sort_values("__r")
        assert mine.id.tolist() == part.sort_values(["h", "id"]).id.head(40).tolist()


def test_six_methods_and_short_keys(spark):
    rows = [("short", i, 1.0 * i, 2.0) for i in range(2)] + [("long", i + 10, (i * 7 % 31) / 3.0, (i * 5 % 17) / 2.0) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, id int, x double, y double")
    methods = {
        "zscore": lambda d: N.zscore(d, B), "iqr": lambda d: N.iqr(d, B), "lof": lambda d: local_outlier_factor(d, B, 5),
        "forest": lambda d: D.isolation_forest(d, B, trees=5, sample=16), "svm": lambda d: D.one_class_svm(d, B, rounds=3),
        "envelope": lambda d: D.elliptic_envelope(d, B, rounds=3),
    }
    got = {(r.k, r.method): r for r in N.timed_comparison(methods, df, B).collect()}
    assert len(got) == 12 and all(r.elapsed_seconds > 0 for r in got.values())
    assert {got["short", m].status for m in methods} == {"insufficient"} and {got["long", m].status for m in methods} == {"ok"}


def test_short_keys_and_flat_keys(spark):
    rows = [("short", i, 1.0 * i, 2.0) for i in range(2)] + [("flat", i + 10, 3.0, 3.0) for i in range(12)]
    df = spark.createDataFrame(rows, "k string, id int, x double, y double")
    assert not any(r.is_anomaly for r in N.zscore(df, B).collect())
    scored = N.compare_methods({"zscore": N.zscore(df, B), "iqr": N.iqr(df, B)}, B).collect()
    status = {(r.k, r.method): r.status for r in scored}
    assert status["short", "iqr"] == "insufficient" and status["flat", "iqr"] == "ok"
    assert {r.k for r in D.isolation_forest(df, B, trees=5, sample=8).select("k").distinct().collect()} == {"flat"}
    for bad in (0.0, 0.5, 0.9):
        with pytest.raises(ValueError):
            D.isolation_forest(df, B, contamination=bad)
    with pytest.raises(ValueError):
        D.one_class_svm(df, B, kernel="poly")


def test_null_keys_and_null_values_survive(spark):
    rows = [(None, i, float(i % 5), 1.0) for i in range(30)] + [("a", i + 30, None, 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, id int, x double, y double")
    out = N.zscore(df, B).collect()
    assert len(out) == 35 and sum(r.z_score is not None for r in out) == 30


def brute_tau(x, y):
    s = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i in range(len(x)) for j in range(i))
    nx = sum(x[i] != x[j] for i in range(len(x)) for j in range(i))
    ny = sum(y[i] != y[j] for i in range(len(x)) for j in range(i))
    return s / np.sqrt(float(nx) * float(ny))


@pytest.mark.parametrize("limit", ["1000000", "20"])
def test_kendall_with_heavy_ties(spark, limit):
    rng = np.random.default_rng(5)
    n = 150
    x = np.where(rng.random(n) < 0.4, 1.0, rng.integers(0, 30, n).astype(float))
    y = np.where(rng.random(n) < 0.3, 2.0, x + rng.normal(size=n).round(0))
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "id": range(n), "x": x, "y": y}))
    spark.conf.set("spark.obsframe.maxGroupRows", limit)
    try:
        got = C.kendall(df, B).first().r
    finally:
        spark.conf.unset("spark.obsframe.maxGroupRows")
    assert got == pytest.approx(brute_tau(x, y), abs=1e-12)


def test_pca_matches_correlation_spectrum(spark, cloud):
    pdf, df = cloud
    got = P.pca(df, B, 2).orderBy("k", "component").collect()
    for k, g in pdf.groupby("k"):
        want = np.sort(np.linalg.eigvalsh(np.corrcoef(g[["x", "y"]].T)))[::-1]
        have = [r.variance for r in got if r.k == k]
        np.testing.assert_allclose(have, want, atol=1e-9)
    assert P.importance(P.pca(df, B, 2, key=()), ()).count() == 2


@pytest.mark.parametrize("parts", [1, 7])
def test_partitioning_does_not_change_results(spark, cloud, parts):
    _, df = cloud
    base = {r.id: r.score for r in N.iqr(df, B).collect()}
    again = {r.id: r.score for r in N.iqr(df.repartition(parts), B).collect()}
    assert base == again
    one = N.iqr(df.where(F.col("k") == "b"), B).collect()
    assert all(base[r.id] == r.score for r in one)
