"""Summed cross products of many small keys and of keys of every size."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsframe.operators import least_squares as L


@pytest.fixture(scope="module")
def keyed(spark):
    rng = np.random.default_rng(5)
    n = 4000
    k = [None if i == 7 else int(i) for i in np.where(np.arange(n) < 1500, 0, rng.integers(1, 400, n))]
    pdf = pd.DataFrame({"k": pd.array(k, dtype="Int64"), "x": rng.normal(size=n), "y": rng.normal(size=n)})
    rows = [(None if pd.isna(a) else int(a), float(x), float(y), float(-1 if pd.isna(a) else a) * 2) for a, x, y in pdf.itertuples(index=False)]
    return pdf, spark.createDataFrame(rows, "k long, x double, y double, c double").repartition(6)


@pytest.mark.parametrize("limit", ["1000000", "1000", "1"])
def test_sums_per_key_at_every_limit(spark, keyed, limit):
    pdf, df = keyed
    spark.conf.set("spark.obsframe.maxGroupRows", limit)
    try:
        got = L.gram(df, ["k"], F.array(F.lit(1.0), "x", "y"), carry=("c",)).collect()
    finally:
        spark.conf.unset("spark.obsframe.maxGroupRows")
    want = {None if pd.isna(k) else int(k): g for k, g in pdf.groupby("k", dropna=False)}
    assert len(got) == len(want)
    for r in got:
        x = np.column_stack([np.ones(len(want[r["k"]])), want[r["k"]][["x", "y"]].to_numpy()])
        np.testing.assert_allclose(r["g"], (x.T @ x).ravel(), rtol=1e-9, atol=1e-9)
        assert r["n"] == len(x) and r["c"] == (-1 if r["k"] is None else r["k"]) * 2


def test_sums_of_small_keys_are_not_shuffled(keyed):
    plan = L.gram(keyed[1], ["k"], F.array(F.lit(1.0), "x", "y"))._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "Exchange" not in above and "FlatMapGroups" not in plan
