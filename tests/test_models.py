"""Planted truth, invariants and split forms of the fitted models."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.operators import evaluate as E
from obsframe.operators import models as M
from obsframe.operators.least_squares import gram, square, vector_sum
from obsframe.operators.stationarity import adf, default_lags
from obsframe.operators.stl import stl
from obsframe.plans import catalog
from tests.conftest import SMALL

B = Binding(key=("k",), ts="slot", values=("value",))


def frame(spark, series: dict[str, np.ndarray]):
    parts = [
        pd.DataFrame({"k": k, "slot": pd.date_range("2024-01-01", periods=len(v), freq="h"), "value": v})
        for k, v in series.items()
    ]
    df = spark.createDataFrame(pd.concat(parts))
    return df.withColumn("slot", F.col("slot").cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(7)
    i = np.arange(480)
    wave = 5 * np.sin(2 * math.pi * i / 24)
    ar = np.zeros(480)
    for t in range(1, 480):
        ar[t] = 0.6 * ar[t - 1] + rng.normal()
    data = {"up": 10 + 0.02 * i + wave + rng.normal(size=480) * 0.3, "ar": ar, "walk": np.cumsum(rng.normal(size=480))}
    return data, frame(spark, data).cache()


def by_hand_adf(y: np.ndarray) -> tuple[int, float]:
    d, top = np.diff(y), default_lags(len(y))

    def fit(k, start):
        rows = range(start, len(d))
        x = np.array([[1.0, y[t], *[d[t - j] for j in range(1, k + 1)]] for t in rows])
        beta, *_ = np.linalg.lstsq(x, d[start:], rcond=None)
        ssr = float(((d[start:] - x @ beta) ** 2).sum())
        return x, beta, ssr

    def aic(k):
        n = len(d) - top
        return n * math.log(fit(k, top)[2] / n) + 2 * (k + 2)

    k = min(range(top + 1), key=aic)
    x, beta, ssr = fit(k, k)
    se = math.sqrt(ssr / (len(x) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    return k, float(beta[1] / se)


@pytest.mark.parametrize("limit", [None, "100"])
def test_adf_equals_plain_regression(spark, planted, limit):
    data, df = planted
    if limit:
        spark.conf.set("spark.obsframe.maxGroupRows", limit)
    try:
        got = {r.k: r for r in adf(df, B).collect()}
    finally:
        spark.conf.unset("spark.obsframe.maxGroupRows")
    for k, y in data.items():
        lags, tau = by_hand_adf(y)
        assert got[k].lags == lags and got[k].statistic == pytest.approx(tau, rel=1e-6)
    assert got["ar"].is_stationary and not got["walk"].is_stationary


def test_sums_are_the_same_when_keys_are_split(spark, split, planted):
    data, df = planted
    g = {r.k: square(r.g) for r in gram(df, ("k",), F.array(F.lit(1.0), "value")).collect()}
    s = {r.k: r for r in vector_sum(df, ("k",), F.array("value")).collect()}
    for k, y in data.items():
        assert g[k][0, 0] == len(y) and g[k][1, 1] == pytest.approx((y * y).sum())
        assert s[k].n == len(y) and s[k].s[0] == pytest.approx(y.sum())


def test_arima_finds_the_autoregression(planted):
    _, df = planted
    model = M.ArimaModel(order=(1, 0, 0)).fit(df, B)
    row = {r.k: r for r in model.orders().collect()}["ar"]
    assert row.beta[1] == pytest.approx(0.6, abs=0.1)
    chosen = {r.k: r.d for r in M.ArimaModel().fit(df, B).orders().collect()}
    assert chosen["ar"] == 0 and chosen["walk"] == 1
    bands = model.predict(12).where("k = 'ar'").orderBy("step").collect()
    widths = [r.upper - r.lower for r in bands]
    assert widths == sorted(widths) and len(bands) == 12
    # the wider the level, the wider the band
    assert model.predict(3, 0.8).where("k = 'ar' and step = 1").first().upper < bands[0].upper


def test_seasonal_model_beats_the_mean(planted):
    data, df = planted
    scores = M.evaluate([M.SeasonalModel()], df, B).where("k = 'up'").first()
    assert scores.r2 > 0.8 and scores.n_points == 96


def check_forecast(df, keys, steps):
    rows = df.collect()
    assert len(rows) == keys * steps
    assert all(r.lower <= r.forecast <= r.upper for r in rows)
    assert {r.step for r in rows} == set(range(1, steps + 1))


def test_multiplicative_takes_all_rows(spark):
    i = np.arange(24 * 14)
    wave = 1 + 0.4 * np.sin(2 * math.pi * i / 24)
    df = frame(spark, {"grows": (20 + 0.05 * i) * wave, "sinks": (6 - 0.04 * i) * wave, "negative": -(20 + 0.05 * i) * wave})
    model = M.SeasonalModel("multiplicative", weekly=False).fit(df, B)
    check_forecast(model.predict(6), 3, 6)
    got = {(r.k, r.step): r.forecast for r in model.predict(6).collect()}
    n = len(i)
    for step in range(1, 7):
        t = n + step - 1
        w = 1 + 0.4 * math.sin(2 * math.pi * t / 24)
        for k, level in (("grows", 20 + 0.05 * t), ("sinks", 6 - 0.04 * t), ("negative", -(20 + 0.05 * t))):
            assert got[k, step] == pytest.approx(level * w, abs=0.6)


def test_every_key_has_a_status(spark, planted):
    data, _ = planted
    df = frame(spark, {"up": data["up"], "nine": data["ar"][:9], "empty": np.full(40, np.nan)})
    df = df.withColumn("value", F.nanvl("value", F.lit(None)))
    for model in (M.SeasonalModel(), M.ArimaModel(order=(1, 1, 0)), M.forest(trees=2, depth=3)):
        got = {r.k: r.status for r in model.fit(df, B).status().collect()}
        assert set(got) == {"up", "nine", "empty"} and got["up"] == "ok" and got["empty"] == "insufficient"
        assert (got["nine"] == "insufficient") == (model.name != "seasonal")


def test_dynamic_weights_are_renewed(spark, planted):
    data, _ = planted
    model = M.DynamicEnsemble([M.SeasonalModel(), M.ArimaModel(order=(1, 0, 0))], window=24, every=6)
    model.fit(frame(spark, {"up": data["up"][:200]}), B)
    before = model.weights
    assert not model.renew(frame(spark, {"up": data["up"][:205]})) and model.weights is before
    assert model.renew(frame(spark, {"up": data["up"][:206]})) and model.weights is not before


def test_trees_roll_forward(planted):
    _, df = planted
    model = M.forest(trees=5, depth=5).fit(df, B)
    check_forecast(model.predict(4), 3, 4)
    shares = [r.importance for r in model.feature_importance().collect()]
    assert sum(shares) == pytest.approx(1.0) and shares == sorted(shares, reverse=True)


@pytest.mark.parametrize("make", [lambda: M.forest(trees=4, depth=6), lambda: M.boosted(rounds=4, depth=4), lambda: M.boosted_wide(rounds=3)])
def test_rolled_trees_are_the_fitted_trees(planted, make):
    """Arrays give what the fitted model gives, on rows that Spark built the features of."""
    _, df = planted
    model = make().fit(df, B)
    frame_ = M.attach(M.X.forecast_features(df, B), model.levels, B.key)
    rows = model.model.transform(model.assemble(frame_)).select("features", "prediction").limit(300).toPandas()
    x = np.stack([v.toArray() for v in rows["features"]])
    np.testing.assert_allclose(M.Trees.of(model.model).predict(x), rows["prediction"], rtol=1e-12)
    # the first step's inputs, by the functions that training used
    past = df.where("k = 'ar'").orderBy("slot").toPandas()
    last = past.slot.iloc[-25:]
    mine = M.tree_inputs(past["value"].to_numpy()[None, -25:-1], np.array([last.iloc[-1].timestamp()]))
    built = M.X.forecast_features(df.where("k = 'ar'"), B).orderBy(F.desc("slot")).first()
    np.testing.assert_allclose(mine[0], [float(built[c]) for c in M.X.feature_names("value")], atol=1e-9)


def test_ensembles(planted):
    _, df = planted
    members = lambda: [M.SeasonalModel(), M.ArimaModel(order=(1, 0, 0))]
    weighted = M.WeightedEnsemble(members(), "performance").fit(df, B)
    check_forecast(weighted.predict(6), 3, 6)
    totals = weighted.weights.groupBy("k").agg(F.sum("weight").alias("w")).collect()
    assert all(r.w == pytest.approx(1.0) for r in totals)
    check_forecast(M.DynamicEnsemble(members()).fit(df, B).predict(6), 3, 6)
    check_forecast(M.StackingEnsemble(members(), "lasso").fit(df, B).predict(6), 3, 6)
    with pytest.raises(ValueError):
        M.StackingEnsemble(members(), "unknown")
    assert len(M.default_ensemble("dynamic").models) == 5


def test_ensemble_queries_combine_the_five_members(spark, monkeypatch):
    seen = {}
    note = lambda self, *a: seen.update({self.name: {m.name for m in self.models}}) or self
    for kind in (M.StackingEnsemble, M.WeightedEnsemble):
        monkeypatch.setattr(kind, "fit", note)
        monkeypatch.setattr(kind, "predict", lambda self, *a: None)
    for name in ("ensemble_stacking", "ensemble_performance", "ensemble_dynamic_models"):
        catalog.QUERIES[name](spark, SMALL)
    five = {"seasonal", "arima", "boosted", "boosted_wide", "forest"}
    assert seen == {"stacking": five, "weighted": five, "dynamic": five}


def test_weights_are_renormalised_over_present_models(spark):
    rows = [("a", 1, "x", 10.0), ("a", 1, "y", 20.0), ("a", 2, "x", 10.0)]
    df = spark.createDataFrame(rows, "k string, step int, model string, forecast double")
    got = {r.step: r.forecast for r in E.weighted(df, {"x": 0.25, "y": 0.75}, ("k", "step"), ("k",)).collect()}
    assert got == {1: 17.5, 2: 10.0}


def test_metrics_edge_cases(spark):
    rows = [("m", 0.0, 0.0), ("m", 0.0, 1.0), ("m", 2.0, None)]
    df = spark.createDataFrame(rows, "model string, actual double, forecast double")
    r = E.metrics(df, ("model",)).first()
    assert r.n_points == 2 and r.mape == 50.0 and r.smape == 100.0 and r.r2 is None


def test_stl_chunks_equal_whole(spark, planted):
    data, _ = planted
    rng = np.random.default_rng(1)
    i = np.arange(3000)
    y = 0.01 * i + 5 * np.sin(2 * math.pi * i / 12) + rng.normal(size=3000)
    y[::97] += 30
    df = frame(spark, {"long": y, "short": data["up"][:20]})
    whole = stl(df, B, period=12, outer=2).toPandas().sort_values(["k", "slot"])
    spark.conf.set("spark.obsframe.maxGroupRows", "500")
    try:
        parts = stl(df, B, period=12, outer=2).toPandas().sort_values(["k", "slot"])
    finally:
        spark.conf.unset("spark.obsframe.maxGroupRows")
    for c in ("trend", "seasonal", "resid"):
        np.testing.assert_allclose(whole[c], parts[c], atol=1e-8)
    long = whole[whole.k == "long"]
    np.testing.assert_allclose(long.trend + long.seasonal + long.resid, long.value, atol=1e-9)
    assert np.abs(long.trend - 0.01 * i).max() < 1.5 and whole[whole.k == "short"].trend.isna().all()
