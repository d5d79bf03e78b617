"""Ensembles: learned second models, weights renewed on the way, keys that members cannot serve."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsframe.operators import models as M
from tests.test_models import B, frame


class Shifted:
    """A member that knows the series and misses it by ``gaps[step]``; keys in ``blind`` it does not serve."""

    def __init__(self, name, truth, gaps, blind=()):
        self.name, self.truth, self.gaps, self.blind = name, truth, gaps, blind

    def fit(self, series, b):
        self.n, self.series = series.groupBy("k").count().toPandas().set_index("k")["count"].to_dict(), series
        return self

    def predict(self, steps=24, level=0.95):
        rows = [
            (k, self.name, s + 1, datetime(2024, 1, 1) + timedelta(hours=n + s), float(self.truth[k][n + s] + self.gaps(s)), 0.0, 0.0)
            for k, n in self.n.items() if k not in self.blind for s in range(min(steps, len(self.truth[k]) - n))
        ]
        shape = "k string, model string, step int, ts timestamp_ntz, forecast double, lower double, upper double"
        return self.series.sparkSession.createDataFrame(rows, shape)

    def status(self):
        rows = [(k, self.name, int(n), 0.0, "insufficient" if k in self.blind else "ok") for k, n in self.n.items()]
        shape = "k string, model string, n long, missing_pct double, status string"
        return self.series.sparkSession.createDataFrame(rows, shape)


@pytest.fixture(scope="module")
def truth():
    rng = np.random.default_rng(1)
    return {"a": rng.normal(10, 3, 200), "b": rng.normal(0, 1, 150)}


def test_weights_follow_the_errors(spark, truth):
    # x is near for the first 20 held-out steps and far after them, y the other way round
    x = Shifted("x", truth, lambda s: 1.0 + s % 2 if s < 20 else 8.0)
    y = Shifted("y", truth, lambda s: 6.0 if s < 20 else 0.5 + s % 3)
    model = M.DynamicEnsemble([x, y], window=8, every=3)
    got = model.follow(frame(spark, truth), B, 0.8).orderBy("k", "step").toPandas()
    assert got.groupby("k").size().to_dict() == {"a": 40, "b": 30}
    for k, part in got.groupby("k"):
        first = len(truth[k]) * 8 // 10
        for s, row in enumerate(part.itertuples()):
            known = slice(max(s - s % 3 - 8, 0), s - s % 3)
            errors = [np.array([m.gaps(i) for i in range(len(part))])[known] for m in (x, y)]
            inverse = [1 / (np.sqrt((e**2).mean()) + 1e-6) if len(e) else 1.0 for e in errors]
            w = inverse[0] / sum(inverse)
            assert (row.weight_x, row.weight_y) == pytest.approx((w, 1 - w), rel=1e-9)
            assert row.actual == truth[k][first + s]
            assert row.forecast == pytest.approx(row.actual + w * x.gaps(s) + (1 - w) * y.gaps(s), rel=1e-9)
    assert got.weight_x.iloc[10] > 0.7 > 0.3 > got.weight_x.iloc[39]


@pytest.mark.parametrize("meta", ["ridge", "lasso", "forest", "boosted"])
def test_second_models_learn_whom_to_trust(spark, truth, meta):
    rng = np.random.default_rng(5)
    noise = rng.normal(0, 6, 400)
    good, bad = Shifted("good", truth, lambda s: 0.0), Shifted("bad", truth, lambda s: noise[s])
    # members forecast beyond the series, so they need a longer truth
    longer = {k: np.concatenate([v, v[:20]]) for k, v in truth.items()}
    good.truth = bad.truth = longer
    model = M.StackingEnsemble([good, bad], meta).fit(frame(spark, truth), B)
    rows = {(r.k, r.step): r.forecast for r in model.predict(20).collect()}
    assert len(rows) == 40
    error = np.mean([abs(f - longer[k][len(truth[k]) + s - 1]) for (k, s), f in rows.items()])
    assert error < (0.5 if meta in ("ridge", "lasso") else 1.5) < np.abs(noise[:20]).mean()


def test_status_of_the_whole(spark, truth):
    df = frame(spark, truth)
    members = lambda: [Shifted("x", truth, lambda s: 0.0, blind=("b",)), Shifted("y", truth, lambda s: 0.0)]
    weighted = M.WeightedEnsemble(members()).fit(df, B)
    got = {r.k: (r.model, r.n, r.status, r.missing) for r in weighted.own_status().collect()}
    assert got == {"a": ("weighted", 200, "ok", []), "b": ("weighted", 150, "partial", ["x"])}
    stacked = M.StackingEnsemble(members(), "ridge").fit(df, B)
    assert {r.k: r.status for r in stacked.own_status().collect()} == {"a": "ok", "b": "insufficient"}
    none = M.WeightedEnsemble([Shifted("x", truth, lambda s: 0.0, blind=("a", "b"))]).fit(df, B)
    assert {r.status for r in none.own_status().collect()} == {"insufficient"}
    # a row of no key is a key like any other
    row = df.sparkSession.createDataFrame([(None, "x", 3, 0.0, "warning")], "k string, model string, n long, missing_pct double, status string")
    assert M.together(row, ("k",), "w", True).select("k", "status").first() == (None, "warning")
