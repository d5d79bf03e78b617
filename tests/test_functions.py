"""Distribution functions and tests against published values."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.functions import scalar as S
from obsframe.functions import special
from obsframe.operators import hypothesis as H
from obsframe.operators.stationarity import dickey_fuller_p


def test_t_quantiles():
    assert special.t_quantile_value(0.975, 10) == pytest.approx(2.2281, abs=1e-4)
    assert special.t_quantile_value(0.975, 1) == pytest.approx(12.7062, abs=1e-3)
    assert special.t_two_sided_value(2.0860, 20) == pytest.approx(0.05, abs=1e-4)


def test_f_chi2_normal():
    assert special.f_upper_value(4.1028, 2, 10) == pytest.approx(0.05, abs=1e-4)
    assert special.chi2_quantile_value(0.95, 4) == pytest.approx(9.4877, abs=1e-3)
    assert special.chi2_quantile_value(0.5, 2) == pytest.approx(1.3863, abs=1e-4)
    assert special.normal_quantile_value(0.975) == pytest.approx(1.959964, abs=1e-6)
    assert special.normal_cdf_value(-1.645) == pytest.approx(0.05, abs=1e-4)


def test_dickey_fuller_critical_values():
    assert dickey_fuller_p(-2.86) == pytest.approx(0.05, abs=2e-3)
    assert dickey_fuller_p(-3.43) == pytest.approx(0.01, abs=2e-3)
    assert dickey_fuller_p(3.0) == 1.0


def test_shapiro_published_example(spark):
    # weights of eleven men from the original paper: W = 0.79
    x = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    df = spark.createDataFrame([("a", float(v)) for v in x], "k string, v double")
    row = H.shapiro(df, ("k",), "v").first()
    assert row.w == pytest.approx(0.79, abs=0.005)
    assert row.p_value == pytest.approx(0.0067, abs=0.001)


def test_shapiro_short_and_long(spark):
    rng = np.random.default_rng(5)
    long = [("flat", float(v)) for v in range(5000)] + [("bell", v) for v in rng.normal(size=20_000).tolist()]
    long += [("skewed", v) for v in rng.exponential(size=20_000).tolist()]
    df = spark.createDataFrame([*long, ("two", 1.0), ("two", 2.0), *[("same", 3.0)] * 4], "k string, v double")
    got = {r.k: r for r in H.shapiro(df, ("k",), "v").collect()}
    assert got["flat"].p_method == "royston" and not got["flat"].is_normal
    assert got["bell"].p_method == "moments" and got["bell"].is_normal and got["bell"].w > 0.999
    assert not got["skewed"].is_normal and got["skewed"].w < 0.9
    assert got["two"].p_value is None and got["same"].p_value is None
    skipped = {r.k: r for r in H.shapiro(df, ("k",), "v", skip_from=5000).collect()}
    assert skipped["flat"].p_value == 1.0 and not skipped["flat"].normality_tested


def test_normal_score_is_the_quantile(spark):
    ps = [1e-300, 1e-12, 0.001, 0.074, 0.3, 0.5, 0.7, 0.926, 0.999, 1 - 1e-12]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    for r in df.select("p", special.normal_score(F.col("p")).alias("z")).collect():
        assert r.z == pytest.approx(special.normal_quantile_value(r.p), abs=1e-12, rel=1e-12)


def test_trend_needs_three_rows(spark):
    rows = [("a", i, float(i)) for i in range(2)] + [("b", i, 2.0 * i + 1) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    got = {r.k: r for r in H.linear_trend(df, Binding(("k",), "t", ("v",))).collect()}
    assert got["a"].trend_direction == "insufficient" and got["a"].slope is None
    assert got["b"].slope == pytest.approx(2.0) and got["b"].p_value == 0.0


def test_two_sample_choice(spark):
    normal = [special.normal_quantile_value((i + 0.5) / 60) for i in range(60)]
    rows = [("a", v) for v in normal] + [("b", v + 2) for v in normal] + [("c", 9 * v) for v in normal]
    rows += [("d", 2.0 ** (v * 3)) for v in normal] + [("e", 1.0), ("e", 2.0)]
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(rows)], "k string, t int, v double")
    pairs = [("a", "b"), ("a", "c"), ("a", "d"), ("a", "e")]
    got = {r.key_b: r for r in H.two_sample(df, Binding(("k",), "t", ("v",)), pairs).collect()}
    assert got["b"].test_used == "student" and got["b"].is_significant
    assert got["b"].effect_label == "large" and got["b"].ci_upper < 0
    assert got["c"].test_used == "welch" and not got["c"].is_significant
    assert got["d"].test_used == "mann_whitney"
    assert got["e"].status == "insufficient" and got["e"].statistic is None


def test_load_cleaning(spark):
    df = spark.createDataFrame([("2024-01-01 05:00:00", float("nan")), ("nonsense", 1.0)], "t string, v double")
    rows = S.nan_to_null(df).select(S.parse_ts("t").alias("t"), "v").collect()
    assert rows[0].t == dt.datetime(2024, 1, 1, 5) and rows[0].v is None
    assert rows[1].t is None and rows[1].v == 1.0
    assert S.available(df, ("v", "missing")) == ["v"]
