"""Every query with SQL gives the SQL's rows; those that depend on order or group size also in split form."""

from __future__ import annotations

import pytest

from obsframe.plans import catalog
from tests.compare import compare
from tests.conftest import SMALL

SPLIT = """anomaly_zscore anomaly_iqr impute_scale vote_consensus anomaly_summary moving_average lag_features
    engineer_features interpolate_linear decompose_additive decompose_multiplicative component_strength
    forecast_features holdout_split future_grid forecast_metrics ensemble_dynamic prediction_band
    descriptive_stats box_summary compare_keys key_comparison avg_rank corr_spearman corr_kendall linear_trend
    durbin_watson levene_halves levene_pair mannwhitney_pair effect_size dickey_fuller_zero anomaly_lof
    dedup_append""".split()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_plain(spark, con, name):
    assert compare(catalog.QUERIES[name](spark, SMALL), con, catalog.ORACLES[name], exact=False) is None


@pytest.mark.parametrize("name", SPLIT)
def test_split(spark, con, split, name):
    assert compare(catalog.QUERIES[name](spark, SMALL), con, catalog.ORACLES[name], exact=False) is None
