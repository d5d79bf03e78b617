"""Importing a family registers its queries."""

from obsframe.plans import basics, detect, forecasts, inference, ingest, models, multivariate, profiles, series
from obsframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
