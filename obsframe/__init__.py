"""Keyed time-series analytics expressed as Spark DataFrame jobs."""

from obsframe.binding import Binding

__all__ = ["Binding"]
