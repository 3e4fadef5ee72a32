"""Sensor time-series analytics as composable PySpark DataFrame operators."""

from fieldsignal.spec import SeriesSpec

__all__ = ["SeriesSpec"]
