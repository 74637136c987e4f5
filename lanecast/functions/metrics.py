"""Accuracy measures as aggregate or row-level column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def absolute_percentage_error(actual: Column | str, predicted: Column | str) -> Column:
    """Relative absolute error of a row; NULL where the actual value is zero."""
    actual, predicted = _col(actual), _col(predicted)
    return F.when(actual != 0, F.abs((actual - predicted) / actual))


def mape(actual: Column | str, predicted: Column | str) -> Column:
    """Mean absolute percentage error over a group; NULL when every actual value is zero."""
    return F.avg(absolute_percentage_error(actual, predicted)) * 100


def rmse(actual: Column | str, predicted: Column | str) -> Column:
    return F.sqrt(F.avg(F.pow(_col(actual) - _col(predicted), 2)))


def mae(actual: Column | str, predicted: Column | str) -> Column:
    return F.avg(F.abs(_col(actual) - _col(predicted)))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
