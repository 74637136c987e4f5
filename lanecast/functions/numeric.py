"""Null-safe arithmetic used by every operator. Missing is always NULL, never NaN or infinity."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column | str) -> Column:
    """NULL for NaN and for either infinity (NaN sorts above infinity in Spark, so one test covers all)."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields NULL instead of failing or overflowing."""
    return finite(F.try_divide(numerator, denominator))


def normal_quantile(width: float) -> float:
    """Half-width, in standard deviations, of the central normal interval of the given coverage."""
    return NormalDist().inv_cdf(0.5 + width / 2.0)


def array_quantile(values: Column | str, probability: float) -> Column:
    """Linear-interpolation quantile of one row's array, NULL elements ignored."""
    kept = F.filter(F.col(values) if isinstance(values, str) else values, lambda v: v.isNotNull())
    ordered = F.sort_array(kept)
    position = (F.size(ordered) - 1) * F.lit(float(probability))
    below = F.floor(position).cast("int")
    low = F.try_element_at(ordered, below + 1)
    high = F.try_element_at(ordered, F.ceil(position).cast("int") + 1)
    return F.when(F.size(ordered) > 0, low + (high - low) * (position - below))


def quantile_interval(values: Column | str, width: float = 0.8) -> tuple[Column, Column]:
    """Lower and upper quantile enclosing the central ``width`` of one row's array."""
    tail = (1.0 - width) / 2.0
    return array_quantile(values, tail), array_quantile(values, 1.0 - tail)
