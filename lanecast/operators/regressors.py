"""Carrying macro series forward into years without observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import finite
from ..schemas import MACRO_COLUMNS


def extrapolate(
    series: DataFrame, years: Sequence[int], key: str = "series_id", order: str = "year", value: str = "value"
) -> DataFrame:
    """One row per series and target year: the observed value, else a straight line.

    The line runs through the last observed value with the plain difference of the last two
    observations as its yearly step, also backwards. One observation gives a flat line, none gives NULL.
    NaN and infinity are no observations.
    """
    earlier = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    series = series.withColumn(value, finite(F.col(value).cast("double")))
    known = F.col(value).isNotNull()
    wanted = known & F.col(order).isin([int(y) for y in years])
    anchors = (
        series.withColumn("_before", F.last(value, ignorenulls=True).over(earlier))
        .groupBy(key)
        .agg(
            F.max(F.when(known, F.struct(order, value, "_before"))).alias("_last"),
            F.map_from_entries(F.collect_list(F.when(wanted, F.struct(order, value)))).alias("_observed"),
        )
    )
    step = F.coalesce(F.col(f"_last.{value}") - F.col("_last._before"), F.lit(0.0))
    line = F.col(f"_last.{value}") + step * (F.col(order) - F.col(f"_last.{order}"))
    return anchors.withColumn(order, F.explode(F.array(*[F.lit(int(y)) for y in years]))).select(
        key, order, F.coalesce(F.try_element_at("_observed", F.col(order)), line).alias(value)
    )


def regressors_by_year(
    macros: DataFrame, years: Sequence[int], columns: Sequence[str] = MACRO_COLUMNS
) -> DataFrame:
    """Every macro column extrapolated to the target years: ``len(years)`` rows."""
    cells = ", ".join(f"'{name}', {name}" for name in columns)
    long = macros.selectExpr("year", f"stack({len(columns)}, {cells}) AS (series_id, value)")
    return (
        extrapolate(long, years)
        .groupBy("year")
        .agg(*[F.max(F.when(F.col("series_id") == name, F.col("value"))).alias(name) for name in columns])
    )


def future_regressors(
    corridors: DataFrame, macros: DataFrame, years: Sequence[int], columns: Sequence[str] = MACRO_COLUMNS
) -> DataFrame:
    """The extrapolated macro columns for each corridor and target year."""
    grid = (
        corridors.select("corridor_id", "corridor_name")
        .distinct()
        .withColumn("year", F.explode(F.array(*[F.lit(int(y)) for y in years])))
    )
    by_year = regressors_by_year(macros, years, columns)
    return grid.join(by_year, "year", "left").select("year", *columns, "corridor_id", "corridor_name")


def step_regressors(macros: DataFrame, years: Sequence[int], columns: Sequence[str] = MACRO_COLUMNS) -> DataFrame:
    """Regressors of each target year: its macro row when there is one, gaps included, else extrapolated."""
    existing = macros.where(F.col("year").isin([int(y) for y in years])).select(
        "year", F.lit(True).alias("_exists"), *[F.col(name).alias(f"_own_{name}") for name in columns]
    )
    merged = regressors_by_year(macros, years, columns).join(existing, "year", "left")
    return merged.select(
        "year", *[F.when(F.col("_exists"), F.col(f"_own_{name}")).otherwise(F.col(name)).alias(name) for name in columns]
    )
