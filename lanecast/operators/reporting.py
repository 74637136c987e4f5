"""Report tables: selections, latest figures, rankings and chart feeds, for all corridors at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import COMPARISON_SCHEMA


def select_rows(df: DataFrame, corridors: Sequence[str] = (), models: Sequence[str] = ()) -> DataFrame:
    """Rows of the chosen corridors and models; an empty choice keeps everything."""
    if corridors:
        df = df.where(F.col("corridor_name").isin(list(corridors)))
    if models:
        df = df.where(F.col("model_name").isin(list(models)))
    return df


def latest_figures(annual: DataFrame) -> DataFrame:
    """Totals of each corridor's latest year and the change from the calendar year before."""
    w = Window.partitionBy("corridor_id", "corridor_name").orderBy("year")
    previous = F.when(F.lag("year").over(w) == F.col("year") - 1, F.lag("total_tons").over(w))
    figures = F.struct("year", "total_tons", "total_value", "total_tmiles", "previous_tons")
    latest = (
        annual.withColumn("previous_tons", previous)
        .groupBy("corridor_id", "corridor_name")
        .agg(F.max_by(figures, "year").alias("latest"))
        .select("corridor_id", "corridor_name", "latest.*")
    )
    change = F.col("total_tons") - F.col("previous_tons")
    return latest.withColumn("yoy_pct", F.try_divide(change, F.col("previous_tons")) * 100)


def best_model(comparison: DataFrame) -> DataFrame:
    """The lowest MAPE of each corridor; a missing MAPE ranks last and names break ties."""
    rank = F.struct(F.col("mape").isNull(), "mape", "model_name", "training_strategy")
    row = F.struct(*[name for name in COMPARISON_SCHEMA.names if not name.startswith("corridor_")])
    return (
        comparison.groupBy("corridor_id", "corridor_name")
        .agg(F.min_by(row, rank).alias("best"))
        .select("corridor_id", "corridor_name", "best.*")
    )


def rmse_matrix(comparison: DataFrame, models: Sequence[str]) -> DataFrame:
    """Average RMSE with a row per corridor and a column per model."""
    return comparison.groupBy("corridor_id", "corridor_name").pivot("model_name", list(models)).agg(F.avg("rmse"))


def score_bars(scores: DataFrame, measure: str) -> DataFrame:
    """One bar per corridor and model."""
    return scores.select("corridor_name", "model_name", F.col(measure).alias("height"))


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    return importance.orderBy(F.desc_nulls_last("importance"), "feature").limit(n)


def corridor_names(annual: DataFrame) -> DataFrame:
    """Distinct corridor names in order of their first id."""
    first = annual.groupBy("corridor_name").agg(F.min("corridor_id").alias("corridor_id"))
    return first.orderBy("corridor_id", "corridor_name").select("corridor_name")


def model_names(forecasts: DataFrame) -> DataFrame:
    return forecasts.select("model_name").distinct().orderBy(F.asc_nulls_last("model_name"))


def forecast_rows(forecasts: DataFrame) -> DataFrame:
    """Forecasts in display order."""
    return forecasts.orderBy(*[F.asc_nulls_last(c) for c in ("model_name", "forecast_type", "year")])


def chart_feed(annual: DataFrame, forecasts: DataFrame, band: DataFrame) -> DataFrame:
    """Actual values, forecasts with bounds and the benchmark band in one long table."""
    keys = ("corridor_id", "corridor_name", "year")
    nothing = F.lit(None).cast("double")
    actual = annual.select(
        *keys, F.lit("actual").alias("series"), F.col("total_tons").alias("value"), nothing.alias("low"), nothing.alias("high")
    )
    predicted = forecasts.select(
        *keys,
        F.col("model_name").alias("series"),
        F.col("prediction").alias("value"),
        F.col("lower_bound").alias("low"),
        F.col("upper_bound").alias("high"),
    )
    published = band.select(
        *keys,
        F.lit("benchmark").alias("series"),
        F.col("bts_tons").alias("value"),
        F.col("bts_tons_low").alias("low"),
        F.col("bts_tons_high").alias("high"),
    )
    return actual.unionByName(predicted).unionByName(published)
