"""Scoring of forecasts against held-out years and against a published band."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import mae, mape, rmse
from ..schemas import (
    BENCHMARK_SCORE_SCHEMA,
    BENCHMARK_YEAR,
    COMPARISON_SCHEMA,
    HOLDOUT_SCORE_SCHEMA,
    HOLDOUT_YEAR,
)

_SERIES_YEAR = ["corridor_id", "corridor_name", "year"]
_RUN = ["corridor_id", "corridor_name", "model_name", "training_strategy"]


def regression_metrics(
    df: DataFrame, actual: str = "actual", predicted: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """MAPE, RMSE and MAE over each group, or over everything."""
    return df.groupBy(*by).agg(
        mape(actual, predicted).alias("mape"), rmse(actual, predicted).alias("rmse"), mae(actual, predicted).alias("mae")
    )


def score_holdout(forecasts: DataFrame, actuals: DataFrame, year: int = HOLDOUT_YEAR) -> DataFrame:
    """Errors of each holdout forecast; a single observation makes RMSE and MAE the absolute error."""
    observed = actuals.where(F.col("year") == year).select(*_SERIES_YEAR, F.col("total_tons").alias("actual"))
    error = F.abs(F.col("actual") - F.col("prediction"))
    scored = (
        forecasts.where((F.col("forecast_type") == "holdout") & (F.col("year") == year))
        .join(observed, _SERIES_YEAR)
        .withColumns(
            {
                "mape": F.when(F.col("actual") != 0, F.abs(error / F.col("actual"))) * 100,
                "rmse": error,
                "mae": error,
            }
        )
    )
    return scored.select(*HOLDOUT_SCORE_SCHEMA.names)


def inside_band(value: str, low: str, high: str) -> Column:
    """Closed-interval test; a missing value or bound is outside."""
    return F.coalesce(F.col(value).between(F.col(low), F.col(high)), F.lit(False))


def score_benchmark(forecasts: DataFrame, band: DataFrame, year: int = BENCHMARK_YEAR) -> DataFrame:
    """Band membership and signed deviation of each forecast of the benchmark year."""
    target = F.col("year") == year
    scored = (
        forecasts.where((F.col("forecast_type") == "future") & target)
        .join(band.where(target), _SERIES_YEAR)
        .withColumns(
            {
                "within_bts_band": inside_band("prediction", "bts_tons_low", "bts_tons_high"),
                "pct_deviation_vs_bts": F.try_divide(F.col("prediction") - F.col("bts_tons"), F.col("bts_tons")) * 100,
            }
        )
    )
    return scored.select(*BENCHMARK_SCORE_SCHEMA.names)


def compare_models(holdout_scores: DataFrame, benchmark_scores: DataFrame) -> DataFrame:
    """Holdout errors next to the benchmark verdict; no verdict leaves NULL."""
    verdicts = benchmark_scores.select(*_RUN, "within_bts_band", "pct_deviation_vs_bts")
    return holdout_scores.join(verdicts, _RUN, "left").select(*COMPARISON_SCHEMA.names)


def evaluate_all(
    forecasts: DataFrame,
    actuals: DataFrame,
    band: DataFrame,
    holdout_year: int = HOLDOUT_YEAR,
    benchmark_year: int = BENCHMARK_YEAR,
) -> dict[str, DataFrame]:
    """The three score tables."""
    holdout = score_holdout(forecasts, actuals, holdout_year)
    benchmark = score_benchmark(forecasts, band, benchmark_year)
    return {
        "holdout_scores": holdout,
        "benchmark_scores": benchmark,
        "model_comparison": compare_models(holdout, benchmark),
    }


def expanding_splits(series: DataFrame, min_train: int = 4, key: str = "corridor_id", order: str = "year") -> DataFrame:
    """Train years and test year of every split: all earlier years of the series, at least ``min_train``."""
    # A series has one row per year, so the collected list stays short.
    earlier = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        series.select(key, F.collect_list(order).over(earlier).alias("train_years"), F.col(order).alias("test_year"))
        .where(F.size("train_years") >= min_train)
        .select(key, "train_years", "test_year")
    )


def backtest_random_walk(annual: DataFrame, min_train: int = 4) -> DataFrame:
    """Prediction of every expanding-window split by the last value known before it."""
    w = Window.partitionBy("corridor_id", "corridor_name").orderBy("year")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    return (
        annual.select(
            "corridor_id",
            "corridor_name",
            F.col("year").alias("test_year"),
            F.col("total_tons").alias("actual"),
            F.last("total_tons", ignorenulls=True).over(earlier).alias("prediction"),
            (F.row_number().over(w) - 1).alias("train_size"),
        )
        .where(F.col("train_size") >= min_train)
    )
