"""The forecast table contract and the yearly series handed to per-series models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FORECAST_COLUMNS, FORECAST_SCHEMA

LEAVE_LAST_OUT = "leave_last_year_out"


def conform(forecasts: DataFrame) -> DataFrame:
    """Project to the forecast columns in order; an absent column is an error."""
    missing = [name for name in FORECAST_COLUMNS if name not in forecasts.columns]
    if missing:
        raise ValueError(f"forecast output lacks columns: {missing}")
    return forecasts.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in FORECAST_SCHEMA])


def dated(annual: DataFrame) -> DataFrame:
    """The series as a model reads it: ``ds``, the first day of the year, and ``y``, its tons."""
    return annual.withColumns({"ds": F.make_date("year", F.lit(1), F.lit(1)), "y": F.col("total_tons")})


def yearly_arrays(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """One row per corridor holding its years, in order, and the given columns as arrays.

    A corridor has one row per year, so the arrays stay short. The one shuffle has a fixed number of
    partitions: fitting, not bytes, is the cost, and merging small partitions would idle most cores.
    """
    spark = df.sparkSession
    most = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    entries = F.sort_array(F.collect_list(F.struct("year", *columns)))
    keys = ("corridor_id", "corridor_name")
    grouped = df.repartition(partitions or most, *keys).groupBy(*keys).agg(entries.alias("_rows"))
    return grouped.select(*keys, *[F.col(f"_rows.{c}").alias(c) for c in ("year", *columns)])
