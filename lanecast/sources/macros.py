"""Long macro-economic series: normalisation and per-series replacement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SERIES_SCHEMA
from ..session import materialise
from .validation import ensure, write_counted


def normalise_series(pull: DataFrame, series_id: str | Column | None = None) -> DataFrame:
    """Typed observations of one pull; unreadable or missing values are dropped."""
    tag = F.col("series_id") if series_id is None else F.lit(series_id) if isinstance(series_id, str) else series_id
    value = F.col("value").try_cast("double")
    return (
        pull.select(
            tag.cast("string").alias("series_id"),
            F.to_date("date").alias("date"),
            F.when(~F.isnan(value), value).alias("value"),
        )
        .dropna(subset=["value"])
    )


def combine_series(spark: SparkSession, pulls: dict[str, DataFrame]) -> DataFrame:
    """All pulled series as one table; a typed empty table when nothing was pulled."""
    frames = [normalise_series(pull, series_id) for series_id, pull in pulls.items()]
    return reduce(DataFrame.unionByName, frames, spark.createDataFrame([], SERIES_SCHEMA))


def replace_series(series: DataFrame, table_path: str, requested: int) -> dict[str, int | str]:
    """Replace exactly the series present in the batch; the others keep their rows.

    The batch is computed once and checked before anything is replaced: it must hold rows of as many
    series as were requested. It is rebalanced by series: short ones share a task, a long one is split.
    """
    batch = materialise(series)
    found = batch.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("series_id").alias("series")).first()
    counts = {"requested": requested, "rows": found["rows"], "series": found["series"]}
    row = ensure("macro series", counts, {"rows": "positive", "series": "requested"})
    rows = batch.hint("rebalance", "series_id")
    write_counted(rows, table_path, partition_by=("series_id",), partitionOverwriteMode="dynamic")
    return row


def read_series(spark: SparkSession, table_path: str) -> DataFrame:
    """The stored series. Ids are text, also where they look like numbers; an empty table has no rows."""
    stored = spark.read.schema(SERIES_SCHEMA).option("basePath", table_path).parquet(table_path)
    return stored.select("series_id", "date", "value")


def write_series(series: DataFrame, table_path: str) -> int:
    """Replace the whole table."""
    return write_counted(series.hint("rebalance", "series_id"), table_path, partition_by=("series_id",))
