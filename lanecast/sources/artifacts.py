"""Readers for the tables a run leaves behind."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FORECAST_SCHEMA


#: Marks a version of a table as complete; names with an underscore are no data to Spark.
PUBLISHED = "_published"


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or a typed empty one when it was never written."""
    current = current_path(spark, path)
    if current is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(current)


def read_optional_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_forecast_csvs(spark: SparkSession, pattern: str) -> DataFrame:
    """Every forecast file matching a glob as one table; no match is an error."""
    try:
        return (
            spark.read.schema(FORECAST_SCHEMA)
            .option("header", True)
            .option("enforceSchema", False)
            .csv(pattern)
        )
    except AnalysisException as error:
        raise FileNotFoundError(f"no forecast files match {pattern}; run training before evaluation") from error


def read_forecasts(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, path):
        raise FileNotFoundError(f"no forecasts at {path}; run training before evaluation")
    return spark.read.schema(FORECAST_SCHEMA).parquet(path)


def flatten_runs(runs: DataFrame) -> DataFrame:
    """Run log with the common parameters and metrics as columns."""
    texts = ("corridor_id", "corridor_name", "model_name", "training_strategy")
    return runs.select(
        "run_id",
        "status",
        *[F.try_element_at("params", F.lit(name)).alias(name) for name in texts],
        *[F.try_element_at("metrics", F.lit(name)).alias(name) for name in ("mape", "rmse", "mae")],
    )


def hadoop_path(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path as it knows it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """The versions of a table by number, and whether each was published."""
    files, target = hadoop_path(spark, path)
    if not files.exists(target):
        return {}
    names = [status.getPath().getName() for status in files.listStatus(target) if status.isDirectory()]
    return {
        int(name[1:]): _exists(spark, f"{path}/{name}/{PUBLISHED}") for name in names if re.fullmatch(r"v\d{10}", name)
    }


def current_path(spark: SparkSession, path: str) -> str | None:
    """Where the rows of a table are: its newest published version, or ``path`` if it has no versions; None if never written."""
    present = versions(spark, path)
    published = [number for number, done in present.items() if done]
    if published:
        return f"{path}/v{max(published):010d}"
    return path if not present and _exists(spark, path) else None


def _exists(spark: SparkSession, path: str) -> bool:
    files, target = hadoop_path(spark, path)
    return files.exists(target)
