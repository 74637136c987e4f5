"""Writers of layers, forecasts, scores and the run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import ordered_table
from ..operators.profiling import profile_distinct, profile_missing
from ..schemas import TABLE_KEYS, FlowLayout, table_schemas
from ..sources.artifacts import current_path
from ..sources.validation import write_counted
from .versions import replace_version


def declare_tables(spark: SparkSession, root: str, layout: FlowLayout = FlowLayout()) -> list[str]:
    """Create every missing table of the three layers, empty and typed."""
    created = []
    for name, schema in table_schemas(layout).items():
        path = f"{root}/{name}"
        if current_path(spark, path) is None:
            spark.createDataFrame([], schema).write.parquet(path)
            created.append(name)
    return created


def replace_table(df: DataFrame, root: str, name: str) -> tuple[str, int]:
    """Replace one table, or leave it as it is if the job fails or its declared key is broken; its name and how many rows it now has."""
    return name, replace_version(df, f"{root}/{name}", TABLE_KEYS.get(name, ()))


def read_table(spark: SparkSession, root: str, name: str, layout: FlowLayout = FlowLayout()) -> DataFrame:
    schema = table_schemas(layout).get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(current_path(spark, f"{root}/{name}") or f"{root}/{name}")


def write_forecasts(forecasts: DataFrame, path: str) -> int:
    """Replace the forecasts of the models in the batch.

    One directory per model; rows are ranged over its files and ordered by corridor, so a corridor filter
    skips files and row groups. Returns how many rows were written.
    """
    rows = forecasts.repartitionByRange("model_name", "corridor_id").sortWithinPartitions("model_name", "corridor_id", "year")
    return write_counted(rows, path, partition_by=("model_name",), partitionOverwriteMode="dynamic")


def write_metrics_json(scores: DataFrame, path: str) -> None:
    """One JSON object of metrics per corridor and model, below the directory of its model."""
    (
        scores.select("model_name", "corridor_id", "mape", "rmse", "mae")
        .write.mode("overwrite")
        .partitionBy("model_name")
        .json(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_ordered(df: DataFrame, path: str, order: Sequence[str], number: str = "row_number") -> None:
    """Replace a table by ``df`` in a total order, nulls last: its files follow each other and every row carries its place."""
    ordered_table(df, [F.asc_nulls_last(c) for c in order], number).write.mode("overwrite").parquet(path)


def write_profiles(df: DataFrame, root: str, name: str) -> list[str]:
    """Summaries of one data set as CSV with a header: missing values, and distinct values, of each column."""
    parts = {"missing": profile_missing(df), "unique": profile_distinct(df)}
    for part, summary in parts.items():
        write_csv(summary, f"{root}/{name}_{part}_summary")
    return [f"{root}/{name}_{part}_summary" for part in parts]


def write_importance(importance: DataFrame, path: str) -> None:
    """Feature importance, most important first."""
    write_csv(importance.orderBy(F.desc_nulls_last("importance"), "feature"), path)


def run_rows(scores: DataFrame, settings: DataFrame | None = None) -> DataFrame:
    """Run-log rows for a table of per-corridor model scores.

    ``settings`` adds the parameters of each fit: a map per ``corridor_id`` and ``model_name``.
    """
    keys = ("corridor_id", "corridor_name", "model_name", "training_strategy")
    params = F.create_map(*[part for key in keys for part in (F.lit(key), F.col(key).cast("string"))])
    if settings is not None:
        scores = scores.join(settings.select("corridor_id", "model_name", "settings"), ["corridor_id", "model_name"], "left")
        params = F.map_concat(params, F.coalesce("settings", F.create_map().cast("map<string,string>")))
    name = F.concat_ws(
        "_", "model_name", F.lit("corridor"), F.col("corridor_id").cast("string"), "training_strategy"
    )
    return scores.select(
        F.expr("uuid()").alias("run_id"),
        name.alias("run_name"),
        F.lit("FINISHED").alias("status"),
        params.alias("params"),
        F.create_map(*[part for m in ("mape", "rmse", "mae") for part in (F.lit(m), F.col(m))]).alias("metrics"),
    )


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)
