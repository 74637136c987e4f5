"""Typed readers for the wide yearly flow files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import FlowLayout, flow_schema, history_schema
from .validation import replace_checked


def read_flow_csv(spark: SparkSession, path: str, layout: FlowLayout = FlowLayout()) -> DataFrame:
    """The wide flow file; a misnamed column or malformed number fails the read."""
    return _read_strict_csv(spark, path, flow_schema(layout))


def read_history_csv(spark: SparkSession, path: str, layout: FlowLayout = FlowLayout()) -> DataFrame:
    """The wide historical flow file, with the same strictness."""
    return _read_strict_csv(spark, path, history_schema(layout))


def load_flows(spark: SparkSession, csv_path: str, table_path: str, layout: FlowLayout = FlowLayout()) -> dict[str, int | str]:
    return replace_checked(read_flow_csv(spark, csv_path, layout), table_path, "raw_flows")


def load_history(
    spark: SparkSession, csv_path: str, table_path: str, layout: FlowLayout = FlowLayout()
) -> dict[str, int | str]:
    return replace_checked(read_history_csv(spark, csv_path, layout), table_path, "raw_flow_history")


def _read_strict_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
