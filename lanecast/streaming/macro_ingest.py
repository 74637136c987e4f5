"""Scheduled macro ingestion as an incremental stream over a drop folder.

Each file is one pull of one or more whole series (``series_id,date,value``). A triggered run picks
up the files that arrived since the last one and replaces exactly the series they hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.sizing import join_lookup
from ..sources.macros import normalise_series, replace_series

PULL_SCHEMA = "series_id string, date string, value string"


def latest_pulls(batch: DataFrame) -> DataFrame:
    """Of several pulls of a series in one batch, the rows of the newest file only."""
    newest = batch.groupBy("series_id").agg(F.max(F.struct("pulled_at", "pulled_from")).alias("newest"))
    return (
        join_lookup(batch, newest, "series_id")
        .where((F.col("pulled_at") == F.col("newest.pulled_at")) & (F.col("pulled_from") == F.col("newest.pulled_from")))
        .select("series_id", "date", "value")
    )


def ingest_available(spark: SparkSession, drop_folder: str, table_path: str, checkpoint: str) -> StreamingQuery:
    """Start a run over the files not yet ingested; it stops by itself when they are done."""
    pulls = (
        spark.readStream.schema(PULL_SCHEMA)
        .option("header", True)
        .csv(drop_folder)
        .select(
            "*",
            F.col("_metadata.file_modification_time").alias("pulled_at"),
            F.col("_metadata.file_path").alias("pulled_from"),
        )
    )

    def replace(batch: DataFrame, _: int) -> None:
        series = normalise_series(latest_pulls(batch)).persist()
        requested = series.select("series_id").distinct().count()
        if requested:
            replace_series(series, table_path, requested)
        series.unpersist()

    return (
        pulls.writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
