"""Session settings, the shared folder for intermediate tables, and shipping of this package."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app_name: str = "lanecast", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the launcher owns these settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if CHECKPOINT_SETTING not in SparkConf().toDebugString():
        builder = builder.config(CHECKPOINT_SETTING, tempfile.mkdtemp(prefix="lanecast-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder, which it keeps for
    its lifetime. A cluster session without it is an error: a machine-local folder would be
    lost with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING)
    if context.getCheckpointDir() is None:
        if not configured:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="lanecast-")
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4()}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a Parquet table in the shared folder and go on from there.

    This cuts the lineage, survives lost executors, and gives later joins the true size of the table.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver was started from."""
    if spark.conf.get("lanecast.shipped", None) == spark.sparkContext.applicationId:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="lanecast-pkg-"), "lanecast.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(root.rglob("*.py")):
            bundle.write(source, str(Path("lanecast") / source.relative_to(root)))
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("lanecast.shipped", spark.sparkContext.applicationId)
