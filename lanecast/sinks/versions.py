"""Replacing a table without losing it: versions written beside each other, of which the newest published one counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.artifacts import PUBLISHED, hadoop_path, versions


def replace_version(df: DataFrame, path: str, key: Sequence[str] = ()) -> int:
    """Make ``df`` the content of the table at ``path`` and return its number of rows.

    The rows go into a folder of their own, which readers pass over until a marker is created in it: a job that
    fails on the way, or rows that break the declared ``key``, leave the table as it was. ``df`` may read the
    table itself. The version before stays for readers that are at work; older ones are removed. One writer at a
    time: a second one of the same number fails.
    """
    spark = df.sparkSession
    present = versions(spark, path)
    target = f"{path}/v{max(present, default=0) + 1:010d}"
    counted = Observation("version")
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in key], F.lit(False))
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("keyless"))
    observed.write.mode("errorifexists").parquet(target)
    files, place = hadoop_path(spark, target)
    try:
        _check_key(spark.read.schema(df.schema).parquet(target), path, key, counted.get["keyless"])
    except ValueError:
        files.delete(place, True)
        raise
    files, marker = hadoop_path(spark, f"{target}/{PUBLISHED}")
    files.create(marker, False).close()
    published = sorted(number for number, done in present.items() if done)
    for number in present:
        if published and number < published[-1]:
            files.delete(hadoop_path(spark, f"{path}/v{number:010d}")[1], True)
    # rows of a table that had no versions would be read in place of them by a reader that knows of none
    for status in files.listStatus(hadoop_path(spark, path)[1]):
        if status.isFile():
            files.delete(status.getPath(), False)
    return counted.get["rows"]


def _check_key(stored: DataFrame, path: str, key: Sequence[str], keyless: int) -> None:
    """Refuses rows without a key and keys of several rows. Only the key columns are read, and combined before they move."""
    if not key:
        return
    if keyless:
        raise ValueError(f"{path} rejected: {keyless} rows lack a part of the key {tuple(key)}")
    twice = stored.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1).limit(3).collect()
    if twice:
        raise ValueError(f"{path} rejected: keys {tuple(key)} of several rows, such as {[tuple(r) for r in twice]}")
