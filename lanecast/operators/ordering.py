"""Row numbers in a total order over a whole table, without a window that runs in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

_TIE, _PART, _AT = "__tie", "__part", "__at"


def numbered(df: DataFrame, order: Sequence[Column | str], number: str = "row_number", partitions: int | None = None) -> DataFrame:
    """``df`` with the place of each row, from 1, in the order of ``order``; rows equal in it come in any order.

    Rows are dealt by ranges of ``order`` and sorted within each; the number of a row is its place in its range
    after the rows of all ranges before. Only one row per range is summed in a single task. Equal rows are spread
    over ranges by a random number. The sorted rows are written to the shared folder first, since a range
    computed again need not have the same borders.
    """
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    spread = df.withColumn(_TIE, F.rand(1)).repartitionByRange(count, *keys, F.col(_TIE))
    placed = spread.sortWithinPartitions(*keys, F.col(_TIE)).withColumns(
        {_PART: F.spark_partition_id(), _AT: F.monotonically_increasing_id()}
    )
    stored = materialise(placed.drop(_TIE))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias("__rows"), F.min(_AT).alias("__first"))
        .select(_PART, (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    )
    # one row per range, whatever the number of rows
    joined = stored.join(F.broadcast(starts), _PART)
    return joined.withColumn(number, F.col(_AT) + F.col("__shift")).drop(_PART, _AT, "__shift")


def ordered_table(df: DataFrame, order: Sequence[Column | str], number: str = "row_number") -> DataFrame:
    """``numbered`` with the rows of each file in order and files in order of their names: what a sorted sink writes."""
    ranked = numbered(df, order, number)
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranked.repartitionByRange(count, number).sortWithinPartitions(number)
