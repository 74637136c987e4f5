import random

import pytest
from pyspark.sql import functions as F

from lanecast.operators.ordering import numbered, ordered_table


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_follow_the_order_whatever_the_partitions(spark, partitions):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 2, 2, 2, 9]), rng.randint(0, 30)) for _ in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = numbered(df, [F.asc_nulls_last("a"), F.desc("b")], "n", partitions).collect()
    assert sorted(r.n for r in got) == list(range(1, 501))
    keys = [(r.a is None, r.a or 0, -r.b) for r in sorted(got, key=lambda r: r.n)]
    assert keys == sorted(keys) and sorted(map(tuple, rows), key=str) == sorted(((r.a, r.b) for r in got), key=str)


def test_equal_rows_are_spread_and_an_empty_table_stays_empty(spark):
    same = spark.range(1000).select(F.lit(5).alias("a"))
    got = numbered(same, ["a"], "n", 4)
    assert sorted(r.n for r in got.collect()) == list(range(1, 1001))
    assert got.groupBy(F.spark_partition_id()).count().count() > 1
    assert numbered(same.limit(0), ["a"]).collect() == []


def test_files_of_an_ordered_table_follow_each_other(spark, tmp_path):
    ordered_table(spark.range(100).select((99 - F.col("id")).alias("v")), ["v"]).write.parquet(str(tmp_path / "t"))
    rows = [(r.f, r.v, r.row_number) for r in spark.read.parquet(str(tmp_path / "t")).withColumn("f", F.input_file_name()).collect()]
    assert sorted(rows, key=lambda r: r[2]) == sorted(rows) and all(v + 1 == n for _, v, n in rows)
