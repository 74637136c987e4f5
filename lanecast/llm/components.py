"""Connected components of a link table, as repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node named by ``links`` (columns a, b: long).

    Every node moves to its smallest neighbour or stays; links are renamed accordingly and loops go. Node ids
    are hashes, so each round removes a constant share of the nodes in expectation and the rounds are
    logarithmic in the longest chain. A hub is handled by partial aggregation and by skew splitting in the
    join; no group is ever gathered. Every round is written to the shared folder.
    """
    spark = links.sparkSession
    edges = materialise(links.select("a", "b").where("a is not null and b is not null").distinct())
    result = None
    while True:
        both = edges.where("a <> b")
        both = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")))
        if moves.isEmpty():
            break
        if result is None:
            result = moves.select(F.col("a").alias("node"), F.col("to").alias("component"))
        else:
            step = moves.select(F.col("a").alias("component"), "to")
            result = result.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        result = materialise(result)
        left = moves.select("a", F.col("to").alias("a2"))
        right = moves.select(F.col("a").alias("b"), F.col("to").alias("b2"))
        edges = edges.where("a <> b").join(left, "a").join(right, "b").where("a2 <> b2")
        edges = materialise(edges.select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct())
    if result is None:
        return spark.createDataFrame([], "node long, component long")
    return result
