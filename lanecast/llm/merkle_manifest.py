"""Merkle manifest of a document table: a tree of digests per language, a tree over those, and proofs for every leaf.

The levels are built in Spark, six at a time, and stored as rows that name their parent. A proof is a climb: a
recursive query takes every leaf, or an altered version of it, from parent to parent, appends the sibling it meets
at each level and folds it into the digest it carries. Nothing but the one root digest reaches the driver.

Digests are lowercase hex SHA-256 of concatenated inputs; a node is the digest of two consecutive nodes, the last one of
a level of its single node if their number is odd. A lone leaf of a language is its subroot, a lone subroot the root.
An empty table has no rows and no root. Rows with equal ids are ordered by their digest; equal rows are leaves of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecast.operators.ordering import numbered
from lanecast.session import materialise, scratch_path

#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels built by one pass: a group holds at most 2 ** STEP digests.
STEP = 6
#: The tree over the subroots.
TOP = -1
_LEVEL_BITS = 48
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: leaf_no, doc_id, leaf, altered, tree, slot; ``subroots``: tree, subroot; ``nodes``: the stored table of
    (tree, slot, sibling, sibling_first, parent_tree, parent_slot)."""

    leaves: DataFrame
    subroots: DataFrame
    nodes: str
    root: str | None


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column] | None = None) -> Column:
    """Digest of a row; ``columns`` replaces fields by other values."""
    given = columns or {}
    return F.sha2(F.concat(*[_field(given.get(name, F.col(name))) for name in FIELDS]), 256)


def _next_level(nodes: Column) -> Column:
    """Digests of each two consecutive ones, the last one alone if it has no partner."""
    count = F.floor((F.size(nodes) + 1) / 2).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.sha2(F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))), 256),
    )


def _height(count: Column) -> Column:
    """Levels above ``count`` nodes until one is left."""
    return F.when(count > 1, F.length(F.bin(count - 1))).otherwise(0)


def _built(rows: DataFrame, sizes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Node rows (without parents of the last level) of all trees, and (tree, digest) of their roots.

    ``rows``: tree, pos, digest; ``sizes``: tree, height.
    """
    tallest = sizes.agg(F.max("height")).first()[0] or 0
    nodes, roots = [], []
    roots.append(rows.join(sizes.where("height = 0"), "tree").select("tree", "digest"))
    for base in range(0, tallest, STEP):
        here = rows.join(sizes.where(F.col("height") > base), "tree")
        steps = F.least(F.col("height") - base, F.lit(STEP))
        block = F.shiftright("pos", STEP)
        grouped = here.groupBy("tree", "height", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("d"))
        levels = F.aggregate(
            F.sequence(F.lit(1), steps),
            F.array(F.col("d.digest")),
            lambda done, k: F.concat(done, F.array(_next_level(F.element_at(done, -1)))),
        )
        folded = materialise(grouped.select("tree", "height", "block", levels.alias("levels")))
        each = folded.select("tree", "height", "block", F.posexplode(F.slice("levels", F.lit(1), F.size("levels") - 1)).alias("l", "level"))
        each = each.select("tree", "height", "block", "l", "level", F.posexplode("level").alias("j", "digest"))
        partner = F.get("level", F.col("j").bitwiseXOR(1))
        pos = F.expr(f"shiftleft(block, {STEP} - l) + j")
        nodes.append(
            each.select(
                "tree",
                (F.col("l") + base).alias("at"),
                pos.alias("pos"),
                F.unhex(partner).alias("sibling"),
                (F.col("j") % 2 == 1).alias("sibling_first"),
                "height",
            )
        )
        top = folded.select("tree", "height", F.col("block").alias("pos"), F.element_at("levels", -1)[0].alias("digest"))
        roots.append(top.where(F.col("height") <= base + STEP).select("tree", "digest"))
        rows = top.where(F.col("height") > base + STEP).select("tree", "pos", "digest")
    return nodes, materialise(reduce(DataFrame.union, roots))


def build(documents: DataFrame, tampered: Column | None = None) -> Manifest:
    """The manifest of ``documents``. Where ``tampered`` is true a second digest, of the row with n_chars one higher, is kept."""
    spark = documents.sparkSession
    changed = leaf_digest({"n_chars": F.col("n_chars") + 1})
    altered = F.when(tampered, changed) if tampered is not None else F.lit(None).cast("string")
    base = documents.select("doc_id", "lang", leaf_digest().alias("leaf"), altered.alias("altered"))
    # strings compare by their UTF-8 bytes
    order = [F.col(c).asc_nulls_first() for c in ("lang", "doc_id", "leaf")]
    rows = numbered(base, order, "leaf_no")
    languages = rows.groupBy("lang").agg(F.min("leaf_no").alias("first"), F.count(F.lit(1)).alias("count"))
    trees = numbered(languages, ["first"], "tree").withColumn("tree", F.col("tree") - 1)
    trees = materialise(trees.withColumn("height", _height(F.col("count"))))
    placed = rows.join(trees, rows["lang"].eqNullSafe(trees["lang"]))
    placed = materialise(
        placed.select("leaf_no", "doc_id", "leaf", "altered", "tree", "height", (F.col("leaf_no") - F.col("first")).alias("pos"))
    )
    nodes, subroots = _built(placed.select("tree", "pos", F.col("leaf").alias("digest")), trees.select("tree", "height"))
    above = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest")
    size = above.groupBy("tree").agg(_height(F.count(F.lit(1))).alias("height"))
    top_nodes, top_root = _built(above, materialise(size))

    def keyed(at: Column, pos: Column) -> tuple[Column, Column]:
        # the root of a language is a leaf of the tree above
        ends = (F.col("tree") != TOP) & (at == F.col("height"))
        tree = F.when(ends, F.lit(TOP).cast("long")).otherwise(F.col("tree"))
        slot = F.when(ends, F.col("tree")).otherwise(F.shiftleft(at.cast("long"), _LEVEL_BITS).bitwiseOR(pos))
        return tree, slot

    every = reduce(DataFrame.union, nodes + top_nodes) if nodes or top_nodes else None
    parent = keyed(F.col("at") + 1, F.shiftright("pos", 1)) if every is not None else ()
    if every is None:
        every = spark.createDataFrame([], "tree long, slot long, sibling binary, sibling_first boolean, parent_tree long, parent_slot long")
    else:
        every = every.select(
            "tree",
            F.shiftleft(F.col("at").cast("long"), _LEVEL_BITS).bitwiseOR(F.col("pos")).alias("slot"),
            "sibling",
            "sibling_first",
            parent[0].alias("parent_tree"),
            parent[1].alias("parent_slot"),
        )
    name = f"merkle_nodes_{uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # laid out by node, so that no level of the climb shuffles it
    every.repartition(buckets, "tree", "slot").write.bucketBy(buckets, "tree", "slot").sortBy("tree", "slot").option(
        "path", scratch_path(spark, "merkle-nodes")
    ).saveAsTable(name)
    tree, slot = keyed(F.lit(0), F.col("pos"))
    leaves = placed.select("leaf_no", "doc_id", "leaf", "altered", "tree", tree.alias("node_tree"), slot.alias("node_slot"))
    root = top_root.first()
    return Manifest(leaves, subroots.withColumnRenamed("digest", "subroot"), name, root["digest"] if root else None)


def _hex_digests(siblings: Column) -> Column:
    """32-byte digests, one after the other, as an array of lowercase hex."""
    starts = F.filter(F.sequence(F.lit(0), F.octet_length(siblings)), lambda i: (i % 32 == 0) & (i < F.octet_length(siblings)))
    return F.transform(starts, lambda i: F.lower(F.hex(F.substring(siblings, i + 1, F.lit(32)))))


def proof_digest(siblings: Column) -> Column:
    """One digest over all siblings of a proof."""
    return F.sha2(F.lower(F.hex(siblings)).cast("binary"), 256)


def climbed(manifest: Manifest, shown: Callable[[Column], Column] = _hex_digests) -> DataFrame:
    """(doc_id, leaf, tree, folded, siblings): each leaf, altered where it is, taken to the root by a recursive query.

    ``siblings`` is what ``shown`` makes of the 32-byte digests, one after the other. A leaf's own columns join its steps as one more row, so that
    they meet in the one grouping and nothing as wide as a proof is shuffled again.
    """
    spark = manifest.leaves.sparkSession
    starts = manifest.leaves.select(
        "leaf_no", F.col("node_tree").alias("tree"), F.col("node_slot").alias("slot"), F.unhex(F.coalesce("altered", "leaf")).alias("folded")
    )
    limit = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        rows = spark.sql(
            """
            WITH RECURSIVE climb(leaf_no, tree, slot, folded, sibling) AS (
              SELECT leaf_no, tree, slot, folded, CAST(NULL AS BINARY) FROM {starts}
              UNION ALL
              SELECT c.leaf_no, n.parent_tree, n.parent_slot,
                     unhex(sha2(lower(concat(
                       CASE WHEN n.sibling_first THEN hex(n.sibling) ELSE '' END,
                       hex(c.folded),
                       CASE WHEN n.sibling_first OR n.sibling IS NULL THEN '' ELSE hex(n.sibling) END)), 256)),
                     n.sibling
              FROM climb c JOIN {nodes} n ON n.tree = c.tree AND n.slot = c.slot)
            SELECT leaf_no, struct(tree = -1 AS above, slot) AS place, folded, sibling FROM climb
            """,
            starts=starts,
            nodes=spark.table(manifest.nodes),
        )
        own = manifest.leaves.select("leaf_no", "doc_id", F.unhex("leaf").alias("leaf"), F.col("tree").alias("language"))
        # a slot grows with its level, and the tree above comes last: one row a level, a few dozen for each leaf
        step = F.when(F.col("place").isNotNull(), F.struct("place", "sibling"))
        path = rows.unionByName(own, allowMissingColumns=True).groupBy("leaf_no").agg(
            F.max("doc_id").alias("doc_id"),
            F.max("leaf").alias("leaf"),
            F.max("language").alias("tree"),
            F.max_by("folded", "place").alias("folded"),
            F.sort_array(F.collect_list(step)).alias("path"),
        )
        siblings = F.aggregate(F.filter("path.sibling", lambda s: s.isNotNull()), F.lit(b""), lambda done, s: F.concat(done, s))
        return materialise(path.select("doc_id", "leaf", "tree", "folded", shown(siblings).alias("siblings")))
    finally:
        spark.conf.set(_ROW_LIMIT, limit)


def proofs(manifest: Manifest, shown: Callable[[Column], Column] = _hex_digests) -> DataFrame:
    """Per leaf: doc_id, leaf, subroot, root, siblings from the leaf up (or what ``shown`` makes of them), folded_root, verified."""
    rows = climbed(manifest, shown).join(manifest.subroots, "tree").withColumn("folded_root", F.lower(F.hex("folded")))
    return rows.select(
        "doc_id",
        F.lower(F.hex("leaf")).alias("leaf"),
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        "siblings",
        "folded_root",
        (F.col("folded_root") == F.lit(manifest.root)).alias("verified"),
    )
