"""N-gram Jaccard join by PartEnum signatures.

The hashed domain of shingles is cut into groups of partitions. Sets of similar size go into one size band, whose
largest sets bound the symmetric difference k of any pair similar enough. With more than k / (k2 + 1) groups of
n2 partitions, one group holds at most k2 differing partitions, so one of its subsets of n2 - k2 partitions is
the same in both sets: every such subset of every group is a signature. Signatures are complete: no pair is
lost. Candidates are verified on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanecast.functions.sizing import fits_broadcast
from lanecast.llm.components import connected_components
from lanecast.llm.words import as_signed, free_name, lists, looked_up, map_batches, mix, pieces, row_key, text_bytes, window_hashes, word_hashes
from lanecast.session import materialise

#: Further partitionings for sets that leave partitions empty; the last one also signs empty subsets.
SEEDS = 4
#: Bits of a set's parity sketch: bit i tells whether an odd number of its shingles falls into cell i. Two sets differ in at least as many
#: shingles as their sketches do in bits, so too many differing bits rule a pair out before any set is read.
SKETCH_BITS = 512
#: The members of a larger bucket sign anew before any pairs are formed, so many times at most.
WIDE_BUCKET, LEVELS = 12, 1
#: Sets that are looked at for shingles common among the members of wide buckets, and the most such shingles.
COMMON_SAMPLE, COMMON_SHINGLES = 4000, 200_000
#: Rows of two or three longs up to which a side of a join is broadcast: some tens of megabytes.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class JaccardSettings:
    """``percent``: similarity that links, in hundredths. ``ratio``: growth of the size bands."""

    words: int = 5
    percent: int = 80
    ratio: float = 1.5
    parts: int = 2
    spare: int = 1
    #: Groups beyond those that the bound asks for, so that sets with some empty partitions keep a margin.
    slack: float = 1.15


@lru_cache(maxsize=None)
def _bands(settings: JaccardSettings) -> list[int]:
    """First sizes of the bands, as far as 64-bit row counts reach; a band spans more than one similarity step."""
    bounds, wide = [1], max(settings.ratio, 101 / settings.percent)
    while bounds[-1] < 2**40:
        bounds.append(max(bounds[-1] + 1, math.ceil(bounds[-1] * wide)))
    return bounds


def band_of(size: int, settings: JaccardSettings) -> list[tuple[int, int]]:
    """The (band, k) in which a set of this size signs: its own, and the one below when a partner may lie there."""
    bounds = _bands(settings)
    at = int(np.searchsorted(bounds, size, side="right")) - 1
    smallest = -(-size * settings.percent // 100)
    return [(band, (bounds[band + 1] - 1) * (100 - settings.percent) // settings.percent)
            for band in ((at, at - 1) if at and smallest < bounds[at] else (at,))]


def prefix(shingles: np.ndarray, settings: JaccardSettings, common: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The first shingles of a set in one order for all sets: those not in ``common`` (sorted) first, then by ``often``, their counts there.

    It is one shingle longer than the most that a similar set can lack. So the first shingle in that order that two similar sets share is in
    the prefix of both, whatever the counts; and a passage that many sets share brings together only those with little else.
    """
    rank = np.zeros(len(shingles), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        rank = np.where(common[at] == shingles, often[at], 0)
    return shingles[np.lexsort((shingles, rank))[: len(shingles) * (100 - settings.percent) // 100 + 1]]


def signatures(shingles: np.ndarray, settings: JaccardSettings, common: np.ndarray | None = None, often: np.ndarray | None = None) -> np.ndarray:
    """The PartEnum signatures of a set of sorted 64-bit shingles; with ``common``, the same for all sets, its prefix instead.

    A subset without elements would be shared by unrelated sets, so it is skipped. To change every other subset of a group takes
    differences in k2 + 1 of its partitions or in all that are filled, whichever is less; so skipping is safe while these add up to more
    than k over all groups. A set without that margin signs again under the next seed, and under the last one with its empty subsets.
    """
    if common is not None:
        return mix(prefix(shingles, settings, common, np.ones(len(common), np.int64) if often is None else often) ^ np.uint64(SEEDS))
    out = []
    for band, k in band_of(len(shingles), settings):
        for seed in range(SEEDS):
            found, safe = _signed(shingles, band, k, seed, settings, seed == SEEDS - 1)
            out.append(found)
            if safe:
                break
    return np.unique(np.concatenate(out))


@lru_cache(maxsize=None)
def _names(band: int, seed: int, groups: int, number: int) -> np.ndarray:
    return mix(mix(np.arange(groups, dtype=np.uint64) * np.uint64(256) + np.uint64(number)) ^ np.uint64(band * 64 + seed))


def _signed(shingles, band, k, seed, settings, sign_empty) -> tuple[np.ndarray, bool]:
    if seed:
        shingles = np.sort(mix(shingles ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1))))
    values = mix(shingles)
    if k == 0:
        return mix(values.sum(keepdims=True) ^ _names(band, seed, 1, 255)), True
    parts, spare = settings.parts, settings.spare
    groups = math.ceil((k + 1) / (spare + 1) * settings.slack) + 1
    place = (((shingles >> np.uint64(32)) * np.uint64(groups * parts)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(place[1:] != place[:-1]) + 1
    first = np.concatenate([[0], first])
    at = place[first]
    sums = np.zeros(groups * parts, np.uint64)
    filled = np.zeros(groups * parts, bool)
    sums[at], filled[at] = np.add.reduceat(values, first), True
    sums, filled = sums.reshape(groups, parts), filled.reshape(groups, parts)
    safe = int(np.minimum(filled.sum(axis=1), spare + 1).sum()) > k
    out = []
    for number, subset in enumerate(combinations(range(parts), parts - spare)):
        keep = np.arange(groups) if sign_empty and not safe else np.flatnonzero(filled[:, subset].any(axis=1))
        total = _names(band, seed, groups, number)[keep]
        for part in subset:
            total = mix(total + sums[keep, part])
        out.append(total)
    return np.concatenate(out), safe


def shingle_sets(texts: list[bytes], words: int, cache) -> Iterator[np.ndarray]:
    """Distinct shingles of each text, sorted; a shorter text is one shingle as a whole, one without words has none."""
    split = [text.lower().split() for text in texts]
    hashes = looked_up(cache, [word for text in split for word in text], np.uint64)
    shingles, begin = window_hashes(hashes, words), 0
    for text in split:
        end = begin + len(text)
        found = shingles[begin : end - words + 1] if len(text) >= words else window_hashes(hashes[begin:end], len(text) or 1)
        found = np.sort(found)
        yield found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) > 1 else found
        begin = end


def whole_sketch(shingles: np.ndarray) -> np.ndarray:
    """The parity of the number of shingles in each of a power of two of cells, at least SKETCH_BITS and twice the shingles, as bytes."""
    cells = max(SKETCH_BITS, 1 << (2 * len(shingles) - 1).bit_length() if len(shingles) else 0)
    at = (mix(shingles) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=cells).astype(np.uint8) & 1)


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch of the same set with fewer cells, ``size`` bytes of them."""
    while len(sketch) > size:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """The whole sketch folded to SKETCH_BITS cells, as 64-bit integers."""
    return folded(whole_sketch(shingles), SKETCH_BITS // 8).view(np.int64)


def _near(percent: int, one: str, other: str) -> Column:
    """Whether two sets can be similar enough, by their sizes and sketches; never false for a pair that is.

    With d differing and s shingles in both sets together, the similarity is (s - d) / (s + d).
    """
    bits = " + ".join(f"bit_count({one}_sketch[{i}] ^ {other}_sketch[{i}])" for i in range(SKETCH_BITS // 64))
    sizes = f"least({one}_n, {other}_n) * 100 >= greatest({one}_n, {other}_n) * {percent}"
    return F.expr(f"{sizes} AND ({bits}) * {100 + percent} <= {100 - percent} * ({one}_n + {other}_n)")


def _as(traits: DataFrame, name: str) -> DataFrame:
    """``node``, ``n`` and ``sketch`` under the name of one side of a pair; other columns stay."""
    return traits.withColumnsRenamed({"node": name, "n": f"{name}_n", "sketch": f"{name}_sketch"})


def _sign_documents(settings: JaccardSettings):
    """Batch function: set size, class and signatures of each text.

    Within a piece of a batch, copies sign once, and a signature met several times is passed on by its smallest class
    alone; the others keep a pointer (``held``, ``leader``) to that class. So a hot signature reaches the shuffle once a piece.
    """
    cache = word_hashes()

    def transform(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = text_bytes(batch)
        for begin, end in pieces(texts):
            sizes, nodes, marks, owners, seen, sketches, wide = [], [], [], [], set(), [], []
            for at, shingles in enumerate(shingle_sets(texts[begin:end], settings.words, cache)):
                sizes.append(len(shingles))
                wide.append(whole_sketch(shingles))
                sketches.append(folded(wide[-1], SKETCH_BITS // 8).view(np.int64))
                if not len(shingles):
                    nodes.append(None)
                    continue
                node = int(as_signed(mix(mix(shingles).sum(keepdims=True) + np.uint64(len(shingles))))[0])
                nodes.append(node)
                if node not in seen:
                    seen.add(node)
                    found = signatures(shingles, settings)
                    marks.append(found)
                    owners.append(np.full(len(found), at))
            count = end - begin
            marks = np.concatenate(marks) if marks else np.zeros(0, np.uint64)
            owners = np.concatenate(owners) if owners else np.zeros(0, np.int64)
            by_row = np.array([n or 0 for n in nodes], np.int64)
            order = np.lexsort((by_row[owners], marks))
            marks, owners = marks[order], owners[order]
            new = np.r_[True, marks[1:] != marks[:-1]] if len(marks) else np.zeros(0, bool)
            lead = by_row[owners[np.flatnonzero(new)]][np.cumsum(new) - 1] if len(marks) else by_row[:0]
            back = np.argsort(owners, kind="stable")
            marks, owners, new, lead = as_signed(marks[back]), owners[back], new[back], lead[back]
            yield {
                "row_key": batch.column(batch.schema.get_field_index("row_key"))[begin:end],
                "doc_id": batch.column(batch.schema.get_field_index("doc_id"))[begin:end],
                "n_shingles": sizes,
                "node": nodes,
                "sketch": lists(np.concatenate(sketches), [SKETCH_BITS // 64] * count),
                "wide": [sketch.tobytes() for sketch in wide],
                "marks": lists(marks[new], np.bincount(owners[new], minlength=count)),
                "held": lists(marks[~new], np.bincount(owners[~new], minlength=count)),
                "leader": lists(lead[~new], np.bincount(owners[~new], minlength=count)),
            }

    return transform


def _set_of_text(settings: JaccardSettings):
    cache = word_hashes()

    def transform(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = text_bytes(batch)
        for begin, end in pieces(texts):
            sets = list(shingle_sets(texts[begin:end], settings.words, cache))
            yield {
                "node": batch.column(batch.schema.get_field_index("node"))[begin:end],
                "shingles": lists(as_signed(np.concatenate(sets)), [len(s) for s in sets]),
            }

    return transform


def _can_be_similar(settings: JaccardSettings):
    """Batch function: the pairs whose whole sketches, folded to the same cells, leave room for the similarity; none that has it is lost."""

    def transform(batch: pa.RecordBatch) -> Iterator[dict]:
        column = {name: batch.column(batch.schema.get_field_index(name)) for name in batch.schema.names}
        sizes = (column["a_n"].to_numpy() + column["b_n"].to_numpy()) * (100 - settings.percent)
        keep = []
        for one, other, room in zip(column["a_wide"].to_pylist(), column["b_wide"].to_pylist(), sizes):
            size = min(len(one), len(other))
            one, other = (folded(np.frombuffer(x, np.uint8), size) for x in (one, other))
            keep.append(int(np.bitwise_count(one ^ other).sum()) * (100 + settings.percent) <= room)
        yield {name: column[name].filter(pa.array(keep, pa.bool_())) for name in ("a", "b")}

    return transform


def _similar_texts(settings: JaccardSettings):
    """Batch function: the pairs whose whole sets are similar enough, of rows with both texts."""
    cache = word_hashes()

    def transform(batch: pa.RecordBatch) -> Iterator[dict]:
        left, right = text_bytes(batch, "left"), text_bytes(batch, "right")
        keep, before, one = [], None, None
        for begin, end in pieces([x + y for x, y in zip(left, right)]):
            others = shingle_sets(right[begin:end], settings.words, cache)
            for at, other in zip(range(begin, end), others):
                if left[at] != before:
                    before, one = left[at], next(shingle_sets([left[at]], settings.words, cache))
                common = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(common * 100 >= (len(one) + len(other) - common) * settings.percent)
        yield {name: batch.column(batch.schema.get_field_index(name)).filter(pa.array(keep, pa.bool_())) for name in ("a", "b")}

    return transform


def _marks_of_set(settings: JaccardSettings, common):
    """Prefix signatures of a stored set; ``common``: broadcast arrays of common shingles and their counts."""

    def transform(batch: pa.RecordBatch) -> Iterator[dict]:
        column = batch.column(batch.schema.get_field_index("shingles"))
        flat, ends = np.asarray(column.flatten()).view(np.uint64), np.cumsum(np.asarray(column.value_lengths()))
        found = [signatures(np.sort(part), settings, *common.value) for part in np.split(flat, ends[:-1])]
        yield {
            "node": batch.column(batch.schema.get_field_index("node")),
            "marks": lists(as_signed(np.concatenate(found)), [len(f) for f in found]),
        }

    return transform


def _common_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles most often met in a bounded sample of sets, sorted, and their counts. They only steer the search: any choice keeps it complete."""
    share = -(-sets.count() // COMMON_SAMPLE) or 1
    sample = sets.where(F.pmod(F.xxhash64("node"), F.lit(share)) == 0).select(F.explode("shingles").alias("x"))
    often = sample.groupBy("x").count().where(F.expr(f"count > 2 and count * {share} > {WIDE_BUCKET}")).orderBy(F.desc("count"), "x").limit(COMMON_SHINGLES)
    table = often.toArrow()
    names, counts = (np.asarray(table.column(name)).astype(np.int64) for name in ("x", "count"))
    order = np.argsort(names.view(np.uint64))
    return names.view(np.uint64)[order], counts[order]


def _verified(pairs: DataFrame, texts: DataFrame, settings: JaccardSettings) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough.

    Whole sketches (2 to 4 bits a shingle) rule out most others first. Texts travel rather than sets: written and compressed they take
    less than half of the 8 bytes a shingle.
    """

    def side(name: str, *columns: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    known = pairs.select("a", "b").join(side("a", "n", "wide"), "a").join(side("b", "n", "wide"), "b")
    left = materialise(map_batches(known, _can_be_similar(settings), "a long, b long"))
    both = left.join(side("a", "text"), "a").join(side("b", "text"), "b").select("a", "b", F.col("a_text").alias("left"), F.col("b_text").alias("right"))
    return map_batches(both, _similar_texts(settings), "a long, b long")


def _small(df: DataFrame) -> DataFrame:
    """``df`` (a few longs a row) for the small side of a join: broadcast if counted small, else left to a shuffle."""
    return F.broadcast(df) if fits_broadcast(df, BROADCAST_ROWS) else df


def _apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs whose classes are in different components."""
    for side in ("a", "b"):
        pairs = pairs.join(parts.select(F.col("node").alias(side), F.col("component").alias(f"{side}_part")), side, "left")
    return pairs.where("coalesce(a_part, a) <> coalesce(b_part, b)").drop("a_part", "b_part")


def _open_members(star: DataFrame, pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """(mark, node) of the buckets with classes in different components.

    The rows of a bucket are the edges of a tree over its classes, so it is open exactly if one of them joins two components:
    only the distinct pairs of classes are held against the components, not every row of every bucket.
    """
    apart = materialise(_apart(pairs, parts).select(F.col("a").alias("leader"), F.col("b").alias("node")))
    marks = materialise(star.join(_small(apart), ["leader", "node"], "left_semi").select("mark").distinct())
    rows = star.join(_small(marks), "mark", "left_semi")
    return rows.select("mark", "node").union(rows.select("mark", F.col("leader").alias("node"))).distinct()


def _still_open(members: DataFrame, parts: DataFrame, least: int) -> DataFrame:
    """(mark, node, part, members) and further columns of the buckets of more than ``least`` classes that are in different components."""
    rows = members.join(parts, "node", "left").select(*members.columns, F.coalesce("component", "node").alias("part"))
    size = rows.groupBy("mark").agg(F.count("*").alias("members"), F.min("part").alias("p"), F.max("part").alias("q"))
    return materialise(rows.join(size.where(F.expr(f"p <> q and members > {least}")).select("mark", "members"), "mark"))


def _central_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Every class of an open bucket with the most central one of another component there, where the two can be similar.

    Central is the class whose buckets are the largest: of a family of near copies the text they were made from, to which
    they are more similar than to each other.
    """
    weight = rows.groupBy("node").agg(F.sum("members").alias("weight"))
    central = F.max(F.struct("weight", "node", "part", "n", "sketch")).alias("c")
    chosen = rows.join(weight, "node").groupBy("mark").agg(central).select("mark", "c.node", F.col("c.part").alias("p"), "c.n", "c.sketch")
    pairs = _as(chosen, "a").join(_as(rows, "b"), "mark").where((F.col("part") != F.col("p")) & _near(percent, "a", "b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _pairs_of_bucket(rows: DataFrame, percent: int) -> DataFrame:
    """The pairs of one bucket, in different components, that can be similar: the test is part of the join, so no other pair becomes a row.

    Marks of prefixes come with ``at``, their place in the order of the set's shingles. The first one that two sets share leaves them no
    more common shingles than follow it in either; a pair that this rules out at a later mark still meets at its first.
    """
    test = (F.col("a") < F.col("b")) & (F.col("p") != F.col("q"))
    if "at" in rows.columns:
        test &= F.expr(f"least(a_n - a_at, b_n - b_at) * {100 + percent} >= (a_n + b_n) * {percent}")
    rows = rows.drop("members")
    left, right = (_as(rows.withColumnsRenamed({"part": part, "at": f"{name}_at"}), name) for part, name in (("p", "a"), ("q", "b")))
    return left.join(right, "mark").where(test & _near(percent, "a", "b")).select("a", "b").distinct()


def _open_pairs(rows: DataFrame, parts: DataFrame, texts: DataFrame, traits: DataFrame, settings: JaccardSettings) -> DataFrame:
    """The other pairs of one bucket that are still in different components.

    A wide bucket mostly comes of a passage that many texts share. Its members sign anew by their rarest shingles: those
    signatures are complete as well, so the wide bucket itself can go.
    """
    found = None
    for level in range(LEVELS + 1):
        narrow = rows if level == LEVELS else rows.where(F.col("members") <= WIDE_BUCKET)
        pairs = _pairs_of_bucket(narrow, settings.percent)
        found = pairs if found is None else found.union(pairs)
        wide = rows.where(F.col("members") > WIDE_BUCKET)
        if level == LEVELS or wide.isEmpty():
            break
        members = texts.join(wide.select("node").distinct(), "node", "left_semi")
        again = materialise(map_batches(members.select("node", "text"), _set_of_text(settings), "node long, shingles array<long>"))
        common = again.sparkSession.sparkContext.broadcast(_common_shingles(again))
        marks = map_batches(again, _marks_of_set(settings, common), "node long, marks array<long>")
        rows = _still_open(marks.select("node", F.posexplode("marks").alias("at", "mark")), parts, 1).join(traits, "node")
    return found.distinct()


def similarity_classes(documents: DataFrame, settings: JaccardSettings) -> DataFrame:
    """(row_key, doc_id, n_shingles, node, component): one row per document row.

    ``node`` is the class of equal sets, ``component`` the class reachable by links; both null for a text without
    words. Null ids and texts, repeated rows and empty tables pass through; other columns are not read.

    Round one compares every class with the one it shares most signatures with, among the smallest classes of its buckets; then with
    the others of these that are still in another component, so a family of n near copies costs about n comparisons. The next rounds
    compare classes of buckets that are still in different components with the most central one there. The last forms the pairs that
    remain; buckets of unrelated sets are first split by further signatures.
    """
    keyed = documents.select(row_key(documents).alias("row_key"), "doc_id", "text")
    # signatures are the largest table here and are of use only until the buckets are known, so they go before the search begins
    signed = map_batches(
        keyed,
        _sign_documents(settings),
        "row_key long, doc_id long, n_shingles long, node long, sketch array<long>, wide binary, marks array<long>, held array<long>, leader array<long>",
    ).persist(StorageLevel.DISK_ONLY)
    spread = signed.select("node", F.explode("marks").alias("mark"))
    top = F.min("node").over(Window.partitionBy("mark"))
    shared = spread.withColumn("leader", top).where("leader <> node").select("mark", "leader", "node")
    local = signed.select("node", F.explode(F.arrays_zip("held", "leader")).alias("x"))
    local = local.select(F.col("x.held").alias("mark"), F.col("x.leader").alias("leader"), "node").where("leader <> node")
    star = materialise(shared.union(local))
    pairs = materialise(star.groupBy(F.col("leader").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("shared")))

    alike = [F.any_value(c).alias(name) for c, name in (("n_shingles", "n"), ("sketch", "sketch"), ("wide", "wide"))]
    classes = signed.where("node is not null").groupBy("node").agg(F.min("row_key").alias("row_key"), *alike)
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    classes = materialise(classes.join(wanted, "node", "left_semi"))
    rows_of_node = materialise(signed.select("row_key", "doc_id", "n_shingles", "node"))
    signed.unpersist()
    traits = classes.select("node", "n", "sketch")
    near = pairs.join(_as(traits, "a"), "a").join(_as(traits, "b"), "b").where(_near(settings.percent, "a", "b")).select("a", "b", "shared")
    near = materialise(near)
    texts = keyed.select("row_key", "text").join(classes.select("node", "row_key", "n", "wide"), "row_key").select("node", "n", "wide", "text")
    texts = materialise(texts.dropDuplicates(["node"]))

    best = near.groupBy("b").agg(F.max(F.struct("shared", "a")).alias("most")).select("most.a", "b")
    links = materialise(_verified(best, texts, settings))
    parts = connected_components(links)
    more = materialise(_verified(_apart(near.join(best, ["a", "b"], "left_anti"), parts), texts, settings))
    if not more.isEmpty():
        links = links.union(more)
        parts = connected_components(links)
    rows = _still_open(_open_members(star, pairs, parts), parts, 2)  # two members were compared with each other in the first round
    for central in (True, False):
        if rows.isEmpty():
            break
        known = rows.join(traits, "node")
        found = _central_pairs(known, settings.percent) if central else _open_pairs(known, parts, texts, traits, settings)
        more = materialise(_verified(found, texts, settings))
        if not more.isEmpty():
            links = links.union(more)
            parts = connected_components(links)
            rows = _still_open(rows.select("mark", "node"), parts, 2) if central else rows
    parts = parts.withColumnRenamed("node", "n2")
    return rows_of_node.join(parts, F.col("node") == F.col("n2"), "left").select(
        "row_key", "doc_id", "n_shingles", "node", F.coalesce("component", "node").alias("component")
    )


def linked_documents(documents: DataFrame, settings: JaccardSettings) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable by links, its own for a text without words."""
    rows = materialise(similarity_classes(documents, settings))
    first = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(first, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(documents: DataFrame, settings: JaccardSettings) -> DataFrame:
    """``documents`` with one row of each group of linked texts: that of the smallest doc_id (null last).

    Rows without words are linked with nothing and all stay. All columns are kept as they are.
    """
    rows = materialise(similarity_classes(documents, settings))
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    first = rows.where("component is not null").groupBy("component").agg(F.min(rank).alias("first"))
    key, one = free_name(documents, "__row_key"), free_name(documents, "__one")
    kept = first.select(F.col("first.row_key").alias(key), F.lit(True).alias(one))
    free = rows.where("component is null").select(F.col("row_key").alias(key), F.lit(False).alias(one)).distinct()
    joined = documents.withColumn(key, row_key(documents)).join(kept.union(free), key)
    single = joined.where(F.col(one)).dropDuplicates([key])
    return single.union(joined.where(~F.col(one))).select(*[F.col(f"`{c}`") for c in documents.columns])
