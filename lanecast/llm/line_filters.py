"""Incremental line dedup: sharded cuckoo filters over an exact table of how many documents hold each line.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case; the empty key never counts.
The reference-count table holds every key of the indexed documents by two 64-bit hashes, with the number of documents
that have it. Keys held by ``min_docs`` documents or more are common; each shard has a cuckoo filter of its common keys.
Inserting documents adds to the counts and deleting them subtracts; keys that cross the threshold enter or leave the filter of
their shard, so a deletion undoes an insertion. A shard that has become too full is rebuilt, with all others, from the exact
table. To clean documents, their lines are looked up in the filters first, and what these let pass in the exact table.

A null text is one empty line; every row is a document, equal rows too. A document that loses all its lines has an empty text.
Deleting a document that was never inserted is an error. Columns other than ``doc_id`` and ``text`` play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecast.llm.words import map_batches, mix, row_key
from lanecast.session import materialise, ship_package

SLOTS = 4
KICKS = 500
#: Common keys that a shard is made for, and the share of its slots beyond which shards are split.
SHARD_KEYS = 32_768
FULLEST = 0.9
#: Filters of up to so many bytes go to all tasks; beyond it every line goes straight to the exact table.
FILTER_BYTES = 64_000_000
#: A common line's occurrences are spread over so many tasks when they meet the exact table.
SALT = 16

_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FILTER_SCHEMA = "shard int, buckets int, items long, slots binary"


# --- one cuckoo filter ----------------------------------------------------------------------------


def _marks(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint (never 0), place before masking, and what to flip for the other place."""
    print_ = np.maximum(mix(h2.view(np.uint64)) >> np.uint64(48), np.uint64(1))
    return print_.astype(np.uint16), mix(h1.view(np.uint64)) >> np.uint64(20), mix(print_) >> np.uint64(20)


def enter(slots: np.ndarray, prints, firsts, flips) -> bool:
    """Put fingerprints into ``slots`` (buckets x SLOTS, 0 is free); False when one finds no place, and then slots are spoilt."""
    mask = len(slots) - 1
    cells = slots.tolist()
    turn = 0
    for mark, first, flip in zip(prints.tolist(), (firsts & np.uint64(mask)).tolist(), (flips & np.uint64(mask)).tolist()):
        for place in (first, first ^ flip):
            if 0 in cells[place]:
                cells[place][cells[place].index(0)] = mark
                break
        else:
            place = first
            for _ in range(KICKS):
                # take the place of one of the four, in turns, and send it to its other place
                turn = (turn + 1) % SLOTS
                mark, cells[place][turn] = cells[place][turn], mark
                place ^= int(mix(np.array([mark], np.uint64))[0] >> np.uint64(20)) & mask
                if 0 in cells[place]:
                    cells[place][cells[place].index(0)] = mark
                    break
            else:
                return False
    slots[:] = cells
    return True


def leave(slots: np.ndarray, prints, firsts, flips) -> None:
    """Take one fingerprint of each out of ``slots``."""
    mask = np.uint64(len(slots) - 1)
    for mark, first, other in zip(prints, firsts & mask, (firsts ^ flips) & mask):
        for place in (int(first), int(other)):
            found = np.flatnonzero(slots[place] == mark)
            if len(found):
                slots[place, found[0]] = 0
                break


def new_filter(h1: np.ndarray, h2: np.ndarray, buckets: int) -> np.ndarray:
    """A filter of these keys, with as many buckets as it takes."""
    while True:
        slots = np.zeros((buckets, SLOTS), np.uint16)
        if enter(slots, *_marks(h1, h2)):
            return slots
        buckets *= 2


def _amended(key, old: pd.DataFrame, crossing: pd.DataFrame) -> pd.DataFrame:
    """One shard's filter after keys have come (side 1) and gone (side -1)."""
    shard = int(key[0])
    come, gone = (crossing[crossing["side"] == side] for side in (1, -1))
    pairs = [(part["h1"].to_numpy(np.int64), part["h2"].to_numpy(np.int64)) for part in (come, gone)]
    items = (int(old["items"].iloc[0]) if len(old) else 0) + len(come) - len(gone)
    if len(old):
        slots = np.frombuffer(old["slots"].iloc[0], np.uint16).reshape(-1, SLOTS).copy()
        leave(slots, *_marks(*pairs[1]))
        if not enter(slots, *_marks(*pairs[0])):
            # full: kept empty, so that the index is rebuilt from the exact table
            slots, items = np.zeros((0, SLOTS), np.uint16), -1
    else:
        slots = new_filter(*pairs[0], 1 << max(1, int(np.ceil(np.log2(max(1, len(come)) / (SLOTS * 0.8))))))
    return pd.DataFrame({"shard": [shard], "buckets": [len(slots)], "items": [items], "slots": [slots.tobytes()]})


# --- the index ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LineIndex:
    """``counts``: h1, h2, n (documents that have the line); ``filters``: shard, buckets, items, slots. Both are stored tables."""

    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int


def line_keys(text: Column) -> Column:
    """The key of every line of a text."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.transform(lines, lambda line: F.translate(F.btrim(line, F.lit(_WHITE)), _UPPER, _LOWER))


def _hashed(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(1), key)


def line_counts(documents: DataFrame) -> DataFrame:
    """(h1, h2, n): the number of documents that have each line; a line repeated in a document counts once."""
    keys = F.array_distinct(F.filter(line_keys(F.col("text")), lambda key: key != ""))
    exploded = documents.select(F.explode(keys).alias("key"))
    h1, h2 = _hashed(F.col("key"))
    return exploded.select(h1.alias("h1"), h2.alias("h2")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))


def _in_shards(rows: DataFrame, shards: int) -> DataFrame:
    return rows.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)).cast("int"))


def _rebuilt(counts: DataFrame, min_docs: int) -> LineIndex:
    """Filters made anew from the exact table, in shards of about SHARD_KEYS common keys."""
    common = counts.where(F.col("n") >= min_docs)
    count, shards = common.count(), 1
    while count > shards * SHARD_KEYS:
        shards *= 2
    coming = _in_shards(common.select("h1", "h2", F.lit(1).alias("side")), shards)
    ship_package(counts.sparkSession)
    # a shard is bounded: hashes are even, and so is the number of keys a shard is made for
    filters = coming.groupBy("shard").applyInPandas(lambda key, rows: _amended(key, rows.iloc[:0].assign(items=[], slots=[]), rows), _FILTER_SCHEMA)
    return LineIndex(counts, materialise(filters), shards, min_docs)


def build(documents: DataFrame, min_docs: int = 10) -> LineIndex:
    """The index of ``documents``."""
    return _rebuilt(materialise(line_counts(documents)), min_docs)


def _changed(index: LineIndex, documents: DataFrame, sign: int) -> LineIndex:
    delta = line_counts(documents).select("h1", "h2", F.lit(0).cast("long").alias("old"), (F.col("n") * sign).alias("n"))
    both = index.counts.select("h1", "h2", F.col("n").alias("old"), "n").union(delta)
    after = materialise(both.groupBy("h1", "h2").agg(F.sum("old").alias("old"), F.sum("n").alias("n")))
    if not after.where("n < 0").isEmpty():
        raise ValueError("a document to delete has never been inserted")
    counts = after.where("n > 0").select("h1", "h2", "n")
    was, now = F.col("old") >= index.min_docs, F.col("n") >= index.min_docs
    crossing = after.where(was != now).select("h1", "h2", F.when(now, 1).otherwise(-1).alias("side"))
    ship_package(documents.sparkSession)
    touched = _in_shards(crossing, index.shards).groupBy("shard")
    filters = materialise(index.filters.groupBy("shard").cogroup(touched).applyInPandas(_amended, _FILTER_SCHEMA))
    if filters.where(f"items < 0 or items > {FULLEST} * {SLOTS} * buckets or items > 2 * {SHARD_KEYS}").isEmpty():
        return replace(index, counts=counts, filters=filters)
    return _rebuilt(counts, index.min_docs)


def insert(index: LineIndex, documents: DataFrame) -> LineIndex:
    """The index with ``documents`` added."""
    return _changed(index, documents, 1)


def delete(index: LineIndex, documents: DataFrame) -> LineIndex:
    """The index without ``documents``, as if they had never been inserted."""
    return _changed(index, documents, -1)


# --- lookup ---------------------------------------------------------------------------------------


def _all_filters(index: LineIndex) -> tuple | None:
    """Slots of all shards in one array, with the begin and mask of each; None when they exceed FILTER_BYTES."""
    size = index.filters.agg(F.sum(F.octet_length("slots"))).first()[0] or 0
    if size > FILTER_BYTES:
        return None
    rows = index.filters.collect()
    begin, mask = np.zeros(index.shards, np.int64), np.full(index.shards, -1, np.int64)
    slots, at = [np.zeros((0, SLOTS), np.uint16)], 0
    for row in rows:
        part = np.frombuffer(row["slots"], np.uint16).reshape(-1, SLOTS)
        begin[row["shard"]], mask[row["shard"]] = at, len(part) - 1
        slots.append(part)
        at += len(part)
    return np.concatenate(slots), begin, mask


def may_hold(filters: tuple, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key may be common: never False for one that is."""
    slots, begin, mask = filters
    shard = np.mod(h1, len(begin))
    live = np.flatnonzero(mask[shard] >= 0)
    shard = shard[live]
    marks, firsts, flips = _marks(h1[live], h2[live])
    found = np.zeros(len(h1), bool)
    for places in (firsts, firsts ^ flips):
        rows = begin[shard] + (places.astype(np.int64) & mask[shard])
        found[live] |= (slots[rows] == marks[:, None]).any(axis=1)
    return found


def _possible(filters):
    """(row_key, h1, h2) of each document's lines that pass the filters."""

    def transform(batch: pa.RecordBatch, filters=filters) -> Iterator[dict]:
        lines = batch.column(1)
        counts = np.diff(np.asarray(lines.offsets))
        h1, h2 = (np.asarray(part) for part in lines.flatten().flatten())
        keys = np.repeat(np.asarray(batch.column(0)), counts)
        passed = may_hold(filters.value, h1, h2)
        yield {"row_key": keys[passed], "h1": h1[passed], "h2": h2[passed]}

    return transform


def _line_hashes(text: Column) -> Column:
    h = lambda key: F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))
    return F.transform(F.filter(line_keys(text), lambda key: key != ""), h)


def common_lines(documents: DataFrame, index: LineIndex) -> DataFrame:
    """(row_key, common): for each row with common lines, their hashes."""
    keyed = documents.select(row_key(documents).alias("row_key"), _line_hashes(F.col("text")).alias("lines"))
    filters = _all_filters(index)
    if filters is None:
        candidates = keyed.select("row_key", F.explode("lines").alias("l")).select("row_key", "l.*")
    else:
        shared = documents.sparkSession.sparkContext.broadcast(filters)
        candidates = map_batches(keyed, _possible(shared), "row_key long, h1 long, h2 long")
    salted = candidates.distinct().withColumn("salt", F.pmod(F.xxhash64("row_key"), F.lit(SALT)).cast("int"))
    exact = index.counts.where(F.col("n") >= index.min_docs).select(
        "h1", "h2", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    )
    held = salted.join(exact, ["h1", "h2", "salt"], "left_semi")
    return held.groupBy("row_key").agg(F.collect_list(F.struct("h1", "h2")).alias("common"))


def _pruned(batch: pa.RecordBatch) -> Iterator[dict]:
    names = batch.schema.names
    texts, hashes, drops = (batch.column(names.index(n)) for n in ("text", "lines", "common"))
    kept, total, gone = [], [], []
    for text, lines, common in zip(texts, hashes, drops):
        parts = (text.as_py() or "").split("\n")
        total.append(len(parts))
        if common.is_valid:
            h1, h2 = (np.asarray(part).tolist() for part in lines.values.flatten())
            bad = set(zip(*(np.asarray(part).tolist() for part in common.values.flatten())))
            parts = [part for part, key in zip(parts, zip(h1, h2)) if key not in bad]
        kept.append("\n".join(parts))
        gone.append(total[-1] - len(parts))
    yield {"doc_id": batch.column(names.index("doc_id")), "n_lines": total, "n_dropped": gone, "kept": kept}


def without_common_lines(documents: DataFrame, index: LineIndex) -> DataFrame:
    """doc_id, n_lines, n_dropped (long) and kept, the text without its common lines, of every row."""
    found = common_lines(documents, index)
    keyed = documents.select("doc_id", "text", row_key(documents).alias("row_key"))
    # the empty key hashes like any other and is never among the common ones
    lines = F.transform(line_keys(F.col("text")), lambda key: F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")))
    joined = keyed.join(found, "row_key", "left").select("doc_id", "text", F.when(F.col("common").isNotNull(), lines).alias("lines"), "common")
    return map_batches(joined, _pruned, "doc_id long, n_lines long, n_dropped long, kept string")


def empty_index(spark: SparkSession, min_docs: int = 10) -> LineIndex:
    """An index of no documents."""
    return LineIndex(
        spark.createDataFrame([], "h1 long, h2 long, n long"), spark.createDataFrame([], _FILTER_SCHEMA), 1, min_docs
    )
