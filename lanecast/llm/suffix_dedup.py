"""Suffix-array dedup: remove every byte covered by a long string that also starts anywhere else.

1. Anchors. Of all 32-byte grams of a string of ``length`` bytes the one with the smallest hash is its anchor; equal strings have equal
   anchors at equal places. Starts with one anchor form a region of a text.
2. Regions that are equal as a whole repeat as a whole. Regions that share only the anchor with others may share
   some strings: these, one of each class, meet by anchor.
3. There the contexts on both sides of the anchor are suffix-sorted (``suffix_sort``). Of neighbours in that order the common lengths are
   known, so for every start the strings that agree to the right and to the left are counted.
4. The removed ranges of each document are merged and cut out.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.llm.suffix_sort import suffix_order
from lanecast.llm.words import as_signed, free_name, map_batches, mix, pieces, row_key, text_bytes
from lanecast.session import materialise

GRAM = 32
#: Starts of one text that are handled at a time; a longer text goes in slices that overlap by a string.
SLICE = 8_000_000
_PLACE_BITS = np.uint64(0xFFFFFF)
#: Bytes that are one sign in the suffix sort.
BLOCK = 40
#: Regions that a task sorts at a time; whole buckets, none larger than WIDE.
SORTED_REGIONS = 4000
#: A bucket of more classes is counted start by start instead, which splits it and adds up before the shuffle.
WIDE = 8192


@dataclass(frozen=True)
class RepeatSettings:
    """``length``: bytes of a string whose repetition counts; at least 2 * GRAM."""

    length: int = 400


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every 32 neighbouring bytes, by doubling."""
    hashes, step = mix(text), 1
    with np.errstate(over="ignore"):
        while step < GRAM:
            hashes = hashes[:-step] * np.uint64(0x9E3779B97F4A7C15 + 2 * step) + hashes[step:]
            hashes ^= hashes >> np.uint64(29)
            hashes *= np.uint64(0xBF58476D1CE4E5B9)
            hashes ^= hashes >> np.uint64(32)
            step *= 2
    return hashes


def window_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of every ``size`` neighbours: of a block's end and the next block's beginning."""
    count = len(values)
    blocks = -(-count // size)
    grid = np.full(blocks * size, np.iinfo(np.uint64).max, np.uint64)
    grid[:count] = values
    grid = grid.reshape(blocks, size)
    heads = np.minimum.accumulate(grid, axis=1).ravel()
    tails = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tails[: count - size + 1], heads[size - 1 : count])


def regions(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text number, first start, last start, anchor place, anchor hash, class) of the regions of some texts.

    The class is a hash of the bytes of the region's strings and of where the anchor lies in them.
    """
    buffer = b"".join(texts)
    if len(buffer) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    hashes = gram_hashes(np.frombuffer(buffer, np.uint8))
    packed = (hashes & ~_PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (window_minimum(packed, length - GRAM + 1) & _PLACE_BITS).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    start = np.flatnonzero(np.arange(len(anchor)) + length <= ends[owner])
    if not len(start):
        return regions([], length)
    new = np.flatnonzero(np.r_[True, (anchor[start[1:]] != anchor[start[:-1]]) | (start[1:] != start[:-1] + 1)])
    first, final = start[new], start[np.r_[new[1:] - 1, len(start) - 1]]
    place, view = anchor[first], memoryview(buffer)
    name = (xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (final + length).tolist()))
    classes = mix(np.fromiter(name, np.uint64, len(first)) ^ (place - first).astype(np.uint64))
    base = (ends - sizes)[owner[first]]
    return owner[first], first - base, final - base, place - base, hashes[place], classes


def _find_regions(length: int):
    def transform(batch: pa.RecordBatch) -> Iterator[dict]:
        keys = np.asarray(batch.column(batch.schema.get_field_index("row_key")))
        texts = text_bytes(batch)
        parts, numbers, offsets = [], [], []
        for number, text in enumerate(texts):
            for at in range(0, max(1, len(text) - length + 1), SLICE):
                parts.append(text[at : at + SLICE + length - 1] if len(text) > SLICE else text)
                numbers.append(number)
                offsets.append(at)
        numbers, offsets = np.array(numbers), np.array(offsets)
        for begin, end in pieces(parts, SLICE // 2):
            owner, first, final, place, anchor, classes = regions(parts[begin:end], length)
            yield {
                "row_key": keys[numbers[begin:end][owner]],
                "start": first + offsets[begin:end][owner],
                "after": (place - final).astype(np.int32),
                "before": (place - first).astype(np.int32),
                "anchor": as_signed(anchor),
                "class": as_signed(classes),
            }

    return transform


def _order(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each string, common length of each string in that order with the one before) for strings of up to ``width`` bytes.

    Strings are cut into blocks, blocks are numbered in lexicographic order, and the suffixes of all strings,
    one after the other, are sorted by linear grouping; the suffixes that are whole strings give the order.
    """
    count, blocks = len(strings), -(-width // BLOCK)
    size = np.array([len(s) for s in strings])
    grid = np.zeros((count, blocks * BLOCK), np.uint8)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    grid[np.repeat(np.arange(count), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    # padding counts as the shortest continuation: the length of a block decides between equal ones
    fill = np.clip(size[:, None] - np.arange(blocks) * BLOCK, 0, BLOCK).astype(np.uint8)
    keys = np.concatenate([grid.reshape(count, blocks, BLOCK), fill[:, :, None]], axis=2).reshape(count * blocks, BLOCK + 1)
    _, sign = np.unique(np.ascontiguousarray(keys).view(np.dtype((np.void, BLOCK + 1))).ravel(), return_inverse=True)
    signs = np.zeros((count, blocks + 1), np.int64)
    signs[:, :blocks] = np.where(fill > 0, sign.reshape(count, blocks) + 1, 0)
    used = np.concatenate([np.ones((count, 1), bool), fill[:, 1:] > 0, np.zeros((count, 1), bool)], axis=1)
    # a string takes its blocks and one lowest sign
    length = used.sum(axis=1)
    used[np.arange(count), length] = True
    text = signs[used].tolist()
    begins = np.cumsum(length + 1) - (length + 1)
    order = np.array(suffix_order(text), np.int64)
    whole = np.full(len(text), -1, np.int64)
    whole[begins] = np.arange(count)
    order = whole[order]
    order = order[order >= 0]
    rank = np.empty(count, np.int64)
    rank[order] = np.arange(count)
    same = grid[order[1:]] == grid[order[:-1]]
    common = np.where(same.all(axis=1), width, same.argmin(axis=1))
    common = np.minimum(common, np.minimum(size[order[1:]], size[order[:-1]]))
    return rank, np.r_[0, common]


def repeated_starts(strings: list[bytes], before: np.ndarray, after: np.ndarray, length: int) -> np.ndarray:
    """For regions that share anchors: which strings start in more than one of them.

    A region is given by its bytes, with ``before`` bytes to the left of the anchor; its strings start ``after`` to ``before`` bytes left of it.
    The result has a row for each region and a column for each number of bytes between start and anchor.
    """
    reach = length - GRAM + 1
    marked = np.zeros((len(strings), reach), bool)
    # a string holds this much to the right of its anchor, or that much to the left: without a partner there, none repeats
    left_core, right_core = reach // 2, length - reach // 2
    right = [s[b:] for s, b in zip(strings, before.tolist())]
    left = [s[:b][::-1] for s, b in zip(strings, before.tolist())]
    heads = Counter(r[:right_core] for r in right)
    tails = Counter((r[:GRAM], x[:left_core]) for r, x in zip(right, left))
    keep = np.array(
        [
            (len(r) >= right_core and heads[r[:right_core]] > 1) or (len(x) >= left_core and tails[r[:GRAM], x[:left_core]] > 1)
            for r, x in zip(right, left)
        ],
        bool,
    )
    who = np.flatnonzero(keep)
    if len(who) < 2:
        return marked
    right_rank, right_common = _order([right[i] for i in who], length)
    left_rank, left_common = _order([left[i] for i in who], reach)
    low, high = after[who], before[who]
    for back in range(reach):
        some = np.flatnonzero((low <= back) & (back <= high))
        if len(some) > 1:
            group = np.cumsum(right_common < length - back)[right_rank[some]] * (len(who) + 1)
            group += np.cumsum(left_common < back)[left_rank[some]] if back else 0
            order = np.argsort(group)
            equal = np.flatnonzero(np.diff(group[order]) == 0)
            marked[who[some[order[equal]]], back] = True
            marked[who[some[order[equal + 1]]], back] = True
    return marked


def _ranges(marked: np.ndarray, length: int, keys, starts, before) -> dict:
    """The byte ranges covered by the marked starts, a row for each unbroken run."""
    edge = np.diff(np.pad(marked.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, low = np.nonzero(edge == 1)
    high = np.nonzero(edge == -1)[1] - 1
    anchor = starts[row] + before[row]
    return {"row_key": keys[row], "begin": anchor - high, "end": anchor - low + length}


def _sort_buckets(length: int):
    """Partition function over regions ordered by anchor: some whole buckets at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def flush(table: pa.Table) -> pa.RecordBatch:
            column = {n: np.asarray(table.column(n)) for n in ("row_key", "start", "before", "after", "copies")}
            marked = repeated_starts(table.column("bytes").to_pylist(), column["before"], column["after"], length)
            marked[column["copies"] > 1] = False  # these are known to repeat as a whole
            found = _ranges(marked, length, column["row_key"], column["start"], column["before"])
            return pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in found.items()})

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            waiting += batch.num_rows
            if waiting >= SORTED_REGIONS:
                table = pa.concat_tables(held).combine_chunks()
                anchors = np.asarray(table.column("anchor"))
                cut = int(np.flatnonzero(anchors != anchors[-1])[-1]) + 1 if anchors[0] != anchors[-1] else 0
                # the last bucket may go on
                for begin in _cuts(anchors[:cut]):
                    yield flush(table.slice(*begin))
                held, waiting = [table.slice(cut)], len(anchors) - cut
        if waiting:
            table = pa.concat_tables(held).combine_chunks()
            for begin in _cuts(np.asarray(table.column("anchor"))):
                yield flush(table.slice(*begin))

    return run


def _cuts(anchors: np.ndarray) -> Iterator[tuple[int, int]]:
    """(offset, rows) of runs of whole buckets with about SORTED_REGIONS rows."""
    edges = np.r_[np.flatnonzero(np.diff(anchors)) + 1, len(anchors)] if len(anchors) else []
    begin = 0
    for edge in map(int, edges):
        if edge - begin >= SORTED_REGIONS or edge == len(anchors):
            yield begin, edge - begin
            begin = edge


def _single_starts(length: int):
    """Every string of a region by its hash, for buckets too wide to sort in one task."""

    def transform(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = batch.to_pydict()
        for at, data in enumerate(rows["bytes"]):
            low, high = rows["after"][at], rows["before"][at]
            hashes = [xxhash.xxh3_64_intdigest(data[high - back : high - back + length]) for back in range(low, high + 1)]
            count = len(hashes)
            yield {
                "string": as_signed(mix(np.array(hashes, np.uint64) ^ np.uint64(rows["anchor"][at] & (2**64 - 1)))),
                "row_key": [rows["row_key"][at]] * count,
                "begin": [rows["start"][at] + high - back for back in range(low, high + 1)],
                "copies": [rows["copies"][at]] * count,
            }

    return transform


def repeated_ranges(documents: DataFrame, settings: RepeatSettings) -> DataFrame:
    """(row_key, ranges): for every row with repeated strings, the byte ranges they cover, as an unsorted array of (begin, end).

    Ranges may overlap. Rows equal in id and text have one key and repeat each other.
    """
    length = settings.length
    keyed = documents.select(row_key(documents).alias("row_key"), "text")
    found = materialise(
        map_batches(
            keyed.where(F.octet_length("text") >= length),
            _find_regions(length),
            "row_key long, start long, after int, before int, anchor long, class long",
        )
    )
    one = F.min(F.struct("row_key", "start", "after", "before")).alias("one")
    classes = materialise(found.groupBy("anchor", "class").agg(F.count("*").alias("copies"), one))
    whole = found.join(classes.where("copies > 1").select("anchor", "class"), ["anchor", "class"], "left_semi").select(
        "row_key", F.col("start").alias("begin"), (F.col("start") + F.col("before") - F.col("after") + length).alias("end")
    ).distinct()  # repeated rows have one key, and each brings the same ranges
    buckets = classes.groupBy("anchor").agg(F.count("*").alias("classes"), F.min("copies").alias("least"))
    # a bucket of one class is done, and so is one in which every class has copies
    mixed = classes.join(buckets.where("classes > 1 and least = 1"), "anchor").select("anchor", "copies", "classes", "one.*")
    # the bytes of the regions, one row a document: its regions travel together
    wanted = mixed.groupBy("row_key").agg(F.collect_list(F.struct("anchor", "copies", "classes", "start", "after", "before")).alias("r"))
    texts = keyed.join(wanted, "row_key").dropDuplicates(["row_key"]).select("row_key", F.encode("text", "UTF-8").alias("b"), F.explode("r").alias("r"))
    size = F.col("r.before") - F.col("r.after") + length
    cut = texts.select("row_key", "r.*", F.substring("b", F.col("r.start").cast("int") + 1, size).alias("bytes"))
    cut = materialise(cut)

    from lanecast.session import ship_package

    ship_package(documents.sparkSession)
    narrow = cut.where(F.col("classes") <= WIDE).repartition("anchor").sortWithinPartitions("anchor")
    narrow = narrow.select("anchor", "row_key", "start", "before", "after", "copies", "bytes")
    partial = narrow.mapInArrow(_sort_buckets(length), "row_key long, begin long, end long")
    wide = map_batches(cut.where(F.col("classes") > WIDE), _single_starts(length), "string long, row_key long, begin long, copies long")
    again = wide.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
    partial = partial.union(
        wide.where("copies = 1").join(again, "string", "left_semi").select("row_key", "begin", (F.col("begin") + length).alias("end"))
    )
    return whole.union(partial).groupBy("row_key").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))


def merged(begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Ranges that overlap or touch as one, in order."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    first = np.flatnonzero(np.r_[True, begins[1:] > reach[:-1]]) if len(begins) else np.zeros(0, int)
    return [(int(begins[a]), int(reach[b])) for a, b in zip(first, np.r_[first[1:], len(begins)] - 1)]


def _ranges_of(batch: pa.RecordBatch) -> list[list[tuple[int, int]]]:
    """The merged ranges of each row, from the last column."""
    out = []
    for item in batch.column(batch.num_columns - 1):
        values = item.values.flatten() if item.is_valid else None
        out.append(merged(*(np.asarray(v) for v in values)) if values else [])
    return out


def _kept(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    edges = [0, *(edge for pair in ranges for edge in pair), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _with_ranges(documents: DataFrame, settings: RepeatSettings) -> DataFrame:
    """``documents`` and, as last column under a free name, the ranges of each row."""
    key, ranges = free_name(documents, "__row_key"), free_name(documents, "__ranges")
    found = repeated_ranges(documents, settings).withColumnsRenamed({"row_key": key, "ranges": ranges})
    joined = documents.withColumn(key, row_key(documents)).join(found, key, "left")
    return joined.select(*[F.col(f"`{c}`") for c in documents.columns], ranges)


def removal_report(documents: DataFrame, settings: RepeatSettings | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (long), kept_sha256, changed and kept of every row.

    ``kept`` is the text left, without characters that are only partly there. A null text is empty, repeated rows repeat each other.
    """

    def transform(batch: pa.RecordBatch) -> Iterator[dict]:
        texts, cuts = text_bytes(batch), _ranges_of(batch)
        kept = [_kept(t, c) for t, c in zip(texts, cuts)]
        yield {
            "doc_id": batch.column(batch.schema.get_field_index("doc_id")),
            "n_bytes": [len(t) for t in texts],
            "n_removed": [sum(b - a for a, b in c) for c in cuts],
            "n_spans": [len(c) for c in cuts],
            "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
            "changed": [bool(c) for c in cuts],
            "kept": [k.decode("utf-8", "ignore") for k in kept],
        }

    rows = _with_ranges(documents.select("doc_id", "text"), settings or RepeatSettings())
    return map_batches(rows, transform, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, changed boolean, kept string")


def without_repeats(documents: DataFrame, settings: RepeatSettings | None = None) -> DataFrame:
    """``documents`` with the repeated strings cut out of ``text``; all other columns and all rows stay.

    A character that is only partly covered goes as well, so that the rest is valid text. A null text stays null.
    """
    settings = settings or RepeatSettings()
    names = documents.columns
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_kept(t, c).decode("utf-8", "ignore") if c else t.decode() for t, c in zip(text_bytes(batch), _ranges_of(batch))]
            texts = pa.array(texts, pa.string())
            column = batch.column(place)
            arrays = [batch.column(i) for i in range(len(names))]
            arrays[place] = pc.if_else(column.is_valid(), texts, pa.scalar(None, pa.string())).cast(column.type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return _with_ranges(documents, settings).mapInArrow(run, documents.schema)
