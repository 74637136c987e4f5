"""Small task-side helpers shared by the text operators: word splitting, hashing, batching."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task turns into arrays at a time; one longer text makes a piece of its own.
PIECE_BYTES = 4_000_000
#: Words a Python worker remembers before it starts afresh. Speed only, never results.
CACHE_WORDS = 400_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


class WordCache(dict):
    """word -> value of ``make(word)``, emptied when it has grown to ``limit`` words."""

    def __init__(self, make: Callable, limit: int = CACHE_WORDS):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.make(word)
        return value


def word_hashes() -> WordCache:
    """A cache of 64-bit word hashes, the same in every task."""
    return WordCache(xxhash.xxh3_64_intdigest)


def looked_up(cache: WordCache, words: list, dtype) -> np.ndarray:
    """The cached value of each word as one array."""
    return np.fromiter(map(cache.__getitem__, words), dtype, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble an array of 64-bit integers (the SplitMix64 finaliser); wraps around."""
    x = values.astype(np.uint64) + _GOLDEN
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for every run of ``size`` neighbours, ``len(hashes) - size + 1`` of them."""
    count = max(0, len(hashes) - size + 1)
    total = np.full(count, size, np.uint64)
    for factor, k in zip(mix(np.arange(size, dtype=np.uint64)) | np.uint64(1), range(size)):
        total += hashes[k : k + count] * factor
    return mix(total)


def pieces(texts: list, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` (bytes or None) with about ``limit`` bytes each."""
    begin = size = 0
    for at, text in enumerate(texts):
        size += len(text or b"")
        if size >= limit:
            yield begin, at + 1
            begin, size = at + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list:
    """The texts of a batch as UTF-8 bytes, null as empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    return [text or b"" for text in column.to_pylist()]


def map_batches(df: DataFrame, transform: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from a batch to dicts of columns, written in the order of ``schema``."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    from lanecast.session import ship_package

    ship_package(df.sparkSession)
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for columns in transform(batch):
                    yield pa.RecordBatch.from_arrays(
                        [
                            column.cast(field.type) if isinstance(column, pa.Array) else pa.array(column, field.type)
                            for field, column in ((f, columns[f.name]) for f in arrow)
                        ],
                        schema=arrow,
                    )

    return df.mapInArrow(run, schema)


def bounded_texts(documents: DataFrame, count: int, max_bytes: int) -> list[str]:
    """About ``count`` texts of at most ``max_bytes``, those with the smallest hash of id and text; the same ones on every run.

    Only hashes are compared first, so what reaches the driver is bounded by the texts chosen. Texts that share the last hash all come.
    """
    short = documents.where(f"octet_length(text) between 1 and {max_bytes}").withColumn("h", F.xxhash64("doc_id", "text"))
    last = [row[0] for row in short.select("h").orderBy("h").limit(count).collect()]
    if not last:
        return []
    return sorted(row[0] for row in short.where(F.col("h") <= last[-1]).select("text").distinct().collect())


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(df: DataFrame) -> Column:
    """A 64-bit key of a document row: equal exactly for rows with equal id and text."""
    return F.xxhash64(df["doc_id"], df["text"], F.isnull(df["text"]), F.isnull(df["doc_id"]))


def as_signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed ones that Spark holds."""
    return values.astype(np.uint64).view(np.int64)


def lists(values: np.ndarray, lengths) -> pa.Array:
    """One Arrow list per document from concatenated values and the length of each."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
