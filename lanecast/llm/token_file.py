"""Token-ID output: binary blocks of separately compressed documents under one shared dictionary.

A block holds some documents in order: an index (doc ids, token counts, offsets), the frames of the documents one after the other, and
the hash of the zstandard dictionary they were compressed with. One document is read by its block's
index, without its neighbours. Blocks are rows of a Parquet table, so Spark's commit protocol keeps them whole
when a task or an executor is lost; the dictionary lies beside them in the same folder.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
import xxhash
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecast.llm.words import CACHE_WORDS, bounded_texts, map_batches, pieces

_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
BLOCK_SCHEMA = (
    "shard int, block int, first_id long, last_id long, n_docs int, n_tokens long, start long, dictionary long, width int, "
    "ids binary, counts binary, offsets binary, frames binary"
)


@dataclass(frozen=True)
class TokenFileSettings:
    """``end_id`` closes every document. ``sample``: documents the dictionary is trained on, of ``sample_bytes`` at most each."""

    end_id: int = 0
    sample: int = 2000
    sample_bytes: int = 16_384
    dictionary_bytes: int = 65_536
    level: int = 3
    block_docs: int = 512
    block_tokens: int = 1_000_000


class TextEncoder:
    """Encodes texts with a tokenizer file, remembering the ids of words.

    A single space or line feed between two other signs is always a cut between the tokenizer's pre-tokens, with that sign on the right,
    so such words are encoded by themselves. A word after a line feed keeps it, all others stand for themselves and the space before them.
    ``width``: bytes of an id.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        size = self.tokenizer.get_vocab_size()
        # byte-level tokens are written with one sign a byte
        self.token_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        #: Words met lately, and those of the time before: a word in use moves over instead of being encoded again.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 10_000):
            for item in self.tokenizer.encode_batch_fast(texts[at : at + 10_000], add_special_tokens=False):
                yield np.array(item.ids, f"<u{self.width}").tobytes()

    def _encoded_words(self, words: list[str]) -> Iterator[bytes]:
        """The ids of words with what is before each, many words a call: no token spans two of them, so lengths tell them apart."""
        for at in range(0, len(words), 2000):
            part = [word if word[0] == "\n" else " " + word for word in words[at : at + 2000]]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.cumsum([len(word.encode()) for word in part])
            cuts = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends, side="left") + 1
            data, begin = ids.astype(f"<u{self.width}").tobytes(), 0
            for cut in (cuts * self.width).tolist():
                yield data[begin:cut]
                begin = cut

    @staticmethod
    def _split(text: str) -> list[str]:
        """The words of a text, the first one with all that is before it."""
        words = text.split()
        if sum(map(len, words)) + len(words) - 1 != len(text):
            return _SAFE_CUT.split(text)  # some gap is wider than one sign, or at an end
        return text.replace("\n", " \n").split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self._split(text) for text in texts]
        heads = self._encoded([words.pop(0) for words in split])
        if len(self.words) > CACHE_WORDS:
            self.words, self.older = {}, self.words
        new = []
        for word in set().union(*split):
            if word not in self.words:
                if word in self.older:
                    self.words[word] = self.older[word]
                else:
                    new.append(word)
        self.words.update(zip(new, self._encoded_words(new)))
        return [head + b"".join(map(self.words.__getitem__, words)) for head, words in zip(heads, split)]


_ENCODERS: dict[str, TextEncoder] = {}


def _encoder(path: str) -> TextEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def _send(spark: SparkSession, path: str) -> str:
    name = os.path.basename(path)
    if not any(name == os.path.basename(known) for known in spark.sparkContext.listFiles):
        spark.sparkContext.addFile(path)
    return name


def train_dictionary(documents: DataFrame, tokenizer: str, settings: TokenFileSettings) -> bytes:
    """A dictionary for serialised ids, trained on a bounded sample of documents of bounded size; empty when there are too few."""
    samples = _encoder(tokenizer).encode(bounded_texts(documents, settings.sample, settings.sample_bytes))
    try:
        return zstandard.train_dictionary(settings.dictionary_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_hash(dictionary: bytes) -> int:
    return xxhash.xxh3_64_intdigest(dictionary) - (1 << 63)


def _write_blocks(name: str, dictionary: bytes, settings: TokenFileSettings):
    """Partition function over documents in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(SparkFiles.get(name))
        used = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        compressor = zstandard.ZstdCompressor(level=settings.level, **used)
        end = np.array([settings.end_id], f"<u{encoder.width}").tobytes()
        shard, number, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            for first, last in pieces(texts, 1_000_000):
                codes = [code + end for code in encoder.encode(texts[first:last])]
                held: list[int] = []
                for at, code in enumerate(codes):
                    held.append(at)
                    tokens = sum(len(codes[i]) for i in held) // encoder.width if len(held) == 1 else tokens + len(code) // encoder.width
                    if len(held) >= settings.block_docs or tokens >= settings.block_tokens or at == len(codes) - 1:
                        frames = [compressor.compress(codes[i]) for i in held]
                        names = [ids[first + i] for i in held]
                        counts = np.array([len(codes[i]) // encoder.width for i in held], "<u8")
                        known = [n for n in names if n is not None]
                        row = {
                            "shard": shard, "block": number, "first_id": min(known, default=None), "last_id": max(known, default=None),
                            "n_docs": len(held), "n_tokens": int(counts.sum()), "start": start, "dictionary": dictionary_hash(dictionary),
                            "width": encoder.width, "ids": b"".join(b"\1" + n.to_bytes(8, "little", signed=True) if n is not None else bytes(9) for n in names),
                            "counts": counts.tobytes(), "offsets": np.cumsum([0] + [len(f) for f in frames]).astype("<u8").tobytes(), "frames": b"".join(frames),
                        }
                        yield pa.RecordBatch.from_pylist([row], schema=schema)
                        number, start, held = number + 1, start + row["n_tokens"], []

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(BLOCK_SCHEMA))
    return run


def write_token_file(documents: DataFrame, path: str, tokenizer: str, settings: TokenFileSettings | None = None) -> None:
    """Write the ids of every text below ``path``, in ascending doc_id order (null first, then equal ids by their text).

    A null text is empty and has the end id alone. Repeated rows are written each. Texts are ranged over the shuffle partitions
    once and encoded after that, in order.
    """
    from lanecast.session import ship_package

    settings, spark = settings or TokenFileSettings(), documents.sparkSession
    ship_package(spark)
    dictionary = train_dictionary(documents.select("doc_id", "text"), tokenizer, settings)
    spark.createDataFrame([(dictionary_hash(dictionary), bytearray(dictionary))], "hash long, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = documents.select("doc_id", "text").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = ordered.mapInArrow(_write_blocks(_send(spark, tokenizer), dictionary, settings), BLOCK_SCHEMA)
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


class BlockReader:
    """The documents of one block row."""

    def __init__(self, row: dict, dictionary: bytes):
        if row["dictionary"] != dictionary_hash(dictionary):
            raise ValueError("the block was compressed with another dictionary")
        self.row = row
        self.counts, self.offsets = np.frombuffer(row["counts"], "<u8"), np.frombuffer(row["offsets"], "<u8")
        self.plain = zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))
        at = range(0, 9 * row["n_docs"], 9)
        self.ids = [int.from_bytes(row["ids"][i + 1 : i + 9], "little", signed=True) if row["ids"][i] else None for i in at]

    def tokens(self, at: int) -> np.ndarray:
        """The ids of the document at this place of the block; no other is decompressed."""
        frame = self.row["frames"][int(self.offsets[at]) : int(self.offsets[at + 1])]
        return np.frombuffer(self.plain.decompress(frame), f"<u{self.row['width']}").astype("<u4")


def _dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (long) of every document of a token file, computed from the ids read back."""
    shared = spark.sparkContext.broadcast(_dictionary(spark, path))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    # one total for each written partition; ids of all shards before
    totals = sorted(blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    before, sums = 0, []
    for shard, count in totals:
        sums.append((shard, before))
        before += count
    base = spark.createDataFrame(sums, "shard int, base long")
    placed = blocks.join(F.broadcast(base), "shard")

    def read(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            block = BlockReader(row, shared.value)
            start = row["base"] + row["start"] + np.cumsum(np.r_[0, block.counts[:-1].astype(np.int64)])
            codes = [block.tokens(i) for i in range(row["n_docs"])]
            yield {
                "doc_id": block.ids,
                "start": start,
                "n_tokens": [len(c) for c in codes],
                "ids_crc32": [zlib.crc32(c.tobytes()) for c in codes],
            }

    return map_batches(placed, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of every document of this id; the block's id range keeps other blocks from being read."""
    dictionary = _dictionary(spark, path)
    rows = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    readers = [BlockReader(row.asDict(), dictionary) for row in rows.orderBy("shard", "block").toLocalIterator()]
    return [reader.tokens(at) for reader in readers for at, name in enumerate(reader.ids) if name == doc_id]
