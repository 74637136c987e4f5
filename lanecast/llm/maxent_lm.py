"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax.

The class of a token is predicted from hashed features of the words before it (n-grams and skips) by a softmax over the classes; the
word within its class by its plain share there, without features: no history tells the words of one class apart, and the tables of
features have a fixed size. Every task makes gradient updates on its own training texts, in several rounds, each from the weights of
the last averaged by tokens; classes and word counts are those of all training texts. Scoring is done in numpy batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecast.llm.words import CACHE_WORDS, as_signed, lists, map_batches, mix, pieces, text_bytes
from lanecast.session import materialise, ship_package

#: Word ids carry the number of a word's ending in their low bits; number 0 is the end of a text.
ENDINGS = 512
_END = np.uint64(0)


@dataclass(frozen=True)
class MaxentSettings:
    """``head``: most frequent words whose counts every task holds; counts of all others come by a join.

    ``rounds``: passes over all training texts, each from the averaged weights of the one before. ``step_tokens``: tokens of a gradient step.
    """

    classes: int = 16
    bits: int = 12
    head: int = 1_000_000
    rounds: int = 3
    step_tokens: int = 8192
    rate: float = 0.4
    ridge: float = 5.0


#: Features of a token: which of the words before it are hashed together.
TEMPLATES = ((1,), (2,), (1, 2), (3,))


def word_id(word: bytes) -> int:
    return (xxhash.xxh3_64_intdigest(word) & ~(ENDINGS - 1)) | (1 + xxhash.xxh3_64_intdigest(word[-3:]) % (ENDINGS - 1))


def short_code(ids: np.ndarray) -> np.ndarray:
    """Word ids in 32 bits, the ending in the low ones as before: enough to tell the few thousand cells of features apart."""
    return (ids >> np.uint64(32 + 9) << np.uint64(9) | ids & np.uint64(ENDINGS - 1)).astype(np.uint32)


class Words(dict):
    """Numbers of words in the order met, their ids by number, and texts as one array of numbers with an end, number 0, after each."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new, self.table = [0], np.zeros(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        self.new.append(word_id(word))
        return number

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Valid until the next call, which may start afresh; ``table`` has the ids."""
        if len(self) > CACHE_WORDS:
            self.forget()
        split = [text.lower().split() for text in texts]
        sizes = np.array([len(s) + 1 for s in split])
        out = np.zeros(int(sizes.sum()), np.int64)
        inside = np.ones(len(out), bool)
        inside[np.cumsum(sizes) - 1] = False
        out[inside] = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, int(inside.sum()))
        self.table, self.new = np.concatenate([self.table, np.array(self.new, np.uint64)]), []
        return out, sizes

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        numbers, sizes = self.numbers(texts)
        return self.table[numbers], sizes

    def distinct(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids among these numbers, how often each is there, and the place of every number among them."""
        times = np.bincount(numbers, minlength=len(self.table))
        present = np.flatnonzero(times)
        place = np.zeros(len(times), np.int64)
        place[present] = np.arange(len(present))
        return self.table[present], times[present], place[numbers]


def feature_rows(ids: np.ndarray, sizes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The hashed feature of every token for each template; words before the text count as its beginning."""
    begins = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(ids)) - begins
    mixed = mix(ids)
    back = {k: np.where(place >= k, np.concatenate([np.zeros(min(k, len(ids)), np.uint64), mixed[: len(ids) - k]]), np.uint64(k)) for k in (1, 2, 3)}
    rows = []
    for template in TEMPLATES:
        total = np.zeros(len(ids), np.uint64)
        for k in template:
            total = total * np.uint64(0x9E3779B97F4A7C15) + back[k]
        rows.append((mix(total) >> np.uint64(64 - bits)).astype(np.int64))
    return rows


def class_logs(rows: list[np.ndarray], bias: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """log probability of each class for every token."""
    total = bias + weights[0].take(rows[0], axis=0)
    for table, own in zip(weights[1:], rows[1:]):
        total += table.take(own, axis=0)
    total -= total.max(axis=1, keepdims=True)
    total -= np.log(np.exp(total).sum(axis=1, keepdims=True))
    return total


def update(rows: list[np.ndarray], target: np.ndarray, bias: np.ndarray, weights: np.ndarray, settings: MaxentSettings, rate: float) -> None:
    """One gradient step on a batch, scaled by the curvature of each weight."""
    off = bias + weights[0].take(rows[0], axis=0)
    for table, own in zip(weights[1:], rows[1:]):
        off += table.take(own, axis=0)
    np.exp(np.minimum(off, 80, out=off), out=off)
    off /= -(off @ np.ones(off.shape[1], off.dtype))[:, None]
    curve = np.maximum(-off.mean(axis=0), 1e-4)
    off[np.arange(len(target)), target] += 1
    for table, own in zip(weights, rows):
        order = np.argsort(own.astype(np.uint16) if settings.bits <= 16 else own, kind="stable")
        own = own[order]
        begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        count = np.diff(np.r_[begins, len(own)]).astype(np.float32)
        slope = np.add.reduceat(off.take(order, axis=0), begins, axis=0)
        table[own[begins]] += rate * np.clip(slope / (count[:, None] * curve + np.float32(settings.ridge)), -2, 2)


def train(ids: np.ndarray, sizes: np.ndarray, classes: np.ndarray, bias: np.ndarray, weights: np.ndarray, settings: MaxentSettings, rate: float) -> int:
    """Gradient steps of ``step_tokens`` tokens each over some texts; how many there were."""
    target = classes[(ids & np.uint64(ENDINGS - 1)).astype(np.int64)]
    rows = feature_rows(ids, sizes, settings.bits)
    steps = -(-len(ids) // settings.step_tokens)
    for number in range(steps):
        own = slice(number * len(ids) // steps, (number + 1) * len(ids) // steps)
        update([row[own] for row in rows], target[own], bias, weights, settings, rate)
    return steps


def ending_pairs(ids: np.ndarray) -> np.ndarray:
    """Counts of neighbouring word endings, by 512 x 512 cells; a text begins after an end."""
    ending = np.concatenate([[0], (ids & np.uint64(ENDINGS - 1)).astype(np.int64)])
    return np.bincount(ending[:-1] * ENDINGS + ending[1:], minlength=ENDINGS * ENDINGS)


def endings_to_classes(cells: np.ndarray, settings: MaxentSettings) -> np.ndarray:
    """Class of each word ending by the pairs of neighbours: endings met beside like endings share one, the end of a text has its own."""
    classes = np.zeros(ENDINGS, np.int64)
    if cells.any():
        cell = cells.reshape(ENDINGS, ENDINGS).astype(float)
        cell += cell.T.copy()
        mass = cell.sum(axis=1)
        shape = np.sqrt((cell + 0.01) / (cell + 0.01).sum(axis=1, keepdims=True))
        # spherical k-means from the heaviest endings that are least alike
        centres = [int(mass.argmax())]
        while len(centres) < settings.classes:
            near = (shape @ shape[centres].T).max(axis=1)
            centres.append(int(((1 - near) * np.sqrt(mass)).argmax()))
        middle = shape[centres]
        for _ in range(20):
            classes = (shape @ middle.T).argmax(axis=1)
            for kind in range(settings.classes):
                own = classes == kind
                if own.any():
                    middle[kind] = (shape[own] * mass[own, None]).sum(axis=0)
                    middle[kind] /= np.linalg.norm(middle[kind]) or 1
    classes[0] = settings.classes
    return classes


@dataclass(frozen=True)
class MaxentModel:
    """``counts``: word id (as long), n of all training words; ``head_ids`` / ``head_counts``: the most frequent of them, by id."""

    settings: MaxentSettings
    classes: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    head_ids: np.ndarray
    head_counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    counts: DataFrame

    @property
    def tokens(self) -> int:
        return int(self.class_tokens.sum())

    @property
    def words(self) -> int:
        return int(self.class_words.sum())


#: Rows of a task: counts of words, blocks of a table of sums, and pieces of texts as short codes with the sizes of the texts.
_COLUMNS = "word long, n long, block int, data binary, codes binary, sizes binary"
_PARTS = pa.schema([("word", pa.int64()), ("n", pa.int64()), ("block", pa.int32()), ("data", pa.binary()), ("codes", pa.binary()), ("sizes", pa.binary())])


def _rows(length: int, **columns) -> pa.RecordBatch:
    """A batch with these columns; the others are null."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(length, f.type) for f in _PARTS], schema=_PARTS)


def _part_rows(total: np.ndarray, seen: int) -> Iterator[pa.RecordBatch]:
    """A table of sums in sixteen rows."""
    for block, part in enumerate(np.split(total.reshape(-1), 16)):
        yield _rows(1, n=[seen], block=[block], data=[part.astype("<f8").tobytes()])


def _add_parts(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(data, "<f8") for data in rows["data"])
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "data": [total.tobytes()], "n": [int(rows["n"].sum())]})


def _summed(rows: DataFrame, length: int) -> tuple[np.ndarray, int]:
    """The sum of all tasks' tables and of what they saw. One row a block comes here: bounded by the table, not by the texts."""
    parts = rows.where("block is not null").groupBy("block").applyInPandas(_add_parts, "block int, data binary, n long").toPandas().sort_values("block")
    if not len(parts):
        return np.zeros(length), 0
    return np.concatenate([np.frombuffer(d, "<f8") for d in parts["data"]]), int(parts["n"].iloc[0])


def fit(documents: DataFrame, settings: MaxentSettings | None = None) -> MaxentModel:
    """Learn from all texts given: counts of words and neighbouring endings in a first pass, weights in ``rounds`` more. A null text is empty and has an end alone.

    Only the first pass reads texts; it leaves them in the shared folder as codes of four bytes a word, from which the rounds learn.
    """
    settings, spark = settings or MaxentSettings(), documents.sparkSession
    ship_package(spark)
    shape = (len(TEMPLATES), 1 << settings.bits, settings.classes + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, cells, seen = Words(), np.zeros(ENDINGS * ENDINGS, np.int64), 0
        for batch in batches:
            texts = text_bytes(batch)
            for first, last in pieces(texts):
                numbers, sizes = words.numbers(texts[first:last])
                names, times, _ = words.distinct(numbers)
                yield _rows(len(names), word=as_signed(names), n=times)
                yield _rows(1, codes=[short_code(words.table)[numbers].astype("<u4").tobytes()], sizes=[sizes.astype("<i8").tobytes()])
                cells += ending_pairs(words.table[numbers])
                seen += len(numbers)
        if seen:
            yield from _part_rows(cells, seen)

    counted = materialise(documents.select("text").mapInArrow(count, _COLUMNS))
    counts = materialise(counted.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")))
    classes = endings_to_classes(_summed(counted, ENDINGS * ENDINGS)[0], settings)
    ending = F.col("word").bitwiseAND(F.lit(ENDINGS - 1)).alias("ending")
    totals = counts.groupBy(ending).agg(F.sum("n").alias("n"), F.count("*").alias("words")).toPandas()
    kinds = classes[totals["ending"].to_numpy(dtype=np.int64)]
    tokens = np.bincount(kinds, weights=totals["n"].to_numpy(dtype=float), minlength=shape[2])
    number = np.bincount(kinds, weights=totals["words"].to_numpy(dtype=float), minlength=shape[2])
    head = counts.orderBy(F.desc("n"), "word").limit(settings.head).toArrow()
    ids = np.asarray(head.column("word")).view(np.uint64)
    order = np.argsort(ids)
    bias = np.log((tokens + 1) / (tokens + 1).sum()).astype(np.float32)
    weights = np.zeros(shape, np.float32)
    pieces_of_texts = counted.where("codes is not null").select("codes", "sizes")
    for done in range(settings.rounds):
        learned = pieces_of_texts.mapInArrow(_learn(spark.sparkContext.broadcast((classes, bias, weights)), settings, done), _COLUMNS)
        total, seen = _summed(learned, weights.size)
        weights = (total / max(1, seen)).reshape(shape).astype(np.float32)
    return MaxentModel(settings, classes, bias, weights, ids[order], np.asarray(head.column("n"))[order], tokens, number, counts)


def _learn(shared, settings: MaxentSettings, number: int):
    """One round: weights of a task, times its tokens, from the weights given."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, bias, start = shared.value
        weights, seen = start.copy(), 0
        for batch in batches:
            for codes, sizes in zip(*(batch.column(batch.schema.get_field_index(name)) for name in ("codes", "sizes"))):
                codes = np.frombuffer(codes.as_buffer(), "<u4").astype(np.uint64)
                train(codes, np.frombuffer(sizes.as_buffer(), "<i8"), classes, bias, weights, settings, settings.rate / (1 + number))
                seen += len(codes)
        if seen:
            yield from _part_rows(weights.astype(float) * seen, seen)

    return learn


def scored(documents: DataFrame, model: MaxentModel, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens (long), base_score, score (double: log10 probability) of every row.

    Unknown words share one place in their class. Null texts are empty: their end alone is scored. Repeated rows score alike.
    """
    spark, settings = documents.sparkSession, model.settings
    full = len(model.head_ids) < model.words
    whole = model.tokens + model.words + 1
    shared = spark.sparkContext.broadcast(
        (model.classes, model.bias, model.weights, model.head_ids, model.head_counts, model.class_tokens + model.class_words + 1)
    )
    words = Words()

    def score(batch: pa.RecordBatch) -> Iterator[dict]:
        classes, bias, weights, head_ids, head_counts, room = shared.value
        texts = text_bytes(batch)
        for first, last in pieces(texts):
            numbers, sizes = words.numbers(texts[first:last])
            ids = words.table[numbers]
            names, _, back = words.distinct(numbers)
            at = np.minimum(np.searchsorted(head_ids, names), max(0, len(head_ids) - 1))
            found = head_ids[at] == names if len(head_ids) else np.zeros(len(names), bool)
            count = np.where(found, head_counts[at] if len(head_counts) else 0, 0)
            kind = classes[(names & np.uint64(ENDINGS - 1)).astype(np.int64)]
            plus, inside = np.log10(count + 1.0), np.log10(room[kind])
            logs = class_logs(feature_rows(short_code(ids).astype(np.uint64), sizes, settings.bits), bias, weights)
            own = logs[np.arange(len(ids)), kind[back]] / np.log(10)
            begins = np.cumsum(sizes) - sizes
            rest = ~found[back] if full else np.zeros(len(ids), bool)
            yield {
                "doc_id": batch.column(batch.schema.get_field_index("doc_id"))[first:last],
                "held_out": batch.column(batch.schema.get_field_index("held_out"))[first:last],
                "n_tokens": sizes,
                "n_known": np.add.reduceat((count > 0)[back].astype(np.int64), begins),
                "plus": np.add.reduceat(plus[back], begins),
                "own": np.add.reduceat(own - inside[back], begins),
                "rest": lists(as_signed(ids[rest]), np.add.reduceat(rest.astype(np.int64), begins)),
            }

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, plus double, own double, rest array<long>"
    rows = map_batches(documents.select("doc_id", "text", held_out.alias("held_out")), score, schema)
    if full:
        rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()))
        rare = rows.select("row", F.explode("rest").alias("word")).groupBy("row", "word").agg(F.count("*").alias("m"))
        rare = rare.join(model.counts, "word").groupBy("row").agg(
            F.sum("m").alias("more_known"), F.sum(F.col("m") * F.log10(F.col("n") + 1)).alias("more")
        )
        rows = rows.join(rare, "row", "left").withColumn("n_known", F.col("n_known") + F.coalesce("more_known", F.lit(0)))
        rows = rows.withColumn("plus", F.col("plus") + F.coalesce("more", F.lit(0.0)))
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("plus") - F.col("n_tokens") * F.log10(F.lit(float(whole)))).alias("base_score"), (F.col("plus") + F.col("own")).alias("score"),
    )
