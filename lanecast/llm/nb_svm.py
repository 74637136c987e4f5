"""Quality classifier: naive Bayes support vectors.

Indicators of hashed n-grams (words, word pairs, and shapes of one to three neighbouring words) are scaled by the log
ratio of their share in the two classes; a linear hinge-loss model over the scaled indicators is fitted by dual
coordinate descent. Fitting takes a bounded sample of labelled rows; scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.llm.words import WordCache, lists, looked_up, map_batches, mix, pieces, text_bytes, window_hashes, word_hashes

_SHAPES = tuple((regex.compile(p), s) for p, s in ((r"\p{Lu}+", "X"), (r"[^\W\d_]+", "x"), (r"\d+", "9"), (r"(.)\1+", r"\1\1")))


@dataclass(frozen=True)
class NbSvmSettings:
    """``per_class``: the most labelled rows of a class that are fitted on, those with the smallest hash of doc_id."""

    per_class: int = 4000
    bits: int = 18
    smoothing: float = 1.0
    cost: float = 1.0
    epochs: int = 10
    #: Weight of the fitted vector against its mean size, as a guard against overfitting.
    blend: float = 0.5


def word_shape(word: bytes) -> int:
    """Hash of a word with its letters and digits reduced to their kinds; repeated signs count as two."""
    text = word.decode("utf-8", "replace")
    # letters first become kinds, so that "x" and "X" below stand for whole runs
    for pattern, kind in _SHAPES:
        text = pattern.sub(kind, text)
    return xxhash.xxh3_64_intdigest(text)


class Indicators:
    """Hashed indicator features of texts; keeps its word caches between batches."""

    def __init__(self, bits: int):
        self.shift, self.words, self.shapes = np.uint64(64 - bits), word_hashes(), WordCache(word_shape)

    def of(self, text: bytes) -> np.ndarray:
        """The distinct feature numbers of a text, in order."""
        words = text.split()
        if not words:
            return np.zeros(0, np.int64)
        names = looked_up(self.words, words, np.uint64)
        shapes = looked_up(self.shapes, words, np.uint64)
        repeated = np.r_[False, names[1:] == names[:-1]].astype(np.uint64)
        shapes = mix(shapes + repeated)
        found = [names, window_hashes(names, 2), shapes, window_hashes(shapes, 2), window_hashes(shapes, 3)]
        kinds = np.concatenate([mix(values ^ np.uint64(kind + 1)) for kind, values in enumerate(found)])
        flags = np.zeros(1 << (64 - int(self.shift)), bool) if len(kinds) > 200_000 else None
        numbers = (kinds >> self.shift).astype(np.int64)
        if flags is None:
            return np.unique(numbers)
        flags[numbers] = True
        return np.flatnonzero(flags)


@lru_cache(maxsize=2)
def indicators(bits: int) -> Indicators:
    """One set of word caches for a worker process."""
    return Indicators(bits)


@dataclass(frozen=True)
class NbSvmModel:
    """``ratio``: log-count ratios; ``weights``: the fitted weights times the ratios; ``bias``."""

    ratio: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int

    def score(self, features: np.ndarray) -> float:
        """Between 0 and 1; 0.5 lies on the separating plane."""
        size = float(np.sqrt(np.square(self.ratio[features]).sum()))
        margin = self.bias + (float(self.weights[features].sum()) / size if size else 0.0)
        return float(1 / (1 + np.exp(-np.clip(2 * margin, -30, 30))))


def dual_coordinate_descent(rows: list, values: list, labels: np.ndarray, cost: np.ndarray, width: int, epochs: int):
    """Weights of the hinge-loss problem min |w|^2 / 2 + sum cost_i max(0, 1 - y_i w.x_i).

    One multiplier is optimised at a time: its projected step along the gradient y_i w.x_i - 1, and ``weights`` is kept as the
    sum of multipliers times rows. Rows are visited in a fixed random order.
    """
    return dual_descent_with_bias(rows, values, labels, cost, width, epochs, 0.0)[0]


def dual_descent_with_bias(rows: list, values: list, labels: np.ndarray, cost: np.ndarray, width: int, epochs: int, unit: float = 1.0):
    """Weights, and the weight of one more feature that is ``unit`` in every row and takes no place in the lists."""
    weights, bias, held = np.zeros(width), 0.0, np.zeros(len(rows))
    square = np.array([float(np.dot(v, v)) + unit * unit for v in values])
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            if square[i] > 0:
                gradient = labels[i] * (float(np.dot(weights[rows[i]], values[i])) + bias * unit) - 1
                new = min(max(held[i] - gradient / square[i], 0.0), cost[i])
                if new != held[i]:
                    step = (new - held[i]) * labels[i]
                    weights[rows[i]] += step * values[i]
                    bias += step * unit
                    held[i] = new
    return weights, bias


def fit_rows(rows: list, labels: np.ndarray, settings: NbSvmSettings) -> NbSvmModel:
    """The model of feature lists and labels in 0, 1. Without rows of both classes every score is 0.5."""
    width = 1 << settings.bits
    if len(set(labels.tolist())) < 2:
        return NbSvmModel(np.zeros(width, np.float32), np.zeros(width, np.float32), 0.0, settings.bits)
    count = [np.full(width, settings.smoothing), np.full(width, settings.smoothing)]
    for row, label in zip(rows, labels):
        count[label][row] += 1
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    seen = (count[0] + count[1]) > 2 * settings.smoothing
    ratio = np.where(seen, ratio, 0.0)
    # one array for the values of all rows: the driver gives it back whole
    ends = np.cumsum([len(row) for row in rows])
    values = np.split(np.empty(ends[-1]), ends[:-1])
    for row, value in zip(rows, values):
        value[:] = ratio[row]
        value /= np.sqrt(np.square(value).sum()) or 1
    weights, bias = dual_descent_with_bias(rows, values, labels * 2 - 1, np.full(len(rows), settings.cost), width, settings.epochs)
    # the values hold the ratios already, so a weight of one in place of each fitted one is plain naive Bayes
    weights = settings.blend * weights + (1 - settings.blend) * np.abs(weights[seen]).mean()
    return NbSvmModel(ratio.astype(np.float32), (weights * ratio).astype(np.float32), float(bias), settings.bits)


def fit(documents: DataFrame, labels: DataFrame, settings: NbSvmSettings | None = None) -> NbSvmModel:
    """Fit on at most ``per_class`` rows of each class among labelled documents whose crc32(doc_id) mod 3 is not 1.

    Rows with a null id, text or label are not learned from; of several labels of an id the smallest counts. The sample is bounded, so
    its ids are broadcast and its feature numbers fitted on the driver.
    """
    settings = settings or NbSvmSettings()
    known = labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    best = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.per_class) for q in (0, 1)]
    rows = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(best[0].union(best[1])), "doc_id")

    def features(batch: pa.RecordBatch) -> Iterator[dict]:
        make = indicators(settings.bits)
        found = [make.of(text) for text in text_bytes(batch)]
        yield {
            "quality": batch.column(batch.schema.get_field_index("quality")),
            "doc_id": batch.column(batch.schema.get_field_index("doc_id")),
            "features": lists(np.concatenate(found), [len(f) for f in found]),
        }

    table = map_batches(rows, features, "doc_id long, quality int, features array<int>").toArrow()
    sets = [np.asarray(row.values) for chunk in table.column("features").chunks for row in chunk]
    order = np.argsort(np.asarray(table.column("doc_id")), kind="stable")
    return fit_rows([sets[i] for i in order], np.asarray(table.column("quality")).astype(np.int64)[order], settings)


def held_out(doc_id):
    """Rows that labels are never learned from; a null id is not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scored(documents: DataFrame, model: NbSvmModel) -> DataFrame:
    """doc_id, score (double), predicted (int) of every row; a null or empty text is scored by the bias alone."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> Iterator[dict]:
        model, texts = shared.value, text_bytes(batch)
        make = indicators(model.bits)
        for begin, end in pieces(texts):
            scores = [model.score(make.of(text)) for text in texts[begin:end]]
            yield {
                "doc_id": batch.column(batch.schema.get_field_index("doc_id"))[begin:end],
                "score": scores,
                "predicted": [int(s >= 0.5) for s in scores],
            }

    return map_batches(documents.select("doc_id", "text"), score, "doc_id long, score double, predicted int")


def accepted(documents: DataFrame, model: NbSvmModel) -> DataFrame:
    """The rows predicted 1, with all their columns. Only the text is read by Python; a row is its own key."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # caches of this task alone: a worker goes on to other stages of a pipeline and would keep shared ones through them
        make = Indicators(shared.value.bits)
        for batch in batches:
            scores = [shared.value.score(make.of(text)) for text in text_bytes(batch)]
            yield batch.filter(pa.array([s >= 0.5 for s in scores], pa.bool_()))

    from lanecast.session import ship_package

    ship_package(documents.sparkSession)
    return documents.mapInArrow(keep, documents.schema)
