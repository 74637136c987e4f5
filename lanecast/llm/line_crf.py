"""Quality rules with line sequence labelling.

A linear-chain conditional random field marks every line of a text as content or boilerplate; Viterbi decoding gives the best
marks, and the share of words in content lines decides whether a text stays. Counts of words, signs and
repetitions come before: a text that fails them goes without further question.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.llm.words import looked_up, map_batches, pieces, text_bytes, window_hashes, word_hashes

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_CLASS = np.zeros((256, 6), np.float32)  # space, symbol, digit, capital, mark at a sentence's end, other punctuation
_CLASS[list(b" \t\n\r\x0b\f"), 0] = 1
_CLASS[:, 1] = _SYMBOLS
_CLASS[ord("0") : ord("9") + 1, 2] = 1
_CLASS[ord("A") : ord("Z") + 1, 3] = 1
_CLASS[list(b".!?"), 4] = 1
_CLASS[list(b",;:-_=+~/\\()[]{}@\"'"), 5] = 1
FEATURES = 22


@dataclass(frozen=True)
class CrfSettings:
    """``per_class``: labelled documents of each class that are learned from, of ``max_lines`` lines at most. ``share``: of words in content that keeps a text."""

    per_class: int = 1500
    max_lines: int = 200
    share: float = 0.5
    steps: int = 120
    rate: float = 0.5
    ridge: float = 1e-3


@dataclass(frozen=True)
class CrfModel:
    """``weights``: features x 2 marks (1 is content); ``change``: score of one mark after the other."""

    weights: np.ndarray
    change: np.ndarray


def line_features(lines: list[bytes]) -> np.ndarray:
    """One row of numbers between 0 and 1 for each line of a text, in order."""
    flat = np.frombuffer(b"".join(lines), np.uint8)
    size = np.array([len(line) for line in lines])
    begin = np.concatenate([np.cumsum(size) - size])
    full = np.flatnonzero(size)
    out = np.zeros((len(lines), FEATURES), np.float32)
    out[:, 0] = 1
    if len(full):
        kinds = np.add.reduceat(_CLASS[flat], begin[full], axis=0)
        length = size[full, None].astype(np.float32)
        signs = np.maximum(length - kinds[:, :1], 1)
        out[full, 1:6] = kinds[:, 1:] / signs
        for at, bound in enumerate((20, 60, 150, 400)):
            out[full, 6 + at] = length[:, 0] > bound
        out[full, 10] = kinds[:, 1] / signs[:, 0] > 0.05
        out[full, 11] = kinds[:, 3] / signs[:, 0] > 0.3
        last = flat[begin[full] + size[full] - 1]
        out[full, 12] = _CLASS[last, 4]
        out[full, 13] = _CLASS[flat[begin[full]], 3]
    words = [line.split() for line in lines]
    out[:, 14] = [len(w) > 0 for w in words]
    out[:, 15] = [len(w) > 8 for w in words]
    # a line that says the same few words again and again
    out[:, 16] = [1 - len(set(w)) / len(w) if w else 0 for w in words]
    out[:, 17] = [len(w) > 3 and 2 * len(set(w)) < len(w) for w in words]
    seen: set[bytes] = set()
    for at, line in enumerate(lines):
        out[at, 18] = line in seen
        seen.add(line)
    out[:, 19] = [any(len(x) > 30 for x in w) for w in words]
    out[0, 20], out[-1, 21] = 1, 1
    return out


def _padded(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(t) for t in texts])
    grid = np.zeros((int(length.max()), len(texts), FEATURES), np.float32)
    for at, rows in enumerate(texts):
        grid[: len(rows), at] = rows
    return grid, length


def fit_lines(texts: list[np.ndarray], labels: np.ndarray, settings: CrfSettings) -> CrfModel:
    """Fit by gradient ascent on the log likelihood, every line of a text bearing the label of its text.

    Expected marks and changes come from forward and backward sums over all texts at once.
    """
    if not len(texts) or len(set(labels.tolist())) < 2:
        return CrfModel(np.zeros((FEATURES, 2)), np.zeros((2, 2)))
    grid, length = _padded(texts)
    steps, count = grid.shape[:2]
    inside = np.arange(steps)[:, None] < length
    # both classes and every text count alike
    weight = (0.5 / np.bincount(labels, minlength=2))[labels] / length
    truth = np.zeros((steps, count, 2))
    truth[:, np.arange(count), labels] = 1
    weights, change = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    speed = [np.full_like(weights, 1e-8), np.full_like(change, 1e-8)]
    seen_change = np.zeros((2, 2))
    for mark in (0, 1):
        seen_change[mark, mark] = ((length - 1) * weight)[labels == mark].sum()
    for _ in range(settings.steps):
        score = grid @ weights
        forward, backward = np.zeros((steps, count, 2)), np.zeros((steps, count, 2))
        forward[0] = score[0]
        for t in range(1, steps):
            path = forward[t - 1][:, :, None] + change
            new = np.logaddexp(path[:, 0], path[:, 1]) + score[t]
            forward[t] = np.where(inside[t][:, None], new, forward[t - 1])
        for t in range(steps - 2, -1, -1):
            path = change + (score[t + 1] + backward[t + 1])[:, None, :]
            backward[t] = np.where(inside[t + 1][:, None], np.logaddexp(path[:, :, 0], path[:, :, 1]), 0)
        total = np.logaddexp(forward[-1][:, 0], forward[-1][:, 1])
        marks = np.exp(forward + backward - total[None, :, None]) * inside[:, :, None]
        off = (truth * inside[:, :, None] - marks) * weight[None, :, None]
        slope = np.tensordot(grid, off, axes=([0, 1], [0, 1])) - settings.ridge * weights
        pairs = np.exp(forward[:-1, :, :, None] + change + (score[1:] + backward[1:])[:, :, None, :] - total[None, :, None, None])
        expected = (pairs * (inside[1:] * weight)[:, :, None, None]).sum(axis=(0, 1))
        slopes = (slope, seen_change - expected - settings.ridge * change)
        for held, gradient, past in zip((weights, change), slopes, speed):
            past += gradient * gradient
            held += settings.rate * gradient / np.sqrt(past)
    return CrfModel(weights, change)


def viterbi_marks(scores: list[np.ndarray], change: np.ndarray) -> list[np.ndarray]:
    """The best marks of each text from its line scores; of equal paths the one with more content."""
    length = np.array([len(s) for s in scores])
    order = np.argsort(-length, kind="stable")
    begins = (np.cumsum(length) - length)[order]
    flat = np.concatenate(scores)
    active = np.searchsorted(-length[order], -np.arange(int(length.max())), side="left")
    best, came = np.zeros((len(scores), 2)), np.zeros(flat.shape, np.int8)
    for step, count in enumerate(active):
        rows = begins[:count] + step
        if step:
            path = best[:count, :, None] + change
            came[rows] = path[:, 1] >= path[:, 0]
            best[:count] = path.max(axis=1)
        best[:count] += flat[rows]
    marks = np.zeros(len(flat), np.int8)
    state = (best[:, 1] >= best[:, 0]).astype(np.int8)
    for step in range(len(active) - 1, -1, -1):
        rows = begins[: active[step]] + step
        marks[rows] = state[: active[step]]
        state[: active[step]] = came[rows, state[: active[step]]]
    return np.split(marks, np.cumsum(length)[:-1])


def base_counts(text: bytes, cache) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated three-word windows) of a text."""
    words, data = text.split(), np.frombuffer(text, np.uint8)
    chars = int(np.count_nonzero((data & 0xC0) != 0x80) - _CLASS[data, 0].sum())
    seen, repeated = set(), 0
    for line in text.split(b"\n"):
        if line in seen and line.split():
            repeated += 1
        seen.add(line)
    windows = window_hashes(looked_up(cache, words, np.uint64), 3)
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    covered = np.zeros(len(words) + 3, bool)
    for twin in (order[1:][same], order[:-1][same]):
        for k in range(3):
            covered[twin + k] = True
    return len(words), chars, int(_SYMBOLS[data].sum()), repeated, int(covered.sum())


def fit(documents: DataFrame, labels: DataFrame, settings: CrfSettings | None = None) -> CrfModel:
    """Learn the marks from a bounded sample of documents labelled by quality: lines of good ones count as content.

    Of several labels of an id the smallest counts; rows with a null id, text or label are not learned from.
    """
    settings = settings or CrfSettings()
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    best = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.per_class) for q in (0, 1)]
    rows = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(best[0].union(best[1])), "doc_id")

    def features(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [line_features(text.split(b"\n")) for text in text_bytes(batch)]
        keep = [at for at, rows in enumerate(found) if len(rows) <= settings.max_lines]
        for name in ("doc_id", "quality"):
            batch_column = batch.column(batch.schema.get_field_index(name)).to_pylist()
            found_column = [batch_column[at] for at in keep]
            if name == "doc_id":
                ids = found_column
            else:
                quality = found_column
        yield {"doc_id": ids, "quality": quality, "features": [found[at].ravel().tolist() for at in keep]}

    table = map_batches(rows, features, "doc_id long, quality int, features array<float>").toPandas().sort_values("doc_id")
    texts = [np.asarray(f, np.float32).reshape(-1, FEATURES) for f in table["features"]]
    return fit_lines(texts, table["quality"].to_numpy(), settings)


def judged(documents: DataFrame, model: CrfModel, settings: CrfSettings | None = None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept (boolean), content_share (double).

    A null text has no words, so it fails the base rules; share is 0 for a text without words. A model that learned nothing keeps all the rest.
    """
    settings = settings or CrfSettings()
    shared = documents.sparkSession.sparkContext.broadcast(model)
    cache = word_hashes()

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        model, texts = shared.value, text_bytes(batch)
        for begin, end in pieces(texts):
            counts = np.array([base_counts(text, cache) for text in texts[begin:end]], np.int64).reshape(-1, 5)
            lines = [text.split(b"\n") for text in texts[begin:end]]
            marks = viterbi_marks([line_features(rows) @ model.weights for rows in lines], model.change)
            content = [sum(len(line.split()) for line, mark in zip(rows, own) if mark) for rows, own in zip(lines, marks)]
            share = np.array(content) / np.maximum(counts[:, 0], 1)
            failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
            yield {
                "doc_id": batch.column(batch.schema.get_field_index("doc_id"))[begin:end],
                **dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), counts.T)),
                "base_failed": failed,
                "kept": ~failed & (share >= settings.share),
                "content_share": share,
            }

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, content_share double"
    )
    return map_batches(documents.select("doc_id", "text"), judge, schema)
