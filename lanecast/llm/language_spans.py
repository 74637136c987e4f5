"""Language identification: script ranges narrow the candidates, then Viterbi over per-word scores labels spans.

A word is scored in each learned language by its hashed letter n-grams. Changing the language between two words costs a
penalty, so spans of mixed text come out whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.llm.words import CACHE_WORDS, map_batches, mix, pieces

_LETTERS = re.compile(r"[^\W\d_]+")
#: First code points of script ranges and their names; what lies between is "other".
SCRIPTS = ((0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"), (0x590, "hebrew"), (0x600, "arabic"), (0x780, "other"),
           (0x900, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
           (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
           (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"))
_STARTS = np.array([start for start, _ in SCRIPTS])
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_NUMBER = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


@dataclass(frozen=True)
class LanguageSettings:
    """``penalty``: cost of a change of language. ``candidate_share``: of a script's words that make a language a candidate for it."""

    bits: int = 15
    sizes: tuple = (1, 2, 3, 4)
    penalty: float = 8.0
    smoothing: float = 0.5
    candidate_share: float = 1e-4


def script_of(word: str) -> int:
    """Number of the script of a word's first letter."""
    return int(_NUMBER[max(0, int(np.searchsorted(_STARTS, ord(word[0]), side="right")) - 1)])


def word_grams(words: list[str], settings: LanguageSettings) -> tuple[np.ndarray, np.ndarray]:
    """(number of the word, hashed n-gram) for every letter n-gram of words with their edges, and for each word as a whole."""
    text = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    begins = np.cumsum(sizes) - sizes
    owners, grams = [], []
    for size in settings.sizes:
        count = max(0, len(text) - size + 1)
        total = np.full(count, size, np.uint64)
        for k in range(size):
            total = total * np.uint64(0x100000001B3) + text[k : k + count]
        same = owner[:count] == owner[size - 1 : size - 1 + count]
        owners.append(owner[:count][same])
        grams.append(mix(total[same]))
    power = mix(np.arange(int(sizes.max(initial=1)), dtype=np.uint64)) | np.uint64(1)
    whole = np.add.reduceat(mix(text) * power[np.arange(len(text)) - begins[owner]], begins) if len(words) else text
    owners.append(np.arange(len(words)))
    grams.append(mix(whole))
    return np.concatenate(owners), (np.concatenate(grams) >> np.uint64(64 - settings.bits)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    """``scores``: log probability of each n-gram by language; ``allowed``: languages by script."""

    languages: list
    scores: np.ndarray
    allowed: np.ndarray
    settings: LanguageSettings


class WordScorer:
    """Scores of words in every language, remembered. A word whose script no language has is open to all."""

    def __init__(self, model: LanguageModel):
        self.model, self.number, self.table = model, {}, np.zeros((0, len(model.languages)), np.float32)

    def rows(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.number) > CACHE_WORDS:
            self.number, self.table = {}, self.table[:0]
        new = list(set().union(*texts) - self.number.keys())
        if new:
            owner, grams = word_grams(new, self.model.settings)
            total = np.stack([np.bincount(owner, weights=column[grams], minlength=len(new)) for column in self.model.scores.T], axis=1)
            # overlapping n-grams of a letter count once
            total /= len(self.model.settings.sizes)
            allowed = self.model.allowed[[script_of(w) for w in new]]
            total = np.where(allowed | ~allowed.any(axis=1, keepdims=True), total, total.min(axis=1, keepdims=True) - 50)
            total -= total.max(axis=1, keepdims=True)
            self.number.update(zip(new, range(len(self.table), len(self.table) + len(new))))
            self.table = np.concatenate([self.table, total.astype(np.float32)])
        return [np.fromiter(map(self.number.__getitem__, t), np.int64, len(t)) for t in texts]


def viterbi_spans(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word of several texts, given one after the other; ties go to the lower label, then to staying.

    Texts advance side by side, the longest first, so a step works on all texts that are still going.
    """
    if not len(scores):
        return np.zeros(0, np.int8)
    order = np.argsort(-sizes, kind="stable")
    begins = (np.cumsum(sizes) - sizes)[order]
    longest = int(sizes.max(initial=0))
    active = np.searchsorted(-sizes[order], -np.arange(longest), side="left")
    came = np.zeros(scores.shape, np.int8)
    best = np.zeros((len(sizes), scores.shape[1]), np.float32)
    for step in range(longest):
        rows = begins[: active[step]] + step
        if step:
            own = best[: active[step]]
            top = own.argmax(axis=1)
            switched = own[np.arange(len(rows)), top][:, None] - penalty
            change = own < switched
            came[rows] = np.where(change, top[:, None], np.arange(scores.shape[1]))
            best[: active[step]] = np.where(change, switched, own) + scores[rows]
        else:
            best[: active[0]] = scores[rows]
    labels = np.zeros(len(scores), np.int8)
    state = best.argmax(axis=1).astype(np.int8)
    for step in range(longest - 1, -1, -1):
        rows = begins[: active[step]] + step
        labels[rows] = state[: active[step]]
        if step:
            state[: active[step]] = came[rows, state[: active[step]]]
    return labels


def letters(text: str) -> list[str]:
    """Runs of letters, lower case."""
    return [w for w in _LETTERS.findall(text.lower())]


def fit(documents: DataFrame, settings: LanguageSettings | None = None) -> LanguageModel:
    """Count n-grams and scripts by language over all given rows; those without text or lang teach nothing.

    Tasks add up before the shuffle; what arrives is bounded by languages x table size.
    """
    settings = settings or LanguageSettings()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            for first, last in pieces(texts):
                words: dict[str, Counter] = {}
                for lang, text in zip(langs[first:last], texts[first:last]):
                    words.setdefault(lang, Counter()).update(letters(text))
                for lang, found in words.items():
                    if not found:
                        continue
                    table = tables.setdefault(lang, np.zeros((1 << settings.bits) + len(SCRIPT_NAMES), np.int64))
                    names, times = list(found), np.array(list(found.values()))
                    owner, grams = word_grams(names, settings)
                    table += np.bincount(grams, weights=times[owner], minlength=len(table)).astype(np.int64)
                    scripts = np.array([script_of(w) for w in names]) + (1 << settings.bits)
                    table += np.bincount(scripts, weights=times, minlength=len(table)).astype(np.int64)
        for lang, table in tables.items():
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "cell": pa.array(at), "n": pa.array(table[at])})

    from lanecast.session import ship_package

    ship_package(documents.sparkSession)
    rows = documents.select("lang", "text").where("lang is not null and text is not null")
    counted = rows.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique().tolist())
    table = np.zeros(((1 << settings.bits) + len(SCRIPT_NAMES), len(languages)))
    if languages:
        table[counted["cell"], [languages.index(x) for x in counted["lang"]]] = counted["n"]
    grams, scripts = table[: 1 << settings.bits], table[1 << settings.bits :]
    scores = np.log((grams + settings.smoothing) / (grams + settings.smoothing).sum(axis=0, keepdims=True))
    allowed = scripts > settings.candidate_share * scripts.sum(axis=1, keepdims=True)
    return LanguageModel(languages, scores.astype(np.float32), allowed, settings)


def _scorer(shared) -> WordScorer:
    if _SCORERS.get("model") is not shared.value:
        _SCORERS.update(model=shared.value, scorer=WordScorer(shared.value))
    return _SCORERS["scorer"]


_SCORERS: dict = {}


def predicted(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, spans (array of (lang, words, letters)) of every row.

    ``lang_pred`` is the language with the most letters in its spans (ties: the earlier name), ``score`` its share of all letters.
    A null text, one without a letter, or a model without languages gives ``und`` with score 0 and no spans.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double, spans array<struct<lang:string,words:int,letters:int>>"

    def label(batch: pa.RecordBatch) -> Iterator[dict]:
        model, scorer = shared.value, _scorer(shared)
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for first, last in pieces(texts, 12_000_000):
            words = [letters(t) if t and model.languages else [] for t in texts[first:last]]
            words = [w if any(x.isalpha() or any(map(str.isalpha, x)) for x in w) else [] for w in words]
            rows = scorer.rows(words)
            sizes = np.array([len(r) for r in rows])
            flat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
            labels = viterbi_spans(scorer.table[flat], sizes, model.settings.penalty)
            weight = np.fromiter((len(x) for w in words for x in w), np.int64, len(flat))
            out: dict = {"doc_id": ids[first:last], "lang_pred": [], "score": [], "spans": []}
            begin = 0
            for size in sizes.tolist():
                own, letter = labels[begin : begin + size], weight[begin : begin + size]
                begin += size
                if not size:
                    out["lang_pred"].append("und"), out["score"].append(0.0), out["spans"].append([])
                    continue
                total = np.bincount(own, weights=letter, minlength=len(model.languages))
                best = int(total.argmax())
                cuts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
                lengths, counts = np.add.reduceat(letter, cuts).tolist(), np.diff(np.append(cuts, size)).tolist()
                out["lang_pred"].append(model.languages[best])
                out["score"].append(float(total[best] / total.sum()))
                out["spans"].append([{"lang": model.languages[own[c]], "words": n, "letters": k} for c, n, k in zip(cuts.tolist(), counts, lengths)])
            yield out

    return map_batches(documents.select("doc_id", "text"), label, schema)
