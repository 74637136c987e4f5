"""Periodic runs of words, found by a dictionary of basic factors.

Level k of the dictionary names every factor of 2 ** k words of a text, equal factors alike: it pairs the names of level
k - 1. Occurrences of one name that follow each other at one distance form an arithmetic progression. A distance d proposes
period d on the level whose length L is the least power of two not below d (so within twice L): inside a run of period d and at
least four periods, the next occurrence of any such factor is exactly d words on, and no smaller period can have that distance. Proposals are extended
in both directions by comparing names from the longest level down, and equal ones become one.

Factors that occur once are dropped, for no longer one at their place occurs twice; a level looks at the rest only. Names
carry the number of their text, so texts are worked on many at a time and nothing reaches across. A null or empty text has no runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecast.llm.words import map_batches, pieces, text_bytes


@dataclass(frozen=True)
class RunSettings:
    """A run has at least ``shortest`` words and ``periods`` periods (4 or more: the search relies on it)."""

    shortest: int = 6
    periods: int = 4

    def __post_init__(self):
        if self.periods < 4:
            raise ValueError("periods must be 4 or more")


def _named(codes: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A table of names by position, -1 where the factor occurs once, and the positions that are left."""
    table = np.full(length, -1, np.int32)
    if not len(codes):
        return table, at
    _, names, counts = np.unique(codes, return_inverse=True, return_counts=True)
    often = counts[names] > 1
    kept = at[often]
    table[kept] = names[often]
    return table, kept


def _proposals(table: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First position and step of every arithmetic progression of occurrences with a step in (length / 2, length]."""
    order = at[np.argsort(table[at], kind="stable")]
    step = np.diff(order)
    good = (table[order[1:]] == table[order[:-1]]) & (2 * step > length) & (step <= length)
    # a progression begins where the step before it is another one
    begins = good & np.r_[True, ~good[:-1] | (step[1:] != step[:-1])]
    return order[:-1][begins], step[begins]


def _extended(tables: list[np.ndarray], at: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The widest ranges [begin, end) around ``at`` in which words ``step`` apart are equal."""
    count = len(tables[0])
    ahead, back = at.copy(), at.copy()
    for level in range(len(tables) - 1, -1, -1):
        table, size = tables[level], 1 << level
        while True:
            b = ahead + step
            room = b + size <= count
            here = np.flatnonzero(room)
            here = here[(table[ahead[here]] >= 0) & (table[ahead[here]] == table[b[here]])]
            if not len(here):
                break
            ahead[here] += size
            if level < len(tables) - 1:
                break
        while True:
            a = back - size
            here = np.flatnonzero(a >= 0)
            here = here[(table[a[here]] >= 0) & (table[a[here]] == table[a[here] + step[here]])]
            if not len(here):
                break
            back[here] -= size
            if level < len(tables) - 1:
                break
    return back, ahead + step


def find_runs(words: np.ndarray, owner: np.ndarray, settings: RunSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and period of all runs in the concatenated word numbers ``words``; ``owner``, ascending, is the text of each word."""
    count = len(words)
    none = np.zeros(0, np.int64)
    if not count:
        return none, none, none
    longest = int(np.bincount(owner - owner[0]).max())
    codes = owner.astype(np.int64) * (int(words.max()) + 1) + words
    table, at = _named(codes, np.arange(count), count)
    tables, found = [], []
    size = 1
    while len(at):
        tables.append(table)
        found.append(_proposals(table, at, size))
        # no run has a period of more than a fourth of its text
        if size >= longest // settings.periods:
            break
        pairs = at[at + size < count]
        pairs = pairs[table[pairs + size] >= 0]
        codes = table[pairs].astype(np.int64) * count + table[pairs + size]
        table, at = _named(codes, pairs, count)
        size *= 2
    if not found:
        return none, none, none
    first, step = (np.concatenate(part) for part in zip(*found))
    begin, end = _extended(tables, first, step)
    long = end - begin >= np.maximum(settings.shortest, settings.periods * step)
    runs = np.unique(np.stack([begin[long], step[long], end[long]], axis=1), axis=0)
    return runs[:, 0], runs[:, 2] - runs[:, 0], runs[:, 1]


def _dropped(count: int, begin: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Words in a run behind its first period."""
    edges = np.zeros(count + 1, np.int64)
    np.add.at(edges, begin + period, 1)
    np.add.at(edges, begin + length, -1)
    return np.cumsum(edges[:-1]) > 0


def periodic_runs(documents: DataFrame, settings: RunSettings | None = None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period; by start, then period) and collapsed, the words outside repetitions, of every row.

    Ids may be null or repeated, each row is a text of its own. Other columns play no part.
    """
    settings = settings or RunSettings()

    def transform(batch: pa.RecordBatch, settings=settings) -> Iterator[dict]:
        texts = text_bytes(batch)
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for low, high in pieces(texts):
            split = [text.split() for text in texts[low:high]]
            sizes = np.array([len(words) for words in split])
            flat = [word for words in split for word in words]
            numbers = pd.factorize(np.array(flat, dtype=object))[0] if flat else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(len(split)), sizes)
            begin, length, period = find_runs(numbers, owner, settings)
            gone = _dropped(len(flat), begin, length, period)
            offsets = np.r_[0, np.cumsum(sizes)]
            per = np.bincount(owner[begin], minlength=len(split)) if len(begin) else np.zeros(len(split), int)
            start = begin - offsets[owner[begin]]
            edges = np.r_[0, np.cumsum(per)].astype(np.int32)
            parts = [pa.array(np.ascontiguousarray(x)) for x in (start, length, period)]
            collapsed = []
            for at, words in enumerate(split):
                if per[at]:
                    lost = gone[offsets[at] : offsets[at + 1]].tolist()
                    words = [word for word, out in zip(words, lost) if not out]
                collapsed.append(b" ".join(words).decode())
            yield {
                "doc_id": ids.slice(low, high - low),
                "n_words": sizes,
                "runs": pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays(parts, ["start", "length", "period"])),
                "collapsed": collapsed,
            }

    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return map_batches(documents.select("doc_id", "text"), transform, schema)


def planted(documents: DataFrame) -> DataFrame:
    """doc_id and text, with the words of about a tenth of the documents from some place on replaced by a repetition, by rules of doc_id alone."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(number / 10)
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+", -1), lambda word: word != "")
    n = F.size("words").cast("long")
    rows = documents.select("doc_id", "text", number.alias("h"), g.alias("g"), F.when(number % 10 == 0, words).alias("words"))
    a = F.when(n > 0, F.col("g") % F.greatest(n, F.lit(1)))
    rows = rows.withColumn("a", a.cast("int"))
    p = (F.floor((n - F.col("a")) / (3 + F.col("g") % 8)) + 1).cast("int")
    rows = rows.withColumn("p", p)
    repeated = F.transform(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))),
    )
    text = F.when((F.col("h") % 10 == 0) & (F.size("words") > 0), F.array_join(repeated, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; of equals the first one. Null without runs."""
    blank = "struct(cast(null as bigint) AS start, cast(null as bigint) AS length, cast(null as bigint) AS period)"
    return F.aggregate(
        runs,
        F.expr(blank),
        lambda best, run: F.when(
            best["start"].isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )
