"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question asked again with other values has the same
template; a unit may be written to its number, and a name may hold capitals and apostrophes. Whether a capitalised word is a name is open, so windows are read in three ways: names inside sentences, all capitalised
words as names, and lower-cased without names. Windows of the texts are looked up in those of the benchmark; matches are aligned token by
token, and the values behind the placeholders must agree one to one between item and text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanecast.llm.words import WordCache, free_name, looked_up, map_batches, pieces, row_key, text_bytes, window_hashes
from lanecast.session import materialise

#: Units of measure that become one placeholder; fixed values.
UNITS = frozenset(
    "mm cm dm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz ounce ounces pound pounds ton tons "
    "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years cent cents dollar dollars euro euros usd eur gbp % percent degree degrees mph kmh km/h m/s w kw kwh v".split()
)
_NUMBER = regex.compile(r"[-+$€£]?\d[\d.,:/]*(?:st|nd|rd|th)?%?")
#: A unit written to its number, which are two placeholders as they are with a space.
_GLUED = re.compile(rb"(\d)(%s)(?![A-Za-z\d])" % b"|".join(re.escape(u.encode()) for u in sorted(UNITS, key=lambda u: (-len(u), u)) if u != "%"), re.I)
_EDGE = regex.compile(r"^[^\w$€£%+-]+|[^\w%]+$")
_WORD, _NUMBER_KIND, _NAME_KIND, _UNIT_KIND, _ENDS = 0, 1, 2, 3, 4


@dataclass(frozen=True)
class TemplateSettings:
    """``window``: template tokens of a window. ``share``: of an item's windows that must be found in one text, or the tokens
    that such a run covers at one shift.

    An item shorter than a window is one window as long as it is, from ``shortest`` tokens on.
    """

    window: int = 8
    share: float = 0.5
    shortest: int = 5
    #: Bytes of benchmark text that are held in a task at a time; a larger benchmark goes in several passes.
    block_bytes: int = 16_000_000


def token_of(word: bytes) -> int:
    """A word as its hash, with its kind and whether it ends a sentence in the three low bits; 0 for bare punctuation."""
    text = word.decode("utf-8", "replace")
    core = _EDGE.sub("", text)
    if not core:
        return 0
    ends = _ENDS if text.rstrip("\"')]»”")[-1:] in (".", "!", "?", ":") else 0
    if _NUMBER.fullmatch(core):
        kind = _NUMBER_KIND
    elif core.lower() in UNITS and len(core) > 1:
        kind = _UNIT_KIND
    elif core[:1].isupper() and any(letter.islower() for letter in core[1:]):
        kind = _NAME_KIND
    else:
        kind = _WORD
    return (xxhash.xxh3_64_intdigest(core.lower()) & ~7) | ends | kind | 8


@lru_cache(maxsize=1)
def _tokens() -> WordCache:
    return WordCache(token_of)


@dataclass(frozen=True)
class Template:
    """Tokens of texts one after another: their kind, the hash of the value, and whether they open a sentence."""

    kind: np.ndarray
    value: np.ndarray
    opens: np.ndarray

    def readings(self) -> Iterator[np.ndarray]:
        """The template tokens: capitalised words as names unless they open a sentence, all of them as names, and none."""
        open_slot = (self.kind == _NUMBER_KIND) | (self.kind == _UNIT_KIND)
        name = self.kind == _NAME_KIND
        for slot in (open_slot | (name & ~self.opens), open_slot | name, open_slot):
            yield np.where(slot, self.kind, self.value)

    def part(self, begin: int, end: int) -> Template:
        return Template(self.kind[begin:end], self.value[begin:end], self.opens[begin:end])


def template(texts: list) -> tuple[Template, np.ndarray]:
    """The template of all texts (bytes) together, and where each begins and the last ends. Punctuation alone is no token."""
    split = [_GLUED.sub(rb"\1 \2", text).split() for text in texts]
    packed = looked_up(_tokens(), list(chain.from_iterable(split)), np.uint64)
    kept = packed != 0
    ends = np.cumsum([0, *map(len, split)])
    bounds = np.concatenate([[0], np.cumsum(kept)])[ends]
    packed = packed[kept]
    opens = np.ones(len(packed), bool)
    opens[1:] = (packed[:-1] & np.uint64(_ENDS)) != 0
    opens[bounds[:-1][bounds[:-1] < len(packed)]] = True
    return Template(packed & np.uint64(3), packed & ~np.uint64(7), opens), bounds


def agreement(ours: Template, theirs: Template, sure: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(places that agree, those of them that hold another value) of two stretches of equal length; None if values contradict.

    Each value of a slot stands for one value of the other side and the other way round: within ``sure``, where windows were found,
    numbers, units and names inside sentences must keep to that; elsewhere, and for words that only may be names, a
    place that does not simply disagrees. A side without any capitalised word hides its names: there a word may stand for a name.
    """
    same = ours.value == theirs.value
    both = ours.kind == theirs.kind
    name, their_name = ours.kind == _NAME_KIND, theirs.kind == _NAME_KIND
    slot = both & (ours.kind != _WORD)
    if not their_name.any():
        hidden = name & (theirs.kind == _WORD) & ~same
    elif not name.any():
        hidden = their_name & (ours.kind == _WORD) & ~same
    else:
        hidden = np.zeros(len(same), bool)
    if hidden.sum() <= same.sum():
        slot |= hidden
    must = slot & both & sure & ~(name & (ours.opens | theirs.opens))
    pairs = set(zip(ours.value[must].tolist(), theirs.value[must].tolist()))
    there, back = dict(pairs), {b: a for a, b in pairs}
    if not len(pairs) == len(there) == len(back):
        return None
    agree = same & (~slot | must | (name & (ours.opens | theirs.opens))) | must
    for at in np.flatnonzero(slot & ~agree).tolist():
        a, b = int(ours.value[at]), int(theirs.value[at])
        if there.get(a, b) == b and back.get(b, a) == a:
            there[a], back[b], agree[at] = b, a, True
    return agree, agree & ~same


class BenchmarkBlock:
    """Windows of some benchmark items in all their readings, ready for lookup."""

    def __init__(self, items: list, settings: TemplateSettings):
        self.settings = settings
        self.ids = [item_id for item_id, _ in items]
        whole, bounds = template([(text or "").encode() for _, text in items])
        self.items = [whole.part(a, b) for a, b in zip(bounds[:-1], bounds[1:])]
        lengths = np.diff(bounds)
        sizes = np.minimum(lengths, settings.window)
        sizes[sizes < max(1, min(settings.shortest, settings.window))] = 0
        self.total = np.where(sizes > 0, lengths - sizes + 1, 0)
        readings = list(whole.readings())
        self.tables = {}
        for size in sorted(set(sizes[sizes > 0].tolist())):
            own = np.flatnonzero(sizes == size)
            number = np.repeat(own, self.total[own])
            start = np.arange(len(number)) - np.repeat(np.cumsum(self.total[own]) - self.total[own], self.total[own])
            at, names, rows = bounds[number] + start, [], []
            for reading in readings:
                found = window_hashes(reading, size)[at]
                new = np.logical_and.reduce([found != other for other in names]) if names else np.ones(len(at), bool)
                names.append(found)
                rows.append(np.flatnonzero(new))
            names, rows = np.concatenate([n[r] for n, r in zip(names, rows)]), np.concatenate(rows)
            order = np.argsort(names, kind="stable")
            sieve = np.zeros(1 << 22, bool)
            sieve[names >> np.uint64(42)] = True
            self.tables[size] = sieve, names[order], number[rows][order], start[rows][order]

    def hits(self, texts: Template, bounds: np.ndarray) -> dict:
        """(text, item number) -> shift of the text against the item -> starts in the item of the windows found."""
        found = defaultdict(lambda: defaultdict(set))
        readings = list(texts.readings())
        for size, (sieve, known, number, start) in self.tables.items():
            for reading in readings:
                names = window_hashes(reading, size)
                at = np.flatnonzero(sieve[names >> np.uint64(42)])
                text = np.searchsorted(bounds, at, "right") - 1
                inside = at + size <= bounds[text + 1]
                at, text = at[inside], text[inside]
                first = np.searchsorted(known, names[at], "left")
                times = np.searchsorted(known, names[at], "right") - first
                for t, a, f, n in zip(text[times > 0].tolist(), at[times > 0].tolist(), first[times > 0].tolist(), times[times > 0].tolist()):
                    for k in range(f, f + n):
                        found[t, int(number[k])][a - int(bounds[t]) - int(start[k])].add(int(start[k]))
        return found

    def matches(self, texts: list) -> Iterator[tuple]:
        """(text, item_id, windows found, windows of the item, values that differ) of each item found in a text.

        Found is an item when its share of windows is, or when as many of its tokens as such a run of windows covers agree at one shift.
        """
        whole, bounds = template(texts)
        for (text, number), shifts in sorted(self.hits(whole, bounds).items()):
            item, total = self.items[number], int(self.total[number])
            length = len(item.kind)
            size = min(self.settings.window, length)
            text_length = int(bounds[text + 1] - bounds[text])
            found, changed, longest = set(), 0, 0
            for shift, starts in sorted(shifts.items()):
                # the part of the item that lies over the text at this shift
                begin, end = max(0, -shift), min(length, text_length - shift)
                sure = np.zeros(length, bool)
                for start in starts:
                    sure[start : start + size] = True
                from_text = int(bounds[text]) + shift
                agreed = agreement(item.part(begin, end), whole.part(from_text + begin, from_text + end), sure[begin:end])
                if agreed is not None:
                    agree, differs = agreed
                    longest = max(longest, int(agree.sum()))
                    changed += int(differs.sum())
                    runs = np.convolve(agree, np.ones(size, int), "valid") == size if len(agree) >= size else np.zeros(0, bool)
                    found |= set((np.flatnonzero(runs) + begin).tolist())
            wanted = self.settings.share * total
            if longest and (len(found) >= wanted or longest >= np.ceil(wanted) + size - 1):
                yield text, self.ids[number], len(found), total, changed


def _blocks(benchmark: DataFrame, settings: TemplateSettings) -> Iterator[list]:
    """The benchmark in lists of bounded size. One pass counts its bytes, one fetches each block."""
    size = benchmark.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    count = -(-int(size) // settings.block_bytes)
    items = benchmark.select("item_id", "text").where("text is not null")
    for number in range(count):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number).distinct()
        yield sorted(((r[0], r[1]) for r in block.toLocalIterator()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def leaks(documents: DataFrame, benchmark: DataFrame, settings: TemplateSettings | None = None) -> DataFrame:
    """One row for each text and benchmark item found in it.

    row_key, doc_id, item_id, windows_found, windows_total (int), values_changed (int: placeholders with another value than in the item).
    Null or empty texts and items match nothing; repeated rows give repeated matches; other columns are not read.
    """
    settings = settings or TemplateSettings()
    spark = documents.sparkSession
    keyed = documents.select(row_key(documents).alias("row_key"), "doc_id", "text").where("text is not null")
    schema = "row_key long, doc_id long, item_id long, windows_found int, windows_total int, values_changed int"
    result = spark.createDataFrame([], schema)
    for items in _blocks(benchmark, settings):
        shared = spark.sparkContext.broadcast(items)
        result = result.union(map_batches(keyed, _find(shared, settings), schema))
    return result


@lru_cache(maxsize=1)
def _block_of(number: int, shared, settings: TemplateSettings) -> BenchmarkBlock:
    return BenchmarkBlock(shared.value, settings)


def _find(shared, settings: TemplateSettings):
    def transform(batch: pa.RecordBatch) -> Iterator[dict]:
        block = _block_of(shared.id if hasattr(shared, "id") else 0, shared, settings)
        keys = batch.column(batch.schema.get_field_index("row_key")).to_pylist()
        ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
        rows, texts = [], text_bytes(batch)
        for first, last in pieces(texts):
            rows += [(keys[first + at], ids[first + at], *match) for at, *match in block.matches(texts[first:last])]
        names = ("row_key", "doc_id", "item_id", "windows_found", "windows_total", "values_changed")
        yield dict(zip(names, map(list, zip(*rows)))) if rows else {name: [] for name in names}

    return transform


def without_leaks(documents: DataFrame, benchmark: DataFrame, settings: TemplateSettings | None = None) -> DataFrame:
    """``documents`` without the rows in which a benchmark item was found; all columns as they are."""
    key = free_name(documents, "__row_key")
    found = materialise(leaks(documents, benchmark, settings).select(F.col("row_key").alias(key)).distinct())
    keyed = documents.withColumn(key, row_key(documents))
    return keyed.join(found, key, "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])
