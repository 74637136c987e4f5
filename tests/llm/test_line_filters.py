import random
import string
from collections import Counter

import numpy as np
import pytest

from lanecast.llm import line_filters

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(texts, indexed, least):
    held = Counter(k for t in indexed for k in {key_of(x) for x in (t or "").split("\n")} - {""})
    out = []
    for text in texts:
        lines = (text or "").split("\n")
        kept = [x for x in lines if held[key_of(x)] < least]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def texts_of(rng, count):
    common = [f"Shared line {i}" for i in range(40)]
    out = []
    for _ in range(count):
        lines = [rng.choice(common) if rng.random() < 0.4 else f"line {rng.randint(0, 500)}" for _ in range(rng.randint(0, 12))]
        out.append("\n".join(rng.choice(("{}", " {}\t", "{}\r", "\x0b{}")).format(rng.choice((x, x.upper()))) for x in lines))
    return out


def rows_of(df):
    return [tuple(r)[1:] for r in sorted(df.collect(), key=lambda r: r.doc_id)]


def counts_of(index):
    return sorted(map(tuple, index.counts.select("h1", "h2", "n").collect()))


def items_of(index):
    return sum(r["items"] for r in index.filters.collect())


@pytest.mark.parametrize("broadcast", [True, False])
def test_equals_brute_force(spark, documents_of, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(line_filters, "FILTER_BYTES", 0)
    texts = texts_of(random.Random(1), 120)
    docs = documents_of(texts)
    got = rows_of(line_filters.without_common_lines(docs, line_filters.build(docs, 5)))
    assert got == brute(texts, texts, 5) and sum(r[1] for r in got) > 50


def test_insertions_and_deletions_are_reversible(spark, documents_of, monkeypatch):
    monkeypatch.setattr(line_filters, "SHARD_KEYS", 8)
    rng = random.Random(2)
    first, second = texts_of(rng, 60), texts_of(rng, 60)
    docs = documents_of(first + second)
    some, more = docs.where("doc_id < 60"), docs.where("doc_id >= 60")
    one = line_filters.build(some, 4)
    both = line_filters.insert(one, more)
    assert both.shards >= one.shards > 1
    assert rows_of(line_filters.without_common_lines(docs, both)) == brute(first + second, first + second, 4)
    back = line_filters.delete(both, more)
    assert counts_of(back) == counts_of(one) and items_of(back) == items_of(one)
    assert rows_of(line_filters.without_common_lines(docs, back)) == brute(first + second, first, 4)
    none = line_filters.delete(back, some)
    assert counts_of(none) == [] and items_of(none) == 0
    assert rows_of(line_filters.without_common_lines(docs, none)) == brute(first + second, [], 4)
    with pytest.raises(ValueError):
        line_filters.delete(none, some)
    again = line_filters.insert(line_filters.empty_index(spark, 4), some)
    assert counts_of(again) == counts_of(one)


def test_an_untouched_shard_count_amends_filters_in_place(spark, documents_of):
    docs = documents_of(["a\nb", "a", "a\nc", "b", "c\nc", "c"])
    index = line_filters.build(docs.where("doc_id < 4"), 2)
    grown = line_filters.insert(index, docs.where("doc_id >= 4"))
    assert grown.shards == 1 and items_of(index) == 2 and items_of(grown) == 3
    assert [r[2] for r in rows_of(line_filters.without_common_lines(docs, grown))] == [""] * 6


def test_odd_rows(spark, documents_of):
    long = "\n".join(["same"] * 2 + [f"l{i}" for i in range(30_000)])
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, " SAME \n\nother"), (4, long), (5, "\n\n"), (6, " same")]
    docs = documents_of(rows)
    got = line_filters.without_common_lines(docs, line_filters.build(docs, 4)).collect()
    found = Counter((r.doc_id, r.n_lines, r.n_dropped) for r in got)
    assert found == Counter({(1, 1, 0): 1, (2, 1, 0): 1, (3, 1, 1): 2, (None, 3, 1): 1, (4, 30_002, 2): 1, (5, 3, 0): 1, (6, 1, 0): 1})
    assert {r.kept for r in got if r.doc_id is None} == {"\nother"}
    empty = docs.limit(0)
    index = line_filters.build(empty, 2)
    assert line_filters.without_common_lines(empty, index).collect() == []
    assert line_filters.without_common_lines(docs, index).count() == len(rows)


def test_filter_never_forgets_and_rarely_errs():
    rng = np.random.default_rng(0)
    keys, others = rng.integers(-(2**63), 2**63 - 1, (2, 2, 20_000))
    slots = line_filters.new_filter(*keys, 4096)
    assert len(slots) == 8192
    filters = (slots, np.zeros(1, np.int64), np.array([len(slots) - 1]))
    assert line_filters.may_hold(filters, *keys).all()
    assert line_filters.may_hold(filters, *others).mean() < 0.001
    line_filters.leave(slots, *line_filters._marks(*keys[:, :15_000]))
    assert line_filters.may_hold(filters, *keys[:, 15_000:]).all() and (slots > 0).sum() == 5_000
