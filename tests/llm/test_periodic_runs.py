import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanecast.llm import periodic_runs


def brute_runs(words, shortest=6, periods=4):
    found, n = {}, len(words)
    for q in range(1, n // periods + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - at
            if end > at and length >= max(shortest, periods * q):
                # a smaller period of the same stretch has been met before
                found.setdefault((at, length), q)
            at = max(end, at + 1)
    return sorted((s, ln, q) for (s, ln), q in found.items())


def collapsed(words, runs):
    gone = {i for s, ln, q in runs for i in range(s + q, s + ln)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    alphabet = "abcd"[: rng.randint(1, 4)]
    words = [rng.choice(alphabet) for _ in range(rng.randint(0, 40))]
    for _ in range(rng.randint(0, 3)):
        unit = [rng.choice(alphabet) for _ in range(rng.randint(1, 9))]
        at = rng.randint(0, len(words))
        words[at:at] = (unit * 6)[: rng.randint(1, 6 * len(unit))]
    return words


def test_equals_brute_force(spark, documents_of):
    rng = random.Random(5)
    texts = [rng.choice((" ", "\n", " \t ")).join(random_words(rng)) for _ in range(400)]
    rows = {r.doc_id: r for r in periodic_runs.periodic_runs(documents_of(texts)).collect()}
    assert len(rows) == 400 and sum(len(r.runs) for r in rows.values()) > 100
    for at, text in enumerate(texts):
        words = text.encode().split()
        runs = brute_runs(words)
        expected = sorted(runs, key=lambda r: (r[0], r[2]))
        assert [tuple(r) for r in rows[at].runs] == expected, text
        assert rows[at].n_words == len(words) and rows[at].collapsed.encode() == collapsed(words, runs)


def test_odd_rows(spark, documents_of):
    long = "word " * 50_000
    # a no-break space is part of a word, a vertical tab is not
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 6), (4, "a " * 6), (None, "b a " * 4), (5, long), (6, "x " * 9), (7, "x\x0b" * 9)]
    got = {(r.doc_id, r.n_words): [tuple(x) for x in r.runs] for r in periodic_runs.periodic_runs(documents_of(rows)).collect()}
    assert got == {
        (1, 0): [], (2, 0): [], (3, 0): [], (4, 6): [(0, 6, 1)], (None, 8): [(0, 8, 2)],
        (5, 50_000): [(0, 50_000, 1)], (6, 1): [], (7, 9): [(0, 9, 1)],
    }
    assert periodic_runs.periodic_runs(documents_of(rows)).count() == len(rows)
    assert periodic_runs.periodic_runs(documents_of(rows).limit(0)).collect() == []


def test_texts_do_not_reach_across():
    words = np.array([0, 0, 0, 0, 0, 0, 0, 0])
    begin, length, period = periodic_runs.find_runs(words, np.array([3, 3, 3, 3, 4, 4, 4, 4]), periodic_runs.RunSettings(shortest=4))
    assert list(zip(begin, length, period)) == [(0, 4, 1), (4, 4, 1)]


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        periodic_runs.RunSettings(periods=3)


def test_planted_repetition(spark, documents_of):
    words = [f"w{i}" for i in range(57)]
    rows = [(i, " ".join(words)) for i in range(300)] + [(i, None) for i in range(300, 330)] + [(i, " ") for i in range(330, 360)] + [(None, "a b")]
    got = {r.doc_id: r.text for r in periodic_runs.planted(documents_of(rows)).collect()}
    changed = 0
    for doc_id, text in rows:
        expected, h = text, zlib.crc32(str(doc_id).encode())
        split = (text or "").split()
        if doc_id is not None and h % 10 == 0 and split:
            g, n = h // 10, len(split)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            expected = " ".join(split[i] if i < a else split[a + (i - a) % p] for i in range(n))
            changed += 1
        assert got[doc_id] == expected
    assert changed > 10


def test_strongest_run(spark):
    cases = [[], [(0, 8, 2), (3, 12, 3), (9, 9, 2)], [(5, 7, 1), (6, 14, 2)]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, runs array<struct<start:long,length:long,period:long>>")
    got = {r.i: r.b for r in df.select("i", periodic_runs.strongest(F.col("runs")).alias("b")).collect()}
    for at, case in enumerate(cases):
        best = max(case, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        assert tuple(got[at]) == best
