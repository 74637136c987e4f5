import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lanecast.llm import suffix_dedup as S
from lanecast.llm.suffix_sort import suffix_order

LENGTH = 70


def covered(texts, length=LENGTH):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for text in texts:
        mark = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if count[text[i : i + length]] > 1:
                mark[i : i + length] = True
        out.append(mark)
    return out


def sample(rng, number):
    base = ["".join(rng.choices("abcdefgé \n", k=rng.randint(80, 400))) for _ in range(5)]
    texts = []
    for _ in range(number):
        text = ""
        for _ in range(rng.randint(1, 3)):
            part = list(rng.choice(base)[rng.randint(0, 50) :][: rng.randint(40, 400)])
            if part and rng.random() < 0.5:
                part[rng.randrange(len(part))] = rng.choice("abcdefgh")
            text += "".join(part) + "".join(rng.choices("xyz", k=rng.randint(0, 10)))
        texts.append(text + "a" * (rng.randint(50, 300) if rng.random() < 0.1 else 0))
    return texts


def test_suffix_order_equals_sorting():
    rng = random.Random(0)
    for _ in range(1500):
        text = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 30))]
        text = (text[:5] * 8)[:40] if rng.random() < 0.3 else text
        assert suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("wide", [S.WIDE, 3])
def test_report_equals_brute_force(documents_of, monkeypatch, wide):
    monkeypatch.setattr(S, "WIDE", wide)
    texts = sample(random.Random(4), 50) + [None, "", "short", "b" * 69, "c" * 70, "d" * 71]
    texts += texts[:2]
    got = S.removal_report(documents_of(texts), S.RepeatSettings(LENGTH)).collect()
    data = [(t or "").encode() for t in texts]
    for row, text, mark in zip(sorted(got, key=lambda r: r["doc_id"]), data, covered(data)):
        rest = bytes(b for b, m in zip(text, mark) if not m)
        spans = int((np.diff(np.concatenate([[0], mark.astype(int)])) == 1).sum())
        assert (row.n_bytes, row.n_removed, row.n_spans) == (len(text), int(mark.sum()), spans)
        assert row.kept_sha256 == hashlib.sha256(rest).hexdigest()


def test_slices_of_a_long_text(monkeypatch, documents_of):
    monkeypatch.setattr(S, "SLICE", 200)
    texts = sample(random.Random(9), 12)
    got = {r.doc_id: r.n_removed for r in S.removal_report(documents_of(texts), S.RepeatSettings(LENGTH)).collect()}
    assert got == {i: int(m.sum()) for i, m in enumerate(covered([t.encode() for t in texts]))}


def test_without_repeats_keeps_rows_and_columns(documents_of):
    passage = "é" * 40 + "".join(random.Random(1).choices("abcdef ", k=100))
    docs = documents_of([(1, "start " + passage + " end"), (None, passage + " tail"), (3, None), (4, "clean text"), (4, "clean text")])
    kept = S.without_repeats(docs, S.RepeatSettings(LENGTH))
    assert kept.columns == docs.columns
    got = {r.doc_id: r.text for r in kept.collect()}
    assert kept.count() == 5 and got[3] is None and got[4] == "clean text"
    assert got[1] == "start end" and got[None] == "tail"  # the space behind the passage repeats too


def test_empty_table(documents_of):
    docs = documents_of(["x"]).limit(0)
    assert S.removal_report(docs).count() == 0
    assert S.without_repeats(docs).count() == 0
