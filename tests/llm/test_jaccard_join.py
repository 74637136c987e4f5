import random

import numpy as np
import pytest
from llm_helpers import components_of

from lanecast.llm import jaccard_join as J
from lanecast.llm.components import connected_components


def family(rng, words, size, edits):
    base = [f"w{rng.randrange(words)}" for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(edits):
        text = list(base)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(size)] = f"e{rng.randrange(9)}"
        out.append(" ".join(text))
    return out


def brute(texts, settings):
    sets = []
    for text in texts:
        w = (text or "").lower().split()
        n = min(settings.words, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    links = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= settings.percent * len(sets[a] | sets[b])
    ]
    return [(i, len(s), c) for i, (s, c) in enumerate(zip(sets, components_of(len(texts), links)))]


def test_signatures_meet_for_every_similar_pair():
    rng = np.random.default_rng(3)
    for settings in (J.JaccardSettings(words=4, percent=85), J.JaccardSettings(parts=6, spare=3), J.JaccardSettings(parts=3, spare=1)):
        for _ in range(400):
            size = int(rng.integers(1, 120))
            union = rng.integers(0, 2**63, size).astype(np.uint64)
            drop = int(rng.integers(0, max(1, size * (100 - settings.percent) // 100 + 1)))
            cut = int(rng.integers(0, drop + 1))
            a, b = np.unique(union[cut:]), np.unique(union[: size - (drop - cut)])
            if not len(a) or not len(b) or 100 * len(np.intersect1d(a, b)) < settings.percent * len(np.union1d(a, b)):
                continue
            common = np.sort(union[:: int(rng.integers(1, 4))])
            for part in (None, common):
                assert len(np.intersect1d(J.signatures(a, settings, part), J.signatures(b, settings, part)))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(documents_of, seed):
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(25))
    texts = family(rng, 5000, 60, 25) + family(rng, 5000, 20, 6) + family(rng, 5000, 200, 4)
    texts += [passage + " " + " ".join(f"u{rng.randrange(9999)}" for _ in range(rng.randint(2, 30))) for _ in range(40)]
    texts += ["", None, "one", "ONE", "two words", " \t\n", "Two  Words", texts[0], texts[0], "a b c d", "a b c d a b c d"]
    settings = J.JaccardSettings(words=4, percent=85)
    got = J.linked_documents(documents_of(texts), settings).collect()
    assert sorted(tuple(r) for r in got) == brute(texts, settings)


def test_one_of_each_keeps_columns_and_the_first(documents_of):
    text = " ".join(f"w{i}" for i in range(50))
    docs = documents_of([(5, text), (2, text + " more"), (2, text + " more"), (9, "other words here now and then"), (None, None), (7, ""), (8, "")])
    kept = J.one_of_each(docs, J.JaccardSettings())
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [2, 7, 8, 9]
    assert kept.where("doc_id is null").count() == 1


def test_empty_table(documents_of):
    docs = documents_of(["x"]).limit(0)
    assert J.linked_documents(docs, J.JaccardSettings()).count() == 0
    assert J.one_of_each(docs, J.JaccardSettings()).count() == 0


def test_components_of_a_long_chain(spark):
    links = [(i * 7919 % 1009, (i + 1) * 7919 % 1009) for i in range(300)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert set(got.values()) == {min(x for pair in links for x in pair)}


def test_sketches_never_rule_out_a_similar_pair():

    rng = np.random.default_rng(3)
    for size in (1, 5, 40, 700, 5000):
        one = rng.integers(0, 2**63, size).astype(np.uint64)
        other = np.concatenate([one[size // 5 :], rng.integers(0, 2**63, size // 7).astype(np.uint64)])
        bits = sum(int(x).bit_count() for x in (J.parity_sketch(one) ^ J.parity_sketch(other)).view(np.uint64))
        assert bits <= len(np.setxor1d(one, other)) and len(J.parity_sketch(one)) * 64 == J.SKETCH_BITS


def test_whole_sketches_of_both_sizes_bound_the_difference():
    rng = np.random.default_rng(4)
    for size in (0, 1, 255, 256, 257, 3000):
        one = rng.integers(0, 2**63, size).astype(np.uint64)
        other = np.concatenate([one[size // 6 :], rng.integers(0, 2**63, size // 3 + 1).astype(np.uint64)])
        sketches = [J.whole_sketch(x) for x in (one, other)]
        for sketch, x in zip(sketches, (one, other)):
            assert len(sketch) * 8 >= max(J.SKETCH_BITS, 2 * len(x))
        small = min(len(sketch) for sketch in sketches)
        bits = int(np.bitwise_count(J.folded(sketches[0], small) ^ J.folded(sketches[1], small)).sum())
        differ = len(np.setxor1d(one, other))
        assert bits <= differ and bits % 2 == differ % 2
        assert bits * 2 >= differ


def test_sets_with_empty_partitions_keep_a_shared_signature():
    """Small sets fill few partitions: the differences that remain allowed are put where they change the most signatures."""
    rng = np.random.default_rng(5)
    settings = J.JaccardSettings()
    for size in (5, 6, 9, 10, 15, 40, 100):
        for _ in range(100):
            one = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            other = np.sort(np.concatenate([one, rng.integers(0, 2**63, size // 4).astype(np.uint64)]))
            assert len(np.intersect1d(J.signatures(one, settings), J.signatures(other, settings)))


def test_a_family_just_below_the_similarity(spark, documents_of):
    """Texts that share most of a template but are linked with no other, beside real copies: every verdict as by brute force."""
    rng = random.Random(9)
    template = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(60):
        at = rng.randrange(0, 170)
        rows.append(" ".join(template[:at] + [f"own{i}x{k}" for k in range(14 + i % 5)] + template[at + 10 :]))
    rows += [rows[0] + " tail", rows[7]]
    settings = J.JaccardSettings(words=4, percent=85)
    sets = []
    for text in rows:
        words = text.split()
        sets.append({tuple(words[k : k + 4]) for k in range(len(words) - 3)})
    links = [(a, b) for a in range(len(rows)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    got = {r.doc_id: r.component_id for r in J.linked_documents(documents_of(rows), settings).collect()}
    assert [got[i] for i in range(len(rows))] == components_of(len(rows), links)


def test_prefixes_of_sets_that_share_a_passage(spark):
    """Sets of a common passage and a fifth of their own sign by few shingles, and no pair of them that is not similar becomes a row."""
    rng = np.random.default_rng(7)
    settings = J.JaccardSettings()
    passage = rng.integers(0, 2**63, 800).astype(np.uint64)
    common = np.sort(passage)
    sets = [np.sort(np.concatenate([passage, rng.integers(0, 2**63, 160).astype(np.uint64)])) for _ in range(30)]
    sets.append(np.sort(np.concatenate([sets[0][: len(sets[0]) - 20], rng.integers(0, 2**63, 20).astype(np.uint64)])))
    marks = [J.signatures(one, settings, common, np.full(len(common), 31)) for one in sets]
    assert all(len(own) == len(one) * 20 // 100 + 1 for own, one in zip(marks, sets))
    sketches = [J.parity_sketch(one).tolist() for one in sets]
    rows = [(node, at, mark, node, len(sets[node]), sketches[node]) for node, own in enumerate(marks) for at, mark in enumerate(J.as_signed(own).tolist())]
    rows = spark.createDataFrame(rows, "node long, at int, mark long, part long, n long, sketch array<long>")
    got = [tuple(r) for r in J._pairs_of_bucket(rows, settings.percent).collect()]
    assert got == [(0, 30)]


def test_first_shared_shingle_passes_the_place_test():
    """Whatever the counts, two similar sets share a prefix shingle after which enough is left of both."""
    rng = np.random.default_rng(8)
    settings = J.JaccardSettings(words=4, percent=85)
    for _ in range(500):
        size = int(rng.integers(1, 150))
        union = rng.integers(0, 2**63, size).astype(np.uint64)
        drop = size * (100 - settings.percent) // 100
        cut = int(rng.integers(0, drop + 1))
        a, b = np.sort(union[cut:]), np.sort(union[: size - (drop - cut)])
        common = np.sort(union[rng.random(size) < rng.random()])
        often = rng.integers(1, 5, len(common))
        one, other = (J.prefix(x, settings, common, often).tolist() for x in (a, b))
        left = [min(len(a) - i, len(b) - other.index(x)) for i, x in enumerate(one) if x in other]
        assert left and max(left) * 185 >= 85 * (len(a) + len(b))
