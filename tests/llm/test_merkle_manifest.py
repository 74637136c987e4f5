import hashlib

import pytest
from pyspark.sql import functions as F

from lanecast.llm import merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, leaf int, pos int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    fields = [doc_id, source, lang, None if n_chars is None else n_chars + more, text]
    return digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(level, at):
    """Root of a list of digests and the siblings of the one at ``at``, with the side of each."""
    path = []
    while len(level) > 1:
        other = at ^ 1
        path.append((level[other] if other < len(level) else None, at % 2 == 1))
        level = [digest(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at //= 2
    return level[0], path


def expected(rows, tampered):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for members in groups.values():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    levels = {k: [leaf(r) for r in groups[k]] for k in langs}
    subroots = [climb(levels[k], 0)[0] for k in langs]
    out = []
    for place, k in enumerate(langs):
        for at, row in enumerate(groups[k]):
            root, above = climb(subroots, place)
            path = climb(levels[k], at)[1] + above
            folded = leaf(row, 1 if row[0] in tampered else 0)
            for sibling, first in path:
                folded = digest(sibling or "", folded) if first else digest(folded, sibling or "")
            siblings = [s for s, _ in path if s]
            out.append((row[0], leaf(row), subroots[place], root, siblings, folded, folded == root))
    return out


def key(row):
    return str(row)


def check(spark, rows, tampered=()):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    manifest = merkle_manifest.build(df, F.col("doc_id").isin(list(tampered)) if tampered else None)
    got = [(r.doc_id, r.leaf, r.subroot, r.root, list(r.siblings), r.folded_root, r.verified) for r in merkle_manifest.proofs(manifest).collect()]
    assert sorted(got, key=key) == sorted(expected(rows, set(tampered)), key=key)
    return got


@pytest.mark.parametrize("count", [1, 2, 65, 200])
def test_equals_brute_force(spark, count):
    rows = [(i * 3, f"text {i}é", ("en", "de", None, "\U0001f600", "￮")[min(i % 7, 4)], "s", i) for i in range(count)]
    got = check(spark, rows, tampered=[0, 9, 300])
    assert sum(not r[-1] for r in got) == sum(r[0] in (0, 9, 300) for r in rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "a", "en", "s", 1), (None, "b", "en", "s", 1), (2, "", "", "", 0), (5, "x" * 300_000, "en", "", 7)]
    got = check(spark, rows, tampered=[1, 2])
    # a null n_chars stays null, so nothing changed there
    assert [r[0] for r in got if not r[-1]] == [2]


def test_empty_table(spark):
    manifest = merkle_manifest.build(spark.createDataFrame([], SCHEMA))
    assert manifest.root is None and merkle_manifest.proofs(manifest).collect() == []


def test_row_limit_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    check(spark, [(1, "a", "en", "s", 1)])
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
