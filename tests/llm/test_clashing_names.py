"""Tables that carry the very names the operators use inside, and rows repeated a thousand times."""

from pyspark.sql import functions as F

from lanecast.llm import jaccard_join, suffix_dedup, template_match
from lanecast.llm.words import free_name, row_key

INSIDE = ("__row_key", "__ranges", "__one", "a", "b", "mark", "part")


def with_inside_names(documents):
    return documents.withColumns({name: F.lit(f"own {name}") for name in INSIDE})


def check(got, documents):
    assert got.columns == documents.columns
    rows = got.collect()
    assert rows and all(row[name] == f"own {name}" for row in rows for name in INSIDE)
    return sorted(row.doc_id for row in rows)


def test_columns_of_the_caller_stay(spark, documents_of):
    base = " ".join(f"w{i}" for i in range(60))
    docs = with_inside_names(documents_of([base, base, "something else entirely", "What is the capital of a far away land?"]))
    assert check(jaccard_join.one_of_each(docs, jaccard_join.JaccardSettings()), docs) == [0, 2, 3]
    assert check(suffix_dedup.without_repeats(docs, suffix_dedup.RepeatSettings(length=100)), docs) == [0, 1, 2, 3]
    items = spark.createDataFrame([(1, "What is the capital of a far away land?")], "item_id long, text string")
    assert check(template_match.without_leaks(docs, items), docs) == [0, 1, 2]


def test_free_name(documents_of):
    docs = documents_of(["x"]).withColumn("__KEY", F.lit(1))
    assert free_name(docs, "__key") == "__key_" and free_name(docs, "other") == "other"


def test_rows_repeated_a_thousand_times(spark, documents_of):
    text = " ".join(f"w{i}" for i in range(1000))
    docs = documents_of([(7, text)] * 1000 + [(8, "w1 w2"), (None, text), (None, text)])
    settings = suffix_dedup.RepeatSettings(length=400)
    ranges = {r.row_key: r.ranges for r in suffix_dedup.repeated_ranges(docs, settings).collect()}
    # one array a key, no longer for a thousand rows than for two
    assert len(ranges) == 2 and len({len(r) for r in ranges.values()}) == 1
    rows = suffix_dedup.removal_report(docs, settings).collect()
    assert len(rows) == 1003 and all(r.changed and r.kept == "" and r.n_removed == len(text) for r in rows if r.n_bytes > 10)
    assert [r.kept for r in rows if r.doc_id == 8] == ["w1 w2"]
    assert docs.select(row_key(docs)).distinct().count() == 3
