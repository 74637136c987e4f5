import numpy as np
import pytest

from lanecast.operators import profiling


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, 1.0, "a"), (1, 1.0, "a"), (2, None, "b"), (3, float("nan"), None), (1, 1.0, "a"), (None, 4.0, "c")]
    return spark.createDataFrame(rows, "k int, v double, s string")


def test_shape(table):
    got = profiling.profile_shape(table).orderBy("position").collect()
    assert [(r["column"], r["dtype"], r["n_rows"], r["n_columns"]) for r in got] == [
        ("k", "int", 6, 3), ("v", "double", 6, 3), ("s", "string", 6, 3),
    ]


def test_first_and_last_rows(table):
    assert [r["k"] for r in profiling.first_rows(table, ["k"], 2).collect()] == [1, 1]
    assert [r["k"] for r in profiling.last_rows(table, ["k"], 2).collect()] == [None, 3]


def test_missing(table):
    got = {r["column"]: (r["missing_count"], r["missing_percent"]) for r in profiling.profile_missing(table).collect()}
    assert got["v"] == (2, pytest.approx(100 / 3)) and got["k"][0] == 1 and got["s"][0] == 1
    assert profiling.profile_missing(table.select("k"), only_missing=True).count() == 1
    assert profiling.profile_missing(table.where("k = 2"), only_missing=True).count() == 1


def test_duplicates(spark, table):
    assert profiling.profile_duplicates(table).first()[0] == 2
    assert profiling.profile_duplicates(table.limit(0)).first()[0] == 0


def test_distinct(table):
    got = [(r["column"], r["dtype"], r["n_unique"]) for r in profiling.profile_distinct(table).collect()]
    assert got == [("k", "int", 3), ("s", "string", 3), ("v", "double", 2)]
    assert {r["n_unique"] for r in profiling.profile_distinct(table.select("k"), approximate=True).collect()} == {3}


def test_categorical(table):
    got = profiling.profile_categorical(table).collect()
    assert [tuple(r) for r in got] == [("s", 5, 3, "a", 3)]
    assert profiling.profile_categorical(table.select("k")).count() == 0


def test_numeric(table):
    got = {r["column"]: r for r in profiling.profile_numeric(table).collect()}
    v = got["v"]
    assert (v["count"], v["mean"], v["min"], v["q25"], v["q50"], v["q75"], v["max"]) == (4, 1.75, 1.0, 1.0, 1.0, 1.75, 4.0)
    assert v["std"] == pytest.approx(1.5) and got["k"]["count"] == 5


@pytest.mark.parametrize("shape", ["spread", "hot", "two hot", "geometric", "constant", "infinite"])
def test_quantiles_of_long_columns_are_exact(spark, shape):
    rng = np.random.default_rng(11)
    values = {
        "spread": rng.normal(size=20_000),
        "hot": np.where(rng.random(20_000) < 0.4, 7.0, rng.normal(size=20_000)),
        "two hot": np.where(rng.random(20_000) < 0.5, 1.0, 2.0),
        "geometric": 2.0 ** -rng.integers(0, 900, 20_000),
        "constant": np.full(20_000, 3.0),
        "infinite": np.where(rng.random(20_000) < 0.2, np.where(rng.random(20_000) < 0.5, np.inf, -np.inf), rng.normal(size=20_000)),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(5)
    probabilities = (0.15, 0.25, 0.5, 0.75) if shape == "infinite" else (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = profiling.exact_quantiles(df, ["v"], probabilities, select_rows=3)["v"]
    assert got == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert profiling.exact_quantiles(df, ["a", "b"], (0.5,)) == {"a": [None], "b": [1.0]}
