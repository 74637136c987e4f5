"""Tables replaced as a whole, their declared keys, and training of what is missing."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lanecast.forecast.boosted import BoostedSettings
from lanecast.operators.features import add_lag_features, add_rolling_features, enrich
from lanecast.plans import pipeline
from lanecast.schemas import BENCHMARK_SCHEMA, FITS_SCHEMA, MACRO_ANNUAL_SCHEMA, MACRO_COLUMNS, SETTINGS_SCHEMA
from lanecast.sinks.tables import declare_tables, read_table, replace_table
from lanecast.sources.artifacts import current_path, read_forecasts, read_optional, versions

BAND = "feature_benchmark"


def band(spark, rows):
    some = spark.createDataFrame(rows, "corridor_id int, year int, bts_tons double")
    return spark.createDataFrame([], BENCHMARK_SCHEMA).unionByName(some, allowMissingColumns=True)


def seen(spark, root):
    return sorted((r.corridor_id, r.year, r.bts_tons) for r in read_table(spark, root, BAND).collect())


def test_a_failing_write_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path)
    assert replace_table(band(spark, [(1, 2030, 1.0)]), root, BAND) == (BAND, 1)
    broken = read_table(spark, root, BAND).withColumn("bts_tons", F.raise_error("no").cast("double"))
    with pytest.raises(Exception, match="no"):
        replace_table(broken, root, BAND)
    assert seen(spark, root) == [(1, 2030, 1.0)]
    # the number of the failed version is not used again, and a table may be derived from itself
    grown = read_table(spark, root, BAND).withColumn("bts_tons", F.col("bts_tons") + 1)
    assert replace_table(grown, root, BAND) == (BAND, 1)
    assert seen(spark, root) == [(1, 2030, 2.0)]
    assert [n for n, done in versions(spark, f"{root}/{BAND}").items() if done][-1] == 3


def test_only_the_version_before_is_kept(spark, tmp_path):
    root = str(tmp_path)
    for tons in range(5):
        replace_table(band(spark, [(1, 2030, float(tons))]), root, BAND)
    assert versions(spark, f"{root}/{BAND}") == {4: True, 5: True}
    assert seen(spark, root) == [(1, 2030, 4.0)]


@pytest.mark.parametrize("rows", [[(1, 2030, 1.0), (1, 2030, 2.0)], [(1, 2030, 1.0), (1, 2030, 1.0)], [(1, None, 1.0)], [(None, 2030, 1.0)]])
def test_a_broken_key_is_refused(spark, tmp_path, rows):
    root = str(tmp_path)
    replace_table(band(spark, [(7, 2030, 1.0)]), root, BAND)
    with pytest.raises(ValueError, match="key"):
        replace_table(band(spark, rows), root, BAND)
    assert seen(spark, root) == [(7, 2030, 1.0)] and len(versions(spark, f"{root}/{BAND}")) == 1


def test_an_empty_table_and_one_without_versions(spark, tmp_path):
    root = str(tmp_path)
    assert BAND in declare_tables(spark, root) and seen(spark, root) == []
    replace_table(band(spark, [(1, 2030, 1.0)]), root, BAND)
    assert BAND not in declare_tables(spark, root) and seen(spark, root) == [(1, 2030, 1.0)]
    with pytest.raises(AnalysisException):
        spark.read.parquet(f"{root}/{BAND}")
    band(spark, [(2, 2030, 1.0)]).write.parquet(f"{root}/plain")
    assert current_path(spark, f"{root}/plain") == f"{root}/plain" and current_path(spark, f"{root}/never") is None


def test_calendar_lags_and_windows_before_the_row(spark):
    rows = [(1, y, t, t, t) for y, t in ((2000, 1.0), (2001, 3.0), (2003, 7.0), (2004, None), (2005, 9.0))]
    df = spark.createDataFrame(rows, "corridor_id int, year int, total_tons double, total_value double, diesel_price double")
    built = add_rolling_features(add_lag_features(df, calendar=True), calendar=True, current=False).orderBy("year").collect()
    assert [r.tons_lag1 for r in built] == [None, 1.0, None, 7.0, None]
    assert [r.tons_lag2 for r in built] == [None, None, 3.0, None, 7.0]
    assert [r.tons_rolling_mean_3yr for r in built] == [None, 1.0, 2.0, 5.0, 7.0]
    before = add_rolling_features(df, current=False).orderBy("year").collect()
    assert [r.tons_rolling_mean_3yr for r in before] == [None, 1.0, 2.0, pytest.approx(11 / 3), 5.0]


# --- training of what is missing ---

YEARS, HOLDOUT, HORIZON = range(2010, 2019), 2018, (2019, 2020)
QUICK = BoostedSettings(trees=2, bins=16)


def annual_of(spark, tons):
    rows = [(c, f"c{c}", y, tons(c, y), *[float(y % 5 + i) for i in range(len(MACRO_COLUMNS))]) for c in (1, 2, 3) for y in YEARS]
    names = "corridor_id int, corridor_name string, year int, total_tons double, " + ", ".join(f"{m} double" for m in MACRO_COLUMNS)
    return spark.createDataFrame(rows, names).withColumns(
        {"total_value": F.col("total_tons") * 2, "total_tmiles": F.col("total_tons") * 3}
    )


def store(spark, root, annual):
    replace_table(annual, root, "feature_corridor_annual")
    replace_table(enrich(annual), root, "feature_corridor_enriched")


def train(spark, root, models=pipeline.MODELS):
    state = pipeline.train_missing(spark, root, HORIZON, HOLDOUT, QUICK, models)
    return {(r.model_name, r.corridor_id) for r in state.where("trained").collect()}


def forecasts(spark, root):
    rows = read_forecasts(spark, f"{root}/forecasts").collect()
    return sorted((r.model_name, r.corridor_id, r.year, r.forecast_type, r.prediction is None or round(r.prediction, 6)) for r in rows)


def test_only_what_changed_is_trained(spark, tmp_path):
    first, fresh = str(tmp_path / "first"), str(tmp_path / "fresh")
    macros = spark.createDataFrame([(y, *[float(y % 5 + i) for i in range(len(MACRO_COLUMNS))]) for y in YEARS], MACRO_ANNUAL_SCHEMA)
    for root in (first, fresh):
        replace_table(macros, root, "staged_macro_annual")
    before = annual_of(spark, lambda c, y: 10.0 * c + (y * c) % 7)
    after = annual_of(spark, lambda c, y: 10.0 * c + (y * c) % 7 + (5 if (c, y) == (2, 2015) else 0))
    everything = {(m, c) for m in pipeline.MODELS for c in (1, 2, 3)}

    store(spark, first, before)
    assert train(spark, first) == everything
    assert train(spark, first) == set()
    store(spark, first, after)
    pooled = {("BoostedTrees", c) for c in (1, 2, 3)}
    assert train(spark, first) == pooled | {("ARIMA", 2), ("TrendRegression", 2)}
    assert train(spark, first) == set()

    # what was kept and what was trained again together equal a training from nothing
    store(spark, fresh, after)
    pipeline.train_and_store(spark, fresh, HORIZON, HOLDOUT, QUICK)
    assert forecasts(spark, first) == forecasts(spark, fresh)
    assert train(spark, fresh) == set()
    kept = [read_optional(spark, f"{root}/model_settings", SETTINGS_SCHEMA).count() for root in (first, fresh)]
    assert kept[0] == kept[1] == 9

    # a corridor that is gone takes its forecasts with it; nothing but the pooled model is trained for that
    store(spark, first, after.where("corridor_id <> 3"))
    assert train(spark, first) == {("BoostedTrees", 1), ("BoostedTrees", 2)}
    assert {r[1] for r in forecasts(spark, first)} == {1, 2}
    assert read_optional(spark, f"{first}/model_fits", FITS_SCHEMA).count() == 6

    # other macros touch the models that read them
    replace_table(macros.withColumn("gdp", F.col("gdp") + F.col("year") % 3), first, "staged_macro_annual")
    assert train(spark, first, pipeline.MODELS[:2]) == {("TrendRegression", 1), ("TrendRegression", 2)}
    assert {r[0] for r in forecasts(spark, first)} == set(pipeline.MODELS)
