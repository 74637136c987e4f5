import pytest
from small_data import SMALL
from pyspark.sql import functions as F

from lanecast import starschema as star
from lanecast.forecast.boosted import BoostedSettings
from lanecast.plans import pipeline
from lanecast.schemas import IMPORTANCE_SCHEMA, table_schemas
from lanecast.sinks.tables import declare_tables, read_table, replace_table
from lanecast.sources.artifacts import flatten_runs, read_forecasts, read_optional_csv

QUICK = BoostedSettings(trees=2, bins=16)


def test_layers_forecasts_and_scores_end_to_end(spark, tmp_path):
    root = str(tmp_path)
    declare_tables(spark, root, star.LAYOUT)
    for name, df in star.raw_layer(spark, SMALL).items():
        replace_table(df, root, name)
    corridors = star.zone_corridors(spark, SMALL).where("origin IN (8, 18)")
    staged = {name: rows for name, rows in pipeline.write_staged(spark, root, star.LAYOUT, star.MACRO_MAPPING)}
    assert staged["staged_flows"] > 0 and staged["staged_zone_state"] == 25
    built = {name: rows for name, rows in pipeline.write_features(spark, root, corridors, star.LAYOUT)}
    assert built["feature_corridor_annual"] == built["feature_corridor_enriched"] > 0
    assert built["feature_benchmark"] % 5 == 0 and built["feature_corridor_history"] == 50 * 4
    for name, schema in table_schemas(star.LAYOUT).items():
        assert read_table(spark, root, name, star.LAYOUT).schema.names == schema.names

    options = {"holdout_year": star.HOLDOUT_YEAR, "horizon": star.HORIZON, "settings": QUICK}
    with pytest.raises(FileNotFoundError):
        pipeline.evaluate_and_store(spark, root, star.HOLDOUT_YEAR, star.BENCHMARK_YEAR)
    scores = pipeline.evaluate_and_store(spark, root, benchmark_year=star.BENCHMARK_YEAR, train_if_missing=True, **options)
    models = {r[0] for r in read_forecasts(spark, f"{root}/forecasts").select("model_name").distinct().collect()}
    assert models == {"ARIMA", "TrendRegression", "BoostedTrees"}
    assert scores["model_comparison"].count() == scores["holdout_scores"].count() > 0
    log = spark.read.parquet(f"{root}/model_runs")
    given = {r[0]: set(r[1]) for r in log.select(F.col("params")["model_name"], F.map_keys("params")).distinct().collect()}
    assert {"order", "aic", "training_rows"} <= given["ARIMA"] and "regressors" in given["TrendRegression"]
    assert {"n_estimators", "pooled_training_rows"} <= given["BoostedTrees"]
    runs = flatten_runs(log)
    assert runs.count() == scores["holdout_scores"].count()
    assert read_optional_csv(spark, f"{root}/feature_importance", IMPORTANCE_SCHEMA).count() == 17
