import datetime

import pytest
from pyspark.sql import functions as F

from lanecast.schemas import FORECAST_SCHEMA, SERIES_SCHEMA, FlowLayout, flow_schema, history_schema, table_schemas
from lanecast.sinks.tables import append_runs, declare_tables, run_rows, write_forecasts, write_metrics_json
from lanecast.sources.artifacts import flatten_runs, read_forecast_csvs, read_forecasts, read_optional
from lanecast.sources.flows import load_flows, load_history, read_flow_csv
from lanecast.sources.lookups import LOOKUP_TABLES, corridor_dimension, load_lookups, normalise_tab, normalise_tabs
from lanecast.sources.macros import combine_series, normalise_series, read_series, replace_series, write_series

DAY = datetime.date


def _flow_csv(path, extra=""):
    names = flow_schema().names
    lines = [",".join(names)] + [",".join([""] * 10 + [str(v)] * 66) for v in (1, 2)]
    path.write_text("\n".join(lines) + "\n" + extra)


def test_wide_layout_has_the_published_width():
    assert len(flow_schema().names) == 76
    assert len(history_schema().names) == 25
    assert flow_schema().names[10] == "tons_2017" and flow_schema().names[-1] == "value_2050_high"
    assert len(FlowLayout().staged_measures()) + 6 == 65
    assert len(FlowLayout().staged_history_measures()) + 5 == 17
    assert len(table_schemas()) == 17


def test_flow_csv_loads_and_counts(spark, tmp_path):
    _flow_csv(tmp_path / "flows.csv")
    result = load_flows(spark, str(tmp_path / "flows.csv"), str(tmp_path / "raw_flows"))
    assert result["sent"] == result["stored"] == 2
    row = spark.read.parquet(str(tmp_path / "raw_flows")).orderBy("tons_2017").first()
    assert row["dms_orig"] is None and row["tons_2017"] == 1.0 and row["value_2050_high"] == 1.0


def test_history_csv_loads(spark, tmp_path):
    names = history_schema().names
    rows = [[""] + [str(a), str(b)] + [""] * 3 + [""] + ["1", "1"] + ["5"] * 16 for a, b in ((1, 2), (2, 3))]
    (tmp_path / "history.csv").write_text("\n".join(",".join(r) for r in [names, *rows]))
    assert load_history(spark, str(tmp_path / "history.csv"), str(tmp_path / "out"))["stored"] == 2


def test_malformed_number_fails(spark, tmp_path):
    _flow_csv(tmp_path / "bad.csv", ",".join(["x"] * 76) + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_flow_csv(spark, str(tmp_path / "bad.csv")).collect()


def test_misnamed_column_fails(spark, tmp_path):
    names = ["wrong", *flow_schema().names[1:]]
    (tmp_path / "bad.csv").write_text(",".join(names) + "\n" + ",".join(["1"] * 76))
    with pytest.raises(Exception, match="(?i)header"):
        read_flow_csv(spark, str(tmp_path / "bad.csv")).collect()


def test_lookup_tabs(spark, tmp_path):
    labelled = spark.createDataFrame([("1", "first", "x")], ["Numeric Label", "Description", "Other"])
    zones = spark.createDataFrame([(11, "short", "long")], ["Numeric Label", "Short Description", "Long Description"])
    tabs = {tab: zones if table == "raw_zones" else labelled for tab, table in LOOKUP_TABLES.items()}
    tables = normalise_tabs(tabs)
    assert len(tables) == 6
    assert tables["raw_states"].schema == table_schemas()["raw_states"]
    assert tables["raw_zones"].collect()[0].asDict() == {
        "numeric_label": 11, "short_description": "short", "long_description": "long",
    }
    assert [(v["target"], v["stored"]) for v in load_lookups(tables, str(tmp_path))][0] == ("raw_states", 1)
    with pytest.raises(Exception):
        normalise_tab(labelled.drop("Description"), "raw_states")


def test_series_normalisation_drops_unreadable_values(spark):
    pull = spark.createDataFrame(
        [("2020-01-01", "100"), ("2020-04-01", "."), ("2020-07-01", None), ("2020-10-01", "NaN")], ["date", "value"]
    )
    got = combine_series(spark, {"GDPC1": pull})
    assert got.schema.names == SERIES_SCHEMA.names
    assert [tuple(r) for r in got.collect()] == [("GDPC1", DAY(2020, 1, 1), 100.0)]


def test_no_series_gives_a_typed_empty_table(spark):
    got = combine_series(spark, {})
    assert got.count() == 0 and got.schema == SERIES_SCHEMA


def test_replacing_one_series_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "series")
    rows = [("A", DAY(2020, 1, 1), 1.0), ("A", DAY(2020, 2, 1), 1.5), ("B", DAY(2020, 1, 1), 2.0)]
    write_series(spark.createDataFrame(rows, SERIES_SCHEMA), path)
    again = spark.createDataFrame([("A", DAY(2020, 1, 1), 9.0)], SERIES_SCHEMA)
    result = replace_series(again, path, requested=1)
    assert (result["rows"], result["series"]) == (1, 1)
    assert sorted((r["series_id"], r["value"]) for r in read_series(spark, path).collect()) == [("A", 9.0), ("B", 2.0)]


def test_series_validation_counts_requested_series(spark, tmp_path):
    one = spark.createDataFrame([("A", DAY(2020, 1, 1), 9.0)], SERIES_SCHEMA)
    path = str(tmp_path / "series")
    write_series(spark.createDataFrame([("A", DAY(2020, 1, 1), 1.0)], SERIES_SCHEMA), path)
    with pytest.raises(ValueError, match="rejected"):
        replace_series(one, path, requested=2)
    assert [r["value"] for r in read_series(spark, path).collect()] == [1.0]


def test_ids_that_look_like_numbers_and_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "series")
    write_series(spark.createDataFrame([], SERIES_SCHEMA), path)
    assert read_series(spark, path).count() == 0
    write_series(spark.createDataFrame([("007", DAY(2020, 1, 1), 1.0), ("08", DAY(2020, 1, 1), 2.0)], SERIES_SCHEMA), path)
    replace_series(spark.createDataFrame([("007", DAY(2020, 1, 1), 3.0)], SERIES_SCHEMA), path, requested=1)
    assert sorted((r["series_id"], r["value"]) for r in read_series(spark, path).collect()) == [("007", 3.0), ("08", 2.0)]


def test_three_pulled_rows_in_two_series(spark):
    rows = [("GDPC1", "2020-01-01", 100.0), ("GDPC1", "2020-04-01", 101.0), ("UNRATE", "2020-01-01", 5.0)]
    got = normalise_series(spark.createDataFrame(rows, ["series_id", "date", "value"]))
    counts = {r["series_id"]: r["count"] for r in got.groupBy("series_id").count().collect()}
    assert counts == {"GDPC1": 2, "UNRATE": 1}


def test_corridor_dimension(spark):
    rows = corridor_dimension(spark).orderBy("corridor_id").collect()
    assert len(rows) == 5 and rows[0].asDict() == {
        "corridor_id": 1, "corridor_name": "LA_to_Chicago", "origin": 61, "destination": 171,
    }


def test_declared_tables_are_created_once(spark, tmp_path):
    created = declare_tables(spark, str(tmp_path))
    assert len(created) == 17
    assert declare_tables(spark, str(tmp_path)) == []
    assert spark.read.parquet(str(tmp_path / "raw_flows")).schema.names == flow_schema().names


def test_absent_table_reads_as_typed_empty(spark, tmp_path):
    got = read_optional(spark, str(tmp_path / "never"), FORECAST_SCHEMA)
    assert got.count() == 0 and got.schema == FORECAST_SCHEMA


def test_missing_forecasts_are_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_forecasts(spark, str(tmp_path / "never"))
    with pytest.raises(FileNotFoundError):
        read_forecast_csvs(spark, str(tmp_path / "*_forecasts.csv"))


def _forecast(spark, model, value):
    row = (1, "A_to_B", model, "s", "future", 2030, value, value - 1, value + 1)
    return spark.createDataFrame([row], FORECAST_SCHEMA)


def test_forecasts_are_replaced_per_model(spark, tmp_path):
    path = str(tmp_path / "forecasts")
    write_forecasts(_forecast(spark, "m1", 1.0).unionByName(_forecast(spark, "m2", 2.0)), path)
    write_forecasts(_forecast(spark, "m2", 3.0), path)
    got = {r["model_name"]: r["prediction"] for r in read_forecasts(spark, path).collect()}
    assert got == {"m1": 1.0, "m2": 3.0}


def test_run_log_round_trip(spark, tmp_path):
    scores = spark.createDataFrame(
        [(1, "A_to_B", "m1", "s", 10.0, 2.0, 2.0, "(0, 1, 0)")],
        "corridor_id int, corridor_name string, model_name string, training_strategy string, mape double, "
        "rmse double, mae double, model_order string",
    )
    path = str(tmp_path / "runs")
    settings = scores.select("corridor_id", "model_name", F.create_map(F.lit("order"), "model_order").alias("settings"))
    append_runs(run_rows(scores, settings), path)
    append_runs(run_rows(scores), path)
    stored = spark.read.parquet(path)
    assert stored.select("run_id").distinct().count() == 2
    assert {r["run_name"] for r in stored.collect()} == {"m1_corridor_1_s"}
    assert stored.where(F.col("params")["order"] == "(0, 1, 0)").count() == 1
    flat = flatten_runs(stored).first()
    assert (flat["corridor_id"], flat["mape"], flat["status"]) == ("1", 10.0, "FINISHED")
    write_metrics_json(scores, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).first()["mape"] == 10.0
