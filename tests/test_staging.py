import datetime


from lanecast.functions.text import infer_state
from lanecast.operators.staging import macro_pivot, stage_flows, stage_history, zone_to_state
from lanecast.schemas import LOOKUP_SCHEMA, SERIES_SCHEMA, ZONE_LOOKUP_SCHEMA, flow_schema, history_schema, table_schemas

DAY = datetime.date


def _rows_of(schema, trade_types):
    one = {"int": 1, "double": 1.0}
    return [
        tuple(t if f.name == "trade_type" else one[f.dataType.simpleString()] for f in schema) for t in trade_types
    ]


def test_only_domestic_flows_are_staged(spark):
    staged = stage_flows(spark.createDataFrame(_rows_of(flow_schema(), (1, 2, 3, None)), flow_schema()))
    assert staged.count() == 1
    assert staged.schema.names == table_schemas()["staged_flows"].names
    staged = stage_history(spark.createDataFrame(_rows_of(history_schema(), (1, 2)), history_schema()))
    assert staged.count() == 1
    assert staged.schema.names == table_schemas()["staged_flow_history"].names


def test_macro_averages_per_year(spark):
    rows = [
        ("GDPC1", DAY(2020, 1, 1), 100.0),
        ("GDPC1", DAY(2020, 4, 1), 102.0),
        ("UNRATE", DAY(2020, 1, 1), 5.0),
        ("UNRATE", DAY(2021, 1, 1), None),
        ("UNMAPPED", DAY(2022, 1, 1), 7.0),
    ]
    got = {r["year"]: r for r in macro_pivot(spark.createDataFrame(rows, SERIES_SCHEMA)).collect()}
    assert sorted(got) == [2020, 2021, 2022]
    assert got[2020]["gdp"] == 101.0 and got[2020]["unemployment_rate"] == 5.0 and got[2020]["diesel_price"] is None
    assert got[2021]["unemployment_rate"] is None and got[2022]["gdp"] is None


def test_macro_averages_per_month(spark):
    rows = [("GDPC1", DAY(2020, 1, d), float(d)) for d in (1, 3)] + [("GDPC1", DAY(2020, 2, 1), 9.0)]
    got = macro_pivot(spark.createDataFrame(rows, SERIES_SCHEMA), grain="month").orderBy("period").collect()
    assert [(r["period"], r["gdp"]) for r in got] == [(DAY(2020, 1, 1), 2.0), (DAY(2020, 2, 1), 9.0)]


ZONES = [
    ("Los Angeles CA", "Los Angeles-Long Beach, CA  CFS Area", "California"),
    ("Rest of TX", "Remainder of Texas", "Texas"),
    ("Alaska", "Alaska", "Alaska"),
    ("Philadelphia PA-NJ-DE-MD (DE Part)", "Philadelphia-Reading-Camden, PA-NJ-DE-MD  CFS Area (DE Part)", "Delaware"),
    ("Rest of ZZ", "foo TX", None),
    ("X OR-WA", "y", "Washington"),
    ("nope", "none", None),
    ("Town (ZZ Part)", "Town, GA", "Georgia"),
    ("Town", "Remainder of   New York ", "New York"),
    ("Town", "Remainder of Nowhere", None),
    ("Rest of  TX ", "foo", "Texas"),
    ("Town", "Iowa", "Iowa"),
    (None, None, None),
    ("TXA xCA", "1TX", None),
    ("ÉCA", "y", None),
]


def test_zone_text_to_state(spark):
    rows = [(i, s, long) for i, (s, long, _) in enumerate(ZONES)]
    df = spark.createDataFrame(rows, "i int, short string, long string")
    got = {r["i"]: r["state"] for r in df.select("i", infer_state("short", "long").alias("state")).collect()}
    assert got == {i: state for i, (_, _, state) in enumerate(ZONES)}


def test_zone_to_state_codes(spark):
    zones = spark.createDataFrame([(1, "Rest of TX", "x"), (2, "nope", "none"), (3, "Alaska", "Alaska")], ZONE_LOOKUP_SCHEMA)
    states = spark.createDataFrame([(48, "Texas"), (49, "Texas"), (1, "Alabama")], LOOKUP_SCHEMA)
    got = zone_to_state(zones, states)
    assert got.schema.names == table_schemas()["staged_zone_state"].names
    assert {r["zone_id"]: (r["state_fips"], r["state_name"]) for r in got.collect()} == {
        1: (49, "Texas"), 2: (None, None), 3: (None, "Alaska"),
    }


def test_filter_reaches_the_file_scan(spark, tmp_path):
    path = str(tmp_path / "flows")
    spark.createDataFrame([], flow_schema()).write.parquet(path)
    plan = stage_flows(spark.read.parquet(path)).select("dms_orig", "tons_2017")._jdf.queryExecution().toString()
    assert "EqualTo(trade_type,1)" in plan
    assert "ReadSchema: struct<dms_orig:int,trade_type:int,tons_2017:double>" in plan
