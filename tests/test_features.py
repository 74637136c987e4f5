import pytest
from pyspark.sql import functions as F

from lanecast.operators import features
from lanecast.schemas import ANNUAL_SCHEMA, ENRICHED_SCHEMA, ZONE_STATE_SCHEMA

FLOWS = (
    "dms_orig int, dms_dest int, tons_2017 double, tons_2018 double, "
    "value_2017 double, value_2018 double, tmiles_2017 double, tmiles_2018 double"
)
YEARS = (2017, 2018)


@pytest.fixture(scope="module")
def flows(spark):
    rows = [
        (1, 2, 1.0, None, 10.0, 1.0, 2.0, 2.0),
        (1, 2, 2.0, None, 20.0, 1.0, 2.0, 2.0),
        (3, 4, 5.0, 6.0, 50.0, 1.0, 2.0, 2.0),
        (9, 9, 7.0, 7.0, 7.0, 7.0, 7.0, 7.0),
    ]
    return spark.createDataFrame(rows, FLOWS)


@pytest.fixture(scope="module")
def lanes(spark):
    rows = [(1, "k1", 1, 2), (2, "k2", 3, 4), (3, "empty", 5, 6)]
    return spark.createDataFrame(rows, "corridor_id int, corridor_name string, origin int, destination int")


def _tons(df):
    return sorted((r["corridor_id"], r["year"], r["total_tons"]) for r in df.collect())


def test_totals_keep_null_years_and_drop_corridors_without_flows(flows, lanes, macro_rows):
    got = features.corridor_annual(flows, lanes, macro_rows, YEARS)
    assert got.schema.names == ANNUAL_SCHEMA.names
    assert sorted(_tons(got), key=str) == sorted([(1, 2017, 3.0), (1, 2018, None), (2, 2017, 5.0), (2, 2018, 6.0)], key=str)
    assert {r["gdp"] for r in got.where("year = 2018").collect()} == {1030.0}


def test_wide_sums_equal_long_sums(flows, lanes, macro_rows):
    wide = features.corridor_annual(flows, lanes, macro_rows, YEARS)
    long = features.unpivot_years(flows, ("dms_orig", "dms_dest"), YEARS, features.ANNUAL_MEASURES)
    summed = (
        long.join(lanes.withColumnsRenamed({"origin": "dms_orig", "destination": "dms_dest"}), ["dms_orig", "dms_dest"])
        .groupBy("corridor_id", "year")
        .agg(F.sum("total_tons").alias("total_tons"))
    )
    assert sorted(_tons(wide), key=str) == sorted(_tons(summed), key=str)


def test_corridors_that_share_a_pair_each_receive_its_totals(flows, lanes):
    columns = ["tons_2017", "tons_2018"]
    shared = lanes.unionByName(lanes.sparkSession.createDataFrame([(4, "k1 again", 1, 2), (2, "k2", 1, 2)], lanes.schema))
    got = features.totals_by_corridor(flows, shared, columns)
    assert {r["corridor_id"]: r["tons_2017"] for r in got.collect()} == {1: 3.0, 2: 8.0, 4: 3.0}


def test_annual_and_band_come_from_one_scan(spark, lanes, macro_rows, tmp_path):
    path = str(tmp_path / "flows")
    row = {name: 1.0 for name in ("tons_2017", "value_2017", "tmiles_2017", "tons_2030", "tons_2030_low", "tons_2030_high")}
    spark.createDataFrame([{"dms_orig": 1, "dms_dest": 2, **row}] * 3).write.parquet(path)
    flows = spark.read.parquet(path)
    wide = features.totals_by_corridor(flows, lanes, list(row))
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.rindex("Aggregate") > plan.index("Join")
    annual, band = features.annual_and_band(flows, lanes, macro_rows, (2017,), (2030,))
    assert [r["total_tons"] for r in annual.collect()] == [r["bts_tons"] for r in band.collect()] == [3.0]


def test_unrelated_corridor_changes_nothing(flows, lanes, macro_rows):
    before = _tons(features.corridor_annual(flows, lanes, macro_rows, (2017,)))
    more = lanes.unionByName(lanes.sparkSession.createDataFrame([(7, "k9", 9, 9)], lanes.schema))
    after = _tons(features.corridor_annual(flows, more, macro_rows, (2017,)))
    assert [r for r in after if r[0] != 7] == before


def test_partitioning_changes_nothing(flows, lanes, macro_rows):
    one = _tons(features.corridor_annual(flows.coalesce(1), lanes, macro_rows, (2017,)))
    many = _tons(features.corridor_annual(flows.orderBy(F.desc("dms_orig")).repartition(7), lanes, macro_rows, (2017,)))
    assert one == many


def test_benchmark_band(spark, lanes):
    schema = "dms_orig int, dms_dest int, tons_2030 double, tons_2030_low double, tons_2030_high double"
    flows = spark.createDataFrame([(1, 2, 10.0, 8.0, 12.0), (1, 2, 1.0, 1.0, 1.0)], schema)
    got = features.benchmark_band(flows, lanes, (2030,)).collect()
    assert [tuple(r) for r in got] == [(1, "k1", 2030, 11.0, 9.0, 13.0)]


HISTORY = "dms_origst int, dms_destst int, tons_1997 double, value_1997 double, tmiles_1997 double"


def test_corridors_sharing_states_each_receive_the_totals(spark, lanes):
    history = spark.createDataFrame([(6, 17, 1.0, 2.0, 3.0), (6, 17, 1.0, 2.0, 3.0), (1, 1, 9.0, 9.0, 9.0)], HISTORY)
    zones = spark.createDataFrame([(z, "", "", s, "") for z, s in ((1, 6), (2, 17), (3, 6), (4, 17), (5, 6), (6, 6))], ZONE_STATE_SCHEMA)
    got = features.corridor_history(history, lanes, zones, (1997,))
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, "k1", 1997, 2.0, 4.0, 6.0, "state"), (2, "k2", 1997, 2.0, 4.0, 6.0, "state"),
    ]


def test_unmapped_corridor_end_fails(spark, lanes):
    history = spark.createDataFrame([(6, 17, 1.0, 2.0, 3.0)], HISTORY)
    zones = spark.createDataFrame([(1, "", "", 6, "")], ZONE_STATE_SCHEMA)
    with pytest.raises(Exception, match="missing zone-to-state mapping for corridor"):
        features.corridor_history(history, lanes, zones, (1997,)).collect()


def _series(df, column, corridor=1):
    return [r[column] for r in df.where(F.col("corridor_id") == corridor).orderBy("year").collect()]


def test_lags(annual):
    got = features.add_lag_features(annual)
    assert _series(got, "tons_lag1")[:4] == [None, 100.0, 110.0, 120.0]
    assert _series(got, "tons_lag3")[:4] == [None, None, None, 100.0]
    assert _series(got, "value_lag1")[1] == 200.0 and _series(got, "diesel_lag1")[1] == 2.0


def test_lags_count_rows_not_years(annual):
    got = features.add_lag_features(annual.where("year <> 2018"))
    assert _series(got, "tons_lag1")[:3] == [None, 100.0, 120.0]


def test_rolling(annual):
    got = features.add_rolling_features(annual)
    assert _series(got, "tons_rolling_mean_3yr")[:3] == [100.0, 105.0, 110.0]
    std = _series(got, "tons_rolling_std_3yr")[:3]
    assert std[0] is None and std[1:] == pytest.approx([7.0710678, 10.0])
    assert _series(got, "tons_rolling_mean_3yr", 2)[:4] == [10.0, 10.0, 5.0, 2.5]
    std = _series(got, "tons_rolling_std_3yr", 2)[:4]
    assert std[:2] == [None, None] and std[2:] == pytest.approx([7.0710678, 3.5355339])


def test_changes_carry_the_last_value_over_gaps(annual):
    got = features.add_derived_features(annual)
    assert _series(got, "tons_yoy_change")[:3] == [None, pytest.approx(0.1), pytest.approx(0.0909091)]
    assert _series(got, "tons_yoy_change", 2)[:4] == [None, 0.0, -1.0, None]
    changes = features.add_economic_change_features(annual)
    assert _series(changes, "gdp_yoy_change")[1:3] == pytest.approx([0.03, 0.0291262])
    assert _series(changes, "diesel_yoy_change")[1:3] == pytest.approx([0.1, 0.0909091])


def test_ratios_without_division_errors(annual):
    got = features.add_derived_features(annual)
    assert _series(got, "value_per_ton")[:3] == [2.0, 2.0, 2.0] and _series(got, "tmiles_per_ton")[:3] == [3.0, 3.0, 3.0]
    assert _series(got, "value_per_ton", 2)[1:3] == [None, None]


def test_infinities_become_null_everywhere(spark, annual_rows):
    rows = [list(annual_rows[0]), list(annual_rows[1])]
    rows[0][3], rows[1][6] = float("inf"), float("nan")
    got = features.enrich(spark.createDataFrame([tuple(r) for r in rows], ANNUAL_SCHEMA)).orderBy("year").collect()
    assert got[0]["total_tons"] is None and got[1]["tons_lag1"] is None and got[1]["gdp"] is None
    assert got[1]["tons_yoy_change"] == -1.0 and got[1]["gdp_yoy_change"] == 0.0


def test_enriched_table_uses_one_shuffle_for_all_windows(spark, annual, tmp_path):
    assert features.enrich(annual).schema.names == ENRICHED_SCHEMA.names
    annual.write.parquet(str(tmp_path / "annual"))
    plan = features.enrich(spark.read.parquet(str(tmp_path / "annual")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_one_pair_holding_most_rows_is_summed_before_the_shuffle(spark, lanes, tmp_path):
    """With the corridor table too long to broadcast, a hot pair still reaches the shuffle as one row per task."""
    path = str(tmp_path / "hot")
    hot = spark.range(30_000).selectExpr(
        "CAST(IF(id % 3 = 0, 1, 3) AS int) AS dms_orig", "CAST(IF(id % 3 = 0, 2, 4) AS int) AS dms_dest", "1D AS tons_2017"
    )
    hot.repartition(6).write.parquet(path)
    got = features.totals_by_corridor(spark.read.parquet(path), lanes, ["tons_2017"])
    assert {r["corridor_id"]: r["tons_2017"] for r in got.collect()} == {1: 10_000.0, 2: 20_000.0}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("partial_sum(tons_2017") > plan.rindex("Join")
