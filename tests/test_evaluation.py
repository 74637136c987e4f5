import pytest

from lanecast.operators import evaluation, reporting
from lanecast.schemas import BENCHMARK_SCHEMA, COMPARISON_SCHEMA, FORECAST_SCHEMA

LOO, POOLED = "leave_last_year_out", "pooled_leave_last_year_out"

# Published results of two corridors and three models: actual, holdout prediction and error in percent;
# then the 2030 prediction, the benchmark with its bounds, and the deviation in percent.
HOLDOUT = [
    (1, "LA_to_Chicago", "walk", LOO, 1168.0639989999997, 1165.450232, 0.22376916010060383),
    (1, "LA_to_Chicago", "trend", LOO, 1168.0639989999997, 1135.48981405552, 2.788732892407195),
    (1, "LA_to_Chicago", "trees", POOLED, 1168.0639989999997, 1166.490478515625, 0.13471183819738117),
    (4, "Dallas_to_Memphis", "walk", LOO, 78.125907, 75.330516, 3.578058940166922),
    (4, "Dallas_to_Memphis", "trend", LOO, 78.125907, 79.7688823271158, 2.1029840039051404),
    (4, "Dallas_to_Memphis", "trees", POOLED, 78.125907, 72.95101928710938, 6.623779373070988),
]
BENCHMARK = [
    (1, "LA_to_Chicago", "walk", LOO, 1168.0639989999995, -26.501012726258338),
    (1, "LA_to_Chicago", "trend", LOO, 1267.2253643472343, -20.26140604722118),
    (1, "LA_to_Chicago", "trees", POOLED, 1146.7166748046875, -27.84426678656919),
]
BAND = [(1, "LA_to_Chicago", 2030, 1589.2246169999999, 1577.784382, 1714.927901)]


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(i, n, m, s, "holdout", 2024, p, None, None) for i, n, m, s, _, p, _ in HOLDOUT]
    rows += [(i, n, m, s, "future", 2030, p, None, None) for i, n, m, s, p, _ in BENCHMARK]
    rows += [(1, "LA_to_Chicago", "walk", LOO, "future", 2029, 1.0, None, None)]
    actual = [(i, n, 2024, a) for i, n, a in {(h[0], h[1], h[4]) for h in HOLDOUT}] + [(1, "LA_to_Chicago", 2023, 1.0)]
    return evaluation.evaluate_all(
        spark.createDataFrame(rows, FORECAST_SCHEMA),
        spark.createDataFrame(actual, "corridor_id int, corridor_name string, year int, total_tons double"),
        spark.createDataFrame(BAND, BENCHMARK_SCHEMA),
    )


def test_published_holdout_errors(scores):
    got = {(r["corridor_id"], r["model_name"]): r for r in scores["holdout_scores"].collect()}
    assert len(got) == 6
    for i, _, model, _, actual, predicted, error in HOLDOUT:
        row = got[i, model]
        assert row["mape"] == pytest.approx(error, rel=1e-12)
        assert row["rmse"] == row["mae"] == pytest.approx(abs(actual - predicted), rel=1e-12)


def test_published_deviations(scores):
    got = {r["model_name"]: r for r in scores["benchmark_scores"].collect()}
    assert len(got) == 3
    for _, _, model, _, _, deviation in BENCHMARK:
        assert got[model]["pct_deviation_vs_bts"] == pytest.approx(deviation, rel=1e-12)
        assert got[model]["within_bts_band"] is False


def test_comparison_keeps_models_without_a_benchmark(scores):
    got = scores["model_comparison"]
    assert got.columns == COMPARISON_SCHEMA.names and got.count() == 6
    assert {r["within_bts_band"] for r in got.where("corridor_id = 4").collect()} == {None}


def test_best_model(scores):
    got = {r["corridor_id"]: r["model_name"] for r in reporting.best_model(scores["model_comparison"]).collect()}
    assert got == {1: "trees", 4: "trend"}


def test_best_model_ranks_missing_errors_last(spark):
    rows = [(1, "c", m, LOO, e, 1.0, 1.0, None, None) for m, e in (("a", None), ("b", 5.0), ("z", 5.0))]
    rows += [(2, "d", "only", LOO, None, 1.0, 1.0, None, None)]
    got = reporting.best_model(spark.createDataFrame(rows, COMPARISON_SCHEMA)).collect()
    assert {r["corridor_id"]: r["model_name"] for r in got} == {1: "b", 2: "only"}


def test_metrics(spark):
    rows = [("x", 100.0, 110.0), ("x", 120.0, 115.0), ("z", 0.0, 5.0), ("z", 100.0, 90.0), ("n", 0.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, actual double, prediction double")
    got = {r["g"]: r for r in evaluation.regression_metrics(df, by=["g"]).collect()}
    assert (got["x"]["mae"], got["x"]["rmse"], got["x"]["mape"]) == pytest.approx((7.5, 7.9056942, 7.0833333))
    assert got["z"]["mape"] == pytest.approx(10.0) and got["n"]["mape"] is None
    assert evaluation.regression_metrics(df).count() == 1


def _band(spark, prediction, band):
    f = spark.createDataFrame([(1, "c", "m", LOO, "future", 2030, prediction, None, None)], FORECAST_SCHEMA)
    return evaluation.score_benchmark(f, spark.createDataFrame([(1, "c", 2030, *band)], BENCHMARK_SCHEMA)).first()


def test_band_is_closed_and_missing_is_outside(spark):
    inside = _band(spark, 150.0, (155.0, 145.0, 165.0))
    assert inside["within_bts_band"] is True and inside["pct_deviation_vs_bts"] == pytest.approx(-3.2258065)
    assert _band(spark, 145.0, (155.0, 145.0, 165.0))["within_bts_band"] is True
    missing = _band(spark, 150.0, (0.0, None, 165.0))
    assert missing["within_bts_band"] is False and missing["pct_deviation_vs_bts"] is None


def test_nothing_to_score_gives_typed_empty_tables(spark):
    empty = spark.createDataFrame([], FORECAST_SCHEMA)
    actual = spark.createDataFrame([], "corridor_id int, corridor_name string, year int, total_tons double")
    scores = evaluation.evaluate_all(empty, actual, spark.createDataFrame([], BENCHMARK_SCHEMA))
    assert all(df.count() == 0 for df in scores.values())
    assert scores["model_comparison"].columns == COMPARISON_SCHEMA.names


def test_expanding_splits(annual):
    got = evaluation.expanding_splits(annual.where("corridor_id = 1")).orderBy("test_year").collect()
    assert [(r["train_years"], r["test_year"]) for r in got][0] == ([2017, 2018, 2019, 2020], 2021)
    assert len(got) == 4 and got[-1]["test_year"] == 2024 and got[-1]["train_years"] == list(range(2017, 2024))


def test_backtest(annual):
    got = evaluation.backtest_random_walk(annual.where("corridor_id = 1")).orderBy("test_year").collect()
    assert [(r["test_year"], r["prediction"], r["actual"]) for r in got][0] == (2021, 118.0, 131.0)
    assert len(got) == 4


def test_latest_figures(annual):
    got = {r["corridor_id"]: r for r in reporting.latest_figures(annual).collect()}
    assert got[1]["year"] == 2024 and got[1]["yoy_pct"] == pytest.approx((150 - 139) / 139 * 100)
    gap = reporting.latest_figures(annual.where("year <> 2023")).where("corridor_id = 1").first()
    assert gap["previous_tons"] is None and gap["yoy_pct"] is None


def test_selection_matrix_and_rankings(spark, scores):
    table = scores["model_comparison"]
    assert reporting.select_rows(table).count() == 6
    assert reporting.select_rows(table, ["LA_to_Chicago"], ["walk", "trees"]).count() == 2
    matrix = reporting.rmse_matrix(table, ["walk", "trees"]).where("corridor_id = 4").first()
    assert matrix["walk"] == pytest.approx(2.795391) and set(matrix.asDict()) == {"corridor_id", "corridor_name", "walk", "trees"}
    ranked = spark.createDataFrame([("a", 0.1), ("b", 0.9), ("c", 0.5), ("d", None)], "feature string, importance double")
    assert [r["feature"] for r in reporting.top_features(ranked, 2).collect()] == ["b", "c"]
    assert reporting.score_bars(table, "mape").count() == 6


def test_names_and_chart_feed(spark, annual):
    assert [r[0] for r in reporting.corridor_names(annual).collect()] == ["A_to_B", "B_to_A"]
    row = (1, "A_to_B", "m", LOO, "future", 2030, 5.0, 4.0, 6.0)
    forecasts = spark.createDataFrame([row, (*row[:2], "b", *row[3:])], FORECAST_SCHEMA)
    assert [r[0] for r in reporting.model_names(forecasts).collect()] == ["b", "m"]
    assert [r["model_name"] for r in reporting.forecast_rows(forecasts).collect()] == ["b", "m"]
    feed = reporting.chart_feed(annual, forecasts, spark.createDataFrame(BAND, BENCHMARK_SCHEMA))
    assert {r["series"]: r["count"] for r in feed.groupBy("series").count().collect()} == {"actual": 16, "m": 1, "b": 1, "benchmark": 1}
