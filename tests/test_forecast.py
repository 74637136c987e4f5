import numpy as np
import pytest
from pyspark.sql import functions as F

from lanecast.forecast import arima, boosted, trend
from lanecast.forecast.common import conform, dated
from lanecast.forecast.random_walk import forecast_random_walk
from lanecast.operators.features import enrich
from lanecast.operators.regressors import extrapolate, future_regressors, step_regressors
from lanecast.schemas import ANNUAL_SCHEMA, BOOSTED_FEATURES, FORECAST_COLUMNS, MACRO_ANNUAL_SCHEMA
from lanecast.functions.numeric import quantile_interval

HORIZON = (2025, 2026, 2027)


def _line(spark, points, years):
    df = spark.createDataFrame([("s", y, v) for y, v in points], "series_id string, year int, value double")
    return {r["year"]: r["value"] for r in extrapolate(df, years).collect()}


def test_extrapolation(spark):
    assert _line(spark, [(2024, 100.0), (2025, 105.0)], [2025, 2026, 2027]) == {2025: 105.0, 2026: 110.0, 2027: 115.0}
    assert _line(spark, [(2020, 10.0), (2024, 18.0)], [2025, 2019]) == {2025: 26.0, 2019: -22.0}
    assert _line(spark, [(2020, 10.0), (2021, None)], [2021, 2022]) == {2021: 10.0, 2022: 10.0}
    assert _line(spark, [(2020, None)], [2021]) == {2021: None}


def test_future_regressors(spark, annual, macro_rows):
    got = future_regressors(annual, macro_rows, HORIZON)
    assert got.count() == 6
    row = got.where("corridor_id = 2 AND year = 2026").first()
    assert row["gdp"] == pytest.approx(1270.0) and row["corridor_name"] == "B_to_A"


def test_existing_macro_row_wins_with_its_gaps(spark, macro_rows):
    extra = macro_rows.unionByName(spark.createDataFrame([(2025, 1.0, None, None, None, None, None)], MACRO_ANNUAL_SCHEMA))
    got = {r["year"]: r for r in step_regressors(extra, HORIZON).collect()}
    assert got[2025]["gdp"] == 1.0 and got[2025]["diesel_price"] is None
    assert got[2026]["diesel_price"] == pytest.approx(2.0 + 0.2 * 9)


def test_quantile_interval(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([None, 5.0],), ([],)], "v array<double>")
    low, high = quantile_interval("v", 0.8)
    rows = df.select(low.alias("l"), high.alias("h")).collect()
    assert rows[0]["l"] == pytest.approx(1.2) and rows[0]["h"] == pytest.approx(2.8)
    assert rows[1]["l"] == 5.0 and rows[2]["l"] is None


def test_forecast_columns_are_checked(spark):
    with pytest.raises(ValueError, match="upper_bound"):
        conform(spark.range(1))


def _by(df, corridor, kind):
    rows = df.where((F.col("corridor_id") == corridor) & (F.col("forecast_type") == kind)).orderBy("year").collect()
    return [(r["year"], r["prediction"], r["lower_bound"], r["upper_bound"]) for r in rows]


def test_random_walk(annual):
    got = forecast_random_walk(annual, HORIZON)
    assert tuple(got.columns) == FORECAST_COLUMNS
    changes = np.diff([100.0, 110.0, 120.0, 118.0, 131.0, 140.0, 139.0, 150.0])
    sigma = np.sqrt((changes**2).mean())
    future = _by(got, 1, "future")
    assert [f[1] for f in future] == [150.0] * 3
    assert [f[3] - f[1] for f in future] == pytest.approx([1.2815515655 * sigma * np.sqrt(h) for h in (1, 2, 3)])
    (holdout,) = _by(got, 1, "holdout")
    assert holdout[:2] == (2024, 139.0)
    assert holdout[3] - holdout[1] == pytest.approx(1.2815515655 * np.sqrt((changes[:-1] ** 2).mean()))


def test_random_walk_spreads_a_change_over_missing_rows(annual):
    changes = [(-10.0, 2), (5.0, 1), (1.0, 1), (1.0, 1), (2.0, 1), (-1.0, 1)]
    sigma = np.sqrt(np.mean([c * c / g for c, g in changes]))
    future = _by(forecast_random_walk(annual, HORIZON), 2, "future")
    assert future[0][3] - future[0][1] == pytest.approx(1.2815515655 * sigma)


def test_no_holdout_row_without_the_holdout_year(annual):
    got = forecast_random_walk(annual.where("year < 2024"), HORIZON)
    assert got.where("forecast_type = 'holdout'").count() == 0 and got.count() == 6


# Half-widths of published random-walk forecasts for one, two and six steps, around 1168.064.
PUBLISHED = {1: 1195.3091865463202, 2: 1206.594512737407, 6: 1234.8008064349224}
PUBLISHED_LEVEL = 1168.0639989999997


def test_published_intervals_grow_with_the_square_root():
    half = {h: upper - PUBLISHED_LEVEL for h, upper in PUBLISHED.items()}
    for steps in (2, 6):
        assert half[steps] / half[1] == pytest.approx(np.sqrt(steps), rel=1e-9)


def _series(spark, rows):
    return spark.createDataFrame([(i, [None if v is None else float(v) for v in r]) for i, r in enumerate(rows)], "i int, x array<double>")


def _fits(spark, rows, steps=3, orders=arima.ORDER_GRID):
    return [r for r in sorted(arima.with_fit(_series(spark, rows), "x", steps, orders).collect(), key=lambda r: r.i)]


def _brute(row, steps, orders=arima.ORDER_GRID):
    """The same estimates by dense least squares on explicitly filtered changes."""
    at = [i for i, v in enumerate(row) if v is not None]
    late, level = (len(row) - 1 - at[-1], row[at[-1]]) if at else (0, None)
    d = np.array([row[b] - row[a] for a, b in zip(at, at[1:])], dtype=float)
    g = np.array([b - a for a, b in zip(at, at[1:])], dtype=float)
    n = len(d)

    def lagged(u, k):
        return np.concatenate([np.zeros(min(k, n)), u[: max(0, n - k)]])

    def fit(p, t):
        u = np.zeros(n)
        for i in range(n):
            u[i] = d[i] - (t * u[i - 1] if i else 0)
        x = np.stack([lagged(u, k) for k in range(1, p + 1)], axis=1) if p else np.zeros((n, 0))
        if p == 2 and (n < 2 or np.linalg.matrix_rank(x / np.sqrt(g)[:, None]) < 2):
            return None
        phi = np.linalg.lstsq(x / np.sqrt(g)[:, None], u / np.sqrt(g), rcond=None)[0] if p else np.zeros(0)
        a, b = (list(phi) + [0, 0])[:2]
        border = max(abs(b), a + b, b - a)
        shrink = min(1, 0.99 / border) if border > 0 else 1
        e = u - x @ (phi * shrink)
        return (e * e / g).sum(), a * shrink, b * shrink, t, e[-1] if n else 0.0

    def best(order):
        if not order[2]:
            return fit(order[0], 0.0)
        base = fit(0, 0.0)[0]
        return min((fit(order[0], t) for t in arima.ma_grid()), key=lambda f: (round(f[0] / base, 9) if base else 0, abs(f[3]), f[3]))

    total, chosen = fit(0, 0.0)[0], None
    for order in orders:
        f = best(order)
        if f and n and f[0] > 1e-12 * total:
            aic = 2 * (order[0] + order[2] + 1) + n * (np.log(2 * np.pi * f[0] / n) + 1) + np.log(g).sum()
            if chosen is None or round(aic, 9) < round(chosen[1], 9):
                chosen = (str(order), aic, f)
    if chosen is None:
        chosen = (str(arima.FALLBACK_ORDER), None, best(arima.FALLBACK_ORDER))
    sse, a, b, t, e = chosen[2]
    weights = [1.0, a + t]
    while len(weights) < late + steps:
        weights.append(a * weights[-1] + b * weights[-2])
    c, path = list(lagged(d, 0)[-1:]) + list(lagged(d, 1)[-1:]) or [0.0, 0.0], []
    c = (c + [0.0, 0.0])[:2]
    for k in range(late + steps):
        move = a * c[0] + b * c[1] + (t * e if k == 0 else 0)
        c, level = [move, c[0]], None if level is None else level + move
        variance = (np.cumsum(weights)[: k + 1] ** 2).sum() * sse / n if n else None
        path.append((level, variance))
    return chosen[0], chosen[1], path[late:]


def test_orders_and_paths_equal_dense_least_squares(spark):
    rng = np.random.default_rng(11)
    rows = [[100, 110, 120, 118, 131], [5, 5, 5], [], [None, None], [7], [3, None], [1, 2], [1, 2, 4], [None, 1, None, 2, 4, None, None], [0, 0, 3, 5, 9]]
    for size in (4, 6, 9, 15, 40):
        for kind in range(4):
            noise = rng.normal(size=size)
            change = noise.copy()
            for i in range(1, size):
                change[i] += (0.8, -0.6, 0.0, 0.5)[kind] * change[i - 1] + (0.0, 0.0, 0.7, 0.0)[kind] * noise[i - 1]
                change[i] -= 0.8 * change[i - 2] if kind == 3 and i > 1 else 0
            levels = list(50 + 10 * change.cumsum())
            rows.append(levels)
            rows.append([None if rng.random() < 0.25 else v for v in levels])
    seen = set()
    for row, got in zip(rows, _fits(spark, rows)):
        order, aic, path = _brute(row, 3)
        assert got["order"] == order and (got["aic"] is None) == (aic is None)
        assert aic is None or got["aic"] == pytest.approx(aic, rel=1e-9)
        assert len(got["path"]) == 3
        for mine, (level, variance) in zip(got["path"], path):
            assert (mine["level"] is None) == (level is None) and (mine["variance"] is None) == (variance is None)
            assert level is None or mine["level"] == pytest.approx(level, rel=1e-7)
            assert variance is None or mine["variance"] == pytest.approx(variance, rel=1e-7, abs=1e-9)
        seen.add(order)
    assert seen == {str(o) for o in arima.ORDER_GRID}


def test_a_persistent_change_is_carried_on(spark):
    change = [10 * 0.8**i for i in range(12)]
    (got,) = _fits(spark, [list(np.cumsum(change))], steps=2, orders=((0, 1, 0), (1, 1, 0)))
    assert got["order"] == "(1, 1, 0)"
    assert got["path"][0]["level"] == pytest.approx(sum(change) + 0.8 * change[-1])


def test_infinity_is_no_observation_and_other_orders_are_refused(spark):
    plain, odd = _fits(spark, [[1, 2, None, 5], [1, 2, float("inf"), 5]])
    assert plain[2:] == odd[2:]
    with pytest.raises(ValueError, match="unsupported"):
        arima.with_fit(_series(spark, [[1]]), "x", 1, orders=((3, 1, 0),))


def test_arima_held_to_the_random_walk(annual):
    walk = forecast_random_walk(annual, HORIZON, model_name="ARIMA")
    held = arima.forecast_arima(annual, horizon=HORIZON, orders=((0, 1, 0),))
    key = ["corridor_id", "forecast_type", "year"]
    for a, b in zip(walk.orderBy(*key).collect(), held.orderBy(*key).collect()):
        assert a[:6] == b[:6] and a[6:] == pytest.approx(b[6:])


def test_arima_table_and_settings(annual):
    fitted = arima.fit_arima(annual, HORIZON, partitions=2)
    assert fitted.count() == 8
    row = fitted.where("corridor_id = 1 AND forecast_type = 'holdout'").first()
    # Exact log-likelihood of a random walk: k = 1 and the mean squared change as variance.
    assert (row["training_rows"], row["full_rows"]) == (7, 8)
    assert row["lower_bound"] < row["prediction"] < row["upper_bound"]
    assert conform(fitted).columns == list(FORECAST_COLUMNS)


def test_random_walk_aic(spark):
    changes = np.diff([100.0, 110.0, 120.0, 118.0, 131.0])
    (got,) = _fits(spark, [[100, 110, 120, 118, 131]], orders=((0, 1, 0),))
    assert got["aic"] == pytest.approx(2 + len(changes) * (np.log(2 * np.pi * (changes**2).mean()) + 1))


def test_backtest_predicts_each_year_from_those_before(spark, annual):
    rows = {(r.corridor_id, r.test_year): r for r in arima.backtest_arima(annual, min_train=4).collect()}
    assert sorted(y for c, y in rows if c == 1) == [2021, 2022, 2023, 2024]
    for (corridor, year), row in rows.items():
        earlier = annual.where((F.col("corridor_id") == corridor) & (F.col("year") < year)).orderBy("year")
        assert row.prediction == pytest.approx(_brute([r.total_tons for r in earlier.collect()], 1)[2][0][0])
        assert row.train_size == year - 2017


def test_series_are_dated_by_the_first_of_january(annual):
    row = dated(annual).where("corridor_id = 1 AND year = 2018").first()
    assert str(row["ds"]) == "2018-01-01" and row["y"] == 110.0


def _yearly(spark, tons, gdp, first=2000):
    """A corridor and its macro table from tons and gdp by year; the other regressors never change."""
    rows = [(1, "c", first + i, t, 1.0, 1.0, g, 2.0, 3.0, 4.0, 5.0, 6.0) for i, (t, g) in enumerate(zip(tons, gdp))]
    macros = [(r[2], *r[6:]) for r in rows]
    return spark.createDataFrame(rows, ANNUAL_SCHEMA), spark.createDataFrame(macros, MACRO_ANNUAL_SCHEMA)


def _predicted(df, kind):
    return [(r["year"], r["prediction"], r["deviation"]) for r in df.where(F.col("forecast_type") == kind).orderBy("year").collect()]


def test_trend_follows_a_straight_line(spark):
    annual, macros = _yearly(spark, [50.0 + 3 * i for i in range(12)], [1.0] * 12)
    got = trend.fit_trend(annual, macros, (2012, 2015), holdout_year=2011)
    (now,), (near, far) = _predicted(got, "holdout"), _predicted(got, "future")
    assert now[1] == pytest.approx(83.0, rel=0.02)
    assert (near[1], far[1]) == (pytest.approx(86.0, rel=0.02), pytest.approx(95.0, rel=0.02))
    assert 0 < near[2] < far[2] < 5


def test_trend_uses_its_regressors(spark):
    gdp = np.random.default_rng(2).normal(size=24).tolist()
    annual, macros = _yearly(spark, [100 + 10 * g for g in gdp], gdp)
    (now,) = _predicted(trend.fit_trend(annual, macros, (2024,), holdout_year=2023), "holdout")
    assert now[1] == pytest.approx(100 + 10 * gdp[-1], rel=0.02)


def _dense_trend(x, y, target, last, noise_grid=trend.NOISE_GRID):
    """Gaussian-process form of the same model: covariances between rows instead of normal equations."""
    prior, scale, best = np.array(trend._prior(x.shape[1] - 5)), np.abs(y).max() or 1.0, None
    for q in noise_grid:
        cov = (x * prior) @ x.T + q * q * np.eye(len(y))
        weights = np.linalg.solve(cov, y / scale)
        evidence = -0.5 * (np.linalg.slogdet(cov)[1] + (y / scale) @ weights) - 0.5 * (q / 0.5) ** 2
        if best is None or evidence > best[0]:
            cross = (target * prior) @ x.T
            size = np.abs((prior[:, None] * x.T) @ weights)[2:5].mean()
            drift = 2 * size**2 * max(target[1] - last, 0) ** 3
            spread = (target**2 * prior).sum() - cross @ np.linalg.solve(cov, cross) + q * q + drift
            best = (evidence, scale * cross @ weights, scale * np.sqrt(spread))
    return best[1:]


def test_trend_equals_the_dense_model(spark):
    rng = np.random.default_rng(4)
    gdp, tons = rng.normal(size=14).tolist(), [None if i in (2, 9) else float(v) for i, v in enumerate(80 + rng.normal(size=14).cumsum() * 9)]
    annual, macros = _yearly(spark, tons, gdp)
    rows = trend.backtest_trend(annual, macros, 2013, min_train=3).collect()
    assert len(rows) == 11
    seen = np.array(gdp[:13])
    t = np.arange(14) / 13
    x = np.column_stack([np.ones(14), t, *[np.maximum(t - h, 0) for h in trend.HINGES], (np.array(gdp) - seen.mean()) / seen.std(ddof=1), np.zeros((14, 3))])
    y = np.array([np.nan if v is None else v for v in tons])
    for row in rows:
        cut = row.test_year - 2000
        keep = ~np.isnan(y[:cut])
        mean, _ = _dense_trend(x[:cut][keep], y[:cut][keep], x[cut], t[cut - 1])
        assert row.prediction == pytest.approx(mean, rel=1e-6)
    (now,) = _predicted(trend.fit_trend(annual, macros, (2014,), holdout_year=2013), "holdout")
    keep = ~np.isnan(y[:13])
    assert now[1:] == pytest.approx(_dense_trend(x[:13][keep], y[:13][keep], x[13], t[12]), rel=1e-6)


def test_trend_needs_two_complete_rows(spark):
    annual, macros = _yearly(spark, [None, 5.0, None, 7.0], [1.0, 2.0, None, 3.0])
    got = trend.fit_trend(annual, macros, (2004,), holdout_year=2003)
    assert _predicted(got, "holdout") == [(2003, None, None)]
    assert _predicted(got, "future")[0][1] is not None
    gapless = trend.fit_trend(annual.where("year < 2003"), macros, (2004,), holdout_year=2003)
    assert _predicted(gapless, "holdout") == [] and _predicted(gapless, "future") == [(2004, None, None)]


def test_trend_table(annual, macro_rows):
    got = trend.fit_trend(annual, macro_rows, HORIZON)
    assert got.count() == 8
    rows = {(r["corridor_id"], r["year"]): r for r in got.collect()}
    assert all(r["lower_bound"] < r["prediction"] < r["upper_bound"] for r in rows.values())
    again = {(r["corridor_id"], r["year"]): r for r in trend.fit_trend(annual.repartition(5), macro_rows, HORIZON).collect()}
    assert rows == again


@pytest.fixture(scope="module")
def pooled(spark, annual_rows):
    rows = [(c, f"c{c}", r[2], r[3] * c, r[4] * c, r[5] * c, *r[6:]) for c in (1, 2, 3, 4) for r in annual_rows[:8]]
    return enrich(spark.createDataFrame(rows, ANNUAL_SCHEMA))


def test_boosted_trees(spark, pooled, macro_rows):
    quick = boosted.BoostedSettings(trees=4, bins=16)
    forecasts, importance = boosted.forecast_boosted(pooled, macro_rows, HORIZON, settings=quick)
    rows = forecasts.collect()
    assert len(rows) == 4 * (1 + len(HORIZON)) and tuple(forecasts.columns) == FORECAST_COLUMNS
    complete = boosted.training_rows(pooled)
    assert complete.count() == 4 * 5
    span = complete.agg(F.min("total_tons"), F.max("total_tons")).first()
    for r in rows:
        low, high = (0.9, 1.1) if r["forecast_type"] == "holdout" else (0.96, 1.04)
        assert (r["lower_bound"], r["upper_bound"]) == pytest.approx((low * r["prediction"], high * r["prediction"]))
        if r["forecast_type"] == "future":
            # Sums of tree corrections may leave the training range, but only slightly.
            assert 0.9 * span[0] <= r["prediction"] <= 1.1 * span[1]
    shares = importance.collect()
    assert {r["feature"] for r in shares} == set(BOOSTED_FEATURES)
    assert sum(r["importance"] for r in shares) == pytest.approx(1.0)
    assert [r["importance"] for r in shares] == sorted((r["importance"] for r in shares), reverse=True)


def test_recursion_feeds_each_year_with_the_one_before(spark, pooled, macro_rows):
    model = boosted.fit_boosted(boosted.training_rows(pooled), boosted.BoostedSettings(trees=4, bins=16))
    state = boosted.latest_state(pooled)
    predicted = boosted.predict_recursively(model, state, macro_rows, HORIZON).collect()
    chained = {(r["corridor_id"], r["year"]): r["prediction"] for r in predicted}
    start = state.where("corridor_id = 2").first()
    lags = [start["tons_lag1"], start["tons_lag2"], start["tons_lag3"]]
    assert lags == [300.0, 278.0, 280.0] and start["value_ratio"] == pytest.approx(2.0)
    before = {"gdp": start["gdp_before"], "diesel_price": start["diesel_lag1"]}
    for year in HORIZON:
        macro = step_regressors(macro_rows, [year]).first().asDict()
        row = {**macro, "corridor_id": 2, "year": year, "tons_lag1": lags[0], "tons_lag2": lags[1], "tons_lag3": lags[2],
               "value_lag1": lags[0] * 2.0, "diesel_lag1": before["diesel_price"],
               "tons_rolling_mean_3yr": float(np.mean(lags)), "tons_rolling_std_3yr": float(np.std(lags, ddof=1)),
               "gdp_yoy_change": macro["gdp"] / before["gdp"] - 1,
               "diesel_yoy_change": macro["diesel_price"] / before["diesel_price"] - 1}
        from pyspark.ml.linalg import Vectors

        expected = model.predict(Vectors.dense([row[f] for f in BOOSTED_FEATURES]))
        assert chained[2, year] == pytest.approx(expected)
        lags = [expected, *lags[:2]]
        before = macro


def test_boosted_trees_without_complete_rows(spark, pooled, macro_rows):
    forecasts, importance = boosted.forecast_boosted(pooled.where("year < 2019"), macro_rows, HORIZON)
    assert forecasts.count() == 0 and importance.count() == 0 and tuple(forecasts.columns) == FORECAST_COLUMNS


def test_trees_as_a_table_predict_in_sql(spark, pooled, tmp_path):
    import duckdb

    model = boosted.fit_boosted(boosted.training_rows(pooled), boosted.BoostedSettings(trees=5, bins=16))
    nodes = boosted.model_nodes(model, str(tmp_path / "model"))
    nodes.write.parquet(str(tmp_path / "nodes"))
    rows = pooled.select("corridor_id", "year", *[f for f in BOOSTED_FEATURES if f not in ("corridor_id", "year")])
    rows.write.parquet(str(tmp_path / "rows"))
    missing_goes_right = ", ".join(f"coalesce({f}::DOUBLE, 'nan'::DOUBLE)" for f in BOOSTED_FEATURES)
    found = duckdb.sql(f"""
WITH RECURSIVE nodes AS (SELECT * FROM read_parquet('{tmp_path}/nodes/*.parquet')),
rows AS (SELECT corridor_id, year, [{missing_goes_right}] AS x FROM read_parquet('{tmp_path}/rows/*.parquet')),
walk AS (
  SELECT corridor_id, year, x, tree, 0 AS node FROM rows CROSS JOIN (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT w.corridor_id, w.year, x, w.tree, CASE WHEN x[feature + 1] <= threshold THEN "left" ELSE "right" END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE "left" >= 0)
SELECT w.corridor_id, w.year, sum(weight * value) FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE "left" < 0 GROUP BY ALL
""").fetchall()
    by_sql = {(c, y): v for c, y, v in found}
    walked = boosted.walk(pooled, nodes).collect()
    said = {(r["corridor_id"], r["year"]): r["prediction"] for r in model.transform(boosted._assemble(pooled, BOOSTED_FEATURES)).collect()}
    assert len(by_sql) == len(walked) == len(said) == 32
    for row in walked:
        key = row["corridor_id"], row["year"]
        assert row["walked"] == pytest.approx(said[key]) and by_sql[key] == pytest.approx(said[key])
    shares = {r["feature"]: r["importance"] for r in boosted.importance_from_nodes(nodes).collect()}
    assert [shares[f] for f in BOOSTED_FEATURES] == pytest.approx(list(model.featureImportances.toArray()))


def test_the_same_rows_are_fitted_once(spark, pooled, macro_rows, tmp_path, monkeypatch):
    fits = []
    fit = boosted.fit_boosted
    monkeypatch.setattr(boosted, "fit_boosted", lambda rows, settings: fits.append(1) or fit(rows, settings))
    options = {"settings": boosted.BoostedSettings(trees=2, bins=16), "store": str(tmp_path)}
    first = boosted.forecast_boosted(pooled, macro_rows, HORIZON, **options)[0].collect()
    again = boosted.forecast_boosted(pooled.repartition(3), macro_rows, HORIZON, **options)[0].collect()
    assert len(fits) == 2 and sorted(first) == sorted(again)
    boosted.forecast_boosted(pooled.where("corridor_id < 4"), macro_rows, HORIZON, **options)
    assert len(fits) == 4


def test_missing_inputs_do_not_cost_the_holdout_row(spark, pooled, macro_rows):
    gappy = pooled.withColumn("value_lag1", F.when(F.col("corridor_id") != 2, F.col("value_lag1")))
    forecasts, _ = boosted.forecast_boosted(gappy, macro_rows, HORIZON, settings=boosted.BoostedSettings(trees=2, bins=16))
    held = forecasts.where("forecast_type = 'holdout'").collect()
    assert sorted(r["corridor_id"] for r in held) == [1, 2, 3, 4] and all(r["prediction"] is not None for r in held)
