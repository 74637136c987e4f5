"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the star-schema tables.

Derived figures are rounded so that the last bits of floating-point sums, which depend on the order
of addition, cannot differ between engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import starschema as star
from ..forecast.arima import backtest_arima, fit_arima, forecast_arima
from ..forecast import boosted
from ..forecast.boosted import forecast_boosted, latest_state, training_rows
from ..forecast.common import conform, dated
from ..forecast.random_walk import forecast_random_walk
from ..forecast.trend import backtest_trend, forecast_trend
from ..functions.numeric import quantile_interval
from ..operators import evaluation, features, profiling, regressors, reporting, staging
from ..plans import pipeline
from ..schemas import BOOSTED_FEATURES, ENRICHED_FEATURES, IMPORTANCE_SCHEMA, SERIES_SCHEMA
from ..session import materialise, scratch_path, shared_dir
from ..sinks import tables as sinks
from ..sources import artifacts, flows, lookups, macros as macro_source, validation

Query = Callable[[SparkSession, str], DataFrame]

KEYS = ("corridor_id", "corridor_name", "year")
# Every kind in the events table.
EVENT_KINDS = ("click", "error", "purchase", "signup", "view")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.selectExpr(*[f"round({n}, {digits}) AS {n}" if t == "double" else f"`{n}`" for n, t in df.dtypes])


# --- layers ---------------------------------------------------------------------------------------


def stage_domestic(spark, sf_dir):
    return star.staged_flows(spark, sf_dir)


def stage_history(spark, sf_dir):
    return star.staged_history(spark, sf_dir)


def macro_annual_pivot(spark, sf_dir):
    return star.macros(spark, sf_dir)


def macro_daily_pivot_events(spark, sf_dir):
    return rounded(staging.macro_pivot(star.event_series(spark, sf_dir), star.EVENT_MAPPING, grain="day"))


def zone_to_state(spark, sf_dir):
    return staging.zone_to_state(star.zone_lookup(spark, sf_dir), star.state_lookup(spark))


def corridor_annual(spark, sf_dir):
    return star.annual(spark, sf_dir, star.zone_corridors(spark, sf_dir))


def corridor_annual_state(spark, sf_dir):
    return star.annual(spark, sf_dir, star.state_corridors(spark, sf_dir))


def corridor_annual_large_dimension(spark, sf_dir):
    """The totals alone, as they are summed per endpoint pair before any corridor is joined."""
    years = star.LAYOUT.annual_years
    columns = [p.format(year=y) for p in features.ANNUAL_MEASURES.values() for y in years]
    wide = features.totals_by_corridor(
        star.staged_flows(spark, sf_dir), star.zone_corridors(spark, sf_dir), columns
    )
    long = features.unpivot_years(wide, ("corridor_id", "corridor_name"), years, features.ANNUAL_MEASURES)
    return rounded(long, 2)


def corridor_annual_via_unpivot(spark, sf_dir):
    """The same totals by unpivoting every flow row first."""
    measures = features.ANNUAL_MEASURES
    lanes = star.zone_corridors(spark, sf_dir).withColumnsRenamed({"origin": "dms_orig", "destination": "dms_dest"})
    long = features.unpivot_years(
        star.staged_flows(spark, sf_dir), ("dms_orig", "dms_dest"), star.LAYOUT.annual_years, measures
    )
    return rounded(
        long.join(lanes, ["dms_orig", "dms_dest"]).groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in measures]), 2
    )


def corridor_history_state(spark, sf_dir):
    built = features.corridor_history(
        star.staged_history(spark, sf_dir),
        star.zone_corridors(spark, sf_dir),
        star.nation_states(spark, sf_dir),
        star.LAYOUT.history_years,
    )
    return rounded(built, 2)


def benchmark_band(spark, sf_dir):
    return features.benchmark_band(
        star.staged_flows(spark, sf_dir), star.zone_corridors(spark, sf_dir), star.LAYOUT.benchmark_years
    )


# --- features -------------------------------------------------------------------------------------


def feat_lags(spark, sf_dir):
    return features.add_lag_features(corridor_annual(spark, sf_dir)).select(*KEYS, *features.lag_features())


def feat_rolling(spark, sf_dir):
    built = features.add_rolling_features(corridor_annual(spark, sf_dir)).select(*KEYS, *features.rolling_features())
    return rounded(built)


def feat_yoy_padded(spark, sf_dir):
    built = features.add_economic_change_features(features.add_derived_features(corridor_annual(spark, sf_dir)))
    return rounded(built.select(*KEYS, "tons_yoy_change", "gdp_yoy_change", "diesel_yoy_change"))


def feat_ratios(spark, sf_dir):
    built = features.add_derived_features(corridor_annual(spark, sf_dir))
    return rounded(built.select(*KEYS, "value_per_ton", "tmiles_per_ton"))


def corridor_enriched(spark, sf_dir):
    return rounded(features.enrich(corridor_annual(spark, sf_dir)))


def feat_on_sparse_zone_pairs(spark, sf_dir):
    """Only the years a pair was active in, so that lags reach across missing years."""
    active = corridor_annual(spark, sf_dir).where(F.col("total_tons").isNotNull())
    return rounded(features.enrich(active).select(*KEYS, "total_tons", *ENRICHED_FEATURES))


def feat_calendar_windows(spark, sf_dir):
    """Lags and rolling figures over years instead of rows, the current year left out, on pairs with missing years."""
    active = corridor_annual(spark, sf_dir).where(F.col("total_tons").isNotNull())
    built = features.add_rolling_features(features.add_lag_features(active, calendar=True), calendar=True, current=False)
    return rounded(built.select(*KEYS, *features.lag_features(), *features.rolling_features()))


def table_replaced_whole(spark, sf_dir):
    """The annual table after a replacement whose job failed and one whose key was broken: as it was."""
    root = scratch_path(spark, "replaced")
    annual = corridor_annual(spark, sf_dir)
    sinks.replace_table(annual, root, "feature_corridor_annual")
    stored = sinks.read_table(spark, root, "feature_corridor_annual", star.LAYOUT)
    failing = stored.withColumn("total_tons", F.when(F.col("year") > 0, F.raise_error("broken input").cast("double")))
    for bad, error in ((failing, Exception), (stored.unionByName(stored), ValueError)):
        try:
            sinks.replace_table(bad, root, "feature_corridor_annual")
        except error:
            continue
        raise AssertionError("a broken table was stored")
    return rounded(sinks.read_table(spark, root, "feature_corridor_annual", star.LAYOUT))


def retrain_changed(spark, sf_dir):
    """Which corridors each model is trained for: at first, again over the same rows, and after the last tons of some changed."""
    root = scratch_path(spark, "retrain")
    known = star.macros(spark, sf_dir).where(F.col("year") <= star.HOLDOUT_YEAR)
    sinks.replace_table(known, root, "staged_macro_annual")
    sinks.replace_table(corridor_annual(spark, sf_dir), root, "feature_corridor_annual")

    def trained(name):
        state = pipeline.train_missing(spark, root, star.HORIZON, star.HOLDOUT_YEAR, models=pipeline.MODELS[:2])
        return state.withColumnRenamed("trained", name)

    first, again = trained("at_first"), trained("again")
    doubled = F.when((F.col("corridor_id") % 10 == 0) & (F.col("year") == star.HOLDOUT_YEAR), F.col("total_tons") * 2)
    annual = sinks.read_table(spark, root, "feature_corridor_annual", star.LAYOUT)
    sinks.replace_table(annual.withColumn("total_tons", F.coalesce(doubled, "total_tons")), root, "feature_corridor_annual")
    keys = ["model_name", "corridor_id"]
    return first.join(again, keys, "full_outer").join(trained("after_a_change"), keys, "full_outer")


def layer_row_counts(spark, sf_dir):
    """Raw tables stored, then both later layers rebuilt from what is stored."""
    root = scratch_path(spark, "layers")
    sinks.declare_tables(spark, root, star.LAYOUT)
    builds = [sinks.replace_table(df, root, name) for name, df in star.raw_layer(spark, sf_dir).items()]
    builds += pipeline.write_staged(spark, root, star.LAYOUT, star.MACRO_MAPPING)
    builds += pipeline.write_features(spark, root, star.zone_corridors(spark, sf_dir), star.LAYOUT)
    return spark.createDataFrame(builds, "table_name string, row_count bigint")


# --- sources and sinks ----------------------------------------------------------------------------


def load_flow_csv(spark, sf_dir):
    """The wide flow file written as CSV, then loaded through the strict typed reader."""
    source = scratch_path(spark, "flow-csv")
    sinks.write_csv(star.raw_flows(spark, sf_dir), source)
    target = scratch_path(spark, "raw-flows")
    flows.load_flows(spark, source, target, star.LAYOUT)
    return spark.read.parquet(target)


def load_history_csv(spark, sf_dir):
    source = scratch_path(spark, "history-csv")
    sinks.write_csv(star.raw_history(spark, sf_dir), source)
    target = scratch_path(spark, "raw-history")
    flows.load_history(spark, source, target, star.LAYOUT)
    return spark.read.parquet(target)


def corridor_rows(spark, sf_dir):
    """The corridor dimension that every join uses."""
    return star.zone_corridors(spark, sf_dir)


def ordered_scan(spark, sf_dir):
    """The annual table written in a total order of corridor and year, and read back with the place of each row."""
    path = scratch_path(spark, "ordered")
    sinks.write_ordered(corridor_annual(spark, sf_dir), path, ["corridor_id", "year"])
    return spark.read.parquet(path)


def score_table_ordered(spark, sf_dir):
    """Holdout scores written from the largest corridor totals to missing ones, with ranks, and read back."""
    annual = _stored_annual(spark, sf_dir)
    scores = evaluation.score_holdout(_forecasts(annual), annual, star.HOLDOUT_YEAR)
    path = scratch_path(spark, "scores")
    sinks.write_ordered(scores, path, ["mape", "corridor_id", "model_name"], "place")
    return rounded(spark.read.parquet(path))


def importance_file(spark, sf_dir):
    """A table of shares by the importance writer and its reader: the tons of each trade type."""
    lines = star.table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("feature")).agg(F.sum("l_quantity").alias("tons"))
    whole = star.table(spark, sf_dir, "lineitem").agg(F.sum("l_quantity")).first()[0]
    path = scratch_path(spark, "importance")
    sinks.write_importance(lines.select("feature", F.try_divide("tons", F.lit(whole)).alias("importance")), path)
    return rounded(artifacts.read_optional_csv(spark, path, IMPORTANCE_SCHEMA))


def feat_infinite_inputs(spark, sf_dir):
    """Ratios and changes over totals in which every third year is infinite: infinity counts as missing everywhere."""
    infinite = F.when(F.col("year") % 3 == 0, F.lit(float("inf")))
    annual = corridor_annual(spark, sf_dir).withColumns(
        {"total_value": F.coalesce(infinite, "total_value"), "gdp": F.coalesce(-infinite, "gdp")}
    )
    built = features.add_economic_change_features(features.add_derived_features(annual))
    return rounded(built.select(*KEYS, "total_value", "gdp", "value_per_ton", "gdp_yoy_change"))


def profile_files(spark, sf_dir):
    """Missing and distinct summaries of three data sets written as CSV files and read back."""
    root = scratch_path(spark, "profiles")
    stored = []
    for name in ("orders", "customer", "lineitem"):
        missing, unique = sinks.write_profiles(star.table(spark, sf_dir, name), root, name)
        read = spark.read.option("header", True)
        both = read.csv(missing).join(read.csv(unique), "column")
        stored.append(both.selectExpr(f"'{name}' AS table_name", "column", "CAST(missing_count AS BIGINT) AS missing_count", "CAST(n_unique AS BIGINT) AS n_unique"))
    return reduce(DataFrame.unionByName, stored)


def load_validation(spark, sf_dir):
    row = validation.replace_checked(star.raw_flows(spark, sf_dir), scratch_path(spark, "validated"), "raw_flows")
    return spark.createDataFrame([row], "target string, sent bigint, stored bigint")


def series_replace(spark, sf_dir):
    """All series loaded, then one of them pulled again with doubled values: the others stay. Ids begin with zeros."""
    path = scratch_path(spark, "macro-series")
    first = macro_source.normalise_series(star.macro_pull(spark, sf_dir))
    first = first.withColumn("series_id", F.concat(F.lit("00"), F.substring("series_id", 1, 1)))
    macro_source.write_series(first, path)
    again = first.where(F.col("series_id") == "001").withColumn("value", F.col("value") * 2)
    macro_source.replace_series(again, path, requested=1)
    return macro_source.read_series(spark, path)


def series_combine(spark, sf_dir):
    """The series of every kind of event as one table, joined by a pull that brought nothing."""
    events = star.table(spark, sf_dir, "events").select(F.col("ts").alias("date"), "value", "event_type")
    pulls = {kind: events.where(F.col("event_type") == kind) for kind in (*EVENT_KINDS, "nothing of the kind")}
    return macro_source.combine_series(spark, pulls)


def lookup_normalise(spark, sf_dir):
    """Customers presented as a zone tab of the lookup workbook."""
    zones = star.zone_lookup(spark, sf_dir).select(
        F.lit("unused").alias("Notes"),
        F.col("long_description").alias("Long Description"),
        F.col("short_description").alias("Short Description"),
        F.col("numeric_label").cast("string").alias("Numeric Label"),
    )
    return lookups.normalise_tab(zones, "raw_zones")


def lookup_load(spark, sf_dir):
    """All tabs of the lookup workbook loaded and read back."""
    root = scratch_path(spark, "lookups")

    def tab(table, key, text):
        return star.table(spark, sf_dir, table).select(F.col(key).alias("Numeric Label"), F.col(text).alias("Description"))

    nations, regions = tab("nation", "n_nationkey", "n_name"), tab("region", "r_regionkey", "r_name")
    zones = star.zone_lookup(spark, sf_dir).withColumnsRenamed(
        {c: lookups.HEADINGS[c] for c in ("numeric_label", "short_description", "long_description")}
    )
    tables = lookups.normalise_tabs(
        {
            "State": nations,
            "FAF Zone (Domestic)": zones,
            "Commodity (SCTG2)": tab("customer", "c_custkey", "c_name"),
            "Mode": regions,
            "Trade Type": tab("supplier", "s_suppkey", "s_name"),
            "Distance Band": nations.union(regions),
        }
    )
    lookups.load_lookups(tables, root)
    stored = [
        spark.read.schema(df.schema).parquet(f"{root}/{name}").select(
            F.lit(name).alias("table_name"), "numeric_label", F.col(df.columns[-1]).alias("description")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, stored)


# --- regressors -----------------------------------------------------------------------------------


def macro_extrapolate(spark, sf_dir):
    """Tons of every nation pair carried forward; pairs with gaps or one year included."""
    series = corridor_annual(spark, sf_dir).select("corridor_id", "year", F.col("total_tons").alias("value"))
    return regressors.extrapolate(series, (2000, 2001, 2002, 2004), key="corridor_id")


def future_regressors(spark, sf_dir):
    known = star.macros(spark, sf_dir).where(F.col("year") <= star.HOLDOUT_YEAR)
    built = regressors.future_regressors(star.zone_corridors(spark, sf_dir), known, star.HORIZON)
    return rounded(built, 4)


def step_regressors(spark, sf_dir):
    """Years with a macro row keep it, here 2000 and the incomplete 2001."""
    return rounded(regressors.step_regressors(star.macros(spark, sf_dir), (2000, 2001, *star.HORIZON)), 4)


# --- forecasts ------------------------------------------------------------------------------------


def _stored_annual(spark, sf_dir):
    # Read several times below: computed once into the shared folder.
    return materialise(corridor_annual(spark, sf_dir))


def _random_walk(annual):
    return forecast_random_walk(annual, star.HORIZON, star.HOLDOUT_YEAR)


def forecast_random_walk_query(spark, sf_dir):
    return rounded(_random_walk(corridor_annual(spark, sf_dir)), 4)


def forecast_arima_fixed_order(spark, sf_dir):
    """The ARIMA fitter held to order (0, 1, 0), which must equal the random walk."""
    built = forecast_arima(
        corridor_annual(spark, sf_dir), horizon=star.HORIZON, holdout_year=star.HOLDOUT_YEAR, orders=((0, 1, 0),)
    )
    return rounded(built, 4)


def forecast_arima_query(spark, sf_dir):
    return rounded(forecast_arima(corridor_annual(spark, sf_dir), horizon=star.HORIZON, holdout_year=star.HOLDOUT_YEAR), 4)


def arima_orders(spark, sf_dir):
    """Order, AIC and row counts behind the holdout forecast of each corridor."""
    fitted = fit_arima(corridor_annual(spark, sf_dir), horizon=star.HORIZON, holdout_year=star.HOLDOUT_YEAR)
    return rounded(
        fitted.where(F.col("forecast_type") == "holdout").select(
            "corridor_id", "corridor_name", "model_order", "aic", "training_rows", "full_rows"
        )
    )


def dated_series(spark, sf_dir):
    """Each year of a corridor as the date and target a model reads."""
    return dated(corridor_annual(spark, sf_dir)).select("corridor_id", "ds", "y")


def forecast_trend_query(spark, sf_dir):
    known = star.macros(spark, sf_dir).where(F.col("year") <= star.HOLDOUT_YEAR)
    built = forecast_trend(
        corridor_annual(spark, sf_dir), known, horizon=star.HORIZON, holdout_year=star.HOLDOUT_YEAR
    )
    # small systems close to singular: the last digits of a solution differ between engines
    return rounded(built, 1)


def _boosted_inputs(spark, sf_dir):
    known = star.macros(spark, sf_dir).where(F.col("year") <= star.HOLDOUT_YEAR)
    return features.enrich(_stored_annual(spark, sf_dir)), known, f"{shared_dir(spark)}/models"


def _boosted(spark, sf_dir):
    """Forecasts and importance of the pooled model, which is fitted only if the same rows have not been."""
    enriched, known, store = _boosted_inputs(spark, sf_dir)
    return forecast_boosted(enriched, known, star.HORIZON, star.HOLDOUT_YEAR, store=store)


def forecast_boosted_query(spark, sf_dir):
    return _boosted(spark, sf_dir)[0]


def boosted_importance(spark, sf_dir):
    return _boosted(spark, sf_dir)[1]


def _boosted_nodes(spark, sf_dir):
    enriched, known, store = _boosted_inputs(spark, sf_dir)
    rows = materialise(enriched)
    early, full = boosted.fitted_models(rows, star.HOLDOUT_YEAR, boosted.BoostedSettings(), store)
    return rows, known, early, full


def boosted_nodes(spark, sf_dir):
    """The trees of the pooled model as a table."""
    return boosted.model_nodes(_boosted_nodes(spark, sf_dir)[3], scratch_path(spark, "trees"))


def boosted_walk(spark, sf_dir):
    """Every forecast of the pooled model against a walk over the stored trees: how far apart, and how wide the bounds are."""
    rows, known, early, full = _boosted_nodes(spark, sf_dir)
    stored = {kind: materialise(boosted.model_nodes(model, scratch_path(spark, "trees"))) for kind, model in (("holdout", early), ("future", full))}
    walked = boosted.walk(rows.where(F.col("year") == star.HOLDOUT_YEAR), stored["holdout"]).select("corridor_id", F.lit("holdout").alias("forecast_type"), "year", "walked")
    state = boosted.latest_state(rows)
    for year in star.HORIZON:
        inputs = boosted.step_inputs(state, year, known)
        step = materialise(boosted.walk(inputs, stored["future"]))
        walked = walked.unionByName(step.select("corridor_id", F.lit("future").alias("forecast_type"), "year", "walked"))
        state = boosted.step_state(step, "walked")
    forecasts = _boosted(spark, sf_dir)[0]
    size = F.greatest(F.abs("prediction"), F.lit(1.0))
    return rounded(
        forecasts.join(walked, ["corridor_id", "forecast_type", "year"], "full_outer").select(
            "corridor_id", "forecast_type", "year",
            F.abs(F.round((F.col("walked") - F.col("prediction")) / size, 6)).alias("apart"),
            ((F.col("upper_bound") - F.col("lower_bound")) / F.abs("prediction")).alias("width"),
        )
    )


def boosted_importance_from_nodes(spark, sf_dir):
    """The importance each feature has in the stored trees against what the model says."""
    _, _, _, full = _boosted_nodes(spark, sf_dir)
    nodes = boosted.model_nodes(full, scratch_path(spark, "trees"))
    says = boosted.feature_importance(spark, full).withColumnRenamed("importance", "said")
    both = boosted.importance_from_nodes(nodes).join(says, "feature", "full_outer")
    return both.select("feature", F.abs(F.round(F.col("importance") - F.col("said"), 6)).alias("apart"))


def top_features(spark, sf_dir):
    return reporting.top_features(boosted_importance(spark, sf_dir), 10)


def boosted_training_rows(spark, sf_dir):
    """Rows complete in every model input."""
    complete = training_rows(features.enrich(corridor_annual(spark, sf_dir)))
    return rounded(complete.select(*BOOSTED_FEATURES, "total_tons"))


def boosted_state(spark, sf_dir):
    """What the recursion starts from: the last tons and macro values of a corridor and its mean value of a ton."""
    return rounded(latest_state(features.enrich(corridor_annual(spark, sf_dir))), 4)


def interval_quantile(spark, sf_dir):
    grouped = corridor_annual(spark, sf_dir).groupBy("corridor_id").agg(F.collect_list("total_tons").alias("tons"))
    low, high = quantile_interval("tons", 0.8)
    return rounded(grouped.select("corridor_id", low.alias("lower_bound"), high.alias("upper_bound")))


# --- evaluation -----------------------------------------------------------------------------------


def _straight_line(annual):
    """A second set of forecasts to compare with: the straight line through the last two years."""
    train = annual.where(F.col("year") < star.HOLDOUT_YEAR)
    names = annual.select("corridor_id", "corridor_name").distinct()

    def line(source, kind, years):
        series = source.select("corridor_id", "year", F.col("total_tons").alias("value"))
        return regressors.extrapolate(series, years, key="corridor_id").select(
            "corridor_id", "year", F.lit(kind).alias("forecast_type"), F.col("value").alias("prediction")
        )

    both = line(train, "holdout", [star.HOLDOUT_YEAR]).unionByName(line(annual, "future", star.HORIZON))
    return conform(
        both.join(names, "corridor_id").withColumns(
            {
                "model_name": F.lit("StraightLine"),
                "training_strategy": F.lit("leave_last_year_out"),
                "lower_bound": F.col("prediction") * 0.75,
                "upper_bound": F.col("prediction") * 1.25,
            }
        )
    )


def _forecasts(annual):
    return _random_walk(annual).unionByName(_straight_line(annual))


def _annual_and_band(spark, sf_dir):
    """Both feature tables from one pass over the flows."""
    annual, band = features.annual_and_band(
        star.staged_flows(spark, sf_dir),
        star.zone_corridors(spark, sf_dir),
        star.macros(spark, sf_dir),
        star.LAYOUT.annual_years,
        star.LAYOUT.benchmark_years,
    )
    return annual.withColumn("total_value", F.round("total_value", 2)), band


def _comparison(spark, sf_dir):
    annual, band = _annual_and_band(spark, sf_dir)
    scores = evaluation.evaluate_all(_forecasts(annual), annual, band, star.HOLDOUT_YEAR, star.BENCHMARK_YEAR)
    return scores["model_comparison"]


def expanding_splits(spark, sf_dir):
    active = corridor_annual(spark, sf_dir).where(F.col("total_tons").isNotNull())
    splits = evaluation.expanding_splits(active, min_train=4)
    return splits.select("corridor_id", F.array_join("train_years", ",").alias("train_years"), "test_year")


def expanding_backtest_random_walk(spark, sf_dir):
    return evaluation.backtest_random_walk(corridor_annual(spark, sf_dir), min_train=3)


def backtest_metrics(spark, sf_dir):
    tested = evaluation.backtest_random_walk(corridor_annual(spark, sf_dir), min_train=3)
    return rounded(evaluation.regression_metrics(tested, by=["corridor_id", "corridor_name"]))


def backtest_models(spark, sf_dir):
    """Errors of three model families over all expanding windows of every corridor."""
    annual = _stored_annual(spark, sf_dir)
    known = star.macros(spark, sf_dir).where(F.col("year") <= star.HOLDOUT_YEAR)
    tested = {
        "RandomWalk": evaluation.backtest_random_walk(annual, min_train=3),
        "ARIMA": backtest_arima(annual, min_train=3),
        "TrendRegression": backtest_trend(annual, known, star.HOLDOUT_YEAR, min_train=3),
    }
    rows = reduce(DataFrame.unionByName, [df.withColumn("model_name", F.lit(name)) for name, df in tested.items()])
    scores = evaluation.regression_metrics(rows, by=["model_name", "corridor_id", "corridor_name"])
    solved = F.col("model_name") == "TrendRegression"
    return scores.withColumns({m: F.when(solved, F.round(m, 1)).otherwise(F.round(m, 5)) for m in ("mape", "rmse", "mae")})


def holdout_scores(spark, sf_dir):
    annual = _stored_annual(spark, sf_dir)
    return rounded(evaluation.score_holdout(_forecasts(annual), annual, star.HOLDOUT_YEAR))


def benchmark_scores(spark, sf_dir):
    annual, band = _annual_and_band(spark, sf_dir)
    return rounded(evaluation.score_benchmark(_forecasts(annual), band, star.BENCHMARK_YEAR))


def model_comparison(spark, sf_dir):
    return rounded(_comparison(spark, sf_dir))


def metrics_by_model(spark, sf_dir):
    annual = _stored_annual(spark, sf_dir)
    scored = evaluation.score_holdout(_forecasts(annual), annual, star.HOLDOUT_YEAR)
    return rounded(evaluation.regression_metrics(scored, by=["model_name"]))


def full_evaluation(spark, sf_dir):
    """Every model trained for every pair of nations, scored and compared."""
    annual, band = _annual_and_band(spark, sf_dir)
    known = star.macros(spark, sf_dir).where(F.col("year") <= star.HOLDOUT_YEAR)
    trained = pipeline.train_all(annual, features.enrich(annual), known, star.HORIZON, star.HOLDOUT_YEAR)
    scores = evaluation.evaluate_all(trained.forecasts, annual, band, star.HOLDOUT_YEAR, star.BENCHMARK_YEAR)
    return scores["model_comparison"]


# --- run log and stored forecasts -----------------------------------------------------------------


def forecast_store(spark, sf_dir):
    """Forecasts written by model, one model replaced, and everything read back."""
    annual = _stored_annual(spark, sf_dir)
    path = scratch_path(spark, "forecasts")
    sinks.write_forecasts(_forecasts(annual), path)
    sinks.write_forecasts(_straight_line(annual), path)
    return rounded(artifacts.read_forecasts(spark, path), 4)


def forecast_csv_scan(spark, sf_dir):
    """Forecast files of two models found by one pattern."""
    annual = _stored_annual(spark, sf_dir)
    root = scratch_path(spark, "forecast-csv")
    sinks.write_csv(_random_walk(annual), f"{root}/walk_forecasts.csv")
    sinks.write_csv(_straight_line(annual), f"{root}/line_forecasts.csv")
    return rounded(artifacts.read_forecast_csvs(spark, f"{root}/*_forecasts.csv"), 4)


def run_log_flat(spark, sf_dir):
    annual = _stored_annual(spark, sf_dir)
    scores = evaluation.score_holdout(_forecasts(annual), annual, star.HOLDOUT_YEAR)
    settings = scores.select(
        "corridor_id", "model_name", F.create_map(F.lit("test_year"), F.col("year").cast("string")).alias("settings")
    )
    path = scratch_path(spark, "runs")
    sinks.append_runs(sinks.run_rows(scores, settings), path)
    stored = spark.read.parquet(path)
    flat = artifacts.flatten_runs(stored.where(F.col("params")["test_year"] == str(star.HOLDOUT_YEAR)))
    return rounded(flat.drop("run_id"))


def metrics_json(spark, sf_dir):
    annual = _stored_annual(spark, sf_dir)
    path = scratch_path(spark, "metrics")
    sinks.write_metrics_json(evaluation.score_holdout(_random_walk(annual), annual, star.HOLDOUT_YEAR), path)
    stored = spark.read.schema("corridor_id int, mape double, rmse double, mae double, model_name string").json(path)
    return rounded(stored)


def optional_tables(spark, sf_dir):
    """A table that was written and one that never was, read the same way."""
    root = scratch_path(spark, "optional")
    sinks.replace_table(macro_source.normalise_series(star.macro_pull(spark, sf_dir)), root, "present")

    def counted(name):
        stored = artifacts.read_optional(spark, f"{root}/{name}", SERIES_SCHEMA)
        return stored.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))

    return counted("present").unionByName(counted("absent"))


# --- reports --------------------------------------------------------------------------------------


def kpi_latest_year(spark, sf_dir):
    active = corridor_annual(spark, sf_dir).where(F.col("total_tons").isNotNull())
    return rounded(reporting.latest_figures(active))


def best_model(spark, sf_dir):
    return rounded(reporting.best_model(_comparison(spark, sf_dir)))


def rmse_matrix(spark, sf_dir):
    return rounded(reporting.rmse_matrix(_comparison(spark, sf_dir), ["RandomWalk", "StraightLine"]))


def score_bars(spark, sf_dir):
    return rounded(reporting.score_bars(_comparison(spark, sf_dir), "pct_deviation_vs_bts"))


def selected_rows(spark, sf_dir):
    chosen = reporting.select_rows(
        _forecasts(_stored_annual(spark, sf_dir)), corridors=["NATION_20_to_NATION_11", "NATION_18_to_NATION_19"], models=["RandomWalk"]
    )
    return rounded(reporting.forecast_rows(chosen), 4)


def corridor_names(spark, sf_dir):
    return reporting.corridor_names(corridor_annual(spark, sf_dir))


def model_names(spark, sf_dir):
    return reporting.model_names(_forecasts(_stored_annual(spark, sf_dir)))


def chart_feed(spark, sf_dir):
    annual, band = _annual_and_band(spark, sf_dir)
    return rounded(reporting.chart_feed(annual, _forecasts(annual), band), 4)


# --- profiles -------------------------------------------------------------------------------------


def profile_shape(spark, sf_dir):
    return profiling.profile_shape(star.table(spark, sf_dir, "lineitem"))


def profile_first_rows(spark, sf_dir):
    return profiling.first_rows(star.table(spark, sf_dir, "orders"), ["o_orderkey"])


def profile_last_rows(spark, sf_dir):
    return profiling.last_rows(star.table(spark, sf_dir, "orders"), ["o_orderkey"])


def profile_missing(spark, sf_dir):
    return rounded(profiling.profile_missing(star.raw_flows(spark, sf_dir)))


def profile_missing_only(spark, sf_dir):
    codes = star.raw_flows(spark, sf_dir).select("fr_orig", "fr_dest", "dms_orig", "trade_type")
    return rounded(profiling.profile_missing(codes, only_missing=True))


def profile_duplicates(spark, sf_dir):
    """Repeated rows of the table as it is, and how many of its items are alike but for order and line."""
    lines = star.table(spark, sf_dir, "lineitem")
    alike = lines.select("l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    return profiling.profile_duplicates(lines).select(
        F.lit("all columns").alias("compared"), "duplicate_rows"
    ).unionByName(profiling.profile_duplicates(alike).select(F.lit("item").alias("compared"), "duplicate_rows"))


def profile_distinct(spark, sf_dir):
    return profiling.profile_distinct(star.table(spark, sf_dir, "lineitem"))


def profile_numeric(spark, sf_dir):
    return rounded(profiling.profile_numeric(star.table(spark, sf_dir, "lineitem")), 4)


def profile_numeric_large(spark, sf_dir):
    """The summary of the orders, whose keys are all different and whose prices nearly so."""
    return rounded(profiling.profile_numeric(star.table(spark, sf_dir, "orders")), 4)


def profile_categorical(spark, sf_dir):
    return profiling.profile_categorical(star.table(spark, sf_dir, "orders"))


QUERIES: dict[str, Query] = {
    "stage_domestic": stage_domestic,
    "stage_history": stage_history,
    "macro_annual_pivot": macro_annual_pivot,
    "macro_daily_pivot_events": macro_daily_pivot_events,
    "zone_to_state": zone_to_state,
    "corridor_annual": corridor_annual,
    "corridor_annual_state": corridor_annual_state,
    "corridor_annual_large_dimension": corridor_annual_large_dimension,
    "corridor_annual_via_unpivot": corridor_annual_via_unpivot,
    "corridor_history_state": corridor_history_state,
    "benchmark_band": benchmark_band,
    "layer_row_counts": layer_row_counts,
    "feat_lags": feat_lags,
    "feat_rolling": feat_rolling,
    "feat_yoy_padded": feat_yoy_padded,
    "feat_ratios": feat_ratios,
    "corridor_enriched": corridor_enriched,
    "feat_on_sparse_zone_pairs": feat_on_sparse_zone_pairs,
    "feat_calendar_windows": feat_calendar_windows,
    "table_replaced_whole": table_replaced_whole,
    "retrain_changed": retrain_changed,
    "load_flow_csv": load_flow_csv,
    "load_history_csv": load_history_csv,
    "corridor_rows": corridor_rows,
    "ordered_scan": ordered_scan,
    "score_table_ordered": score_table_ordered,
    "importance_file": importance_file,
    "feat_infinite_inputs": feat_infinite_inputs,
    "profile_files": profile_files,
    "load_validation": load_validation,
    "series_replace": series_replace,
    "series_combine": series_combine,
    "lookup_normalise": lookup_normalise,
    "lookup_load": lookup_load,
    "macro_extrapolate": macro_extrapolate,
    "future_regressors": future_regressors,
    "step_regressors": step_regressors,
    "forecast_random_walk": forecast_random_walk_query,
    "forecast_arima_fixed_order": forecast_arima_fixed_order,
    "forecast_arima": forecast_arima_query,
    "arima_orders": arima_orders,
    "dated_series": dated_series,
    "forecast_trend": forecast_trend_query,
    "forecast_boosted": forecast_boosted_query,
    "boosted_importance": boosted_importance,
    "boosted_nodes": boosted_nodes,
    "boosted_walk": boosted_walk,
    "boosted_importance_from_nodes": boosted_importance_from_nodes,
    "boosted_training_rows": boosted_training_rows,
    "boosted_state": boosted_state,
    "top_features": top_features,
    "interval_quantile": interval_quantile,
    "expanding_splits": expanding_splits,
    "expanding_backtest_random_walk": expanding_backtest_random_walk,
    "backtest_metrics": backtest_metrics,
    "backtest_models": backtest_models,
    "holdout_scores": holdout_scores,
    "benchmark_scores": benchmark_scores,
    "model_comparison": model_comparison,
    "metrics_by_model": metrics_by_model,
    "full_evaluation": full_evaluation,
    "forecast_store": forecast_store,
    "forecast_csv_scan": forecast_csv_scan,
    "run_log_flat": run_log_flat,
    "metrics_json": metrics_json,
    "optional_tables": optional_tables,
    "kpi_latest_year": kpi_latest_year,
    "best_model": best_model,
    "rmse_matrix": rmse_matrix,
    "score_bars": score_bars,
    "selected_rows": selected_rows,
    "corridor_names": corridor_names,
    "model_names": model_names,
    "chart_feed": chart_feed,
    "profile_shape": profile_shape,
    "profile_first_rows": profile_first_rows,
    "profile_last_rows": profile_last_rows,
    "profile_missing": profile_missing,
    "profile_missing_only": profile_missing_only,
    "profile_duplicates": profile_duplicates,
    "profile_distinct": profile_distinct,
    "profile_numeric": profile_numeric,
    "profile_numeric_large": profile_numeric_large,
    "profile_categorical": profile_categorical,
}
