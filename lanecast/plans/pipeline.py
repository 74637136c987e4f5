"""The layers in order: raw, staged, feature, forecasts, scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..forecast.arima import fit_arima
from ..forecast.boosted import BoostedSettings, forecast_boosted, training_rows
from ..forecast.common import conform
from ..forecast.trend import fit_trend
from ..operators.evaluation import evaluate_all
from ..operators.features import annual_and_band, corridor_history, enrich
from ..operators.staging import macro_pivot, stage_flows, stage_history, zone_to_state
from ..schemas import BENCHMARK_YEAR, FITS_SCHEMA, HOLDOUT_YEAR, HORIZON, MACRO_SERIES, SETTINGS_SCHEMA, TREND_REGRESSORS, FlowLayout
from ..session import materialise
from ..sinks.tables import (
    append_runs,
    read_table,
    replace_table,
    run_rows,
    write_forecasts,
    write_importance,
    write_metrics_json,
)
from ..sources.artifacts import read_forecasts, read_optional
from .retrain import fingerprints, with_changes


@dataclass(frozen=True)
class Training:
    forecasts: DataFrame
    importance: DataFrame
    settings: DataFrame


def build_staged(
    raw: dict[str, DataFrame], layout: FlowLayout = FlowLayout(), mapping: dict[str, str] = MACRO_SERIES
) -> dict[str, DataFrame]:
    return {
        "staged_flows": stage_flows(raw["raw_flows"], layout),
        "staged_flow_history": stage_history(raw["raw_flow_history"], layout),
        "staged_macro_annual": macro_pivot(raw["raw_macro_series"], mapping),
        "staged_zone_state": zone_to_state(raw["raw_zones"], raw["raw_states"]),
    }


def build_features(
    staged: dict[str, DataFrame], corridors: DataFrame, layout: FlowLayout = FlowLayout()
) -> dict[str, DataFrame]:
    annual, band = annual_and_band(
        staged["staged_flows"], corridors, staged["staged_macro_annual"], layout.annual_years, layout.benchmark_years
    )
    return {
        "feature_corridor_annual": annual,
        "feature_corridor_enriched": enrich(annual),
        "feature_corridor_history": corridor_history(
            staged["staged_flow_history"], corridors, staged["staged_zone_state"], layout.history_years
        ),
        "feature_benchmark": band,
    }


def train_all(
    annual: DataFrame,
    enriched: DataFrame,
    macros: DataFrame,
    horizon: Sequence[int] = HORIZON,
    holdout_year: int = HOLDOUT_YEAR,
    settings: BoostedSettings = BoostedSettings(),
) -> Training:
    """Train every model for every corridor. Each fit runs once, into the shared folder."""
    arima = materialise(fit_arima(annual, horizon, holdout_year))
    trend = materialise(fit_trend(annual, macros, horizon, holdout_year))
    boosted, importance = forecast_boosted(enriched, macros, horizon, holdout_year, settings)
    fits = [
        _series_settings(arima, "ARIMA"),
        _series_settings(trend, "TrendRegression"),
        _pooled_settings(boosted, enriched, holdout_year, settings),
    ]
    forecasts = conform(arima).unionByName(conform(trend)).unionByName(boosted)
    return Training(forecasts, importance, reduce(DataFrame.unionByName, fits))


def fit_settings(fitted: DataFrame, settings: dict[str, Column]) -> DataFrame:
    """The parameters of each holdout fit as a map, one row per corridor and model."""
    entries = [part for name, value in settings.items() for part in (F.lit(name), value.cast("string"))]
    return fitted.where(F.col("forecast_type") == "holdout").select(
        "corridor_id", "model_name", F.create_map(*entries).alias("settings")
    )


def write_staged(
    spark: SparkSession, root: str, layout: FlowLayout = FlowLayout(), mapping: dict[str, str] = MACRO_SERIES
) -> list[tuple[str, int]]:
    """Rebuild the staged tables from the raw tables below ``root``."""
    names = ("raw_flows", "raw_flow_history", "raw_macro_series", "raw_zones", "raw_states")
    staged = build_staged({name: read_table(spark, root, name, layout) for name in names}, layout, mapping)
    return [replace_table(df, root, name) for name, df in staged.items()]


def write_features(
    spark: SparkSession, root: str, corridors: DataFrame, layout: FlowLayout = FlowLayout()
) -> list[tuple[str, int]]:
    """Rebuild the feature tables from the staged tables below ``root``.

    The enriched table is derived from the stored annual table, so flows are summed once.
    """
    names = ("staged_flows", "staged_flow_history", "staged_macro_annual", "staged_zone_state")
    features = build_features({name: read_table(spark, root, name, layout) for name in names}, corridors, layout)
    builds = [replace_table(features["feature_corridor_annual"], root, "feature_corridor_annual")]
    features["feature_corridor_enriched"] = enrich(read_table(spark, root, "feature_corridor_annual", layout))
    others = [name for name in features if name != "feature_corridor_annual"]
    return builds + [replace_table(features[name], root, name) for name in others]


def train_and_store(
    spark: SparkSession,
    root: str,
    horizon: Sequence[int] = HORIZON,
    holdout_year: int = HOLDOUT_YEAR,
    settings: BoostedSettings = BoostedSettings(),
) -> int:
    """Train on the stored features and replace the stored forecasts, importance and fit settings."""
    annual = read_table(spark, root, "feature_corridor_annual")
    enriched = read_table(spark, root, "feature_corridor_enriched")
    macros = read_table(spark, root, "staged_macro_annual")
    trained = train_all(annual, enriched, macros, horizon, holdout_year, settings)
    write_importance(trained.importance, f"{root}/feature_importance")
    replace_table(trained.settings, root, "model_settings")
    written = write_forecasts(trained.forecasts, f"{root}/forecasts")
    replace_table(fingerprints(annual, macros, horizon, holdout_year, {m: repr(settings) for m in MODELS}), root, "model_fits")
    return written


#: The trained models; the last one is fitted to all corridors together.
MODELS = ("ARIMA", "TrendRegression", "BoostedTrees")


def train_missing(
    spark: SparkSession,
    root: str,
    horizon: Sequence[int] = HORIZON,
    holdout_year: int = HOLDOUT_YEAR,
    settings: BoostedSettings = BoostedSettings(),
    models: Sequence[str] = MODELS,
) -> DataFrame:
    """Train what the stored forecasts lack, and keep the rest: one row per model and corridor, with ``trained``.

    A corridor is trained again if any of its rows, the macros or the settings differ from those of its stored fit;
    the pooled model for all corridors if any has changed, come or gone. Forecasts of corridors that are gone go.
    Fingerprints are stored last, so a run that fails trains the same corridors again.
    """
    annual = read_table(spark, root, "feature_corridor_annual")
    macros = read_table(spark, root, "staged_macro_annual")
    stored = read_optional(spark, f"{root}/model_fits", FITS_SCHEMA)
    prints = materialise(fingerprints(annual, macros, horizon, holdout_year, {m: repr(settings) for m in models}))
    state = materialise(with_changes(prints, stored, pooled=MODELS[-1:]))
    gone = stored.where(F.col("model_name").isin(*models)).join(prints, ["model_name", "corridor_id"], "left_anti")
    touched = {r[0] for r in state.where("trained").select("model_name").union(gone.select("model_name")).distinct().collect()}
    if not touched:
        return state.select("model_name", "corridor_id", "trained")

    kept = state.where(~F.col("trained")).select("model_name", "corridor_id")
    settings_now = read_optional(spark, f"{root}/model_settings", SETTINGS_SCHEMA)
    fits = [settings_now.join(kept, ["model_name", "corridor_id"], "left_semi"), settings_now.where(~F.col("model_name").isin(*models))]
    try:
        forecasts = [read_forecasts(spark, f"{root}/forecasts").join(kept.where(F.col("model_name").isin(*touched)), ["model_name", "corridor_id"], "left_semi")]
    except FileNotFoundError:
        forecasts = []
    for model in [m for m in models if m in touched]:
        changed = state.where(F.col("trained") & (F.col("model_name") == model)).select("corridor_id")
        if changed.isEmpty():
            continue
        if model == MODELS[-1]:
            enriched = read_table(spark, root, "feature_corridor_enriched")
            rows, importance = forecast_boosted(enriched, macros, horizon, holdout_year, settings, store=f"{root}/models")
            write_importance(importance, f"{root}/feature_importance")
            fits.append(_pooled_settings(rows, enriched, holdout_year, settings))
        else:
            series = annual.join(changed, "corridor_id", "left_semi")
            rows = materialise(fit_arima(series, horizon, holdout_year) if model == "ARIMA" else fit_trend(series, macros, horizon, holdout_year))
            fits.append(_series_settings(rows, model))
        forecasts.append(conform(rows))
    columns = [F.col(name) for name in SETTINGS_SCHEMA.names]
    replace_table(reduce(DataFrame.unionByName, [f.select(*columns) for f in fits]), root, "model_settings")
    if forecasts:
        # what is kept comes from the very folders that are replaced
        write_forecasts(materialise(reduce(DataFrame.unionByName, forecasts)), f"{root}/forecasts")
    others = stored.where(~F.col("model_name").isin(*models))
    replace_table(others.unionByName(prints), root, "model_fits")
    return state.select("model_name", "corridor_id", "trained")


def _series_settings(fitted: DataFrame, model: str) -> DataFrame:
    own = {"order": F.col("model_order"), "aic": F.col("aic")} if model == "ARIMA" else {"regressors": F.lit(",".join(TREND_REGRESSORS))}
    return fit_settings(fitted, {**own, **{name: F.col(name) for name in ("training_rows", "full_rows")}})


def _pooled_settings(boosted: DataFrame, enriched: DataFrame, holdout_year: int, settings: BoostedSettings) -> DataFrame:
    pooled = training_rows(enriched).where(F.col("year") < holdout_year).count()
    return fit_settings(
        boosted,
        {
            "n_estimators": F.lit(settings.trees),
            "max_depth": F.lit(settings.depth),
            "learning_rate": F.lit(settings.rate),
            "pooled_training_rows": F.lit(pooled),
        },
    )


def evaluate_and_store(
    spark: SparkSession,
    root: str,
    holdout_year: int = HOLDOUT_YEAR,
    benchmark_year: int = BENCHMARK_YEAR,
    train_if_missing: bool = False,
    horizon: Sequence[int] = HORIZON,
    settings: BoostedSettings = BoostedSettings(),
) -> dict[str, DataFrame]:
    """Score the stored forecasts, store the scores and add them to the run log. ``train_if_missing`` first trains what is missing."""
    if train_if_missing:
        train_missing(spark, root, horizon, holdout_year, settings)
    forecasts = read_forecasts(spark, f"{root}/forecasts")
    scores = evaluate_all(
        forecasts,
        read_table(spark, root, "feature_corridor_annual"),
        read_table(spark, root, "feature_benchmark"),
        holdout_year,
        benchmark_year,
    )
    stored = {}
    for name, df in scores.items():
        replace_table(df, root, name)
        stored[name] = read_optional(spark, f"{root}/{name}", df.schema)
    write_metrics_json(stored["holdout_scores"], f"{root}/metrics")
    fits = read_optional(spark, f"{root}/model_settings", SETTINGS_SCHEMA)
    append_runs(run_rows(stored["holdout_scores"], fits), f"{root}/model_runs")
    return stored
