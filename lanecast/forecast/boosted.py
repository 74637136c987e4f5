"""Pooled gradient-boosted trees with a recursive multi-year forecast.

One model serves every corridor. Each forecast year is a projection over the corridor table: the
last three tons and the last macro values travel as columns, so no step shuffles or collects.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from ..operators.regressors import step_regressors
from ..schemas import BOOSTED_FEATURES, FORECAST_SCHEMA, HOLDOUT_YEAR, HORIZON, IMPORTANCE_SCHEMA, MACRO_COLUMNS
from ..session import materialise
from .common import conform

POOLED_LEAVE_LAST_OUT = "pooled_leave_last_year_out"

ROWS_PER_TASK = 50_000

# Holdout bounds, and the future bounds that the 0.1 and 0.9 quantiles of
# (0.95 p, p, 1.05 p) amount to.
HOLDOUT_BOUNDS = (0.9, 1.1)
FUTURE_BOUNDS = (0.96, 1.04)


@dataclass(frozen=True)
class BoostedSettings:
    """Fixed default values of the published model: 200 trees, depth 3, rate 0.05, seed 42."""

    trees: int = 200
    depth: int = 3
    rate: float = 0.05
    bins: int = 256
    seed: int = 42


def training_rows(enriched: DataFrame, features: Sequence[str] = BOOSTED_FEATURES) -> DataFrame:
    """Rows complete in every feature and in the target."""
    return enriched.dropna(subset=[*features, "total_tons"])


def fit_boosted(
    rows: DataFrame, settings: BoostedSettings = BoostedSettings(), features: Sequence[str] = BOOSTED_FEATURES
) -> GBTRegressionModel:
    booster = GBTRegressor(
        featuresCol="features",
        labelCol="total_tons",
        maxIter=settings.trees,
        maxDepth=settings.depth,
        stepSize=settings.rate,
        maxBins=settings.bins,
        subsamplingRate=1.0,
        minInstancesPerNode=1,
        seed=settings.seed,
    )
    # A tree takes several jobs over the same rows: as few tasks as their number needs.
    tasks = 1 + rows.count() // ROWS_PER_TASK
    prepared = _assemble(rows, features).select("features", "total_tons").repartition(tasks).persist()
    try:
        return booster.fit(prepared)
    finally:
        prepared.unpersist()


def fingerprint(rows: DataFrame, settings: BoostedSettings, features: Sequence[str] = BOOSTED_FEATURES) -> str:
    """Name for a fit: the same for the same rows, in any order, and settings."""
    total = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*features, "total_tons").cast("decimal(20,0)"))).first()
    return f"{total[0]}-{total[1] or 0}-" + "-".join(str(v) for v in vars(settings).values())


def fit_or_load(rows: DataFrame, settings: BoostedSettings, store: str | None) -> GBTRegressionModel:
    """The model of these rows: from the folder ``store`` if the same rows were fitted before, else fitted and stored there."""
    if store is None:
        return fit_boosted(rows, settings)
    path = f"{store}/boosted-{fingerprint(rows, settings)}"
    try:
        return GBTRegressionModel.load(path)
    except (PySparkException, Py4JJavaError):
        # never stored, stored in part, or expired
        model = fit_boosted(rows, settings)
        model.write().overwrite().save(path)
        return model


NODE_SCHEMA = "tree int, weight double, node int, feature int, threshold double, left int, right int, value double, gain double, rows double"


def model_nodes(model: GBTRegressionModel, path: str) -> DataFrame:
    """The fitted trees as a table, one row per node: which feature goes left up to which threshold, or the value of a leaf.

    The model is written below ``path`` by its own writer, and its node rows are read from there. A leaf has no feature and
    children of -1; ``gain`` and ``rows`` are what importance is made of.
    """
    spark = SparkSession.active()
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.treeWeights)], "tree int, weight double")
    leaf = F.col("leftChild") < 0
    rows = nodes.select(
        F.col("treeID").cast("int").alias("tree"),
        F.col("id").cast("int").alias("node"),
        F.when(~leaf, F.col("split.featureIndex")).cast("int").alias("feature"),
        F.when(~leaf, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.col("leftChild").cast("int").alias("left"),
        F.col("rightChild").cast("int").alias("right"),
        F.col("prediction").alias("value"),
        F.when(~leaf, F.col("gain")).alias("gain"),
        F.col("impurityStats")[0].alias("rows"),
    )
    return rows.join(weights, "tree").select(*[part.split()[0] for part in NODE_SCHEMA.split(", ")])


def walk(rows: DataFrame, nodes: DataFrame, features: Sequence[str] = BOOSTED_FEATURES) -> DataFrame:
    """``rows`` with ``walked``: the prediction of the stored trees, by following each from its root.

    All trees are one row, bounded by the settings of the model, which joins every row. A missing input goes right.
    """
    node = F.struct("node", "feature", "threshold", "left", "right", "value")
    trees = nodes.groupBy("tree", "weight").agg(F.sort_array(F.collect_list(node)).alias("nodes"), F.max("node").alias("deepest"))
    whole = trees.groupBy(F.lit(1).alias("_model")).agg(F.collect_list(F.struct("weight", "nodes")).alias("_trees"))
    inputs = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features])
    joined = rows.withColumns({"_inputs": inputs, "_model": F.lit(1)}).join(F.broadcast(whole), "_model")
    # a node's number exceeds its parent's, so a walk has at most as many steps as a tree has nodes
    step = """CASE WHEN t.nodes[n].left < 0 THEN n
      WHEN _inputs[t.nodes[n].feature] <= t.nodes[n].threshold THEN t.nodes[n].left ELSE t.nodes[n].right END"""
    end = f"aggregate(sequence(1, CAST(log2(size(t.nodes) + 1) AS INT) + 1), 0, (n, k) -> {step})"
    total = F.expr(f"aggregate(_trees, 0D, (a, t) -> a + t.weight * t.nodes[{end}].value)")
    return joined.withColumn("walked", total).drop("_model", "_trees", "_inputs")


def importance_from_nodes(nodes: DataFrame, features: Sequence[str] = BOOSTED_FEATURES) -> DataFrame:
    """Share of each feature in the sum, over all trees, of gain times rows of its nodes."""
    found = nodes.where("feature IS NOT NULL").groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("part"))
    # one row a feature
    found = found.withColumn("importance", F.try_divide("part", F.sum("part").over(Window.partitionBy())))
    names = nodes.sparkSession.createDataFrame(list(enumerate(features)), "feature int, name string")
    return names.join(found, "feature", "left").select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))


def forecast_boosted(
    enriched: DataFrame,
    macros: DataFrame,
    horizon: Sequence[int] = HORIZON,
    holdout_year: int = HOLDOUT_YEAR,
    settings: BoostedSettings = BoostedSettings(),
    model_name: str = "BoostedTrees",
    store: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Forecast table and feature importance; models come from ``store`` if the same rows were fitted before.

    The holdout comes from a model of earlier years, the future from a model of all complete rows. Every corridor
    with a row in the holdout year gets a forecast there, missing inputs or not. Without complete rows both tables are empty.
    """
    spark = enriched.sparkSession
    # Boosting passes over its input many times and the recursion reads it again.
    features = materialise(enriched)
    early, full = fitted_models(features, holdout_year, settings, store)
    if full is None:
        return spark.createDataFrame([], FORECAST_SCHEMA), spark.createDataFrame([], IMPORTANCE_SCHEMA)
    labels = {"model_name": F.lit(model_name), "training_strategy": F.lit(POOLED_LEAVE_LAST_OUT)}
    future = predict_recursively(full, latest_state(features), macros, horizon)
    forecasts = conform(future.withColumns({**labels, **_bounds(FUTURE_BOUNDS)}))
    if early is not None:
        scored = early.transform(_assemble(features.where(F.col("year") == holdout_year), BOOSTED_FEATURES))
        holdout = scored.withColumns({**labels, **_bounds(HOLDOUT_BOUNDS), "forecast_type": F.lit("holdout")})
        forecasts = conform(holdout).unionByName(forecasts)
    return forecasts, feature_importance(spark, full)


def fitted_models(
    features: DataFrame, holdout_year: int, settings: BoostedSettings, store: str | None = None
) -> tuple[GBTRegressionModel | None, GBTRegressionModel | None]:
    """The model of the years before the holdout and the model of all years, fitted side by side; None without rows."""
    complete = training_rows(features)
    sources = [complete.where(F.col("year") < holdout_year), complete]
    # each fit is a chain of small jobs, so two of them at once keep the cores busier
    with ThreadPoolExecutor(2) as pool:
        return tuple(pool.map(lambda rows: None if rows.isEmpty() else fit_or_load(rows, settings, store), sources))


def latest_state(enriched: DataFrame) -> DataFrame:
    """Per corridor: the last three tons, the last macro values, and the mean value of a ton."""
    newest = Window.partitionBy("corridor_id", "corridor_name").orderBy(F.desc("year"))

    def at(rank: int, column: str) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col(column)))

    ranked = enriched.withColumn("_rank", F.row_number().over(newest))
    return ranked.groupBy("corridor_id", "corridor_name").agg(
        at(1, "total_tons").alias("tons_lag1"),
        at(2, "total_tons").alias("tons_lag2"),
        at(3, "total_tons").alias("tons_lag3"),
        at(1, "gdp").alias("gdp_before"),
        at(1, "diesel_price").alias("diesel_lag1"),
        F.avg("value_per_ton").alias("value_ratio"),
    )


def predict_recursively(
    model: GBTRegressionModel, state: DataFrame, macros: DataFrame, horizon: Sequence[int]
) -> DataFrame:
    """Predictions of every year of the horizon, each fed by the predictions before it."""
    years = sorted(int(y) for y in horizon)
    known = _macro_literals(macros, years)
    table = state
    done: list[str] = []
    for year in years:
        inputs = table.selectExpr("*", f"{year} AS year", *known[year]).selectExpr("*", *_STEP_FEATURES)
        predicted = model.transform(_assemble(inputs, BOOSTED_FEATURES))
        table = step_state(predicted, "prediction", (*done, f"prediction AS tons_{year}"))
        done.append(f"tons_{year}")
    cells = ", ".join(f"{year}, tons_{year}" for year in years)
    return table.selectExpr(
        "corridor_id", "corridor_name", "'future' AS forecast_type", f"stack({len(years)}, {cells}) AS (year, prediction)"
    )


def _macro_literals(macros: DataFrame, years: Sequence[int]) -> dict[int, list[str]]:
    # One row per year of the horizon, so this never grows with the data.
    by_year = {row["year"]: row for row in step_regressors(macros, years).collect()}
    values = {y: {n: by_year[y][n] if y in by_year else None for n in MACRO_COLUMNS} for y in years}
    return {y: [f"CAST({'NULL' if v is None else repr(float(v))} AS DOUBLE) AS {n}" for n, v in row.items()] for y, row in values.items()}


def step_inputs(state: DataFrame, year: int, macros: DataFrame) -> DataFrame:
    """The model's inputs for one year of the horizon."""
    known = _macro_literals(macros, [year])[year]
    return state.selectExpr("*", f"{year} AS year", *known).selectExpr("*", *_STEP_FEATURES)


def step_state(predicted: DataFrame, newest: str, more: Sequence[str] = ()) -> DataFrame:
    """The state for the next year: the newest value takes the first place and the others move back by one."""
    return predicted.selectExpr(
        "corridor_id",
        "corridor_name",
        "value_ratio",
        f"{newest} AS tons_lag1",
        "tons_lag1 AS tons_lag2",
        "tons_lag2 AS tons_lag3",
        "gdp AS gdp_before",
        "diesel_price AS diesel_lag1",
        *more,
    )


_MEAN = "(tons_lag1 + tons_lag2 + tons_lag3) / 3"
_SQUARES = " + ".join(f"pow({lag} - {_MEAN}, 2)" for lag in ("tons_lag1", "tons_lag2", "tons_lag3"))
_STEP_FEATURES = (
    "tons_lag1 * value_ratio AS value_lag1",
    f"{_MEAN} AS tons_rolling_mean_3yr",
    f"sqrt(({_SQUARES}) / 2) AS tons_rolling_std_3yr",
    "try_divide(gdp - gdp_before, gdp_before) AS gdp_yoy_change",
    "try_divide(diesel_price - diesel_lag1, diesel_lag1) AS diesel_yoy_change",
)


def _bounds(factors: tuple[float, float]) -> dict[str, Column]:
    ends = [F.col("prediction") * factor for factor in factors]
    return {"lower_bound": F.least(*ends), "upper_bound": F.greatest(*ends)}


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    # Missing inputs reach the trees as NaN, which every split sends the same way.
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep").transform(df)


def feature_importance(spark, model: GBTRegressionModel, features: Sequence[str] = BOOSTED_FEATURES) -> DataFrame:
    """Share of the total impurity reduction owed to each feature."""
    rows = [(name, float(share)) for name, share in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, IMPORTANCE_SCHEMA).orderBy(F.desc_nulls_last("importance"), "feature")
