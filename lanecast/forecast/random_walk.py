"""Random-walk forecasts with normal intervals, entirely in column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import normal_quantile
from ..schemas import HOLDOUT_YEAR, HORIZON
from .common import LEAVE_LAST_OUT, conform


def forecast_random_walk(
    annual: DataFrame,
    horizon: Sequence[int] = HORIZON,
    holdout_year: int = HOLDOUT_YEAR,
    width: float = 0.8,
    model_name: str = "RandomWalk",
) -> DataFrame:
    """Last value carried forward; the interval grows with the square root of the distance.

    Steps count rows, not calendar years. A row without tons is a step without an observation: the
    change across it spans several steps and is scaled accordingly. The holdout row is fitted on the
    years before it and exists only for corridors observed in that year.
    """
    w = Window.partitionBy("corridor_id", "corridor_name").orderBy("year")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    position = F.row_number().over(w)
    known_at = F.when(F.col("total_tons").isNotNull(), F.col("_at"))
    steps = (
        annual.select("corridor_id", "corridor_name", "year", "total_tons", position.alias("_at"))
        .withColumn("_gap", F.col("_at") - F.last(known_at, ignorenulls=True).over(before))
        .withColumn("_change", F.col("total_tons") - F.last("total_tons", ignorenulls=True).over(before))
    )

    known = F.col("total_tons").isNotNull()
    training = F.col("year") < holdout_year

    def fit(rows):
        last = F.max(F.when(rows & known, F.struct("_at", "total_tons")))
        return F.struct(
            F.avg(F.when(rows, F.pow("_change", 2) / F.col("_gap"))).alias("variance"),
            last["total_tons"].alias("level"),
            (F.max(F.when(rows, F.col("_at"))) - last["_at"]).alias("stale"),
        )

    fitted = steps.groupBy("corridor_id", "corridor_name").agg(
        fit(training).alias("train"),
        fit(F.lit(True)).alias("full"),
        F.max(F.col("year") == holdout_year).alias("_has_holdout"),
    )

    def target(kind: str, year: int, step: int, model: str):
        return F.struct(
            F.lit(kind).alias("forecast_type"),
            F.lit(int(year)).alias("year"),
            F.col(f"{model}.level").alias("prediction"),
            F.sqrt(F.col(f"{model}.variance") * (F.col(f"{model}.stale") + step)).alias("deviation"),
        )

    future = [target("future", year, i + 1, "full") for i, year in enumerate(horizon)]
    holdout = F.when(F.col("_has_holdout"), F.array(target("holdout", holdout_year, 1, "train")))
    rows = fitted.select(
        "corridor_id", "corridor_name", F.inline(F.concat(F.coalesce(holdout, F.array()), F.array(*future)))
    )
    spread = F.col("deviation") * normal_quantile(width)
    return conform(
        rows.withColumns(
            {
                "model_name": F.lit(model_name),
                "training_strategy": F.lit(LEAVE_LAST_OUT),
                "lower_bound": F.col("prediction") - spread,
                "upper_bound": F.col("prediction") + spread,
            }
        )
    )
