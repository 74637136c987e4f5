"""Raw layer to staged layer: filtering, projection, macro pivot and zone classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import join_lookup
from ..functions.text import infer_state
from ..schemas import (
    DOMESTIC_TRADE_TYPE,
    MACRO_SERIES,
    STAGED_FLOW_CODES,
    STAGED_HISTORY_CODES,
    FlowLayout,
)


def stage_flows(raw: DataFrame, layout: FlowLayout = FlowLayout(), domestic_code: int = DOMESTIC_TRADE_TYPE) -> DataFrame:
    """Domestic flows without foreign codes and current-value measures."""
    return raw.where(F.col("trade_type") == domestic_code).select(*STAGED_FLOW_CODES, *layout.staged_measures())


def stage_history(raw: DataFrame, layout: FlowLayout = FlowLayout(), domestic_code: int = DOMESTIC_TRADE_TYPE) -> DataFrame:
    """Domestic historical flows."""
    return raw.where(F.col("trade_type") == domestic_code).select(
        *STAGED_HISTORY_CODES, *layout.staged_history_measures()
    )


def macro_pivot(series: DataFrame, mapping: dict[str, str] = MACRO_SERIES, grain: str = "year") -> DataFrame:
    """Average of each series per period, one column per series.

    ``grain`` is ``year`` or any unit ``date_trunc`` accepts. Every average is a conditional
    aggregate, so one pass with map-side combine serves all series, however long any one is.
    Periods in which only unmapped series were observed keep a row of nulls.
    """
    period = F.year("date") if grain == "year" else F.date_trunc(grain, "date").cast("date")
    return series.groupBy(period.alias("year" if grain == "year" else "period")).agg(
        *[F.avg(F.when(F.col("series_id") == sid, F.col("value"))).alias(name) for sid, name in mapping.items()]
    )


def zone_to_state(zones: DataFrame, states: DataFrame) -> DataFrame:
    """Zones with the state inferred from their text and that state's code (NULL when unknown).

    A state listed twice resolves to its highest code.
    """
    codes = states.groupBy(F.col("description").alias("state_name")).agg(F.max("numeric_label").alias("state_fips"))
    named = zones.select(
        F.col("numeric_label").alias("zone_id"),
        F.col("short_description").alias("zone_short_description"),
        F.col("long_description").alias("zone_long_description"),
        infer_state("short_description", "long_description").alias("state_name"),
    )
    return join_lookup(named, codes, "state_name", "left").select(
        "zone_id", "zone_short_description", "zone_long_description", "state_fips", "state_name"
    )
