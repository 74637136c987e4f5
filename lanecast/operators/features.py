"""Staged layer to feature layer: corridor totals and engineered features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import finite, ratio
from ..functions.sizing import fits_broadcast
from ..session import materialise
from ..schemas import (
    ANNUAL_YEARS,
    BENCHMARK_YEARS,
    ENRICHED_FEATURES,
    HISTORY_YEARS,
    MACRO_COLUMNS,
    TOTALS,
)

# Output column -> name pattern of the wide column that holds it.
ANNUAL_MEASURES = {"total_tons": "tons_{year}", "total_value": "value_{year}", "total_tmiles": "tmiles_{year}"}
BAND_MEASURES = {"bts_tons": "tons_{year}", "bts_tons_low": "tons_{year}_low", "bts_tons_high": "tons_{year}_high"}


def unpivot_years(wide: DataFrame, keys: Sequence[str], years: Sequence[int], measures: dict[str, str]) -> DataFrame:
    """Year-suffixed columns to one row per year, in a single scan."""
    rows = [
        ", ".join([str(int(year)), *(f"`{pattern.format(year=year)}`" for pattern in measures.values())])
        for year in years
    ]
    names = ", ".join(["year", *measures])
    return wide.selectExpr(*keys, f"stack({len(rows)}, {', '.join(rows)}) AS ({names})")


def totals_by_corridor(
    flows: DataFrame,
    corridors: DataFrame,
    columns: Sequence[str],
    flow_keys: tuple[str, str] = ("dms_orig", "dms_dest"),
    corridor_keys: tuple[str, str] = ("origin", "destination"),
) -> DataFrame:
    """Sums of wide columns per corridor; corridors without flows are absent.

    Flows are summed per endpoint pair before they meet the corridors: that sum combines map-side, so even a
    pair holding most of the rows reaches the shuffle as one row per task, and corridors that share
    a pair multiply sums, never flows. Whether the join is broadcast is left to adaptive execution.
    """
    sums = [F.expr(f"sum(`{name}`) AS `{name}`") for name in columns]
    ends = [F.col(c).alias(f) for c, f in zip(corridor_keys, flow_keys)]
    lanes = corridors.select("corridor_id", "corridor_name", *ends)
    matched = flows.groupBy(*flow_keys).agg(*sums).join(lanes, list(flow_keys))
    return matched.groupBy("corridor_id", "corridor_name").agg(*sums)


def _yearly_totals(flows, corridors, years, measures, **ends) -> DataFrame:
    # Summing the wide columns before unpivoting sends one row per corridor into the shuffle, not one per year.
    columns = [pattern.format(year=year) for pattern in measures.values() for year in years]
    wide = totals_by_corridor(flows, corridors, columns, **ends)
    return unpivot_years(wide, ("corridor_id", "corridor_name"), years, measures)


def corridor_annual(
    flows: DataFrame, corridors: DataFrame, macros: DataFrame, years: Sequence[int] = ANNUAL_YEARS
) -> DataFrame:
    """Annual tons, value and ton-miles per corridor, with the macro averages of the year."""
    return _with_macros(_yearly_totals(flows, corridors, years, ANNUAL_MEASURES), macros)


def _with_macros(totals: DataFrame, macros: DataFrame) -> DataFrame:
    return totals.join(macros, "year", "left").select("corridor_id", "corridor_name", "year", *TOTALS, *MACRO_COLUMNS)


def annual_and_band(
    flows: DataFrame,
    corridors: DataFrame,
    macros: DataFrame,
    annual_years: Sequence[int] = ANNUAL_YEARS,
    benchmark_years: Sequence[int] = BENCHMARK_YEARS,
) -> tuple[DataFrame, DataFrame]:
    """Annual totals and benchmark band from one pass over the flows.

    All columns of both are summed together; only that table, a row per corridor, goes to the shared folder.
    """
    keys = ("corridor_id", "corridor_name")
    parts = ((ANNUAL_MEASURES, annual_years), (BAND_MEASURES, benchmark_years))
    columns = [pattern.format(year=year) for measures, years in parts for pattern in measures.values() for year in years]
    wide = materialise(totals_by_corridor(flows, corridors, list(dict.fromkeys(columns))))
    annual, band = (unpivot_years(wide, keys, years, measures) for measures, years in parts)
    return _with_macros(annual, macros), band


def benchmark_band(flows: DataFrame, corridors: DataFrame, years: Sequence[int] = BENCHMARK_YEARS) -> DataFrame:
    """Published mid, low and high tons per corridor and benchmark year."""
    return _yearly_totals(flows, corridors, years, BAND_MEASURES)


def corridor_states(corridors: DataFrame, zone_state: DataFrame) -> DataFrame:
    """State codes at both ends of each corridor; an unmapped end fails the job that needs it."""
    codes = zone_state.groupBy("zone_id").agg(F.min("state_fips").alias("state_fips"))
    small = fits_broadcast(codes)

    def attach(df: DataFrame, zone_column: str, state_column: str) -> DataFrame:
        side = codes.select(F.col("zone_id").alias(zone_column), F.col("state_fips").alias(state_column))
        return df.join(F.broadcast(side) if small else side, zone_column, "left")

    def required(name: str) -> Column:
        message = F.concat(F.lit("missing zone-to-state mapping for corridor "), F.col("corridor_name"))
        return F.coalesce(F.col(name), F.raise_error(message).cast("int")).alias(name)

    both = attach(attach(corridors, "origin", "origin_state_fips"), "destination", "dest_state_fips")
    return both.select("corridor_id", "corridor_name", required("origin_state_fips"), required("dest_state_fips"))


def corridor_history(
    history: DataFrame, corridors: DataFrame, zone_state: DataFrame, years: Sequence[int] = HISTORY_YEARS
) -> DataFrame:
    """State-level totals of each corridor; corridors sharing a pair of states each receive them."""
    totals = _yearly_totals(
        history,
        corridor_states(corridors, zone_state),
        years,
        ANNUAL_MEASURES,
        flow_keys=("dms_origst", "dms_destst"),
        corridor_keys=("origin_state_fips", "dest_state_fips"),
    )
    return totals.withColumn("geography_level", F.lit("state"))


def _series_window(key: str, order: str):
    # A corridor has one row per year, so no window partition grows with the data.
    return Window.partitionBy(key).orderBy(order)


def lag_features(key: str = "corridor_id", order: str = "year", calendar: bool = False) -> dict[str, Column]:
    """Earlier rows of the series; a missing year shortens the distance.

    With ``calendar`` the values of the very year so many years before, NULL where that year is missing.
    """
    w = _series_window(key, order)

    def lag(name: str, distance: int) -> Column:
        return F.first(name).over(w.rangeBetween(-distance, -distance)) if calendar else F.lag(name, distance).over(w)

    return {
        "tons_lag1": lag("total_tons", 1),
        "tons_lag2": lag("total_tons", 2),
        "tons_lag3": lag("total_tons", 3),
        "value_lag1": lag("total_value", 1),
        "diesel_lag1": lag("diesel_price", 1),
    }


def rolling_features(
    key: str = "corridor_id", order: str = "year", rows: int = 3, calendar: bool = False, current: bool = True
) -> dict[str, Column]:
    """Mean (from one value) and sample deviation (from two) of the last rows, the current one included.

    With ``calendar`` of the rows of the last years, however many there are; without ``current`` of those before the row,
    so that a feature holds nothing of the value it is to predict.
    """
    w = _series_window(key, order)
    last = 0 if current else -1
    w = w.rangeBetween(last + 1 - rows, last) if calendar else w.rowsBetween(last + 1 - rows, last)
    return {
        "tons_rolling_mean_3yr": F.avg("total_tons").over(w),
        "tons_rolling_std_3yr": F.stddev_samp("total_tons").over(w),
    }


def padded_change(value: Column | str, key: str = "corridor_id", order: str = "year") -> Column:
    """Relative change to the previous row after carrying the last known value forward."""
    value = F.col(value) if isinstance(value, str) else value
    known = F.when(~F.isnan(value), value)
    w = _series_window(key, order)
    current = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    previous = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return finite(F.try_divide(current, previous) - 1)


def derived_features(key: str = "corridor_id", order: str = "year") -> dict[str, Column]:
    return {
        "tons_yoy_change": padded_change("total_tons", key, order),
        "value_per_ton": ratio("total_value", "total_tons"),
        "tmiles_per_ton": ratio("total_tmiles", "total_tons"),
    }


def economic_change_features(key: str = "corridor_id", order: str = "year") -> dict[str, Column]:
    return {
        "gdp_yoy_change": padded_change(finite("gdp"), key, order),
        "diesel_yoy_change": padded_change(finite("diesel_price"), key, order),
    }


def add_lag_features(df: DataFrame, key: str = "corridor_id", order: str = "year", calendar: bool = False) -> DataFrame:
    return df.withColumns(lag_features(key, order, calendar))


def add_rolling_features(
    df: DataFrame, key: str = "corridor_id", order: str = "year", calendar: bool = False, current: bool = True
) -> DataFrame:
    return df.withColumns(rolling_features(key, order, calendar=calendar, current=current))


def add_derived_features(df: DataFrame, key: str = "corridor_id", order: str = "year") -> DataFrame:
    return finite_columns(df.withColumns(derived_features(key, order)))


def add_economic_change_features(df: DataFrame, key: str = "corridor_id", order: str = "year") -> DataFrame:
    return finite_columns(df.withColumns(economic_change_features(key, order)))


def finite_columns(df: DataFrame) -> DataFrame:
    """Infinities and NaN to NULL in every floating-point column."""
    limit = "abs(`{0}`) < double('infinity')"  # False for NaN, which sorts above infinity.
    return df.selectExpr(
        *[
            f"CASE WHEN {limit.format(name)} THEN `{name}` END AS `{name}`" if dtype in ("double", "float") else f"`{name}`"
            for name, dtype in df.dtypes
        ]
    )


def enrich(annual: DataFrame, key: str = "corridor_id", order: str = "year") -> DataFrame:
    """The full feature table: every window shares one partitioning and one sort."""
    features = {
        **lag_features(key, order),
        **rolling_features(key, order),
        **derived_features(key, order),
        **economic_change_features(key, order),
    }
    return finite_columns(annual.withColumns(features)).select(
        "corridor_id", "corridor_name", "year", *TOTALS, *MACRO_COLUMNS, *ENRICHED_FEATURES
    )
