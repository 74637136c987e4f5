"""Column contracts of every table, generated from the years a deployment covers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The years covered by the published flow files, the holdout year and the horizon.
ANNUAL_YEARS = (2017, 2018, 2019, 2020, 2021, 2022, 2023, 2024)
BENCHMARK_YEARS = (2030, 2035, 2040, 2045, 2050)
HISTORY_YEARS = (1997, 2002, 2007, 2012)
HOLDOUT_YEAR = 2024
HORIZON = (2025, 2026, 2027, 2028, 2029, 2030)
BENCHMARK_YEAR = 2030
DOMESTIC_TRADE_TYPE = 1

# Macro-economic series identifiers and the feature columns they feed.
MACRO_SERIES = {
    "GDPC1": "gdp",
    "GASDESW": "diesel_price",
    "INDPRO": "industrial_production",
    "UNRATE": "unemployment_rate",
    "PCU484484": "ppi_transportation",
    "TRFVOLUSM227NFWA": "vehicle_miles",
}
MACRO_COLUMNS = tuple(MACRO_SERIES.values())

# The five published corridors (id, name, origin zone, destination zone).
CORRIDORS = (
    (1, "LA_to_Chicago", 61, 171),
    (2, "Houston_to_Atlanta", 481, 131),
    (3, "NYC_to_Miami", 362, 121),
    (4, "Dallas_to_Memphis", 482, 471),
    (5, "Seattle_to_Portland", 531, 411),
)

# Column order of the forecast table.
FORECAST_COLUMNS = (
    "corridor_id",
    "corridor_name",
    "model_name",
    "training_strategy",
    "forecast_type",
    "year",
    "prediction",
    "lower_bound",
    "upper_bound",
)

# Inputs of the boosted-tree model.
BOOSTED_FEATURES = (
    "corridor_id",
    "year",
    "gdp",
    "diesel_price",
    "industrial_production",
    "unemployment_rate",
    "ppi_transportation",
    "vehicle_miles",
    "tons_lag1",
    "tons_lag2",
    "tons_lag3",
    "value_lag1",
    "diesel_lag1",
    "tons_rolling_mean_3yr",
    "tons_rolling_std_3yr",
    "gdp_yoy_change",
    "diesel_yoy_change",
)

# Regressors of the trend model.
TREND_REGRESSORS = ("gdp", "diesel_price", "industrial_production", "unemployment_rate")

ENRICHED_FEATURES = (
    "tons_lag1",
    "tons_lag2",
    "tons_lag3",
    "value_lag1",
    "diesel_lag1",
    "tons_rolling_mean_3yr",
    "tons_rolling_std_3yr",
    "tons_yoy_change",
    "gdp_yoy_change",
    "diesel_yoy_change",
    "value_per_ton",
    "tmiles_per_ton",
)

FLOW_CODES = (
    ("fr_orig", T.DoubleType()),
    ("dms_orig", T.IntegerType()),
    ("dms_dest", T.IntegerType()),
    ("fr_dest", T.DoubleType()),
    ("fr_inmode", T.DoubleType()),
    ("dms_mode", T.IntegerType()),
    ("fr_outmode", T.DoubleType()),
    ("sctg2", T.IntegerType()),
    ("trade_type", T.IntegerType()),
    ("dist_band", T.IntegerType()),
)
HISTORY_CODES = (
    ("fr_orig", T.DoubleType()),
    ("dms_origst", T.IntegerType()),
    ("dms_destst", T.IntegerType()),
    ("fr_dest", T.DoubleType()),
    ("fr_inmode", T.DoubleType()),
    ("dms_mode", T.IntegerType()),
    ("fr_outmode", T.DoubleType()),
    ("sctg2", T.IntegerType()),
    ("trade_type", T.IntegerType()),
)
STAGED_FLOW_CODES = ("dms_orig", "dms_dest", "dms_mode", "sctg2", "trade_type", "dist_band")
STAGED_HISTORY_CODES = ("dms_origst", "dms_destst", "dms_mode", "sctg2", "trade_type")


@dataclass(frozen=True)
class FlowLayout:
    """The years a wide flow file spreads over its columns."""

    annual_years: tuple[int, ...] = ANNUAL_YEARS
    benchmark_years: tuple[int, ...] = BENCHMARK_YEARS
    history_years: tuple[int, ...] = HISTORY_YEARS

    def flow_measures(self) -> list[str]:
        every = (*self.annual_years, *self.benchmark_years)
        names = [f"tons_{y}" for y in every]
        names += [f"value_{y}" for y in every]
        names += [f"current_value_{y}" for y in self.annual_years[1:]]
        names += [f"tmiles_{y}" for y in every]
        return names + self.band_measures()

    def band_measures(self) -> list[str]:
        return [
            f"{measure}_{y}_{side}"
            for measure in ("tons", "value")
            for side in ("low", "high")
            for y in self.benchmark_years
        ]

    def staged_measures(self) -> list[str]:
        return [name for name in self.flow_measures() if not name.startswith("current_value_")]

    def history_measures(self) -> list[str]:
        return [f"{m}_{y}" for m in ("tons", "value", "current_value", "tmiles") for y in self.history_years]

    def staged_history_measures(self) -> list[str]:
        return [name for name in self.history_measures() if not name.startswith("current_value_")]


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


def _doubles(names) -> list[tuple[str, T.DataType]]:
    return [(name, T.DoubleType()) for name in names]


def flow_schema(layout: FlowLayout = FlowLayout()) -> T.StructType:
    return _struct([*FLOW_CODES, *_doubles(layout.flow_measures())])


def history_schema(layout: FlowLayout = FlowLayout()) -> T.StructType:
    return _struct([*HISTORY_CODES, *_doubles(layout.history_measures())])


SERIES_SCHEMA = _struct([("series_id", T.StringType()), ("date", T.DateType()), ("value", T.DoubleType())])
LOOKUP_SCHEMA = _struct([("numeric_label", T.IntegerType()), ("description", T.StringType())])
ZONE_LOOKUP_SCHEMA = _struct(
    [("numeric_label", T.IntegerType()), ("short_description", T.StringType()), ("long_description", T.StringType())]
)
CORRIDOR_SCHEMA = _struct(
    [
        ("corridor_id", T.IntegerType()),
        ("corridor_name", T.StringType()),
        ("origin", T.IntegerType()),
        ("destination", T.IntegerType()),
    ]
)
MACRO_ANNUAL_SCHEMA = _struct([("year", T.IntegerType()), *_doubles(MACRO_COLUMNS)])
ZONE_STATE_SCHEMA = _struct(
    [
        ("zone_id", T.IntegerType()),
        ("zone_short_description", T.StringType()),
        ("zone_long_description", T.StringType()),
        ("state_fips", T.IntegerType()),
        ("state_name", T.StringType()),
    ]
)
CORRIDOR_YEAR = [("corridor_id", T.IntegerType()), ("corridor_name", T.StringType()), ("year", T.IntegerType())]
TOTALS = ("total_tons", "total_value", "total_tmiles")
ANNUAL_SCHEMA = _struct([*CORRIDOR_YEAR, *_doubles((*TOTALS, *MACRO_COLUMNS))])
ENRICHED_SCHEMA = _struct([*CORRIDOR_YEAR, *_doubles((*TOTALS, *MACRO_COLUMNS, *ENRICHED_FEATURES))])
CORRIDOR_HISTORY_SCHEMA = _struct([*CORRIDOR_YEAR, *_doubles(TOTALS), ("geography_level", T.StringType())])
BENCHMARK_SCHEMA = _struct([*CORRIDOR_YEAR, *_doubles(("bts_tons", "bts_tons_low", "bts_tons_high"))])
FORECAST_SCHEMA = _struct(
    [
        ("corridor_id", T.IntegerType()),
        ("corridor_name", T.StringType()),
        ("model_name", T.StringType()),
        ("training_strategy", T.StringType()),
        ("forecast_type", T.StringType()),
        ("year", T.IntegerType()),
        *_doubles(("prediction", "lower_bound", "upper_bound")),
    ]
)
HOLDOUT_SCORE_SCHEMA = _struct(
    [
        ("corridor_id", T.IntegerType()),
        ("corridor_name", T.StringType()),
        ("model_name", T.StringType()),
        ("training_strategy", T.StringType()),
        ("year", T.IntegerType()),
        *_doubles(("actual", "prediction", "mape", "rmse", "mae")),
    ]
)
BENCHMARK_SCORE_SCHEMA = _struct(
    [
        ("corridor_id", T.IntegerType()),
        ("corridor_name", T.StringType()),
        ("model_name", T.StringType()),
        ("training_strategy", T.StringType()),
        ("year", T.IntegerType()),
        *_doubles(("prediction", "bts_tons", "bts_tons_low", "bts_tons_high")),
        ("within_bts_band", T.BooleanType()),
        ("pct_deviation_vs_bts", T.DoubleType()),
    ]
)
COMPARISON_SCHEMA = _struct(
    [
        ("corridor_id", T.IntegerType()),
        ("corridor_name", T.StringType()),
        ("model_name", T.StringType()),
        ("training_strategy", T.StringType()),
        *_doubles(("mape", "rmse", "mae")),
        ("within_bts_band", T.BooleanType()),
        ("pct_deviation_vs_bts", T.DoubleType()),
    ]
)
IMPORTANCE_SCHEMA = _struct([("feature", T.StringType()), ("importance", T.DoubleType())])
SETTINGS_SCHEMA = _struct(
    [
        ("corridor_id", T.IntegerType()),
        ("model_name", T.StringType()),
        ("settings", T.MapType(T.StringType(), T.StringType())),
    ]
)
FITS_SCHEMA = _struct([("model_name", T.StringType()), ("corridor_id", T.IntegerType()), ("fingerprint", T.StringType())])
RUN_SCHEMA = _struct(
    [
        ("run_id", T.StringType()),
        ("run_name", T.StringType()),
        ("status", T.StringType()),
        ("params", T.MapType(T.StringType(), T.StringType())),
        ("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

#: Columns that no row of a table lacks and no two rows share.
TABLE_KEYS = {
    "staged_macro_annual": ("year",),
    "feature_corridor_annual": ("corridor_id", "year"),
    "feature_corridor_enriched": ("corridor_id", "year"),
    "feature_corridor_history": ("corridor_id", "year"),
    "feature_benchmark": ("corridor_id", "year"),
    "model_fits": ("model_name", "corridor_id"),
    "model_settings": ("model_name", "corridor_id"),
}


def table_schemas(layout: FlowLayout = FlowLayout()) -> dict[str, T.StructType]:
    """The seventeen tables of the three layers, by name."""
    staged_types = dict([*FLOW_CODES, *HISTORY_CODES])

    def staged(codes, measures):
        return _struct([*((c, staged_types[c]) for c in codes), *_doubles(measures)])

    return {
        "raw_flows": flow_schema(layout),
        "raw_flow_history": history_schema(layout),
        "raw_macro_series": SERIES_SCHEMA,
        "raw_states": LOOKUP_SCHEMA,
        "raw_zones": ZONE_LOOKUP_SCHEMA,
        "raw_commodities": LOOKUP_SCHEMA,
        "raw_modes": LOOKUP_SCHEMA,
        "raw_trade_types": LOOKUP_SCHEMA,
        "raw_distance_bands": LOOKUP_SCHEMA,
        "staged_flows": staged(STAGED_FLOW_CODES, layout.staged_measures()),
        "staged_flow_history": staged(STAGED_HISTORY_CODES, layout.staged_history_measures()),
        "staged_macro_annual": MACRO_ANNUAL_SCHEMA,
        "staged_zone_state": ZONE_STATE_SCHEMA,
        "feature_corridor_annual": ANNUAL_SCHEMA,
        "feature_corridor_enriched": ENRICHED_SCHEMA,
        "feature_corridor_history": CORRIDOR_HISTORY_SCHEMA,
        "feature_benchmark": BENCHMARK_SCHEMA,
    }
