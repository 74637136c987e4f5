"""The domain tables expressed over an order/line-item star schema.

Lines become flows between the nations of supplier and customer, orders become macro observations,
and regions play the part of states. Years, codes and factors below define this mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.text import REMAINDER_PREFIX, REST_PREFIX, STATE_ABBREVIATIONS
from .operators.features import corridor_annual
from .operators.staging import macro_pivot, stage_flows, stage_history
from .schemas import MACRO_COLUMNS, FlowLayout, flow_schema, history_schema
from .sources.macros import normalise_series

LAYOUT = FlowLayout(
    annual_years=(1995, 1996, 1997, 1998, 1999, 2000, 2001),
    benchmark_years=(2005, 2010, 2015, 2020, 2025),
    history_years=(1995, 1996, 1997, 1998),
)
HOLDOUT_YEAR = 2001
HORIZON = (2002, 2003, 2004, 2005, 2006, 2007)
BENCHMARK_YEAR = 2005

# Published futures: multiples of the base year that binary fractions hold exactly.
BASE_YEAR = 2000
MID_FACTORS = {2005: 1.25, 2010: 1.5, 2015: 1.75, 2020: 2.0, 2025: 2.25}
LOW_FACTOR = 0.75
HIGH_FACTOR = 1.125

PART_PAID_SERIES = "STATUS-P"
MACRO_MAPPING = {
    "1-URGENT": "gdp",
    "2-HIGH": "diesel_price",
    "3-MEDIUM": "industrial_production",
    "4-NOT SPECIFIED": "unemployment_rate",
    "5-LOW": "ppi_transportation",
    PART_PAID_SERIES: "vehicle_miles",
}
EVENT_MAPPING = {"click": "clicks", "error": "errors", "purchase": "purchases", "signup": "signups", "view": "views"}
NATIONS = 25
REGIONS = 5


# Declared rather than inferred, so that opening a table reads no footers.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def flow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with its endpoints, codes, year and measures. An order of a year without columns is an error."""
    year = F.year("o_orderdate")
    unknown = F.raise_error(F.concat(F.lit("no columns for the year "), year.cast("string"))).cast("int")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("dms_dest"))
    orders = (
        table(spark, sf_dir, "orders")
        .select(
            "o_orderkey",
            F.col("o_custkey").alias("c_custkey"),
            F.when(year.isin(list(LAYOUT.annual_years)), year).otherwise(unknown).alias("year"),
        )
        .join(customers, "c_custkey")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("dms_orig")
    )
    distance = F.lit(1) + F.abs(F.col("dms_orig") - F.col("dms_dest"))
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_orderkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_quantity", "l_extendedprice"
        )
        .join(suppliers, "l_suppkey")
        .join(orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
        .select(
            "dms_orig",
            "dms_dest",
            F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("dms_mode"),
            F.col("l_linenumber").alias("sctg2"),
            F.when(F.col("l_returnflag") == "N", 1)
            .when(F.col("l_returnflag") == "R", 2)
            .otherwise(3)
            .alias("trade_type"),
            "year",
            F.col("l_quantity").alias("tons"),
            F.col("l_extendedprice").alias("value"),
            (F.col("l_quantity") * distance).alias("tmiles"),
        )
    )


# The wide tables have dozens of generated columns; SQL text builds them in one call each.


def _wide_sums(lines: DataFrame, codes: list[str], years) -> DataFrame:
    return lines.groupBy(*codes).agg(
        *[
            F.expr(f"round(sum(CASE WHEN year = {y} THEN {m} END), 2) AS {m}_{y}")
            for m in ("tons", "value", "tmiles")
            for y in years
        ]
    )


def _conform(df: DataFrame, schema: T.StructType, derived: dict[str, str]) -> DataFrame:
    return df.selectExpr(
        *[f"CAST({derived.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]
    )


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide flow table, laid out as the flow file is."""
    codes = ["dms_orig", "dms_dest", "dms_mode", "sctg2", "trade_type"]
    wide = _wide_sums(flow_lines(spark, sf_dir), codes, LAYOUT.annual_years)
    derived = {f"current_value_{year}": f"value_{year}" for year in LAYOUT.annual_years[1:]}
    for year, factor in MID_FACTORS.items():
        for m in ("tons", "value", "tmiles"):
            base = f"{m}_{BASE_YEAR}"
            derived[f"{m}_{year}"] = f"{base} * {factor}D"
            derived[f"{m}_{year}_low"] = f"{base} * {factor * LOW_FACTOR}D"
            derived[f"{m}_{year}_high"] = f"{base} * {factor * HIGH_FACTOR}D"
    derived |= {
        "fr_orig": "CASE WHEN trade_type = 2 THEN dms_orig END",
        "fr_dest": "CASE WHEN trade_type = 3 THEN dms_dest END",
        "fr_inmode": "CASE WHEN trade_type = 2 THEN dms_mode END",
        "fr_outmode": "CASE WHEN trade_type = 3 THEN dms_mode END",
        "dist_band": "abs(dms_orig - dms_dest) div 5 + 1",
    }
    return _conform(wide, flow_schema(LAYOUT), derived)


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide historical table between regions."""
    lines = flow_lines(spark, sf_dir).withColumns(
        {"dms_origst": F.col("dms_orig") % REGIONS, "dms_destst": F.col("dms_dest") % REGIONS}
    )
    codes = ["dms_origst", "dms_destst", "dms_mode", "sctg2", "trade_type"]
    wide = _wide_sums(lines, codes, LAYOUT.history_years)
    derived = {f"current_value_{y}": f"value_{y}" for y in LAYOUT.history_years}
    derived |= {name: "NULL" for name in ("fr_orig", "fr_dest", "fr_inmode", "fr_outmode")}
    return _conform(wide, history_schema(LAYOUT), derived)


def macro_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as text, the way a series service returns them."""
    tags = F.array("o_orderpriority", F.when(F.col("o_orderstatus") == "P", F.lit(PART_PAID_SERIES)))
    return table(spark, sf_dir, "orders").select(
        F.explode(F.filter(tags, lambda tag: tag.isNotNull())).alias("series_id"),
        F.col("o_orderdate").cast("string").alias("date"),
        F.col("o_totalprice").cast("string").alias("value"),
    )


def macros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual macro averages to four decimals, which makes them independent of summation order."""
    annual = macro_pivot(normalise_series(macro_pull(spark, sf_dir)), MACRO_MAPPING)
    return annual.select("year", *[F.round(name, 4).alias(name) for name in MACRO_COLUMNS])


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_series(
        table(spark, sf_dir, "events").select(
            F.col("event_type").alias("series_id"), F.col("ts").alias("date"), F.col("value")
        )
    )


def zone_corridors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ordered pair of nations."""
    return _pairs(table(spark, sf_dir, "nation"), "n_nationkey", "n_name", NATIONS)


def state_corridors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ordered pair of regions, each made of the pairs of their nations."""
    regions = _pairs(table(spark, sf_dir, "region"), "r_regionkey", "r_name", REGIONS)
    lanes = zone_corridors(spark, sf_dir).select(
        F.col("origin").alias("origin_zone"),
        F.col("destination").alias("destination_zone"),
        (F.col("origin") % REGIONS).alias("origin"),
        (F.col("destination") % REGIONS).alias("destination"),
    )
    return lanes.join(regions, ["origin", "destination"]).select(
        "corridor_id", "corridor_name", F.col("origin_zone").alias("origin"), F.col("destination_zone").alias("destination")
    )


def _pairs(places: DataFrame, key: str, name: str, count: int) -> DataFrame:
    ends = places.select(F.col(key).alias("origin"), F.col(name).alias("origin_name")).withColumn(
        "destination", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    )
    names = places.select(F.col(key).alias("destination"), F.col(name).alias("destination_name"))
    return ends.join(names, "destination").select(
        (F.col("origin") * count + F.col("destination") + 1).alias("corridor_id"),
        F.concat_ws("_to_", "origin_name", "destination_name").alias("corridor_name"),
        "origin",
        "destination",
    )


def nation_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, with their region as the state."""
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("state_fips"), F.col("r_name").alias("state_name"))
    zones = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("zone_id"), F.col("n_regionkey").alias("state_fips")
    )
    return zones.join(regions, "state_fips").select("zone_id", "state_fips", "state_name")


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone per customer, its text in one of nine shapes and naming one of the states."""
    names = F.array(*[F.lit(n) for n in STATE_ABBREVIATIONS])
    shorts = F.array(*[F.lit(a) for a in STATE_ABBREVIATIONS.values()])
    count = len(STATE_ABBREVIATIONS)
    own, other = F.col("c_custkey") % count, (F.col("c_custkey") * 7 + 3) % count
    state, abbreviation = F.get(names, own), F.get(shorts, own)
    second = F.get(shorts, other)
    town = F.col("c_mktsegment")
    shape = F.col("c_custkey") % 10
    short = (
        F.when(shape == 0, F.concat(town, F.lit(" "), abbreviation))
        .when(shape == 1, F.concat(F.lit(REST_PREFIX), abbreviation))
        .when(shape == 2, state)
        .when(shape == 3, F.concat(town, F.lit(" "), abbreviation, F.lit("-"), second, F.lit(" ("), second, F.lit(" Part)")))
        .when(shape == 4, F.concat(F.lit(REST_PREFIX), F.lit("ZZ")))
        .when(shape == 5, F.concat(town, F.lit(" "), abbreviation, F.lit("-"), second))
        .when(shape == 6, F.concat(town, F.lit(" (ZZ Part)")))
        .when(shape == 7, F.lit("outlying"))
        .when(shape == 8, F.lit("plain"))
        .otherwise(F.lit("nowhere"))
    )
    long = (
        F.when(shape == 0, F.concat(town, F.lit(", "), abbreviation, F.lit("  CFS Area")))
        .when(shape == 1, F.concat(F.lit(REMAINDER_PREFIX), state))
        .when(shape == 7, F.concat(F.lit(REMAINDER_PREFIX), F.lit(" "), state, F.lit(" ")))
        .when(shape == 8, state)
        .when(shape == 9, F.lit("nothing known"))
        .otherwise(F.concat(F.lit("area of "), abbreviation, F.lit(" XY")))
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("numeric_label"),
        short.alias("short_description"),
        long.alias("long_description"),
    )


def nation_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones whose text names the state that stands for their region."""
    shorts = F.array(*[F.lit(a) for a in list(STATE_ABBREVIATIONS.values())[:REGIONS]])
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("numeric_label"),
        F.concat(F.lit(REST_PREFIX), F.get(shorts, F.col("n_regionkey"))).alias("short_description"),
        F.col("n_name").alias("long_description"),
    )


def region_state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as states: the region's key with the name of the state that stands for it."""
    names = F.array(*[F.lit(n) for n in list(STATE_ABBREVIATIONS)[:REGIONS]])
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("numeric_label"), F.get(names, F.col("r_regionkey")).alias("description")
    )


def raw_layer(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every raw table that the staged layer is built from."""
    return {
        "raw_flows": raw_flows(spark, sf_dir),
        "raw_flow_history": raw_history(spark, sf_dir),
        "raw_macro_series": normalise_series(macro_pull(spark, sf_dir)),
        "raw_zones": nation_zone_lookup(spark, sf_dir),
        "raw_states": region_state_lookup(spark, sf_dir),
    }


def state_lookup(spark: SparkSession) -> DataFrame:
    """States numbered in alphabetical order, from one."""
    rows = [(i + 1, name) for i, name in enumerate(STATE_ABBREVIATIONS)]
    return spark.createDataFrame(rows, "numeric_label int, description string")


def staged_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_flows(raw_flows(spark, sf_dir), LAYOUT)


def staged_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_history(raw_history(spark, sf_dir), LAYOUT)


def annual(spark: SparkSession, sf_dir: str, corridors: DataFrame, staged: DataFrame | None = None) -> DataFrame:
    """Corridor totals and macros; value to the cent, which removes the noise of summation order."""
    flows = staged_flows(spark, sf_dir) if staged is None else staged
    built = corridor_annual(flows, corridors, macros(spark, sf_dir), LAYOUT.annual_years)
    return built.withColumn("total_value", F.round("total_value", 2))
