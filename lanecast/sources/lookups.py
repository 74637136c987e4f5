"""Lookup tabs: renaming, projection and loading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CORRIDOR_SCHEMA, CORRIDORS, table_schemas
from .validation import replace_checked

# Tab names of the lookup workbook, the table each fills, and the headings of their columns.
LOOKUP_TABLES = {
    "State": "raw_states",
    "FAF Zone (Domestic)": "raw_zones",
    "Commodity (SCTG2)": "raw_commodities",
    "Mode": "raw_modes",
    "Trade Type": "raw_trade_types",
    "Distance Band": "raw_distance_bands",
}
HEADINGS = {
    "numeric_label": "Numeric Label",
    "description": "Description",
    "short_description": "Short Description",
    "long_description": "Long Description",
}


def normalise_tab(tab: DataFrame, table: str) -> DataFrame:
    """The columns that ``table`` declares, found by their headings, typed and in order; others are left out."""
    fields = table_schemas()[table]
    return tab.select(*[F.col(f"`{HEADINGS[f.name]}`").cast(f.dataType).alias(f.name) for f in fields])


def normalise_tabs(tabs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every lookup table from the tabs of the workbook by their names."""
    return {table: normalise_tab(tabs[tab], table) for tab, table in LOOKUP_TABLES.items()}


def load_lookups(tables: dict[str, DataFrame], root: str) -> list[dict[str, int | str]]:
    """Replace each lookup table below ``root``; a row for the run log of each."""
    return [replace_checked(df, f"{root}/{name}", name) for name, df in tables.items()]


def corridor_dimension(spark, rows=CORRIDORS) -> DataFrame:
    """Corridor definitions given as literal rows."""
    return spark.createDataFrame(list(rows), CORRIDOR_SCHEMA)
