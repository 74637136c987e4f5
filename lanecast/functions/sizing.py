"""Size checks that decide whether a join side may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup row here is a few ids and a short text, so this many rows stay in the tens of megabytes.
BROADCAST_MAX_ROWS = 200_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` is proven to hold at most ``max_rows`` rows; reads no more than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_lookup(
    facts: DataFrame, lookup: DataFrame, on, how: str = "inner", max_rows: int = BROADCAST_MAX_ROWS
) -> DataFrame:
    """Join a lookup table: broadcast when proven small, else a shuffle join left to adaptive execution."""
    side = F.broadcast(lookup) if fits_broadcast(lookup, max_rows) else lookup
    return facts.join(side, on, how)
