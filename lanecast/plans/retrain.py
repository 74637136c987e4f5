"""Which stored fits still hold: content fingerprints of the rows each corridor was fitted to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _content(df: DataFrame) -> Column:
    """An aggregate over rows in any order: their number, and sum and parity of their hashes."""
    # a NULL leaves a hash as it was, so its place is hashed too
    row = F.xxhash64(*[part for name in sorted(df.columns) for part in (F.col(name), F.col(name).isNull())])
    parts = (F.count(F.lit(1)), F.sum(row.cast("decimal(20,0)")), F.bit_xor(row))
    return F.concat_ws(":", *[part.cast("string") for part in parts])


def fingerprints(
    annual: DataFrame, macros: DataFrame, horizon: Sequence[int], holdout_year: int, models: Mapping[str, str]
) -> DataFrame:
    """What each corridor is fitted to, by model: its rows, the macros, the years and the settings in ``models``.

    ARIMA reads neither macros nor settings, so these do not touch it.
    """
    years = f"{holdout_year}:{','.join(str(int(y)) for y in horizon)}"
    shared = macros.agg(_content(macros)).first()[0]
    contexts = {m: years if m == "ARIMA" else f"{years}|{shared}" if m == "TrendRegression" else f"{years}|{shared}|{s}" for m, s in models.items()}
    content = annual.groupBy("corridor_id").agg(_content(annual).alias("content"))
    prints = [
        F.struct(F.lit(m).alias("model_name"), F.sha2(F.concat_ws("|", F.lit(context), "content"), 256).alias("fingerprint"))
        for m, context in contexts.items()
    ]
    return content.select("corridor_id", F.inline(F.array(*prints))).select("model_name", "corridor_id", "fingerprint")


def with_changes(prints: DataFrame, stored: DataFrame, pooled: Sequence[str] = ()) -> DataFrame:
    """``prints`` with ``trained``: true where no stored fit has the same fingerprint.

    A model in ``pooled`` is fitted to all corridors together: one that changed, came or went changes all.
    """
    keys = ["model_name", "corridor_id"]
    before = stored.select(*keys, F.col("fingerprint").alias("before"))
    both = prints.join(before, keys, "full_outer").where(F.col("model_name").isin(*pooled) | F.col("fingerprint").isNotNull())
    differs = ~F.col("fingerprint").eqNullSafe(F.col("before"))
    state = both.withColumn("trained", differs)
    if pooled:
        # one row per pooled model
        changed = state.where(F.col("model_name").isin(*pooled)).groupBy("model_name").agg(F.bool_or("trained").alias("any"))
        state = state.join(F.broadcast(changed), "model_name", "left").withColumn("trained", F.coalesce("any", "trained"))
    return state.where(F.col("fingerprint").isNotNull()).select(*keys, "fingerprint", "trained")
