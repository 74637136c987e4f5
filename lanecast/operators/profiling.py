"""Profiles of a table: shape, missing values, duplicates, distinct counts and summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The most values of one rank's interval, and of all intervals of one pass, that are gathered and sorted.
_SELECT_ROWS = 10_000
_GATHERED_ROWS = 100_000
_ACCURACY = 10_000
_CELL = 2.0 / _ACCURACY  # Twice the error of an approximate percentile of that accuracy.
QUARTILES = (0.25, 0.5, 0.75)


def profile_shape(df: DataFrame) -> DataFrame:
    """Name, position and type of each column, with the size of the table."""
    cells = [F.lit(len(df.columns))]
    for position, (name, dtype) in enumerate(df.dtypes):
        cells += [F.lit(position), F.lit(name), F.lit(dtype)]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.stack(*cells).alias("position", "column", "dtype"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )


def first_rows(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) for c in key]).limit(n)


def last_rows(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """The last rows in key order (a distributed table has no order of its own)."""
    return df.orderBy(*[F.desc_nulls_first(c) for c in key]).limit(n)


def profile_missing(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Missing count and percent of each column, largest first, from a single aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.expr(f"count_if({_missing_sql(name, dtype)}) AS `{name}`") for name, dtype in df.dtypes],
    )
    cells = ", ".join(f"'{name}', `{name}`" for name in df.columns)
    summary = counts.selectExpr("_rows", f"stack({len(df.columns)}, {cells}) AS (column, missing_count)").select(
        "column",
        "missing_count",
        F.try_divide(F.col("missing_count"), F.col("_rows")).cast("double").alias("_share"),
    )
    summary = summary.select("column", "missing_count", (F.col("_share") * 100).alias("missing_percent"))
    if only_missing:
        summary = summary.where(F.col("missing_count") > 0)
    return summary.orderBy(F.desc("missing_count"), "column")


def profile_duplicates(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one; copies combine map-side before the shuffle."""
    return df.groupBy(*df.columns).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_rows"))


#: Columns that one scan of the table counts the values of.
COLUMNS_PER_SCAN = 16


def _value_text(name: str, dtype: str) -> str:
    """A text that is equal exactly for equal values; NULL for a missing one."""
    if dtype == "string":
        text = f"`{name}`"
    elif dtype == "binary":
        text = f"hex(`{name}`)"
    elif dtype in ("double", "float"):
        text = f"CAST(`{name}` + 0 AS STRING)"  # minus zero is zero
    elif dtype.startswith(("array", "struct", "map", "variant")):
        text = f"to_json(struct(`{name}`))"
    else:
        text = f"CAST(`{name}` AS STRING)"
    return f"CASE WHEN NOT ({_missing_sql(name, dtype)}) THEN {text} END"


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n): how often each value of each column occurs, values as text, missing ones left out.

    A scan counts up to COLUMNS_PER_SCAN columns together; equal values combine in their task before anything is shuffled.
    """
    types = {name: dtype for name, dtype in df.dtypes if columns is None or name in columns}
    names = list(types)
    counted = []
    for begin in range(0, len(names), COLUMNS_PER_SCAN):
        group = names[begin : begin + COLUMNS_PER_SCAN]
        cells = ", ".join(f"'{name}', {_value_text(name, types[name])}" for name in group)
        long = df.selectExpr(f"stack({len(group)}, {cells}) AS (column, value)").where("value IS NOT NULL")
        counted.append(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    return reduce(DataFrame.unionByName, counted)


def profile_distinct(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-missing values of each column, largest first, exactly or by one sketch a column."""
    types = df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")
    if approximate:
        present = [F.expr(_value_text(*column)) for column in df.dtypes]
        sketched = df.agg(*[F.approx_count_distinct(p).alias(f"c{i}") for i, p in enumerate(present)])
        cells = ", ".join(f"'{name}', c{i}" for i, name in enumerate(df.columns))
        found = sketched.selectExpr(f"stack({len(df.columns)}, {cells}) AS (column, found)")
    else:
        found = value_counts(df).groupBy("column").agg(F.count(F.lit(1)).alias("found"))
    # one row a column
    rows = types.join(F.broadcast(found), "column", "left")
    return rows.select("column", "dtype", F.coalesce("found", F.lit(0)).alias("n_unique")).orderBy(F.desc("n_unique"), "column")


def profile_categorical(df: DataFrame) -> DataFrame:
    """Count, distinct count, most frequent value and its frequency for each text column.

    Of equally frequent values the smallest is reported.
    """
    names = [name for name, dtype in df.dtypes if dtype == "string"]
    spark = df.sparkSession
    if not names:
        return spark.createDataFrame([], "column string, count bigint, unique bigint, top string, freq bigint")
    found = value_counts(df, names).groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), "value")).alias("top"),
        F.max("n").alias("freq"),
    )
    rows = spark.createDataFrame([(n,) for n in names], "column string").join(F.broadcast(found), "column", "left")
    zero = F.lit(0).cast("long")
    return rows.select("column", F.coalesce("count", zero).alias("count"), F.coalesce("unique", zero).alias("unique"), "top", "freq")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of each numeric column."""
    names = list(columns or numeric_columns(df))
    values = df.select(*[_number(name).alias(name) for name in names])
    found = exact_quantiles(values, names, QUARTILES)
    quartiles = {name: F.array(*[F.lit(v).cast("double") for v in found[name]]) for name in names}
    summaries = [
        F.struct(
            F.count(name).alias("count"),
            F.avg(name).alias("mean"),
            F.stddev_samp(name).alias("std"),
            F.min(name).alias("min"),
            quartiles[name].alias("q"),
            F.max(name).alias("max"),
        ).alias(name)
        for name in names
    ]
    cells = ", ".join(f"'{name}', `{name}`" for name in names)
    return (
        values.agg(*summaries)
        .selectExpr(f"stack({len(names)}, {cells}) AS (column, s)")
        .selectExpr(
            "column", "s.count", "s.mean", "s.std", "s.min", "s.q[0] AS q25", "s.q[1] AS q50", "s.q[2] AS q75", "s.max"
        )
    )


def exact_quantiles(
    values: DataFrame, columns: Sequence[str], probabilities: Sequence[float], select_rows: int = _SELECT_ROWS
) -> dict[str, list[float | None]]:
    """Exact, linearly interpolated quantiles of columns of any length.

    Every wanted rank is enclosed by two values of an approximate percentile; counting the values
    below and at them either identifies the wanted one or leaves an interval thousands of times
    shorter. When what remains is short it is sorted. All columns share each pass, and only the
    counters reach the driver.
    """
    totals = values.agg(*[F.count(c).alias(c) for c in columns]).first()
    places = {c: [(totals[c] - 1) * p for p in probabilities] for c in columns if totals[c]}
    # Bounds of an open interval, the count of values at or below the lower one, and the count inside.
    open_ranks = {
        (c, rank): (None, None, 0, totals[c])
        for c, spots in places.items()
        for spot in spots
        for rank in (floor(spot), ceil(spot))
    }
    found: dict[tuple[str, int], float] = {}
    while open_ranks:
        short = {k: v for k, v in open_ranks.items() if v[3] <= select_rows}
        for group in _bounded(short):
            found.update(_select(values, group))
        open_ranks = _narrow(values, {k: v for k, v in open_ranks.items() if k not in short}, found)
    result: dict[str, list[float | None]] = {}
    for c in columns:
        result[c] = []
        for spot in places.get(c, [None] * len(probabilities)):
            if spot is None:
                result[c].append(None)
            else:
                low, high = found[c, floor(spot)], found[c, ceil(spot)]
                result[c].append(low + (high - low) * (spot - floor(spot)))
    return result


def _bounded(ranks: dict) -> list[dict]:
    """``ranks`` in groups whose intervals hold a bounded number of values together."""
    groups: list[dict] = []
    held = _GATHERED_ROWS
    for key, bounds in ranks.items():
        held += bounds[3]
        if held > _GATHERED_ROWS:
            groups.append({})
            held = bounds[3]
        groups[-1][key] = bounds
    return groups


def _inside(column: str, low: float | None, high: float | None) -> Column:
    """The values strictly between two bounds; None leaves a side open."""
    test = F.col(column).isNotNull()
    if low is not None:
        test &= F.col(column) > low
    if high is not None:
        test &= F.col(column) < high
    return F.when(test, F.col(column))


def _select(values: DataFrame, ranks: dict) -> dict:
    # At most a set number of values per rank is collected here; see exact_quantiles.
    intervals = {(c, low, high) for (c, _), (low, high, *_) in ranks.items()}
    names = {interval: f"i{i}" for i, interval in enumerate(intervals)}
    row = values.agg(*[F.sort_array(F.collect_list(_inside(*i))).alias(name) for i, name in names.items()]).first()
    return {
        (c, rank): row[names[c, low, high]][rank - below] for (c, rank), (low, high, below, *_) in ranks.items()
    }


def _narrow(values: DataFrame, ranks: dict, found: dict) -> dict:
    if not ranks:
        return {}
    # A bracket spans three cells of a grid of shares; neighbouring ranks fall into the same one.
    brackets: dict[tuple, list] = {}
    for (c, rank), (low, high, below, inside) in ranks.items():
        cell = floor((rank - below) / inside / _CELL)
        brackets.setdefault((c, low, high), []).append((rank, cell))
    pieces = []
    for i, (interval, members) in enumerate(brackets.items()):
        ends = [min(max((cell + side) * _CELL, 0.0), 1.0) for _, cell in members for side in (-1, 2)]
        pieces.append(F.percentile_approx(_inside(*interval), ends, _ACCURACY).alias(f"r{i}"))
    row = values.agg(*pieces).first()
    ends = {
        (interval[0], rank): row[f"r{i}"][2 * j : 2 * j + 2]
        for i, (interval, members) in enumerate(brackets.items())
        for j, (rank, _) in enumerate(members)
    }
    cuts = {(c, end): f"n{i}" for i, (c, end) in enumerate({(c, e) for (c, _), pair in ends.items() for e in pair})}
    row = values.agg(
        *[F.struct(F.count_if(F.col(c) < end), F.count_if(F.col(c) <= end)).alias(n) for (c, end), n in cuts.items()]
    ).first()
    remaining = {}
    for (c, rank), (new_low, new_high) in ends.items():
        low, high, below, inside = ranks[c, rank]
        under_low, upto_low = row[cuts[c, new_low]]
        under_high, upto_high = row[cuts[c, new_high]]
        if under_low <= rank < upto_low:
            found[c, rank] = new_low
        elif under_high <= rank < upto_high:
            found[c, rank] = new_high
        elif rank < under_low:
            remaining[c, rank] = (low, new_low, below, under_low - below)
        elif rank >= upto_high:
            remaining[c, rank] = (new_high, high, upto_high, below + inside - upto_high)
        else:
            remaining[c, rank] = (new_low, new_high, upto_low, under_high - upto_low)
    return remaining


def _missing_sql(name: str, dtype: str) -> str:
    return f"`{name}` IS NULL OR isnan(`{name}`)" if dtype in ("double", "float") else f"`{name}` IS NULL"


def _number(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)
