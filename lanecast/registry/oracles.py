"""Independent SQL for the registered queries, written directly over the star-schema tables."""

from __future__ import annotations

from ..functions.text import STATE_ABBREVIATIONS
from ..schemas import BOOSTED_FEATURES
from ..starschema import (
    EVENT_MAPPING,
    LAYOUT,
    MACRO_MAPPING,
    PART_PAID_SERIES,
)
from .model_sql import arima_ctes, trend_ctes

# Written out here, so that a wrong value in the code under test cannot pass.
YEARS = tuple(range(1995, 2002))
HOLDOUT_YEAR = 2001
HORIZON = tuple(range(2002, 2008))
BASE_YEAR = 2000
MID_FACTORS = {2005: 1.25, 2010: 1.5, 2015: 1.75, 2020: 2.0, 2025: 2.25}
LOW_FACTOR, HIGH_FACTOR = 0.75, 1.125
MEASURES = ("tons", "value", "tmiles")
MACROS = tuple(MACRO_MAPPING.values())
Z80 = 1.2815515655446004


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


LINES = f"""lines AS (
  SELECT s_nationkey AS o, c_nationkey AS d,
         CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS dms_mode,
         l_linenumber AS sctg2,
         CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS trade_type,
         CAST(year(o_orderdate) AS INTEGER) AS yr,
         l_quantity AS tons, l_extendedprice AS value,
         l_quantity * (1 + abs(s_nationkey - c_nationkey)) AS tmiles
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey)"""

MACRO_CASES = ", ".join(
    f"round(avg(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 4) AS {name}"
    if sid == PART_PAID_SERIES
    else f"round(avg(CASE WHEN o_orderpriority = '{sid}' THEN o_totalprice END), 4) AS {name}"
    for sid, name in MACRO_MAPPING.items()
)
MACRO = f"""macro AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {MACRO_CASES}
  FROM orders GROUP BY 1)"""
KNOWN_MACRO = f"known_macro AS (SELECT * FROM macro WHERE year <= {HOLDOUT_YEAR})"

ZONE_LANES = """lanes AS (
  SELECT CAST(a.n_nationkey * 25 + b.n_nationkey + 1 AS INTEGER) AS corridor_id,
         a.n_name || '_to_' || b.n_name AS corridor_name, a.n_nationkey AS o, b.n_nationkey AS d
  FROM nation a CROSS JOIN nation b)"""
STATE_LANES = """lanes AS (
  SELECT CAST(a.n_regionkey * 5 + b.n_regionkey + 1 AS INTEGER) AS corridor_id,
         ra.r_name || '_to_' || rb.r_name AS corridor_name, a.n_nationkey AS o, b.n_nationkey AS d
  FROM nation a CROSS JOIN nation b
  JOIN region ra ON ra.r_regionkey = a.n_regionkey JOIN region rb ON rb.r_regionkey = b.n_regionkey)"""

YEAR_LIST = ", ".join(f"({y})" for y in YEARS)
TOTALS = f"""totals AS (
  SELECT corridor_id, corridor_name, yr AS year, sum(tons) AS total_tons,
         round(sum(value), 2) AS total_value, sum(tmiles) AS total_tmiles
  FROM lines JOIN lanes USING (o, d) WHERE trade_type = 1 GROUP BY ALL),
grid AS (
  SELECT corridor_id, corridor_name, CAST(y AS INTEGER) AS year
  FROM (SELECT DISTINCT corridor_id, corridor_name FROM totals) CROSS JOIN (VALUES {YEAR_LIST}) AS v(y)),
filled AS (
  SELECT corridor_id, corridor_name, year, total_tons, total_value, total_tmiles
  FROM grid LEFT JOIN totals USING (corridor_id, corridor_name, year))"""
ANNUAL = f"annual AS (SELECT filled.*, {', '.join(MACROS)} FROM filled LEFT JOIN macro USING (year))"

ZONE_ANNUAL = (LINES, MACRO, ZONE_LANES, TOTALS, ANNUAL)
STATE_ANNUAL = (LINES, MACRO, STATE_LANES, TOTALS, ANNUAL)
ACTIVE = "active AS (SELECT * FROM annual WHERE total_tons IS NOT NULL)"


# --- wide tables ----------------------------------------------------------------------------------


def _wide(keys: str, years) -> str:
    sums = ", ".join(
        f"round(sum(CASE WHEN yr = {y} THEN {m} END), 2) AS {m}_{y}" for m in MEASURES for y in years
    )
    return f"SELECT {keys}, {sums} FROM lines GROUP BY ALL"


WIDE = f"wide AS ({_wide('o, d, dms_mode, sctg2, trade_type', YEARS)})"


def _future_columns(measures=MEASURES) -> str:
    cells = []
    for m in measures:
        cells += [f"{m}_{BASE_YEAR} * {f} AS {m}_{y}" for y, f in MID_FACTORS.items()]
    for m in ("tons", "value"):
        for y, f in MID_FACTORS.items():
            cells.append(f"{m}_{BASE_YEAR} * {f * LOW_FACTOR} AS {m}_{y}_low")
            cells.append(f"{m}_{BASE_YEAR} * {f * HIGH_FACTOR} AS {m}_{y}_high")
    return ", ".join(cells)


CODES = """o AS dms_orig, d AS dms_dest, CAST(dms_mode AS INTEGER) AS dms_mode, sctg2,
  CAST(trade_type AS INTEGER) AS trade_type, CAST(floor(abs(o - d) / 5.0) AS INTEGER) + 1 AS dist_band"""
ANNUAL_COLUMNS = ", ".join(f"{m}_{y}" for m in MEASURES for y in YEARS)
STAGE_DOMESTIC = _with(LINES, WIDE) + (
    f"SELECT {CODES}, {ANNUAL_COLUMNS}, {_future_columns()} FROM wide WHERE trade_type = 1"
)
RAW_FLOWS = _with(LINES, WIDE) + f"""SELECT {CODES},
  CAST(CASE WHEN trade_type = 2 THEN o END AS DOUBLE) AS fr_orig,
  CAST(CASE WHEN trade_type = 3 THEN d END AS DOUBLE) AS fr_dest,
  CAST(CASE WHEN trade_type = 2 THEN dms_mode END AS DOUBLE) AS fr_inmode,
  CAST(CASE WHEN trade_type = 3 THEN dms_mode END AS DOUBLE) AS fr_outmode,
  {ANNUAL_COLUMNS}, {", ".join(f"value_{y} AS current_value_{y}" for y in YEARS[1:])}, {_future_columns()}
FROM wide"""

HISTORY_KEYS = """CAST(o % 5 AS INTEGER) AS dms_origst, CAST(d % 5 AS INTEGER) AS dms_destst,
  CAST(dms_mode AS INTEGER) AS dms_mode, sctg2, CAST(trade_type AS INTEGER) AS trade_type"""
STAGE_HISTORY = _with(LINES) + (
    f"SELECT * FROM ({_wide(HISTORY_KEYS, LAYOUT.history_years)}) WHERE trade_type = 1"
)
HISTORY_WIDE = f"history AS ({_wide(HISTORY_KEYS, LAYOUT.history_years)})"
RAW_HISTORY = _with(LINES) + (
    f"SELECT *, {', '.join(f'CAST(NULL AS DOUBLE) AS fr_{c}' for c in ('orig', 'dest', 'inmode', 'outmode'))}, "
    f"{', '.join(f'value_{y} AS current_value_{y}' for y in LAYOUT.history_years)} "
    f"FROM ({_wide(HISTORY_KEYS, LAYOUT.history_years)})"
)

HISTORY_TOTALS = _with(
    LINES,
    ZONE_LANES,
    """state_totals AS (
  SELECT o % 5 AS os, d % 5 AS ds, yr, sum(tons) AS t, sum(value) AS v, sum(tmiles) AS m
  FROM lines WHERE trade_type = 1 GROUP BY ALL)""",
    "pairs AS (SELECT DISTINCT o % 5 AS os, d % 5 AS ds FROM lines WHERE trade_type = 1)",
) + f"""SELECT corridor_id, corridor_name, CAST(y AS INTEGER) AS year, t AS total_tons,
  round(v, 2) AS total_value, m AS total_tmiles, 'state' AS geography_level
FROM lanes JOIN pairs ON o % 5 = os AND d % 5 = ds
CROSS JOIN (VALUES {", ".join(f"({y})" for y in LAYOUT.history_years)}) AS v1(y)
LEFT JOIN state_totals s ON s.os = pairs.os AND s.ds = pairs.ds AND s.yr = y"""


def _band_rows() -> str:
    selects = [
        f"SELECT corridor_id, corridor_name, CAST({y} AS INTEGER) AS year, base * {f} AS bts_tons, "
        f"base * {f * LOW_FACTOR} AS bts_tons_low, base * {f * HIGH_FACTOR} AS bts_tons_high FROM base_tons"
        for y, f in MID_FACTORS.items()
    ]
    return " UNION ALL ".join(selects)


BAND = f"""base_tons AS (
  SELECT corridor_id, corridor_name, sum(CASE WHEN yr = {BASE_YEAR} THEN tons END) AS base
  FROM lines JOIN lanes USING (o, d) WHERE trade_type = 1 GROUP BY ALL),
band AS ({_band_rows()})"""


# --- features -------------------------------------------------------------------------------------


def _change(column: str) -> str:
    held = f"last_value({column} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = f"last_value({column} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"{held} / nullif({before}, 0) - 1"


FEATURES = {
    "tons_lag1": "lag(total_tons, 1) OVER w",
    "tons_lag2": "lag(total_tons, 2) OVER w",
    "tons_lag3": "lag(total_tons, 3) OVER w",
    "value_lag1": "lag(total_value, 1) OVER w",
    "diesel_lag1": "lag(diesel_price, 1) OVER w",
    "tons_rolling_mean_3yr": "avg(total_tons) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
    "tons_rolling_std_3yr": "stddev_samp(total_tons) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
    "tons_yoy_change": _change("total_tons"),
    "gdp_yoy_change": _change("gdp"),
    "diesel_yoy_change": _change("diesel_price"),
    "value_per_ton": "total_value / nullif(total_tons, 0)",
    "tmiles_per_ton": "total_tmiles / nullif(total_tons, 0)",
}
WINDOW = "WINDOW w AS (PARTITION BY corridor_id ORDER BY year)"


def _features(names, source: str, extra: str = "") -> str:
    cells = ", ".join(f"round({FEATURES[n]}, 6) AS {n}" for n in names)
    return f"SELECT corridor_id, corridor_name, year, {extra}{cells} FROM {source} {WINDOW}"


ALL_FEATURES = list(FEATURES)
BASE_COLUMNS = "total_tons, total_value, total_tmiles, " + ", ".join(MACROS) + ", "
ENRICHED = f"enriched AS ({_features(ALL_FEATURES, 'annual', BASE_COLUMNS)})"


# --- zones ----------------------------------------------------------------------------------------

_STATES = ", ".join(f"({i}, '{n}', '{a}')" for i, (n, a) in enumerate(STATE_ABBREVIATIONS.items()))
_COUNT = len(STATE_ABBREVIATIONS)
ZONES = f"""states(idx, name, abbr) AS (VALUES {_STATES}),
zones AS (
  SELECT CAST(c_custkey AS INTEGER) AS zone_id,
    CASE c_custkey % 10
      WHEN 0 THEN c_mktsegment || ' ' || s.abbr
      WHEN 1 THEN 'Rest of ' || s.abbr
      WHEN 2 THEN s.name
      WHEN 3 THEN c_mktsegment || ' ' || s.abbr || '-' || t.abbr || ' (' || t.abbr || ' Part)'
      WHEN 4 THEN 'Rest of ZZ'
      WHEN 5 THEN c_mktsegment || ' ' || s.abbr || '-' || t.abbr
      WHEN 6 THEN c_mktsegment || ' (ZZ Part)'
      WHEN 7 THEN 'outlying'
      WHEN 8 THEN 'plain'
      ELSE 'nowhere' END AS short,
    CASE c_custkey % 10
      WHEN 0 THEN c_mktsegment || ', ' || s.abbr || '  CFS Area'
      WHEN 1 THEN 'Remainder of ' || s.name
      WHEN 7 THEN 'Remainder of  ' || s.name || ' '
      WHEN 8 THEN s.name
      WHEN 9 THEN 'nothing known'
      ELSE 'area of ' || s.abbr || ' XY' END AS long
  FROM customer
  JOIN states s ON s.idx = c_custkey % {_COUNT}
  JOIN states t ON t.idx = (c_custkey * 7 + 3) % {_COUNT})"""
ZONE_TO_STATE = _with(
    ZONES,
    r"""tokens AS (
  SELECT zone_id, unnest(tok) AS token, generate_subscripts(tok, 1) AS place
  FROM (SELECT zone_id, regexp_extract_all(short || ' ' || long, '\b([A-Z]{2})\b', 1) AS tok FROM zones)),
last_token AS (
  SELECT zone_id, arg_max(name, place) AS name FROM tokens JOIN states ON token = abbr GROUP BY zone_id),
named AS (
  SELECT z.zone_id, z.short, z.long,
    CASE
      WHEN part.name IS NOT NULL THEN part.name
      WHEN own.name IS NOT NULL THEN own.name
      WHEN rem.name IS NOT NULL THEN rem.name
      WHEN z.short LIKE 'Rest of %' THEN rest.name
      WHEN whole.name IS NOT NULL THEN whole.name
      ELSE lt.name END AS state_name
  FROM zones z
  LEFT JOIN states part ON part.abbr = regexp_extract(z.short || ' ' || z.long, '\(([A-Z]{2}) Part\)', 1)
  LEFT JOIN states own ON own.name = z.short
  LEFT JOIN states rem ON z.long LIKE 'Remainder of %' AND rem.name = trim(z.long[14:])
  LEFT JOIN states rest ON rest.abbr = trim(z.short[9:])
  LEFT JOIN states whole ON whole.name = z.long
  LEFT JOIN last_token lt ON lt.zone_id = z.zone_id)""",
) + """SELECT zone_id, short AS zone_short_description, long AS zone_long_description,
  CAST(idx + 1 AS INTEGER) AS state_fips, state_name
FROM named LEFT JOIN states ON state_name = name"""
LOOKUP_NORMALISE = _with(ZONES) + (
    "SELECT zone_id AS numeric_label, short AS short_description, long AS long_description FROM zones"
)


# --- regressors -----------------------------------------------------------------------------------


def _values(years) -> str:
    return ", ".join(f"({int(y)})" for y in years)


def _extrapolated(name: str, source: str, key: str, value: str, years) -> str:
    """CTEs ending in ``name(key, year, value)``."""
    return f"""{name}_ranked AS (
  SELECT {key}, year, {value} AS value, row_number() OVER (PARTITION BY {key} ORDER BY year DESC) AS n
  FROM {source} WHERE {value} IS NOT NULL),
{name}_line AS (
  SELECT {key}, max(CASE WHEN n = 1 THEN year END) AS last_year, max(CASE WHEN n = 1 THEN value END) AS last_value,
         max(CASE WHEN n = 1 THEN value END) - max(CASE WHEN n = 2 THEN value END) AS slope
  FROM {name}_ranked GROUP BY {key}),
{name} AS (
  SELECT k.{key}, CAST(y AS INTEGER) AS year,
         coalesce(s.{value}, last_value + coalesce(slope, 0) * (y - last_year)) AS value
  FROM (SELECT DISTINCT {key} FROM {source}) k CROSS JOIN (VALUES {_values(years)}) AS t(y)
  LEFT JOIN {name}_line l ON l.{key} = k.{key}
  LEFT JOIN {source} s ON s.{key} = k.{key} AND s.year = y)"""


def _macro_future(source: str, years) -> str:
    long = " UNION ALL ".join(f"SELECT '{m}' AS sid, year, {m} AS mv FROM {source}" for m in MACROS)
    wide = ", ".join(f"round(max(CASE WHEN sid = '{m}' THEN value END), 4) AS {m}" for m in MACROS)
    return f"""long_macro AS ({long}),
{_extrapolated("carried", "long_macro", "sid", "mv", years)},
future_macro AS (SELECT year, {wide} FROM carried GROUP BY year)"""


STEP_YEARS = (2000, 2001, *HORIZON)
STEP_REGRESSORS = _with(MACRO, _macro_future("macro", STEP_YEARS)) + "SELECT f.year, " + ", ".join(
    f"CASE WHEN m.year IS NOT NULL THEN m.{c} ELSE f.{c} END AS {c}" for c in MACROS
) + " FROM future_macro f LEFT JOIN macro m ON m.year = f.year"


# --- forecasts ------------------------------------------------------------------------------------


def _walk(name: str, source: str, model: str) -> str:
    """Random walk over rows without gaps handled: changes span the rows since the last known value."""
    future = ", ".join(f"({i + 1}, {y})" for i, y in enumerate(HORIZON))
    return f"""{name}_pos AS (
  SELECT corridor_id, corridor_name, year, total_tons,
         row_number() OVER (PARTITION BY corridor_id ORDER BY year) AS pos FROM {source}),
{name}_chg AS (
  SELECT *, pos - lag(pos) OVER k AS gap, total_tons - lag(total_tons) OVER k AS chg
  FROM {name}_pos WHERE total_tons IS NOT NULL WINDOW k AS (PARTITION BY corridor_id ORDER BY year)),
{name}_fit AS (
  SELECT p.corridor_id, p.corridor_name, cut,
         max(p.pos) AS last_pos, max(CASE WHEN p.total_tons IS NOT NULL THEN p.pos END) AS known_pos,
         arg_max(p.total_tons, p.pos) FILTER (WHERE p.total_tons IS NOT NULL) AS level,
         avg(c.chg * c.chg / c.gap) AS variance
  FROM (VALUES ('train', {HOLDOUT_YEAR - 1}), ('full', 9999)) AS cuts(cut, upto)
  JOIN {name}_pos p ON p.year <= upto
  LEFT JOIN {name}_chg c ON c.corridor_id = p.corridor_id AND c.year = p.year
  GROUP BY ALL),
{name}_rows AS (
  SELECT corridor_id, corridor_name, 'future' AS forecast_type, CAST(y AS INTEGER) AS year, level,
         sqrt(variance * (last_pos - known_pos + step)) AS dev
  FROM {name}_fit CROSS JOIN (VALUES {future}) AS h(step, y) WHERE cut = 'full'
  UNION ALL
  SELECT p.corridor_id, p.corridor_name, 'holdout', p.year, level, sqrt(variance * (last_pos - known_pos + 1))
  FROM {name}_pos p LEFT JOIN {name}_fit f ON f.corridor_id = p.corridor_id AND f.cut = 'train'
  WHERE p.year = {HOLDOUT_YEAR}),
{name} AS (
  SELECT corridor_id, corridor_name, '{model}' AS model_name, 'leave_last_year_out' AS training_strategy,
         forecast_type, year, level AS prediction, level - {Z80} * dev AS lower_bound, level + {Z80} * dev AS upper_bound
  FROM {name}_rows)"""


ROUND_FORECAST = """corridor_id, corridor_name, model_name, training_strategy, forecast_type, year,
  round(prediction, 4) AS prediction, round(lower_bound, 4) AS lower_bound, round(upper_bound, 4) AS upper_bound"""

STRAIGHT = f"""train_rows AS (SELECT * FROM annual WHERE year < {HOLDOUT_YEAR}),
{_extrapolated("line_holdout", "train_rows", "corridor_id", "total_tons", [HOLDOUT_YEAR])},
{_extrapolated("line_future", "annual", "corridor_id", "total_tons", HORIZON)},
line AS (
  SELECT corridor_id, corridor_name, 'StraightLine' AS model_name, 'leave_last_year_out' AS training_strategy,
         forecast_type, year, value AS prediction, value * 0.75 AS lower_bound, value * 1.25 AS upper_bound
  FROM (SELECT 'holdout' AS forecast_type, * FROM line_holdout UNION ALL SELECT 'future', * FROM line_future)
  JOIN (SELECT DISTINCT corridor_id, corridor_name FROM annual) USING (corridor_id))"""
FORECASTS = "forecasts AS (SELECT * FROM walk UNION ALL SELECT * FROM line)"
ALL_FORECASTS = (*ZONE_ANNUAL, _walk("walk", "annual", "RandomWalk"), STRAIGHT, FORECASTS)

BOTH_CUTS = (("train", HOLDOUT_YEAR - 1), ("full", 9999))
BACKTEST_YEARS = YEARS[3:]
BACKTEST_CUTS = tuple((f"before_{y}", y - 1) for y in BACKTEST_YEARS)


def _recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def _fitted(name: str, model: str, source: str, mean: str, deviation: str) -> str:
    """A forecast table from (cut, corridor_id, year) rows; corridors without an observation in the holdout year have none there."""
    return f"""{name} AS (
  SELECT corridor_id, corridor_name, '{model}' AS model_name, 'leave_last_year_out' AS training_strategy, forecast_type, year,
         {mean} AS prediction, {mean} - {Z80} * {deviation} AS lower_bound, {mean} + {Z80} * {deviation} AS upper_bound
  FROM (SELECT corridor_id, corridor_name, 'holdout' AS forecast_type, year, 'train' AS cut FROM annual WHERE year = {HOLDOUT_YEAR}
        UNION ALL SELECT DISTINCT corridor_id, corridor_name, 'future', CAST(y AS INTEGER), 'full' FROM annual CROSS JOIN (VALUES {_values(HORIZON)}) AS v(y))
  LEFT JOIN {source} USING (cut, corridor_id, year))"""


ARIMA = (
    *arima_ctes(BOTH_CUTS, len(HORIZON)),
    f"a_years AS (SELECT *, CASE cut WHEN 'train' THEN {HOLDOUT_YEAR} ELSE {HOLDOUT_YEAR} + step END AS year FROM a_path WHERE cut = 'full' OR step = 1)",
    _fitted("arima", "ARIMA", "a_years", "level", "sqrt(variance)"),
)
_REGRESSOR_LIST = "gdp, diesel_price, industrial_production, unemployment_rate"
TREND = (
    KNOWN_MACRO,
    _macro_future("known_macro", HORIZON).replace("round(max(CASE WHEN sid", "(max(CASE WHEN sid").replace("END), 4)", "END))"),
    *trend_ctes(
        BOTH_CUTS,
        f"""SELECT 'train' AS cut, corridor_id, year, {_REGRESSOR_LIST} FROM annual WHERE year = {HOLDOUT_YEAR}
  UNION ALL SELECT 'full', corridor_id, year, {_REGRESSOR_LIST} FROM (SELECT DISTINCT corridor_id FROM annual) CROSS JOIN future_macro""",
        "known_macro",
        HOLDOUT_YEAR,
    ),
    _fitted("trend", "TrendRegression", "t_found", "mean", "deviation"),
)
BACKTESTS = f"""backtests AS (
  SELECT 'ARIMA' AS model_name, a.corridor_id, corridor_name, year, total_tons AS actual, level AS prediction
  FROM annual a JOIN a_path p ON p.corridor_id = a.corridor_id AND cut = 'before_' || year AND step = 1
  UNION ALL
  SELECT 'TrendRegression', corridor_id, corridor_name, year, total_tons, mean
  FROM annual JOIN (VALUES {_values(BACKTEST_YEARS)}) AS v(y) ON year = y LEFT JOIN t_found USING (corridor_id, year)
  UNION ALL
  SELECT 'RandomWalk', corridor_id, corridor_name, year, actual, prediction
  FROM (SELECT corridor_id, corridor_name, year, total_tons AS actual, row_number() OVER w AS n,
          last_value(total_tons IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prediction
        FROM annual WINDOW w AS (PARTITION BY corridor_id ORDER BY year)) WHERE n > 3)"""
BACKTESTED = (
    *arima_ctes(BACKTEST_CUTS, 1),
    KNOWN_MACRO,
    *trend_ctes(
        BACKTEST_CUTS,
        f"SELECT 'before_' || year AS cut, corridor_id, year, {_REGRESSOR_LIST} FROM annual WHERE year >= {BACKTEST_YEARS[0]}",
        "known_macro",
        HOLDOUT_YEAR,
    ),
    BACKTESTS,
)

SCORES = f"""holdout AS (
  SELECT f.corridor_id, f.corridor_name, model_name, training_strategy, f.year, a.total_tons AS actual, prediction,
         abs((a.total_tons - prediction) / nullif(a.total_tons, 0)) * 100 AS mape,
         abs(a.total_tons - prediction) AS rmse, abs(a.total_tons - prediction) AS mae
  FROM forecasts f JOIN annual a ON a.corridor_id = f.corridor_id AND a.year = f.year
  WHERE forecast_type = 'holdout' AND f.year = {HOLDOUT_YEAR})"""
VERDICTS = """verdicts AS (
  SELECT f.corridor_id, f.corridor_name, model_name, training_strategy, f.year, prediction,
         bts_tons, bts_tons_low, bts_tons_high,
         coalesce(prediction BETWEEN bts_tons_low AND bts_tons_high, false) AS within_bts_band,
         (prediction - bts_tons) / nullif(bts_tons, 0) * 100 AS pct_deviation_vs_bts
  FROM forecasts f JOIN band b ON b.corridor_id = f.corridor_id AND b.year = f.year
  WHERE forecast_type = 'future' AND f.year = 2005)"""
COMPARISON = """comparison AS (
  SELECT corridor_id, corridor_name, model_name, training_strategy, round(mape, 6) AS mape, round(rmse, 6) AS rmse,
         round(mae, 6) AS mae, within_bts_band, round(pct_deviation_vs_bts, 6) AS pct_deviation_vs_bts
  FROM holdout LEFT JOIN (SELECT corridor_id, model_name, within_bts_band, pct_deviation_vs_bts FROM verdicts)
  USING (corridor_id, model_name))"""
COMPARED = (*ALL_FORECASTS, BAND, SCORES, VERDICTS, COMPARISON)


# --- profiles -------------------------------------------------------------------------------------

LINE_TYPES = (
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
)
def _numeric(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(CAST(min({c}) AS DOUBLE), 4) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75,
  round(CAST(max({c}) AS DOUBLE), 4) AS max FROM {table}"""
        for c in columns
    )


def _missing(columns) -> str:
    rows = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
  round((count(*) - count({c})) * 1.0 / count(*) * 100, 6) AS missing_percent FROM raw_flows"""
        for c in columns
    )
    return _with(f"raw_flows AS ({RAW_FLOWS})") + f"SELECT * FROM ({rows})"


def _flow_columns() -> list[str]:
    from ..schemas import flow_schema

    return flow_schema(LAYOUT).names


def _categorical(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS count, count(DISTINCT {column}) AS "unique",
  (SELECT {column} FROM orders WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {column} LIMIT 1) AS top,
  (SELECT count(*) FROM orders WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY 1 DESC LIMIT 1) AS freq
FROM orders"""


SERIES = f"""series AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date, o_totalprice AS value
  FROM orders
  UNION ALL
  SELECT '{PART_PAID_SERIES}', CAST(o_orderdate AS DATE), o_totalprice
  FROM orders WHERE o_orderstatus = 'P')"""

ORACLES: dict[str, str] = {
    "stage_domestic": STAGE_DOMESTIC,
    "stage_history": STAGE_HISTORY,
    "macro_annual_pivot": _with(MACRO) + "SELECT * FROM macro",
    "macro_daily_pivot_events": "SELECT CAST(ts AS DATE) AS period, "
    + ", ".join(
        f"round(avg(CASE WHEN event_type = '{e}' THEN value END), 6) AS {n}" for e, n in EVENT_MAPPING.items()
    )
    + " FROM events GROUP BY 1",
    "zone_to_state": ZONE_TO_STATE,
    "corridor_annual": _with(*ZONE_ANNUAL) + "SELECT * FROM annual",
    "corridor_annual_state": _with(*STATE_ANNUAL) + "SELECT * FROM annual",
    "corridor_annual_large_dimension": _with(LINES, ZONE_LANES, TOTALS) + "SELECT * FROM filled",
    "corridor_annual_via_unpivot": _with(LINES, ZONE_LANES, TOTALS) + "SELECT * FROM filled",
    "corridor_history_state": HISTORY_TOTALS,
    "benchmark_band": _with(LINES, ZONE_LANES, BAND) + "SELECT * FROM band",
    "layer_row_counts": _with(LINES, WIDE, MACRO, SERIES, ZONE_LANES, TOTALS, HISTORY_WIDE)
    + f"""SELECT 'raw_flows' AS table_name, count(*) AS row_count FROM wide
UNION ALL SELECT 'raw_flow_history', count(*) FROM history
UNION ALL SELECT 'raw_macro_series', count(*) FROM series
UNION ALL SELECT 'raw_zones', count(*) FROM nation
UNION ALL SELECT 'raw_states', count(*) FROM region
UNION ALL SELECT 'staged_flows', count(*) FROM wide WHERE trade_type = 1
UNION ALL SELECT 'staged_flow_history', count(*) FROM history WHERE trade_type = 1
UNION ALL SELECT 'staged_macro_annual', count(*) FROM (
  SELECT DISTINCT year(date) FROM series)
UNION ALL SELECT 'staged_zone_state', count(*) FROM nation
UNION ALL SELECT 'feature_corridor_annual', count(*) FROM filled
UNION ALL SELECT 'feature_corridor_enriched', count(*) FROM filled
UNION ALL SELECT 'feature_corridor_history', {len(LAYOUT.history_years)} * count(*) FROM lanes
  JOIN (SELECT DISTINCT dms_origst, dms_destst FROM history WHERE trade_type = 1) ON o % 5 = dms_origst AND d % 5 = dms_destst
UNION ALL SELECT 'feature_benchmark', {len(MID_FACTORS)} * count(DISTINCT corridor_id) FROM totals""",
    "feat_lags": _with(*ZONE_ANNUAL) + _features(ALL_FEATURES[:5], "annual"),
    "feat_rolling": _with(*ZONE_ANNUAL) + _features(ALL_FEATURES[5:7], "annual"),
    "feat_yoy_padded": _with(*ZONE_ANNUAL) + _features(ALL_FEATURES[7:10], "annual"),
    "feat_ratios": _with(*ZONE_ANNUAL) + _features(ALL_FEATURES[10:], "annual"),
    "corridor_enriched": _with(*ZONE_ANNUAL, ENRICHED) + "SELECT * FROM enriched",
    "feat_on_sparse_zone_pairs": _with(*ZONE_ANNUAL, ACTIVE) + _features(ALL_FEATURES, "active", "total_tons, "),
    "feat_calendar_windows": _with(*ZONE_ANNUAL, ACTIVE)
    + """SELECT a.corridor_id, a.corridor_name, a.year,
  round(b1.total_tons, 6) AS tons_lag1, round(b2.total_tons, 6) AS tons_lag2, round(b3.total_tons, 6) AS tons_lag3,
  round(b1.total_value, 6) AS value_lag1, round(b1.diesel_price, 6) AS diesel_lag1,
  round(list_avg(list_value(b1.total_tons, b2.total_tons, b3.total_tons)), 6) AS tons_rolling_mean_3yr,
  round(list_stddev_samp(list_value(b1.total_tons, b2.total_tons, b3.total_tons)), 6) AS tons_rolling_std_3yr
FROM active a
LEFT JOIN active b1 ON b1.corridor_id = a.corridor_id AND b1.year = a.year - 1
LEFT JOIN active b2 ON b2.corridor_id = a.corridor_id AND b2.year = a.year - 2
LEFT JOIN active b3 ON b3.corridor_id = a.corridor_id AND b3.year = a.year - 3""",
    "table_replaced_whole": _with(*ZONE_ANNUAL) + "SELECT * FROM annual",
    "retrain_changed": _with(*ZONE_ANNUAL)
    + f"""SELECT model_name, corridor_id, true AS at_first, false AS again,
  corridor_id % 10 = 0 AND coalesce(max(CASE WHEN year = {HOLDOUT_YEAR} THEN total_tons END), 0) <> 0 AS after_a_change
FROM annual CROSS JOIN (VALUES ('ARIMA'), ('TrendRegression')) m(model_name) GROUP BY model_name, corridor_id""",
    "load_flow_csv": RAW_FLOWS,
    "load_history_csv": RAW_HISTORY,
    "load_validation": _with(LINES, WIDE)
    + "SELECT 'raw_flows' AS target, count(*) AS sent, count(*) AS stored FROM wide",
    "series_replace": _with(SERIES)
    + """SELECT '00' || substr(series_id, 1, 1) AS series_id, date,
  CASE WHEN substr(series_id, 1, 1) = '1' THEN value * 2 ELSE value END AS value FROM series""",
    "series_combine": """SELECT event_type AS series_id, CAST(ts AS DATE) AS date, value FROM events
WHERE value IS NOT NULL AND NOT isnan(value)""",
    "lookup_normalise": LOOKUP_NORMALISE,
    "lookup_load": _with(ZONES)
    + """SELECT 'raw_states' AS table_name, CAST(n_nationkey AS INTEGER) AS numeric_label, n_name AS description FROM nation
UNION ALL SELECT 'raw_zones', zone_id, long FROM zones
UNION ALL SELECT 'raw_commodities', c_custkey, c_name FROM customer
UNION ALL SELECT 'raw_modes', r_regionkey, r_name FROM region
UNION ALL SELECT 'raw_trade_types', s_suppkey, s_name FROM supplier
UNION ALL SELECT 'raw_distance_bands', n_nationkey, n_name FROM nation
UNION ALL SELECT 'raw_distance_bands', r_regionkey, r_name FROM region""",
    "macro_extrapolate": _with(
        LINES, ZONE_LANES, TOTALS, _extrapolated("carried", "filled", "corridor_id", "total_tons", (2000, 2001, 2002, 2004))
    )
    + "SELECT * FROM carried",
    "future_regressors": _with(MACRO, KNOWN_MACRO, ZONE_LANES, _macro_future("known_macro", HORIZON))
    + f"SELECT year, {', '.join(MACROS)}, corridor_id, corridor_name FROM future_macro CROSS JOIN lanes",
    "step_regressors": STEP_REGRESSORS,
    "forecast_random_walk": _with(*ZONE_ANNUAL, _walk("walk", "annual", "RandomWalk"))
    + f"SELECT {ROUND_FORECAST} FROM walk",
    "forecast_arima_fixed_order": _with(*ZONE_ANNUAL, _walk("walk", "annual", "ARIMA"))
    + f"SELECT {ROUND_FORECAST} FROM walk",
    "forecast_arima": _recursive(*ZONE_ANNUAL, *ARIMA) + f"SELECT {ROUND_FORECAST} FROM arima",
    "arima_orders": _recursive(*ZONE_ANNUAL, *ARIMA)
    + f"""SELECT a.corridor_id, a.corridor_name, model_order, round(aic, 6) AS aic, CAST(n_rows AS INTEGER) AS training_rows,
  CAST(full_rows AS INTEGER) AS full_rows
FROM annual a LEFT JOIN a_best b ON b.corridor_id = a.corridor_id AND b.cut = 'train'
JOIN (SELECT corridor_id, count(*) AS full_rows FROM annual GROUP BY 1) c ON c.corridor_id = a.corridor_id WHERE a.year = {HOLDOUT_YEAR}""",
    "forecast_trend": _recursive(*ZONE_ANNUAL, *TREND) + f"SELECT {ROUND_FORECAST.replace(', 4)', ', 1)')} FROM trend",
    "backtest_models": _recursive(*ZONE_ANNUAL, *BACKTESTED)
    + "SELECT model_name, corridor_id, corridor_name, "
    + ", ".join(
        f"CASE any_value(model_name) WHEN 'TrendRegression' THEN round({m}, 1) ELSE round({m}, 5) END AS {name}"
        for name, m in {
            "mape": "avg(abs((actual - prediction) / nullif(actual, 0))) * 100",
            "rmse": "sqrt(avg((actual - prediction) * (actual - prediction)))",
            "mae": "avg(abs(actual - prediction))",
        }.items()
    )
    + " FROM backtests GROUP BY ALL",
    "boosted_walk": _with(*ZONE_ANNUAL)
    + f"""SELECT corridor_id, 'holdout' AS forecast_type, year, 0.0::DOUBLE AS apart, 0.2::DOUBLE AS width FROM annual WHERE year = {HOLDOUT_YEAR}
UNION ALL SELECT DISTINCT corridor_id, 'future', CAST(y AS INTEGER), 0.0::DOUBLE, 0.08::DOUBLE FROM annual CROSS JOIN (VALUES {_values(HORIZON)}) AS v(y)""",
    "boosted_importance_from_nodes": "SELECT feature, 0.0::DOUBLE AS apart FROM (VALUES "
    + ", ".join(f"('{f}')" for f in BOOSTED_FEATURES)
    + ") AS v(feature) WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'N')",
    "corridor_rows": _with(ZONE_LANES) + "SELECT corridor_id, corridor_name, CAST(o AS INTEGER) AS origin, CAST(d AS INTEGER) AS destination FROM lanes",
    "ordered_scan": _with(*ZONE_ANNUAL) + "SELECT *, row_number() OVER (ORDER BY corridor_id, year) AS row_number FROM annual",
    "score_table_ordered": _with(*ALL_FORECASTS, SCORES)
    + """SELECT corridor_id, corridor_name, model_name, training_strategy, year, actual, round(prediction, 6) AS prediction,
  round(mape, 6) AS mape, round(rmse, 6) AS rmse, round(mae, 6) AS mae,
  row_number() OVER (ORDER BY mape NULLS LAST, corridor_id, model_name) AS place FROM holdout""",
    "importance_file": """SELECT l_returnflag AS feature, round(sum(l_quantity) / (SELECT sum(l_quantity) FROM lineitem), 6) AS importance
FROM lineitem GROUP BY 1""",
    "feat_infinite_inputs": _with(
        *ZONE_ANNUAL,
        "holed AS (SELECT * REPLACE (CASE WHEN year % 3 <> 0 THEN total_value END AS total_value, CASE WHEN year % 3 <> 0 THEN gdp END AS gdp) FROM annual)",
    )
    + _features(["value_per_ton", "gdp_yoy_change"], "holed", "total_value, gdp, "),
    "profile_files": " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS "column", count(*) - count({c}) AS missing_count, count(DISTINCT {c}) AS n_unique FROM {t}"""
        for t, columns in {
            "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
            "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
            "lineitem": tuple(c for c, _ in LINE_TYPES),
        }.items()
        for c in columns
    ),
    "dated_series": _with(LINES, ZONE_LANES, TOTALS)
    + "SELECT corridor_id, make_date(year, 1, 1) AS ds, total_tons AS y FROM filled",
    "boosted_training_rows": _with(*ZONE_ANNUAL, ENRICHED)
    + f"SELECT {', '.join(BOOSTED_FEATURES)}, total_tons FROM enriched WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in (*BOOSTED_FEATURES, "total_tons")),
    "interval_quantile": _with(*ZONE_ANNUAL)
    + """SELECT corridor_id, round(quantile_cont(total_tons, 0.1), 6) AS lower_bound,
  round(quantile_cont(total_tons, 0.9), 6) AS upper_bound FROM annual GROUP BY corridor_id""",
    "expanding_splits": _with(
        *ZONE_ANNUAL,
        ACTIVE,
        """ordered AS (
  SELECT corridor_id, year, row_number() OVER (PARTITION BY corridor_id ORDER BY year) AS n FROM active)""",
    )
    + """SELECT t.corridor_id, string_agg(CAST(e.year AS VARCHAR), ',' ORDER BY e.year) AS train_years, t.year AS test_year
FROM ordered t JOIN ordered e ON e.corridor_id = t.corridor_id AND e.n < t.n
WHERE t.n > 4 GROUP BY t.corridor_id, t.year""",
    "boosted_state": _with(*ZONE_ANNUAL)
    + """SELECT corridor_id, corridor_name, round(max(CASE WHEN n = 1 THEN total_tons END), 4) AS tons_lag1,
  round(max(CASE WHEN n = 2 THEN total_tons END), 4) AS tons_lag2, round(max(CASE WHEN n = 3 THEN total_tons END), 4) AS tons_lag3,
  round(max(CASE WHEN n = 1 THEN gdp END), 4) AS gdp_before, round(max(CASE WHEN n = 1 THEN diesel_price END), 4) AS diesel_lag1,
  round(avg(total_value / nullif(total_tons, 0)), 4) AS value_ratio
FROM (SELECT *, row_number() OVER (PARTITION BY corridor_id ORDER BY year DESC) AS n FROM annual) GROUP BY ALL""",
    "expanding_backtest_random_walk": _with(*ZONE_ANNUAL)
    + """SELECT corridor_id, corridor_name, year AS test_year, actual, prediction, CAST(n - 1 AS INTEGER) AS train_size
FROM (SELECT corridor_id, corridor_name, year, total_tons AS actual, row_number() OVER w AS n,
        last_value(total_tons IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prediction
      FROM annual WINDOW w AS (PARTITION BY corridor_id ORDER BY year)) WHERE n > 3""",
    "backtest_metrics": _with(*ZONE_ANNUAL)
    + """SELECT corridor_id, corridor_name,
  round(avg(abs((actual - prediction) / nullif(actual, 0))) * 100, 6) AS mape,
  round(sqrt(avg((actual - prediction) * (actual - prediction))), 6) AS rmse,
  round(avg(abs(actual - prediction)), 6) AS mae
FROM (SELECT corridor_id, corridor_name, total_tons AS actual, row_number() OVER w AS n,
        last_value(total_tons IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prediction
      FROM annual WINDOW w AS (PARTITION BY corridor_id ORDER BY year)) WHERE n > 3 GROUP BY ALL""",
    "holdout_scores": _with(*ALL_FORECASTS, SCORES)
    + """SELECT corridor_id, corridor_name, model_name, training_strategy, year, actual, round(prediction, 6) AS prediction,
  round(mape, 6) AS mape, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM holdout""",
    "benchmark_scores": _with(*ALL_FORECASTS, BAND, VERDICTS)
    + """SELECT * REPLACE (round(prediction, 6) AS prediction, round(bts_tons, 6) AS bts_tons,
  round(bts_tons_low, 6) AS bts_tons_low, round(bts_tons_high, 6) AS bts_tons_high,
  round(pct_deviation_vs_bts, 6) AS pct_deviation_vs_bts) FROM verdicts""",
    "model_comparison": _with(*COMPARED) + "SELECT * FROM comparison",
    "metrics_by_model": _with(*ALL_FORECASTS, SCORES)
    + """SELECT model_name, round(avg(mape), 6) AS mape, round(sqrt(avg(rmse * rmse)), 6) AS rmse,
  round(avg(mae), 6) AS mae FROM holdout GROUP BY model_name""",
    "forecast_store": _with(*ALL_FORECASTS) + f"SELECT {ROUND_FORECAST} FROM forecasts",
    "forecast_csv_scan": _with(*ALL_FORECASTS) + f"SELECT {ROUND_FORECAST} FROM forecasts",
    "run_log_flat": _with(*ALL_FORECASTS, SCORES)
    + """SELECT 'FINISHED' AS status, CAST(corridor_id AS VARCHAR) AS corridor_id, corridor_name, model_name,
  training_strategy, round(mape, 6) AS mape, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM holdout""",
    "metrics_json": _with(*ALL_FORECASTS, SCORES)
    + """SELECT corridor_id, model_name, round(mape, 6) AS mape, round(rmse, 6) AS rmse, round(mae, 6) AS mae
FROM holdout WHERE model_name = 'RandomWalk'""",
    "optional_tables": _with(SERIES)
    + """SELECT 'present' AS table_name, count(*) AS row_count FROM series
UNION ALL SELECT 'absent', 0""",
    "kpi_latest_year": _with(*ZONE_ANNUAL, ACTIVE)
    + """SELECT a.corridor_id, a.corridor_name, a.year, a.total_tons, a.total_value, a.total_tmiles,
  p.total_tons AS previous_tons,
  round((a.total_tons - p.total_tons) / nullif(p.total_tons, 0) * 100, 6) AS yoy_pct
FROM active a JOIN (SELECT corridor_id, max(year) AS year FROM active GROUP BY 1) m USING (corridor_id, year)
LEFT JOIN active p ON p.corridor_id = a.corridor_id AND p.year = a.year - 1""",
    "best_model": _with(*COMPARED)
    + """SELECT corridor_id, corridor_name, model_name, training_strategy, mape, rmse, mae, within_bts_band,
  pct_deviation_vs_bts FROM comparison
QUALIFY row_number() OVER (PARTITION BY corridor_id ORDER BY mape NULLS LAST, model_name) = 1""",
    "rmse_matrix": _with(*COMPARED)
    + """SELECT corridor_id, corridor_name, avg(CASE WHEN model_name = 'RandomWalk' THEN rmse END) AS RandomWalk,
  avg(CASE WHEN model_name = 'StraightLine' THEN rmse END) AS StraightLine FROM comparison GROUP BY 1, 2""",
    "score_bars": _with(*COMPARED)
    + "SELECT corridor_name, model_name, pct_deviation_vs_bts AS height FROM comparison",
    "selected_rows": _with(*ALL_FORECASTS)
    + f"""SELECT {ROUND_FORECAST} FROM forecasts
WHERE corridor_name IN ('NATION_20_to_NATION_11', 'NATION_18_to_NATION_19') AND model_name = 'RandomWalk'""",
    "corridor_names": _with(LINES, ZONE_LANES, TOTALS) + "SELECT DISTINCT corridor_name FROM totals",
    "model_names": "SELECT model_name FROM (VALUES ('RandomWalk'), ('StraightLine')) AS v(model_name)"
    " WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'N')",
    "chart_feed": _with(*ALL_FORECASTS, BAND)
    + """SELECT corridor_id, corridor_name, year, 'actual' AS series, round(total_tons, 4) AS value,
  CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high FROM annual
UNION ALL SELECT corridor_id, corridor_name, year, model_name, round(prediction, 4), round(lower_bound, 4),
  round(upper_bound, 4) FROM forecasts
UNION ALL SELECT corridor_id, corridor_name, year, 'benchmark', round(bts_tons, 4), round(bts_tons_low, 4),
  round(bts_tons_high, 4) FROM band""",
    "profile_shape": "SELECT CAST(position AS INTEGER) AS position, \"column\", dtype, n_rows, 11 AS n_columns FROM (VALUES "
    + ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(LINE_TYPES))
    + ') AS v(position, "column", dtype) CROSS JOIN (SELECT count(*) AS n_rows FROM lineitem)',
    "profile_first_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "profile_last_rows": "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 5",
    "profile_missing": _missing(_flow_columns()),
    "profile_missing_only": _missing(["fr_orig", "fr_dest", "dms_orig", "trade_type"]) + " WHERE missing_count > 0",
    "profile_duplicates": """SELECT 'all columns' AS compared, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM (SELECT * FROM lineitem) t GROUP BY t)
UNION ALL SELECT 'item', CAST(sum(n - 1) AS BIGINT) FROM (
  SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey, l_quantity, l_returnflag, l_linestatus)""",
    "profile_distinct": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(DISTINCT {c}) AS n_unique FROM lineitem"""
        for c, t in LINE_TYPES
    ),
    "profile_numeric": _numeric("lineitem", [c for c, t in LINE_TYPES if t in ("bigint", "int", "double")]),
    "profile_numeric_large": _numeric("orders", ("o_orderkey", "o_custkey", "o_totalprice")),
    "profile_categorical": " UNION ALL ".join(_categorical(c) for c in ("o_orderstatus", "o_orderpriority")),
}
