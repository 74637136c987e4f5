"""Order-selected ARIMA(p, 1, q), p <= 2 and q <= 1, per corridor, entirely in column expressions.

A corridor's years are one array. Orders are fitted by conditional least squares on the changes between known values:
with changes before the first taken as zero, filtering the changes by the moving-average part leaves a regression on
their own lags, so one fold over the array gives the lag sums that every autoregressive order is solved from. The moving-average
coefficient is tried on a fixed grid. The order with the lowest AIC predicts; its intervals grow with the
cumulated weights of past noise.

A row without tons is a step without an observation: the change across it counts as one change, with a variance in
proportion to the steps it spans, as in the random walk, which is order (0, 1, 0).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import finite, normal_quantile
from ..schemas import HOLDOUT_YEAR, HORIZON
from .common import LEAVE_LAST_OUT, conform, yearly_arrays

# The candidate orders, the first winning ties, and the one used when all fail.
ORDER_GRID = ((0, 1, 0), (1, 1, 0), (1, 1, 1), (2, 1, 0))
FALLBACK_ORDER = (1, 1, 0)

#: Moving-average coefficients tried, the smallest first; zero is also what purely autoregressive orders use.
MA_STEP, MA_LARGEST = 0.05, 0.95
#: Estimates outside the stationary region are shrunk to this share of its border.
STATIONARY = 0.99
#: Squared errors below this share of the squared changes count as none: such an order fails.
NOTHING = 1e-12

_STEPS_ON = "named_struct('level', a.level, 'variance', a.variance)"


def ma_grid() -> list[float]:
    """Zero, then pairs of growing size."""
    sizes = [round(MA_STEP * k, 10) for k in range(1, round(MA_LARGEST / MA_STEP) + 1)]
    return [0.0] + [sign * size for size in sizes for sign in (-1, 1)]


def _changes(values: str) -> str:
    """Changes between neighbouring known values, each with the steps it spans."""
    known = f"filter(transform({values}, (x, i) -> named_struct('at', i, 'x', x)), r -> r.x IS NOT NULL)"
    pair = "named_struct('d', b.x - a.x, 'g', CAST(b.at - a.at AS DOUBLE))"
    return f"""transform(array({known}), k -> CASE WHEN size(k) > 1
      THEN zip_with(slice(k, 1, size(k) - 1), slice(k, 2, size(k) - 1), (a, b) -> {pair}) END)[0]"""


# One fold: u is the change filtered by 1 / (1 + t B), u1 to u3 its last values, sXY the sums of u at lags X and Y.
_FOLD = """aggregate(changes,
  named_struct('t', t, 'u1', 0D, 'u2', 0D, 'u3', 0D, 's00', 0D, 's01', 0D, 's02', 0D, 's11', 0D, 's12', 0D, 's22', 0D),
  (a, x) -> named_struct('t', t, 'u1', x.d - t * a.u1, 'u2', a.u1, 'u3', a.u2,
    's00', a.s00 + (x.d - t * a.u1) * (x.d - t * a.u1) / x.g,
    's01', a.s01 + (x.d - t * a.u1) * a.u1 / x.g,
    's02', a.s02 + (x.d - t * a.u1) * a.u2 / x.g,
    's11', a.s11 + a.u1 * a.u1 / x.g,
    's12', a.s12 + a.u1 * a.u2 / x.g,
    's22', a.s22 + a.u2 * a.u2 / x.g))"""

# Order (1, 1, q) for every coefficient of the grid; the smallest of these structs is the best fit, ties going to small t.
_FIRST_ORDER = f"""transform(
  transform(sums, s -> named_struct('s', s, 'p', greatest(-{STATIONARY}D, least({STATIONARY}D, coalesce(try_divide(s.s01, s.s11), 0D))))),
  f -> named_struct(
    'share', round(try_divide(f.s.s00 - 2 * f.p * f.s.s01 + f.p * f.p * f.s.s11, sums[0].s00), 9),
    'size', abs(f.s.t), 't', f.s.t, 'p1', f.p, 'p2', 0D,
    'sse', f.s.s00 - 2 * f.p * f.s.s01 + f.p * f.p * f.s.s11,
    'e', f.s.u1 - f.p * f.s.u2))"""

_SECOND_ORDER = f"""transform(transform(transform(slice(sums, 1, 1),
    s -> named_struct('s', s, 'det', CASE WHEN s.s11 * s.s22 - s.s12 * s.s12 > {NOTHING} * s.s11 * s.s22 THEN s.s11 * s.s22 - s.s12 * s.s12 END)),
    f -> named_struct('s', f.s, 'p1', (f.s.s01 * f.s.s22 - f.s.s02 * f.s.s12) / f.det, 'p2', (f.s.s02 * f.s.s11 - f.s.s01 * f.s.s12) / f.det)),
    f -> named_struct('s', f.s, 'p1', f.p1, 'p2', f.p2,
      'shrink', least(1D, coalesce(try_divide({STATIONARY}D, greatest(abs(f.p2), f.p1 + f.p2, f.p2 - f.p1)), 1D))))"""

_SECOND_FIT = f"""transform(transform({_SECOND_ORDER},
    f -> named_struct('s', f.s, 'p1', f.p1 * f.shrink, 'p2', f.p2 * f.shrink)),
    f -> named_struct('share', 0D, 'size', 0D, 't', 0D, 'p1', f.p1, 'p2', f.p2,
      'sse', f.s.s00 + f.p1 * f.p1 * f.s.s11 + f.p2 * f.p2 * f.s.s22 - 2 * f.p1 * f.s.s01 - 2 * f.p2 * f.s.s02 + 2 * f.p1 * f.p2 * f.s.s12,
      'e', f.s.u1 - f.p1 * f.s.u2 - f.p2 * f.s.u3))[0]"""

_WALK = "named_struct('share', 0D, 'size', 0D, 't', 0D, 'p1', 0D, 'p2', 0D, 'sse', sums[0].s00, 'e', sums[0].u1)"

#: Fit of each order as a struct (t, p1, p2, sse, e).
_FITS = {(0, 1, 0): _WALK, (1, 1, 0): "first[0]", (1, 1, 1): "array_min(first)", (2, 1, 0): _SECOND_FIT}


def with_fit(series: DataFrame, values: str, steps: int, orders: Sequence[tuple] = ORDER_GRID, prefix: str = "") -> DataFrame:
    """``series`` with, for the array column ``values``, the fitted order, its AIC and ``steps`` predictions.

    Adds ``{prefix}order`` (text), ``{prefix}aic`` (NULL when every order fails) and ``{prefix}path``: an array of
    (level, variance), one for each row after the last one.
    """
    grid = [tuple(o) for o in orders]
    unknown = [o for o in grid if o not in _FITS]
    if unknown:
        raise ValueError(f"unsupported orders {unknown}")
    kept = series.columns
    texts = ", ".join(f"'{o}'" for o in grid)
    fits = ", ".join(
        f"named_struct('at', {i}, 'k', {o[0] + o[2] + 1}, 'fit', {_FITS[o]})" for i, o in enumerate([*grid, FALLBACK_ORDER])
    )
    aic = f"""CASE WHEN f.fit.sse > {NOTHING} * sums[0].s00 AND size(changes) > 0
      THEN 2 * f.k + size(changes) * (ln(2 * pi() * f.fit.sse / size(changes)) + 1) + logs END"""
    stages = [
        {"_x": f"transform({values}, v -> CASE WHEN abs(v) < double('infinity') THEN v END)"},
        {"changes": f"coalesce({_changes('_x')}, array())", "level": "try_element_at(filter(_x, v -> v IS NOT NULL), -1)"},
        {"sums": f"transform(array({', '.join(f'{t}D' for t in ma_grid())}), t -> {_FOLD})", "logs": "aggregate(changes, 0D, (a, x) -> a + ln(x.g))"},
        {"first": _FIRST_ORDER},
        {"fits": f"array({fits})"},
        {"scored": f"transform(slice(fits, 1, {len(grid)}), f -> named_struct('rank', round({aic}, 9), 'at', f.at, 'aic', {aic}))"},
        {"best": "array_min(filter(scored, s -> s.aic IS NOT NULL))"},
        {"fit": f"element_at(fits, coalesce(best.at, {len(grid)}) + 1).fit"},
        # rows after the last known value are steps already taken
        {"late": "CASE WHEN level IS NULL THEN 0 ELSE size(_x) - aggregate(_x, named_struct('i', 0, 'last', 0), "
                 "(a, v) -> named_struct('i', a.i + 1, 'last', CASE WHEN v IS NULL THEN a.last ELSE a.i + 1 END)).last END"},
        {"_path": f"""aggregate(sequence(1, late + {steps}),
            named_struct('level', level, 'm1', sums[0].u1, 'm2', sums[0].u2, 'w1', 0D, 'w2', 0D, 'weight', 0D,
                         'variance', 0D, 'path', array()::array<struct<level double, variance double>>),
            (a, k) -> transform(transform(array(named_struct(
                'c', fit.p1 * a.m1 + fit.p2 * a.m2 + CASE WHEN k = 1 THEN fit.t * fit.e ELSE 0D END,
                'w', CASE k WHEN 1 THEN 1D WHEN 2 THEN fit.p1 + fit.t ELSE fit.p1 * a.w1 + fit.p2 * a.w2 END)),
              n -> named_struct('level', a.level + n.c, 'm1', n.c, 'm2', a.m1, 'w1', n.w, 'w2', a.w1, 'weight', a.weight + n.w,
                                'variance', a.variance + (a.weight + n.w) * (a.weight + n.w), 'path', a.path)),
              a -> named_struct('level', a.level, 'm1', a.m1, 'm2', a.m2, 'w1', a.w1, 'w2', a.w2, 'weight', a.weight,
                                'variance', a.variance, 'path', concat(a.path, array({_STEPS_ON}))))[0]).path"""},
    ]
    out = series
    for stage in stages:
        out = out.withColumns({name: F.expr(text) for name, text in stage.items()})
    noise = "fit.sse / nullif(size(changes), 0)"
    return out.select(
        *kept,
        F.expr(f"CASE WHEN best IS NULL THEN '{FALLBACK_ORDER}' ELSE array({texts})[best.at] END").alias(f"{prefix}order"),
        F.expr("best.aic").alias(f"{prefix}aic"),
        F.expr(f"transform(slice(_path, late + 1, {steps}), s -> named_struct('level', s.level, 'variance', s.variance * {noise}))").alias(f"{prefix}path"),
    )


def _rows(kind: str, years: Sequence[int], path: str) -> list[Column]:
    return [
        F.struct(
            F.lit(kind).alias("forecast_type"),
            F.lit(int(year)).alias("year"),
            finite(F.col(path)[i]["level"]).alias("prediction"),
            finite(F.sqrt(F.col(path)[i]["variance"])).alias("deviation"),
        )
        for i, year in enumerate(years)
    ]


def fit_arima(
    annual: DataFrame,
    horizon: Sequence[int] = HORIZON,
    holdout_year: int = HOLDOUT_YEAR,
    orders: Sequence[tuple[int, int, int]] = ORDER_GRID,
    width: float = 0.8,
    model_name: str = "ARIMA",
    partitions: int | None = None,
) -> DataFrame:
    """Forecast rows plus the settings of the holdout fit: order, AIC and row counts."""
    years = [int(y) for y in horizon]
    series = yearly_arrays(annual, ["total_tons"], partitions).withColumns(
        {
            "training_rows": F.size(F.filter("year", lambda y: y < holdout_year)),
            "full_rows": F.size("year"),
            "_observed": F.array_contains("year", holdout_year),
        }
    )
    # years are in order, so those before the holdout come first
    series = series.withColumn("_train", F.slice("total_tons", F.lit(1), F.col("training_rows")))
    fitted = with_fit(with_fit(series, "_train", 1, orders, "train_"), "total_tons", len(years), orders, "full_")
    holdout = F.when(F.col("_observed"), F.array(*_rows("holdout", [holdout_year], "train_path")))
    targets = F.concat(F.coalesce(holdout, F.array()), F.array(*_rows("future", years, "full_path")))
    rows = fitted.select(
        "corridor_id",
        "corridor_name",
        F.col("train_order").alias("model_order"),
        F.col("train_aic").alias("aic"),
        "training_rows",
        "full_rows",
        F.inline(targets),
    )
    spread = F.col("deviation") * normal_quantile(width)
    return rows.withColumns(
        {
            "model_name": F.lit(model_name),
            "training_strategy": F.lit(LEAVE_LAST_OUT),
            "lower_bound": F.col("prediction") - spread,
            "upper_bound": F.col("prediction") + spread,
        }
    )


def forecast_arima(annual: DataFrame, **options) -> DataFrame:
    """The forecast table of :func:`fit_arima`."""
    return conform(fit_arima(annual, **options))


def backtest_arima(annual: DataFrame, min_train: int = 4, orders: Sequence[tuple] = ORDER_GRID) -> DataFrame:
    """Prediction of every expanding-window split: each year by the order fitted to the rows before it."""
    series = yearly_arrays(annual, ["total_tons"])
    splits = series.select(
        "corridor_id",
        "corridor_name",
        F.explode(
            F.transform(
                F.filter(F.sequence(F.lit(0), F.size("year") - 1), lambda i: i >= min_train),
                lambda i: F.struct(
                    F.get("year", i).alias("test_year"),
                    F.get("total_tons", i).alias("actual"),
                    F.slice("total_tons", F.lit(1), i).alias("before"),
                    i.alias("train_size"),
                ),
            )
        ).alias("s"),
    ).select("corridor_id", "corridor_name", "s.*")
    return with_fit(splits, "before", 1, orders).select(
        "corridor_id", "corridor_name", "test_year", "actual", F.col("path")[0]["level"].alias("prediction"), "train_size"
    )
