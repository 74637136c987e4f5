"""Piecewise-linear trend with macro regressors per corridor, entirely in column expressions.

The model is linear with Gaussian priors: level, slope, slope changes at fixed shares of the years, and standardised
regressors. Its normal equations are sums over the rows of a corridor, kept as running sums over one window, so the fit
before every year comes from one pass. They are solved by elimination over a small array, for each noise level of a
fixed grid; the level with the highest evidence predicts, and mean and interval follow in closed form.

Rows lacking tons or a regressor are left out of the sums. With fewer than two rows left, a corridor keeps its forecast rows
without a prediction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.numeric import finite, normal_quantile
from ..operators.regressors import regressors_by_year
from ..schemas import HOLDOUT_YEAR, HORIZON, TREND_REGRESSORS
from .common import LEAVE_LAST_OUT, conform

# Prior variances, where the slope may change (shares of the years up to the holdout), and noise levels tried.
LEVEL_VARIANCE = 25.0
SLOPE_VARIANCE = 25.0
CHANGE_VARIANCE = 0.005
REGRESSOR_VARIANCE = 100.0
NOISE_SCALE = 0.5
HINGES = (0.2, 0.4, 0.6)
NOISE_GRID = (0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0)

_KEYS = ("corridor_id", "corridor_name")
_FIRST_HINGE = 2


def _prior(regressors: int) -> list[float]:
    return [LEVEL_VARIANCE, SLOPE_VARIANCE] + [CHANGE_VARIANCE] * len(HINGES) + [REGRESSOR_VARIANCE] * regressors


def _scales(macros: DataFrame, names: Sequence[str], holdout_year: int) -> Row:
    """Mean and deviation of each regressor over the years a holdout fit may see: one row."""
    seen = macros.where(F.col("year") < holdout_year)
    stats = [F.avg(n).alias(f"mean_{n}") for n in names] + [F.stddev_samp(n).alias(f"dev_{n}") for n in names]
    return seen.agg(*stats).first()


def _terms(t: Column, regressors: list[Column]) -> list[Column]:
    return [F.lit(1.0), t, *[F.greatest(t - h, F.lit(0.0)) for h in HINGES], *regressors]


def _upper(i: int, j: int, size: int) -> int:
    """Place of cell (i, j), i <= j, among the cells of the upper triangle."""
    return i * size - i * (i - 1) // 2 + j - i


def running_sums(annual: DataFrame, macros: DataFrame, names: Sequence[str], holdout_year: int) -> DataFrame:
    """Each year of a corridor with its terms ``x``, its time ``t``, and the sums of all rows up to it (``through``) and before it (``before``).

    Sums are one array: rows, sum of squares, largest absolute value, sums with the terms, upper triangle of the terms' products.
    """
    scales = _scales(macros, names, holdout_year)

    def standard(name: str) -> Column:
        centre, width = scales[f"mean_{name}"], scales[f"dev_{name}"]
        return (finite(F.col(name).cast("double")) - F.lit(centre).cast("double")) / F.lit(width or 1.0)

    corridor = Window.partitionBy(*_KEYS)
    w = corridor.orderBy("year")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.min("year").over(corridor)
    rows = annual.select(*_KEYS, "year", finite(F.col("total_tons").cast("double")).alias("y"), first.alias("first"), *[standard(n).alias(f"z_{n}") for n in names])
    rows = rows.withColumn("t", _time(F.col("year"), F.col("first"), holdout_year))
    rows = rows.withColumn("x", F.array(*_terms(F.col("t"), [F.col(f"z_{n}") for n in names])))
    whole = F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull())
    rows = rows.withColumns({"_y": F.when(whole, F.col("y")), "_x": F.when(whole, F.col("x"))})
    size = len(_prior(len(names)))
    at = [F.col("_x")[i] for i in range(size)]
    sums = [F.count("_y"), F.sum(F.col("_y") * F.col("_y")), F.max(F.abs("_y"))]
    sums += [F.sum(F.col("_y") * x) for x in at]
    sums += [F.sum(at[i] * at[j]) for i in range(size) for j in range(i, size)]
    rows = rows.withColumns({f"_s{k}": s.over(upto) for k, s in enumerate(sums)})
    through = F.array(*[F.coalesce(F.col(f"_s{k}").cast("double"), F.lit(0.0)) for k in range(len(sums))])
    rows = rows.select(*_KEYS, "year", "y", "first", "t", "x", through.alias("through"))
    return rows.withColumns(
        {"before": F.lag("through").over(w), "t_before": F.lag("t").over(w), "place": F.row_number().over(w)}
    )


def _time(year: Column, first: Column, holdout_year: int) -> Column:
    """0 in the first year of the corridor, 1 in the holdout year."""
    return (year - first) / F.greatest(F.lit(holdout_year) - first, F.lit(1))


def solved(rows: DataFrame, sums: str, targets: str, last: str, name: str, regressors: int) -> DataFrame:
    """``rows`` with ``name``: an array of (mean, deviation) for the term vectors in the array column ``targets``.

    ``sums`` is the column of normal equations, ``last`` the time of the last row in them. NULL for fewer than two rows.
    """
    prior = _prior(regressors)
    size = len(prior)
    cell = lambda i, j: f"{sums}[{3 + size + _upper(min(i, j), max(i, j), size)}]"
    matrix = ", ".join(
        "array(" + ", ".join([*(cell(i, j) for j in range(size)), f"{sums}[{3 + i}] / _scale"]) + ")" for i in range(size)
    )
    variances = "array(" + ", ".join(f"{v}D" for v in prior) + ")"
    logs = f"aggregate({variances}, 0D, (a, v) -> a + ln(v))"
    # one row a term: products with all terms, with the series, and each target's own term
    system = f"""transform(_matrix, (r, i) -> concat(
        transform(slice(r, 1, {size}), (v, j) -> CASE WHEN i = j THEN v + q * q / {variances}[i] ELSE v END),
        slice(r, {size + 1}, 1), transform({targets}, x -> x[i])))"""
    eliminated = f"""aggregate(sequence(0, {size - 1}), named_struct('m', {system}, 'logdet', 0D), (a, k) -> named_struct(
        'm', transform(a.m, (r, i) -> CASE WHEN i = k THEN transform(r, v -> v / a.m[k][k])
                                           ELSE zip_with(r, a.m[k], (u, v) -> u - r[k] / a.m[k][k] * v) END),
        'logdet', a.logdet + ln(a.m[k][k])))"""
    quadratic = f"({sums}[1] / (_scale * _scale) - aggregate(sequence(0, {size - 1}), 0D, (a, i) -> a + _matrix[i][{size}] * f.s.m[i][{size}]))"
    evidence = f"""-0.5D * (({sums}[0] - {size}) * ln(f.q * f.q) + {logs} + f.s.logdet + {quadratic} / (f.q * f.q))
        - 0.5D * pow(f.q / {NOISE_SCALE}D, 2)"""
    change = " + ".join(f"abs(_best.m[{_FIRST_HINGE + i}][{size}])" for i in range(len(HINGES)))
    drift = f"{2 * len(HINGES) / 3}D * pow(({change}) / {len(HINGES)}, 2) * pow(greatest(x[1] - {last}, 0D), 3)"
    mean = f"aggregate(x, named_struct('i', 0, 'v', 0D), (a, v) -> named_struct('i', a.i + 1, 'v', a.v + v * _best.m[a.i][{size}])).v"
    lever = f"aggregate(x, named_struct('i', 0, 'v', 0D), (a, v) -> named_struct('i', a.i + 1, 'v', a.v + v * _best.m[a.i][{size + 1} + h])).v"
    grid = ", ".join(f"{q}D" for q in NOISE_GRID)
    enough = f"coalesce({sums}[0], 0D) >= 2"
    stages = {
        "_scale": f"CASE WHEN {sums}[2] > 0 THEN {sums}[2] ELSE 1D END",
        "_matrix": f"array({matrix})",
        "_tried": f"CASE WHEN {enough} THEN transform(array({grid}), q -> named_struct('q', q, 's', {eliminated})) END",
        "_weighed": f"transform(_tried, f -> named_struct('evidence', round({evidence}, 9), 'less', -f.q, 'm', f.s.m))",
        "_best": "array_max(_weighed)",
        name: f"CASE WHEN _best IS NOT NULL THEN transform({targets}, (x, h) -> named_struct('mean', _scale * {mean}, 'deviation', "
        f"_scale * sqrt(_best.less * _best.less * (1 + {lever}) + {drift}))) END",
    }
    out = rows
    for column, text in stages.items():
        out = out.withColumn(column, F.expr(text))
    return out.drop("_scale", "_matrix", "_tried", "_weighed", "_best")


def fit_trend(
    annual: DataFrame,
    macros: DataFrame,
    horizon: Sequence[int] = HORIZON,
    holdout_year: int = HOLDOUT_YEAR,
    regressors: Sequence[str] = TREND_REGRESSORS,
    width: float = 0.8,
    model_name: str = "TrendRegression",
) -> DataFrame:
    """Forecast rows plus the row counts of both fits.

    The holdout is fitted on earlier years and uses that year's own regressors; the future is fitted
    on every year and uses regressors carried forward.
    """
    names, years = list(regressors), [int(y) for y in horizon]
    scales = _scales(macros, names, holdout_year)
    # One row per requested year, so this never grows with the data.
    ahead = {row["year"]: row for row in regressors_by_year(macros, years, names).collect()}

    def known(year: int, name: str) -> Column:
        value, centre = ahead[year][name] if year in ahead else None, scales[f"mean_{name}"]
        missing = value is None or centre is None
        return F.lit(None if missing else (value - centre) / (scales[f"dev_{name}"] or 1.0)).cast("double")

    holdout = F.col("year") == holdout_year
    rows = running_sums(annual, macros, names, holdout_year)
    # the window has brought a corridor together: this needs no further shuffle
    corridors = rows.groupBy(*_KEYS).agg(
        F.max(F.when(holdout, F.struct("before", "t_before", "x"))).alias("held"),
        F.max(F.struct("year", "through", "t", "first")).alias("all"),
        F.count(F.when(F.col("year") < holdout_year, 1)).cast("int").alias("training_rows"),
        F.count(F.lit(1)).cast("int").alias("full_rows"),
    )
    futures = [
        F.array(*_terms(_time(F.lit(y), F.col("all.first"), holdout_year), [known(y, n) for n in names])) for y in years
    ]
    corridors = corridors.select(
        *_KEYS, "training_rows", "full_rows", F.col("held").isNotNull().alias("observed"), "held.before", "held.t_before",
        F.array("held.x").alias("now"), F.col("all.through").alias("through"), F.col("all.t").alias("t"), F.array(*futures).alias("later"),
    )
    corridors = solved(corridors, "before", "now", "t_before", "held", len(names))
    corridors = solved(corridors, "through", "later", "t", "ahead", len(names))

    def entry(kind: str, year: int, found: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("forecast_type"),
            F.lit(year).alias("year"),
            finite(found["mean"]).alias("prediction"),
            finite(found["deviation"]).alias("deviation"),
        )

    past = F.when(F.col("observed"), F.array(entry("holdout", int(holdout_year), F.get("held", F.lit(0)))))
    future = F.array(*[entry("future", year, F.get("ahead", F.lit(i))) for i, year in enumerate(years)])
    fitted = corridors.select(*_KEYS, "training_rows", "full_rows", F.inline(F.concat(F.coalesce(past, F.array()), future)))
    spread = F.col("deviation") * normal_quantile(width)
    return fitted.withColumns(
        {
            "model_name": F.lit(model_name),
            "training_strategy": F.lit(LEAVE_LAST_OUT),
            "lower_bound": F.col("prediction") - spread,
            "upper_bound": F.col("prediction") + spread,
        }
    )


def forecast_trend(annual: DataFrame, macros: DataFrame, **options) -> DataFrame:
    """The forecast table of :func:`fit_trend`."""
    return conform(fit_trend(annual, macros, **options))


def backtest_trend(
    annual: DataFrame, macros: DataFrame, holdout_year: int, min_train: int = 4, regressors: Sequence[str] = TREND_REGRESSORS
) -> DataFrame:
    """Prediction of every expanding-window split, all from one pass of running sums: each year by the fit to the rows before it."""
    rows = running_sums(annual, macros, list(regressors), holdout_year).where(F.col("place") > min_train)
    rows = solved(rows.withColumn("now", F.array("x")), "before", "now", "t_before", "found", len(regressors))
    return rows.select(
        *_KEYS,
        F.col("year").alias("test_year"),
        F.col("y").alias("actual"),
        F.get("found", F.lit(0))["mean"].alias("prediction"),
        (F.col("place") - 1).alias("train_size"),
    )
