"""SQL of the fitted models: the same estimates as the library's column expressions, found by recursive queries and a written-out Cholesky solve.

A cut is one fit: ``(name, upto)`` with all rows of a corridor up to a year. All constants are written out here.
"""

from __future__ import annotations

from collections.abc import Sequence

_MA = ", ".join(f"({k / 20}::DOUBLE)" for k in sorted(range(-19, 20), key=lambda k: (abs(k), k)))


def _cuts(cuts: Sequence[tuple[str, int]]) -> str:
    return ", ".join(f"('{name}', {upto})" for name, upto in cuts)


def arima_ctes(cuts: Sequence[tuple[str, int]], steps: int) -> tuple[str, ...]:
    """CTEs over ``annual`` ending in ``a_best`` (chosen fit of each cut) and ``a_path`` (cut, corridor_id, step, level, variance)."""
    sums = "s00", "s01", "s02", "s11", "s12", "s22"
    u = "(c.d - f.t * f.u1)"
    products = {"s00": f"{u} * {u}", "s01": f"{u} * f.u1", "s02": f"{u} * f.u2", "s11": "f.u1 * f.u1", "s12": "f.u1 * f.u2", "s22": "f.u2 * f.u2"}
    added = ", ".join(f"f.{s} + {products[s]} / c.g" for s in sums)
    return (
        f"""a_pos AS (
  SELECT cut, corridor_id, corridor_name, year, total_tons, row_number() OVER (PARTITION BY cut, corridor_id ORDER BY year) AS pos
  FROM annual JOIN (VALUES {_cuts(cuts)}) AS v(cut, upto) ON year <= upto)""",
        """a_chg AS (
  SELECT cut, corridor_id, d, g, row_number() OVER (PARTITION BY cut, corridor_id ORDER BY pos) AS i
  FROM (SELECT cut, corridor_id, pos, total_tons - lag(total_tons) OVER k AS d, pos - lag(pos) OVER k AS g
        FROM a_pos WHERE total_tons IS NOT NULL WINDOW k AS (PARTITION BY cut, corridor_id ORDER BY pos)) WHERE d IS NOT NULL)""",
        """a_series AS (
  SELECT p.*, coalesce(n, 0) AS n, logs FROM (
    SELECT cut, corridor_id, corridor_name, max(pos) AS n_rows, max(pos) FILTER (WHERE total_tons IS NOT NULL) AS known_pos,
           arg_max(total_tons, pos) FILTER (WHERE total_tons IS NOT NULL) AS level FROM a_pos GROUP BY ALL) p
  LEFT JOIN (SELECT cut, corridor_id, count(*) AS n, sum(ln(g)) AS logs FROM a_chg GROUP BY ALL) c USING (cut, corridor_id))""",
        f"""a_fold(cut, corridor_id, t, i, u1, u2, u3, {", ".join(sums)}) AS (
  SELECT cut, corridor_id, t, 0, {", ".join("0::DOUBLE" for _ in range(9))} FROM a_series CROSS JOIN (VALUES {_MA}) AS v(t)
  UNION ALL
  SELECT f.cut, f.corridor_id, f.t, f.i + 1, {u}, f.u1, f.u2, {added}
  FROM a_fold f JOIN a_chg c ON c.cut = f.cut AND c.corridor_id = f.corridor_id AND c.i = f.i + 1)""",
        "a_end AS (SELECT f.*, s.n, s.logs FROM a_fold f JOIN a_series s USING (cut, corridor_id) WHERE f.i = s.n)",
        "a_zero AS (SELECT *, s00 AS total FROM a_end WHERE t = 0)",
        """a_first AS (
  SELECT *, s00 - 2 * p1 * s01 + p1 * p1 * s11 AS sse, u1 - p1 * u2 AS e
  FROM (SELECT *, greatest(-0.99, least(0.99, coalesce(s01 / nullif(s11, 0), 0))) AS p1 FROM a_end))""",
        """a_second AS (
  SELECT *, r1 * shrink AS p1, r2 * shrink AS p2
  FROM (SELECT *, least(1, coalesce(0.99 / nullif(greatest(abs(r2), r1 + r2, r2 - r1), 0), 1)) AS shrink
        FROM (SELECT *, (s01 * s22 - s02 * s12) / (s11 * s22 - s12 * s12) AS r1, (s02 * s11 - s01 * s12) / (s11 * s22 - s12 * s12) AS r2
              FROM a_zero WHERE s11 * s22 - s12 * s12 > 1e-12 * s11 * s22)))""",
        """a_fits AS (
  SELECT cut, corridor_id, 0 AS o, 1 AS k, 0::DOUBLE AS t, 0::DOUBLE AS p1, 0::DOUBLE AS p2, s00 AS sse, u1 AS e FROM a_zero
  UNION ALL SELECT cut, corridor_id, 1, 2, 0, p1, 0, sse, e FROM a_first WHERE t = 0
  UNION ALL (SELECT f.cut, f.corridor_id, 2, 3, f.t, f.p1, 0, f.sse, f.e FROM a_first f JOIN a_zero z USING (cut, corridor_id)
    QUALIFY row_number() OVER (PARTITION BY f.cut, f.corridor_id ORDER BY round(f.sse / nullif(z.total, 0), 9), abs(f.t), f.t) = 1)
  UNION ALL SELECT cut, corridor_id, 3, 3, 0, p1, p2,
    s00 + p1 * p1 * s11 + p2 * p2 * s22 - 2 * p1 * s01 - 2 * p2 * s02 + 2 * p1 * p2 * s12, u1 - p1 * u2 - p2 * u3 FROM a_second)""",
        """a_scored AS (
  SELECT f.*, CASE WHEN f.sse > 1e-12 * z.total AND z.n > 0 THEN 2 * k + z.n * (ln(2 * pi() * f.sse / z.n) + 1) + z.logs END AS aic
  FROM a_fits f JOIN a_zero z USING (cut, corridor_id))""",
        """a_best AS (
  SELECT s.*, f.t, f.p1, f.p2, f.e, f.sse / nullif(s.n, 0) AS noise, b.aic, n_rows - known_pos AS late,
         CASE coalesce(b.o, 1) WHEN 0 THEN '(0, 1, 0)' WHEN 1 THEN '(1, 1, 0)' WHEN 2 THEN '(1, 1, 1)' ELSE '(2, 1, 0)' END AS model_order
  FROM a_series s
  LEFT JOIN (SELECT cut, corridor_id, o, aic FROM a_scored WHERE aic IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY cut, corridor_id ORDER BY round(aic, 9), o) = 1) b USING (cut, corridor_id)
  LEFT JOIN a_fits f ON f.cut = s.cut AND f.corridor_id = s.corridor_id AND f.o = coalesce(b.o, 1))""",
        f"""a_steps(cut, corridor_id, k, level, m1, m2, w1, w2, weight, variance, p1, p2, t, e, late, noise) AS (
  SELECT b.cut, b.corridor_id, 0, b.level, z.u1, z.u2, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE, b.p1, b.p2, b.t, b.e, coalesce(b.late, 0), b.noise
  FROM a_best b JOIN a_zero z USING (cut, corridor_id)
  UNION ALL
  SELECT cut, corridor_id, k, level + c, c, m1, w, w1, weight + w, variance + (weight + w) * (weight + w), p1, p2, t, e, late, noise
  FROM (SELECT cut, corridor_id, k + 1 AS k, level, m1, w1, weight, variance, p1, p2, t, e, late, noise,
               p1 * m1 + p2 * m2 + CASE WHEN k = 0 THEN t * e ELSE 0 END AS c,
               CASE k WHEN 0 THEN 1 WHEN 1 THEN p1 + t ELSE p1 * w1 + p2 * w2 END AS w
        FROM a_steps WHERE k < late + {steps}))""",
        "a_path AS (SELECT cut, corridor_id, k - late AS step, level, variance * noise AS variance FROM a_steps WHERE k > late)",
    )


_PRIOR = (25.0, 25.0, 0.005, 0.005, 0.005, 100.0, 100.0, 100.0, 100.0)
_HINGES = (0.2, 0.4, 0.6)
_NOISE = (0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0)
_REGRESSORS = ("gdp", "diesel_price", "industrial_production", "unemployment_rate")


def trend_ctes(cuts: Sequence[tuple[str, int]], targets: str, macros: str, holdout_year: int) -> tuple[str, ...]:
    """CTEs over ``annual`` and the annual macro table ``macros``, ending in ``t_found`` (cut, corridor_id, year, mean, deviation).

    ``targets`` is SQL for (cut, corridor_id, year, and the regressors) to predict.
    """
    p = len(_PRIOR)
    terms = ["1::DOUBLE", "t", *(f"greatest(t - {h}, 0)" for h in _HINGES), *(f"({r} - mean_{r}) / coalesce(nullif(dev_{r}, 0), 1)" for r in _REGRESSORS)]
    xs = ", ".join(f"{term} AS x{i}" for i, term in enumerate(terms))
    time = f"(year - first)::DOUBLE / greatest({holdout_year} - first, 1)"
    scales = ", ".join(f"avg({r}) AS mean_{r}, stddev_samp({r}) AS dev_{r}" for r in _REGRESSORS)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in ("total_tons", *_REGRESSORS))
    sums = ", ".join(f"sum(total_tons * x{i}) AS c{i}" for i in range(p))
    sums += ", " + ", ".join(f"sum(x{i} * x{j}) AS s{i}_{j}" for i in range(p) for j in range(i, p))
    ctes = [
        "t_first AS (SELECT corridor_id, min(year) AS first FROM annual GROUP BY 1)",
        f"t_scales AS (SELECT {scales} FROM {macros} WHERE year < {holdout_year})",
        f"""t_rows AS (SELECT *, {xs} FROM (SELECT *, {time} AS t FROM annual JOIN t_first USING (corridor_id)) CROSS JOIN t_scales)""",
        f"""t_last AS (SELECT cut, corridor_id, max(t) AS t_last FROM t_rows JOIN (VALUES {_cuts(cuts)}) AS v(cut, upto) ON year <= upto GROUP BY ALL)""",
        f"""t_sums AS (
  SELECT cut, corridor_id, count(*) AS n, sum(total_tons * total_tons) AS yy, coalesce(nullif(max(abs(total_tons)), 0), 1) AS scale, {sums}
  FROM t_rows JOIN (VALUES {_cuts(cuts)}) AS v(cut, upto) ON year <= upto WHERE {whole} GROUP BY ALL HAVING count(*) >= 2)""",
        f"t_l0 AS (SELECT * FROM t_sums CROSS JOIN (VALUES {', '.join(f'({q}::DOUBLE)' for q in _NOISE)}) AS v(q))",
    ]
    # Cholesky, a column at a time: the diagonal cell, then those below it
    for j in range(p):
        inner = lambda i: "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))  # noqa: E731, B023
        ctes.append(f"t_d{j} AS (SELECT *, sqrt(s{j}_{j} + q * q / {_PRIOR[j]}{inner(j)}) AS l{j}_{j} FROM t_l{j})")
        below = "".join(f", (s{j}_{i}{inner(i)}) / l{j}_{j} AS l{i}_{j}" for i in range(j + 1, p))
        ctes.append(f"t_l{j + 1} AS (SELECT *{below} FROM t_d{j})")
    source = f"t_l{p}"
    for i in range(p):
        ctes.append(f"t_f{i} AS (SELECT *, (c{i} / scale{''.join(f' - l{i}_{k} * f{k}' for k in range(i))}) / l{i}_{i} AS f{i} FROM {source})")
        source = f"t_f{i}"
    squares = " + ".join(f"f{i} * f{i}" for i in range(p))
    logdet = " + ".join(f"2 * ln(l{i}_{i})" for i in range(p))
    logprior = " + ".join(f"ln({v})" for v in _PRIOR)
    ctes.append(
        f"""t_best AS (
  SELECT *, -0.5 * ((n - {p}) * ln(q * q) + {logprior} + {logdet} + (yy / (scale * scale) - ({squares})) / (q * q)) - 0.5 * (q / 0.5) * (q / 0.5) AS evidence
  FROM {source} QUALIFY row_number() OVER (PARTITION BY cut, corridor_id ORDER BY round(evidence, 9) DESC, q) = 1)"""
    )
    source = "t_best"
    for i in reversed(range(p)):
        ctes.append(f"t_b{i} AS (SELECT *, (f{i}{''.join(f' - l{k}_{i} * b{k}' for k in range(i + 1, p))}) / l{i}_{i} AS b{i} FROM {source})")
        source = f"t_b{i}"
    ctes.append(
        f"""t_goal AS (
  SELECT goal.*, {xs} FROM (SELECT g.*, {time} AS t FROM ({targets}) g JOIN t_first USING (corridor_id)) goal CROSS JOIN t_scales)"""
    )
    columns = ", ".join(f"g.x{i}" for i in range(p))
    ctes.append(f"t_g AS (SELECT b.*, g.year, g.t, t_last, {columns} FROM t_goal g JOIN {source} b USING (cut, corridor_id) JOIN t_last USING (cut, corridor_id))")
    source = "t_g"
    for i in range(p):
        ctes.append(f"t_w{i} AS (SELECT *, (x{i}{''.join(f' - l{i}_{k} * w{k}' for k in range(i))}) / l{i}_{i} AS w{i} FROM {source})")
        source = f"t_w{i}"
    size = " + ".join(f"abs(b{2 + i})" for i in range(len(_HINGES)))
    mean = " + ".join(f"x{i} * b{i}" for i in range(p))
    lever = " + ".join(f"w{i} * w{i}" for i in range(p))
    ctes.append(
        f"""t_found AS (
  SELECT cut, corridor_id, year, scale * ({mean}) AS mean,
         scale * sqrt(q * q * (1 + {lever}) + {2 * len(_HINGES) / 3} * (({size}) / {len(_HINGES)}) ** 2 * greatest(t - t_last, 0) ** 3) AS deviation
  FROM {source})"""
    )
    return tuple(ctes)
