"""DuckDB SQL that follows the EM loop at any k over all its steps, and the ADF test at its chosen lag.

Both work by other means than the operators: the eigenvectors come from Jacobi rotations (all columns paired round by
round, the step before giving the first basis), and the regressions from elimination on lists of sums.
"""

from __future__ import annotations

from macropanel.plans import oracle as Q

#: Rounds of all pairs in the first step and in each later one.
SWEEPS_FIRST, SWEEPS = 10, 5


def em_cte(k: int, steps: int, tol: float) -> str:
    """CTEs behind ``standardized`` and ``kept`` of one panel: ``em_end`` (n_iter, delta, k, z) and ``em_cells`` (date, i, z, gap)."""
    return f"""
placed AS (
  SELECT s.*, CAST(dense_rank() OVER (PARTITION BY s.panel_id ORDER BY k.pos) AS INT) AS i
  FROM standardized s JOIN kept k ON s.panel_id = k.panel_id AND s.series_id = k.series_id),
vectors AS (SELECT date, list(coalesce(z, 0) ORDER BY i) AS r, list(z IS NULL ORDER BY i) AS g FROM placed GROUP BY date),
filled AS (SELECT list(r ORDER BY date) AS z, list(g ORDER BY date) AS gap, list(date ORDER BY date) AS dates, len(first(r)) AS n, count(*) AS t FROM vectors),
-- m: players of a round robin that pairs all columns in m - 1 rounds (n, or one more if n is odd)
shape AS (SELECT *, n + n % 2 AS m, greatest(1, least({k}, least(n, t) - 1)) AS k FROM filled),
-- round r: column i (from 0) meets (r - i) mod (m - 1); the one that would meet itself meets column m - 1
rounds AS (
  SELECT r, list(CASE WHEN i = m - 1 THEN (r * (m // 2)) % (m - 1) WHEN (r - i + m - 1) % (m - 1) = i THEN m - 1 ELSE (r - i + m - 1) % (m - 1) END + 1 ORDER BY i) AS other
  FROM shape, generate_series(0, m - 2) AS a(r), generate_series(0, m - 1) AS b(i) GROUP BY r),
meet AS (SELECT list(other ORDER BY r) AS other FROM rounds),
unit AS (SELECT list_transform(generate_series(1, m), lambda i: list_transform(generate_series(1, m), lambda j: CAST(CAST(i = j AS INT) AS DOUBLE))) AS e FROM shape),
-- it: steps made; q: rotations left before the next; a: the Gram matrix in the basis v
em(it, q, delta, z, a, v) AS (
  SELECT 0, (m - 1) * {SWEEPS_FIRST}, CAST('inf' AS DOUBLE), z,
    list_transform(generate_series(1, m), lambda i: list_transform(generate_series(1, m), lambda j: CASE WHEN i <= n AND j <= n
      THEN list_sum(list_transform(z, lambda r: r[i] * r[j])) ELSE 0.0 END)), e
  FROM shape, unit
  UNION ALL
  SELECT CASE WHEN q > 0 THEN it ELSE it + 1 END, CASE WHEN q > 0 THEN q - 1 ELSE (m - 1) * {SWEEPS} END,
    CASE WHEN q > 0 THEN delta ELSE change END, CASE WHEN q > 0 THEN z ELSE refilled END,
    CASE WHEN q > 0 THEN list_transform(turned, lambda row, i: list_transform(row, lambda x, j: c[i] * x + s[i] * turned[o[i]][j]))
      ELSE list_transform(generate_series(1, m), lambda i: list_transform(generate_series(1, m), lambda j: list_sum(list_transform(scores, lambda r: r[i] * r[j])))) END,
    CASE WHEN q > 0 THEN list_transform(v, lambda row: list_transform(row, lambda x, j: c[j] * x + s[j] * row[o[j]])) ELSE v END
  FROM (
    SELECT *, list_transform(a, lambda row: list_transform(row, lambda x, j: c[j] * x + s[j] * row[o[j]])) AS turned,
      CASE WHEN q > 0 THEN NULL ELSE list_transform(refilled, lambda r: list_transform(generate_series(1, m), lambda j: list_dot_product(list_resize(r, m, 0.0), list_transform(v, lambda w: w[j])))) END AS scores
    FROM (
      SELECT *, list_transform(tangent, lambda x: 1 / sqrt(1 + x * x)) AS c,
        list_transform(tangent, lambda x, i: CASE WHEN i < o[i] THEN -x ELSE x END / sqrt(1 + x * x)) AS s,
        CASE WHEN q > 0 THEN NULL ELSE list_transform(z, lambda r, i: list_transform(r, lambda x, j: CASE WHEN gap[i][j] THEN zhat[i][j] ELSE x END)) END AS refilled,
        CASE WHEN q > 0 THEN NULL ELSE sqrt(list_sum(list_transform(z, lambda r, i: list_sum(list_transform(r, lambda x, j: CASE WHEN gap[i][j] THEN (zhat[i][j] - x) * (zhat[i][j] - x) ELSE 0.0 END)))))
          / (sqrt(list_sum(list_transform(z, lambda r, i: list_sum(list_transform(r, lambda x, j: CASE WHEN gap[i][j] THEN x * x ELSE 0.0 END))))) + 1e-12) END AS change
      FROM (
        SELECT *, -- tangents of the rotations by column; both of a pair have the same
          list_transform(o, lambda x, i: CASE WHEN abs(a[least(i, x)][greatest(i, x)]) <= 1e-300 THEN 0.0 ELSE
            CASE WHEN a[greatest(i, x)][greatest(i, x)] >= a[least(i, x)][least(i, x)] THEN 1 ELSE -1 END
            / (abs((a[greatest(i, x)][greatest(i, x)] - a[least(i, x)][least(i, x)]) / (2 * a[least(i, x)][greatest(i, x)]))
               + sqrt(1 + ((a[greatest(i, x)][greatest(i, x)] - a[least(i, x)][least(i, x)]) / (2 * a[least(i, x)][greatest(i, x)])) ** 2))
            * CASE WHEN a[least(i, x)][greatest(i, x)] >= 0 THEN 1 ELSE -1 END END) AS tangent,
          CASE WHEN q > 0 THEN NULL ELSE list_transform(z, lambda r: list_transform(p, lambda w: list_dot_product(r, w))) END AS zhat
        FROM (
          SELECT em.*, n, m, k, gap, other[q % (m - 1) + 1] AS o,
            -- the projector on the k columns of v with the largest diagonal entries of a
            CASE WHEN q > 0 THEN NULL ELSE list_transform(generate_series(1, n), lambda i: list_transform(generate_series(1, n), lambda j:
              list_sum(list_transform(generate_series(1, m), lambda x: CASE WHEN a[x][x] >= list_reverse_sort(list_transform(a, lambda row, y: row[y]))[k] THEN v[i][x] * v[j][x] ELSE 0.0 END)))) END AS p
          FROM em, shape, meet WHERE it < {steps} AND delta >= {tol}) x1) x2) x3) x4),
em_end AS (SELECT it AS n_iter, delta, em.z, k, dates FROM em, shape WHERE q = (m - 1) * {SWEEPS} ORDER BY it DESC LIMIT 1),
em_dates AS (SELECT unnest(dates) AS date, unnest(z) AS r FROM em_end),
em_cells AS (
  SELECT p.panel_id, p.series_id, p.date, p.i, p.value IS NULL AS imputed, CASE WHEN p.value IS NULL THEN e.r[p.i] ELSE p.z END AS z,
    CASE WHEN p.value IS NULL THEN e.r[p.i] * p.sd + p.mu ELSE p.value END AS value
  FROM placed p JOIN em_dates e ON p.date = e.date)"""


def em_chain(k: int, steps: int, tol: float) -> str:
    return Q.ALL_STD.replace("WITH ", "WITH RECURSIVE ", 1).rstrip("\n") + "," + em_cte(k, steps, tol)


def _eliminated(name: str, source: str, most: str) -> str:
    """``name`` (panel, series, j, a, ...): the matrix after j pivots, each row less its share of the pivot row."""
    return f"""
{name}(panel_id, series_id, lag, n, j, a) AS (
  SELECT panel_id, series_id, lag, n, 0, a FROM {source}
  UNION ALL
  SELECT panel_id, series_id, lag, n, j + 1, list_transform(a, lambda row, i: CASE WHEN i <= j + 1 THEN row ELSE list_transform(row, lambda x, c: x - row[j + 1] * a[j + 1][c] / a[j + 1][j + 1]) END)
  FROM {name} WHERE j < {most})"""


def adf_cte(source: str = "em_cells") -> str:
    """CTEs behind cells (panel, series, date, z): ``adf`` (panel, series, lag, tau, p) of series of 30 values or more.

    Rows of a regression are [1, level, lagged differences 1 .. lag, difference]; the sums' last entry after a pivot is
    the residual sum of the regression on the columns so far. ln((2i + 1)!!) gives the normal distribution's series.
    """
    sums = "list_transform(generate_series(1, len(rows[1])), lambda x: list_transform(generate_series(1, len(rows[1])), lambda y: list_sum(list_transform(rows, lambda r: r[x] * r[y]))))"
    return f"""
ordered AS (SELECT panel_id, series_id, list(z ORDER BY date) AS z, count(*) AS n FROM {source} GROUP BY panel_id, series_id HAVING count(*) >= 30 AND min(z) < max(z)),
scaled AS (
  SELECT panel_id, series_id, n, list_transform(z, lambda x: (x - list_avg(z)) / list_stddev_pop(z)) AS x,
    CAST(least(n // 2 - 2, ceil(12 * (n / 100.0) ** 0.25)) AS INT) AS lag FROM ordered),
common AS (
  SELECT panel_id, series_id, lag, n, list_transform(generate_series(lag + 2, n), lambda t:
    list_concat([1.0, x[t - 1]], list_transform(generate_series(1, lag + 1), lambda d: CASE WHEN d <= lag THEN x[t - d] - x[t - d - 1] ELSE x[t] - x[t - 1] END))) AS rows
  FROM scaled),
common_sums AS (SELECT panel_id, series_id, lag, n, {sums} AS a FROM common),""" + _eliminated("down", "common_sums", "lag + 2") + f""",
aic AS (
  SELECT panel_id, series_id, j - 2 AS p, (n - 1 - lag) * (ln(2 * pi()) + ln(a[lag + 3][lag + 3] / (n - 1 - lag)) + 1) + 2 * j AS v
  FROM down WHERE j >= 2),
chosen AS (SELECT panel_id, series_id, p FROM (SELECT *, row_number() OVER (PARTITION BY panel_id, series_id ORDER BY v, p) AS k FROM aic) q WHERE k = 1),
own AS (
  SELECT s.panel_id, s.series_id, c.p AS lag, n, list_transform(generate_series(p + 2, n), lambda t:
    list_concat([1.0], list_transform(generate_series(1, p + 2), lambda d: CASE WHEN d <= p THEN x[t - d] - x[t - d - 1] WHEN d = p + 1 THEN x[t - 1] ELSE x[t] - x[t - 1] END))) AS rows
  FROM scaled s JOIN chosen c ON s.panel_id = c.panel_id AND s.series_id = c.series_id),
own_sums AS (SELECT panel_id, series_id, lag, n, {sums} AS a FROM own),""" + _eliminated("through", "own_sums", "lag + 1") + f""",
ratio AS (
  SELECT panel_id, series_id, lag, a[lag + 2][lag + 3] / sqrt((a[lag + 3][lag + 3] - a[lag + 2][lag + 3] ** 2 / a[lag + 2][lag + 2]) / (n - 1 - lag - (lag + 2)) * a[lag + 2][lag + 2]) AS tau
  FROM through WHERE j = lag + 1),
surface AS (
  SELECT *, CASE WHEN tau <= -1.61 THEN 2.1659 + 1.4412 * tau + 0.038269 * tau ** 2 ELSE 1.7339 + 0.93202 * tau - 0.12745 * tau ** 2 - 0.010368 * tau ** 3 END AS x FROM ratio),
adf AS (
  SELECT panel_id, series_id, lag, tau, CASE WHEN tau > 2.74 THEN 1.0 WHEN tau < -18.83 THEN 0.0 WHEN abs(x) > 8 THEN CAST(x > 0 AS INT) ELSE
    0.5 + sign(x) * exp(-x * x / 2) / sqrt(2 * pi()) * list_sum(list_transform(generate_series(0, 150), lambda i:
      exp((2 * i + 1) * ln(greatest(abs(x), 1e-300)) - ((i + 1) * ln(2) + lgamma(i + 1.5) - ln(pi()) / 2)))) END AS p
  FROM surface)"""
