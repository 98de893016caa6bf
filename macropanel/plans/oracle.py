"""DuckDB SQL that states what each registered query must return.

The CTE chain mirrors the operators: ``panel`` (fixture panel on the month x
brand facts) -> ``clean`` (outliers) -> ``transformed`` (tcodes + slice) ->
``flagged`` (leading) -> ``counts`` / ``card`` / ``kept``. Derived doubles are
rounded to 6 places on both sides; counts are BIGINT.
"""

from __future__ import annotations

W = "PARTITION BY panel_id, series_id"

PANEL_CTE = """
base AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, p_brand AS series_id,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS v
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM base),
dates AS (
  SELECT CAST(d AS DATE) AS date, CAST(date_diff('month', lo, CAST(d AS DATE)) AS INT) AS m
  FROM bounds, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH) AS g(d)),
ids AS (
  SELECT series_id, CAST(row_number() OVER (ORDER BY series_id) - 1 AS INT) AS b
  FROM (SELECT DISTINCT series_id FROM base) q),
dense AS (
  SELECT d.date, d.m, i.series_id, i.b, x.v
  FROM dates d CROSS JOIN ids i LEFT JOIN base x ON x.date = d.date AND x.series_id = i.series_id),
panel AS (
  SELECT 'brand_revenue' AS panel_id, series_id, date, b AS pos,
    CASE WHEN b = 23 THEN CAST(NULL AS INT) ELSE CAST(1 + b % 7 AS INT) END AS tcode,
    CAST(CASE WHEN b < 4 AND m < 20 THEN NULL
         WHEN (m * 7 + b * 13) % 29 = 0 THEN NULL
         WHEN b = 24 AND m % 3 <> 0 THEN NULL
         WHEN b = 5 AND m = 40 THEN v * 1000
         WHEN b = 10 AND m = 30 THEN -v
         WHEN b = 6 AND m = 50 THEN 0.0
         ELSE v END AS DOUBLE) AS value
  FROM dense)"""

CLEAN_CTE = f"""
ranked AS (
  SELECT *, row_number() OVER ({W} ORDER BY value ASC NULLS LAST) - 1 AS rk,
         count(value) OVER ({W}) AS n
  FROM panel),
stats AS (
  SELECT panel_id, series_id, max(n) AS n,
    (max(CASE WHEN rk = floor((n - 1) / 2.0) THEN value END)
     + max(CASE WHEN rk = ceil((n - 1) / 2.0) THEN value END)) / 2 AS median,
    max(CASE WHEN rk = CAST(round(0.25 * (n - 1)) AS BIGINT) THEN value END) AS q25,
    max(CASE WHEN rk = CAST(round(0.75 * (n - 1)) AS BIGINT) THEN value END) AS q75
  FROM ranked GROUP BY panel_id, series_id),
clean AS (
  SELECT p.panel_id, p.series_id, p.date, p.pos, p.tcode,
    CASE WHEN p.value >= s.median - 10.0 * (s.q75 - s.q25)
          AND p.value <= s.median + 10.0 * (s.q75 - s.q25) THEN p.value END AS value
  FROM panel p JOIN stats s ON p.panel_id = s.panel_id AND p.series_id = s.series_id)"""


def lag_cte(src: str = "clean", name: str = "lagged") -> str:
    return f"""
{name}0 AS (
  SELECT *, CASE WHEN value > 0 THEN ln(value) END AS lv FROM {src}),
{name} AS (
  SELECT *, row_number() OVER w AS rn,
    lag(value, 1) OVER w AS l1, lag(value, 2) OVER w AS l2,
    lag(lv, 1) OVER w AS ll1, lag(lv, 2) OVER w AS ll2
  FROM {name}0 WINDOW w AS ({W} ORDER BY date))"""


def tcode_case(code: str) -> str:
    return f"""CASE WHEN {code} IS NULL OR {code} = 1 THEN value
    WHEN {code} = 2 THEN value - l1
    WHEN {code} = 3 THEN (value - l1) - (l1 - l2)
    WHEN {code} = 4 THEN lv
    WHEN {code} = 5 THEN lv - ll1
    WHEN {code} = 6 THEN (lv - ll1) - (ll1 - ll2)
    WHEN {code} = 7 THEN (value / nullif(l1, 0) - 1) - (l1 / nullif(l2, 0) - 1) END"""


TRANSFORMED_CTE = (
    lag_cte()
    + f""",
transformed AS (
  SELECT panel_id, series_id, date, pos, tcode, CAST({tcode_case('tcode')} AS DOUBLE) AS value
  FROM lagged WHERE rn > 2)"""
)

CARD_CTE = f"""
flagged AS (
  SELECT *, count(value) OVER ({W} ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 0 AS lead_flag
  FROM transformed),
counts AS (
  SELECT panel_id, series_id, max(pos) AS pos, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(value) AS BIGINT) AS n_obs,
    CAST(count_if(value IS NULL AND lead_flag) AS BIGINT) AS n_missing_leading,
    CAST(count_if(value IS NULL AND NOT lead_flag) AS BIGINT) AS n_missing_internal,
    min(CASE WHEN value IS NOT NULL THEN date END) AS first_obs_date,
    max(CASE WHEN value IS NOT NULL THEN date END) AS last_obs_date
  FROM flagged GROUP BY panel_id, series_id),
card AS (
  SELECT panel_id, series_id, first_obs_date, last_obs_date, n_obs, n_missing_leading, n_missing_internal,
    round((n_missing_leading + n_missing_internal) / greatest(n_rows, 1), 4) AS frac_missing,
    round(n_missing_leading / greatest(n_rows, 1), 4) AS frac_missing_leading,
    round(n_missing_internal / greatest(n_rows, 1), 4) AS frac_missing_internal,
    (n_missing_leading + n_missing_internal) / greatest(n_rows, 1) <= 0.5 AS kept,
    CASE WHEN NOT ((n_missing_leading + n_missing_internal) / greatest(n_rows, 1) <= 0.5)
         THEN 'missing_frac>0.5' END AS drop_reason,
    pos, n_rows
  FROM counts),
kept AS (SELECT panel_id, series_id, pos FROM card WHERE kept),
kept_cells AS (
  SELECT t.* FROM transformed t JOIN kept k ON t.panel_id = k.panel_id AND t.series_id = k.series_id)"""

STD_CTE = """
moments AS (
  SELECT panel_id, series_id, avg(value) AS mu, stddev_pop(value) AS sd0 FROM kept_cells GROUP BY panel_id, series_id),
standardized AS (
  SELECT c.panel_id, c.series_id, c.date, c.value, m.mu,
    CASE WHEN m.sd0 < 1e-12 THEN 1.0 ELSE m.sd0 END AS sd,
    (c.value - m.mu) / CASE WHEN m.sd0 < 1e-12 THEN 1.0 ELSE m.sd0 END AS z
  FROM kept_cells c JOIN moments m ON c.panel_id = m.panel_id AND c.series_id = m.series_id)"""


def chain(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


ALL = chain(PANEL_CTE, CLEAN_CTE, TRANSFORMED_CTE, CARD_CTE)
ALL_STD = chain(PANEL_CTE, CLEAN_CTE, TRANSFORMED_CTE, CARD_CTE, STD_CTE)
