"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB oracles.

Every query starts from the driver's parquet tables: the month x brand panel
is built from the whole of ``lineitem`` and ``part`` (FIXTURES.md §2), then the
operators run over it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macropanel.model import BRAND_PARAMS, DATE, K, PANEL, SERIES, VALUE
from macropanel.operators import card as C
from macropanel.operators import outliers as O
from macropanel.operators import stationarity as S
from macropanel.plans import inputs as I
from macropanel.plans import oracle as Q
from macropanel.plans import oracle_em as OE
from macropanel.operators import contracts as CT
from macropanel.operators import factors as FA
from macropanel.operators import validation as VA
from macropanel.plans.prepare import prepare
from macropanel.sinks import artifacts as W
from macropanel.sinks import published as R
from macropanel.sinks.digest import digest_sql
from macropanel.sources import panels as P
from macropanel.sources import vintage as V
from macropanel.streaming.vintages import read_quarantine, start_vintage_stream

P_ = BRAND_PARAMS
LANDING = "/landing/vintages"
#: The vintage as which a panel is landed, and the digits of doubles in digests that SQL states too.
VINTAGE, DIGITS = "2002-01", 5


#: Columns of the artifacts in their digests, with their kind in SQL.
_CELL = {"panel_id": "varchar", "series_id": "varchar", "date": "date"}
_FRACTIONS = dict.fromkeys(("frac_missing", "frac_missing_leading", "frac_missing_internal"), "double")
_CARD = dict.fromkeys(("panel_id", "series_id", "first_obs_date", "last_obs_date", "n_obs", "n_missing_leading", "n_missing_internal", "kept", "drop_reason"), "varchar")
ARTIFACT_COLUMNS = {"raw": _CELL | {"value": "double"}, "transformed": _CELL | {"value": "double"}, "mask": _CELL | {"imputed": "boolean"}, "data_card": _CARD | _FRACTIONS}
_VALIDATION = dict.fromkeys(("panel_id", "series_id", "pos", "n_obs", "flag_sparse", "flag_infinite", "flag_nonstationary"), "varchar")
PUBLISHED = ARTIFACT_COLUMNS | {
    "data_card": _CARD | _FRACTIONS | {"pos": "int"},
    "validation": _VALIDATION | {"null_rate": "double", "adf_pvalue": "double"},
    "transformed_balanced": ARTIFACT_COLUMNS["transformed"],
    "mask_balanced": ARTIFACT_COLUMNS["mask"],
}
#: Vintages that the stream's query lands.
GOOD_VINTAGES = ("2001-11", "2001-12")
ODD_VINTAGES = {"2001-07": "number", "2001-08": "code", "2001-09": "twice"}


def r6(c) -> F.Column:
    return F.round(c if isinstance(c, F.Column) else F.col(c), 6)


# ---------------------------------------------------------------- stages


def brand(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return I.brand_fixture_panel(spark, sf)


def cleaned(spark, sf):
    panel, series = brand(spark, sf)
    return O.remove_outliers(panel, P_.outlier_k), series


def transformed(spark, sf, materialize: bool = True):
    """Transformed panel; checkpointed when several outputs read it (panel-sized, not input-sized)."""
    clean, series = cleaned(spark, sf)
    t = S.transform_all(clean, series)
    return (t.checkpoint(eager=True) if materialize else t), series


# ---------------------------------------------------------------- queries


def q_panel_build(spark, sf):
    panel, series = brand(spark, sf)
    return panel.join(series, K).select(PANEL, SERIES, DATE, "pos", "tcode", VALUE)


def q_outlier_bounds(spark, sf):
    panel, _ = brand(spark, sf)
    b = O.outlier_bounds(panel, P_.outlier_k)
    return b.select(PANEL, SERIES, "n_obs", *[r6(c).alias(c) for c in ["median", "q25", "q75", "lower", "upper"]])


def q_remove_outliers(spark, sf):
    clean, _ = cleaned(spark, sf)
    return clean.select(PANEL, SERIES, DATE, VALUE)


def q_long_series_band(spark, sf):
    """The band of one series that holds every event: no task sorts or holds it."""
    e = P.read_table(spark, sf, "events")
    panel = e.select(F.lit("events").alias(PANEL), F.lit("all").alias(SERIES), F.to_date("ts").alias(DATE), F.col("value").alias(VALUE))
    stats = O.long_series_stats(panel)
    lower, upper = O._band(P_.outlier_k)
    return stats.select(PANEL, SERIES, F.col("_n").alias("n_obs"), r6("_median").alias("median"), r6("_q25").alias("q25"), r6("_q75").alias("q75"), r6(lower).alias("lower"), r6(upper).alias("upper"))


def q_remove_outliers_long(spark, sf):
    panel, _ = brand(spark, sf)
    return O.remove_outliers_long(panel, P_.outlier_k).select(PANEL, SERIES, DATE, VALUE)


def q_wide_and_back(spark, sf):
    """Nation x month order values as a wide table, one column a nation, and back to cells."""
    facts = P.month_nation_orders(P.read_table(spark, sf, "orders"), P.read_table(spark, sf, "customer"))
    cells, series = P.facts_to_panel(facts)
    names = [r[SERIES] for r in series.orderBy("pos").select(SERIES).collect()]  # the columns of a wide table
    wide = P.to_wide(cells.select(PANEL, SERIES, DATE, VALUE), names).drop(PANEL)
    return P.unpivot_wide(wide, "nation_orders")


def make_tcode_query(code: int):
    def q(spark, sf):
        clean, _ = cleaned(spark, sf)
        return S.apply_tcode(clean, F.lit(code)).select(PANEL, SERIES, DATE, r6(VALUE).alias(VALUE))

    q.__name__ = f"q_tcode_{code}"
    return q


def q_transform_all(spark, sf):
    t, _ = transformed(spark, sf, materialize=False)
    return t.select(PANEL, SERIES, DATE, r6(VALUE).alias(VALUE))


def q_data_card(spark, sf):
    t, series = transformed(spark, sf, materialize=False)
    return C.build_data_card(t, series, P_.max_missing_frac).drop("pos")


def q_vintage_path(spark, sf):
    o = P.read_table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("ref_date")).distinct()
    pin = F.concat(F.year("ref_date").cast("string"), F.lit("-"), F.month("ref_date").cast("string"))
    return o.select(
        "ref_date",
        V.vintage_name(F.col("ref_date")).alias("vintage"),
        V.vintage_path(LANDING, F.col("ref_date")).alias("path"),
        V.vintage_name(F.col("ref_date"), pin).alias("pinned_vintage"),
    )


def _ingested(spark, sf):
    """The panel written as a vintage file and read back by the vintage reader."""
    panel, series = brand(spark, sf)
    lines = I.published_lines(V.panel_to_lines(panel, series)).withColumn(PANEL, F.lit(VINTAGE))
    landing = I.scratch_folder(spark, "landing")
    V.land_vintages(lines, landing)
    named = F.lit("brand_revenue").alias(PANEL)
    back, dim = V.read_vintages(spark, landing, P_.date_floor, pin=VINTAGE)
    return back.select(named, SERIES, DATE, VALUE), dim.select(named, SERIES, "pos", "tcode")


def q_ingest_long(spark, sf):
    panel, _ = _ingested(spark, sf)
    return panel.select(PANEL, SERIES, DATE, VALUE)


def q_series_dim(spark, sf):
    _, dim = _ingested(spark, sf)
    return dim.select(PANEL, SERIES, "pos", "tcode")


def q_missing_fraction(spark, sf):
    t, _ = transformed(spark, sf, materialize=False)
    return C.missing_fraction(t).select(PANEL, SERIES, "n_rows", "n_missing", r6("missing_frac").alias("missing_frac"))


def q_kept_series(spark, sf):
    t, series = transformed(spark, sf)
    return C.kept_series(t, series, P_.max_missing_frac)


def q_mask(spark, sf):
    t, series = transformed(spark, sf)
    return C.mask(t, C.kept_series(t, series, P_.max_missing_frac))


def _std(spark, sf):
    t, series = transformed(spark, sf)
    kidx = FA.kept_index(t, series, P_.max_missing_frac).checkpoint(eager=True)  # read by the moments and by both sides of the names
    return FA.standardize(t, kidx), kidx


def q_standardize(spark, sf):
    std, _ = _std(spark, sf)
    return std.select(PANEL, SERIES, DATE, r6("z").alias("z"))


def q_gram_matrix(spark, sf):
    std, kidx = _std(spark, sf)
    g = FA.gram_matrix(FA.row_vectors(std))
    ki = kidx.select(PANEL, F.col("idx").alias("i"), F.col(SERIES).alias("series_i"))
    kj = kidx.select(PANEL, F.col("idx").alias("j"), F.col(SERIES).alias("series_j"))
    return g.join(ki, [PANEL, "i"]).join(kj, [PANEL, "j"]).select(PANEL, "series_i", "series_j", r6("g").alias("g"))


def q_leading_internal(spark, sf):
    t, series = transformed(spark, sf)
    return C.leading_internal(t, C.kept_series(t, series, P_.max_missing_frac))


def q_imputation_counts(spark, sf):
    t, series = transformed(spark, sf)
    c = C.imputation_counts(t, series, P_.max_missing_frac, P_.k)
    return c.select(
        PANEL,
        F.array_join("kept_series", ",").alias("kept_ids"),
        F.array_join("dropped_series", ",").alias("dropped_ids"),
        "n_dates",
        "n_kept",
        "n_dropped",
        "n_imputed",
        "n_imputed_leading",
        "n_imputed_internal",
        *[r6(c_).alias(c_) for c_ in ["frac_imputed", "frac_imputed_leading", "frac_imputed_internal"]],
        "k_factors",
    )


def _card(spark, sf):
    t, series = transformed(spark, sf)
    return C.build_data_card(t, series, P_.max_missing_frac), t, series


def q_balanced_series(spark, sf):
    card, _, _ = _card(spark, sf)
    return C.balanced_series(card, P_.balanced_cutoff)


def q_balanced_panel(spark, sf):
    card, t, series = _card(spark, sf)
    m = C.mask(t, C.kept_series(t, series, P_.max_missing_frac))
    return C.balanced_projection(m, C.balanced_series(card, P_.balanced_cutoff))


def q_series_quality(spark, sf):
    t, series = transformed(spark, sf, materialize=False)
    return VA.series_quality(I.with_infinities(t, series))


def q_df_tstat_lag0(spark, sf):
    t, _ = transformed(spark, sf, materialize=False)
    return VA.df_tstat_lag0(t)


def q_contract_violations(spark, sf):
    clean, series = cleaned(spark, sf)
    clean = clean.checkpoint(eager=True)
    t = S.transform_all(clean, series).checkpoint(eager=True)
    card = C.build_data_card(t, series, P_.max_missing_frac)
    m = C.mask(t, C.kept_series(t, series, P_.max_missing_frac))
    spoiled = I.spoiled_artifacts(clean, t, m, card.drop("pos"), series)
    return CT.all_violations({name: df.checkpoint(eager=True) for name, df in spoiled.items()})


def q_artifact_manifest(spark, sf):
    clean, series = cleaned(spark, sf)
    clean = clean.checkpoint(eager=True)
    t = S.transform_all(clean, series).checkpoint(eager=True)
    card = C.build_data_card(t, series, P_.max_missing_frac)
    m = C.mask(t, C.kept_series(t, series, P_.max_missing_frac))
    card = card.drop("pos")
    parts = [W.manifest_counts(n, d.select(*ARTIFACT_COLUMNS[n]), DIGITS) for n, d in [("raw", clean), ("transformed", t), ("mask", m), ("data_card", card)]]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def q_contract_failures(spark, sf):
    """The rows behind ``contract_violations``, over the same spoiled artifacts."""
    clean, series = cleaned(spark, sf)
    clean = clean.checkpoint(eager=True)
    t = S.transform_all(clean, series).checkpoint(eager=True)
    card = C.build_data_card(t, series, P_.max_missing_frac)
    m = C.mask(t, C.kept_series(t, series, P_.max_missing_frac))
    spoiled = I.spoiled_artifacts(clean, t, m, card.drop("pos"), series)
    found = CT.all_failures(spoiled)
    fraction = F.format_string("%.4f", F.col("value").cast("double"))
    return found.withColumn("value", F.when(F.col("column").startswith("frac_") & F.col("value").isNotNull(), fraction).otherwise(F.col("value")))


def _published(spark, sf) -> str:
    """The folder to which a whole run over the brand panel was published."""
    out = I.scratch_folder(spark, "published")
    R.publish(prepare(*brand(spark, sf), P_), out)
    return out


def q_published_artifacts(spark, sf):
    """Every Parquet artifact of a published run, read back: rows and content digest."""
    return R.published_digests(spark, _published(spark, sf), list(PUBLISHED), DIGITS)


def q_published_report(spark, sf):
    """The two JSON artifacts of a published run, read back and joined."""
    out = _published(spark, sf)
    report, summary = (R.read_published(spark, out, name) for name in R.JSON)
    summary = summary.select(PANEL, "rows", "series_input", "series_kept", "series_dropped", F.col("balanced_n_series").alias("balanced"), "em_iter", "em_converged")
    fractions = [r6(c).alias(c) for c in ("frac_imputed", "frac_imputed_leading", "frac_imputed_internal")]
    names = ["n_iter", "converged", "k_factors", "n_kept", "n_dropped", "n_dates", "balanced_n_series", "pipeline_version", "balanced_cutoff_date"]
    return report.join(summary, PANEL).select(PANEL, *names, F.round("final_delta", 8).alias("final_delta"), *fractions, "rows", "series_input", "series_kept", "series_dropped", "balanced", "em_iter", "em_converged")


def q_vintage_stream(spark, sf):
    """Vintage files landed, streamed in small batches, prepared and written; bad ones set aside: rows per artifact and reason."""
    panel, series = brand(spark, sf)
    lines = I.stream_lines(V.panel_to_lines(panel, series), list(GOOD_VINTAGES), ODD_VINTAGES)
    landing, out, aside, position = (I.scratch_folder(spark, name) for name in ("landing", "stream-out", "quarantine", "stream-position"))
    V.land_vintages(lines, landing)
    start_vintage_stream(spark, landing, out, position, P_.with_(k=2), max_files_per_trigger=3, quarantine=aside).awaitTermination()
    parts = [spark.read.parquet(f"{out}/{name}").select(F.col(PANEL).cast("string").alias(PANEL), F.lit(name).alias("what")) for name in ("raw", "mask", "data_card")]
    parts.append(read_quarantine(spark, aside).select(PANEL, F.concat(F.lit("quarantine: "), "reason").alias("what")))
    return reduce(DataFrame.unionByName, parts).groupBy(PANEL, "what").agg(F.count(F.lit(1)).cast("long").alias("n_rows"))


def q_run_summary_counts(spark, sf):
    card, t, series = _card(spark, sf)
    counts = C.imputation_counts(t, series, P_.max_missing_frac, P_.k)
    s = W.run_summary(counts, C.balanced_series(card, P_.balanced_cutoff), t, series, P_.pipeline_version)
    return s.select(*[r6(c).alias(c) if c.startswith("frac") else c for c in s.columns])


def _em(spark, sf):
    """All steps at the production k, the panel's rows dealt over several tasks as a panel of any size would be."""
    t, series = transformed(spark, sf)
    return FA.em_impute(t, series, P_.with_(cells_per_task=500))


def _in_deviations(imputed: DataFrame) -> DataFrame:
    """Cells with ``z``, their value less the mean of their series' observed cells, over their deviation."""
    seen = F.when(~F.col("imputed"), F.col(VALUE))
    moments = imputed.groupBy(*K).agg(F.avg(seen).alias("mu"), F.stddev_pop(seen).alias("sd"))
    return imputed.join(moments, K).select(*K, DATE, "imputed", ((F.col(VALUE) - F.col("mu")) / F.col("sd")).alias("z"))


def q_em_pca_impute(spark, sf):
    return _in_deviations(_em(spark, sf).imputed).withColumn("z", r6("z") + 0.0)  # no negative zero


def q_em_wide_impute(spark, sf):
    """Quarters x parts, as many series as the part table has rows: beyond ``gram_series`` no Gram matrix is formed."""
    rows, series = I.wide_part_panel(spark, sf)
    em = FA.em_impute(P.cells_of(rows), series, P_, rows=rows)
    report = em.report.drop("kept_series", "dropped_series")
    # a panel's cells stay where they are, and its row comes to them; a panel without kept series has its row alone
    cells = em.imputed.join(F.broadcast(report), PANEL).select(*report.columns, SERIES, DATE, VALUE, "imputed")
    return cells.unionByName(report.where("n_kept = 0"), allowMissingColumns=True)


def q_em_wide_rank1(spark, sf):
    """One step at k = 1 of the same panel, always by passes over its vectors."""
    rows, series = I.wide_part_panel(spark, sf)
    one = FA.em_impute(P.cells_of(rows), series, P_.with_(k=1, max_iter=1, gram_series=0, cells_per_task=5_000), rows=rows).imputed
    return _in_deviations(one).withColumn("z", F.round("z", 4) + 0.0)


def _rank1(spark, sf, **params):
    """One EM step with one factor: what SQL can follow by power iteration."""
    t, series = transformed(spark, sf)
    one = FA.em_impute(t, series, P_.with_(k=1, max_iter=1, **params)).imputed
    return one.select(PANEL, SERIES, DATE, "imputed", r6(VALUE).alias(VALUE))


def q_em_rank1_refill(spark, sf):
    return _rank1(spark, sf)


def q_em_rank1_dealt(spark, sf):
    """The same with the panel's rows dealt over several tasks, as a panel of any size would be."""
    return _rank1(spark, sf, cells_per_task=200)


def q_em_pca_report(spark, sf):
    return _em(spark, sf).report


def q_em_report_k8(spark, sf):
    """The same report with ids joined and numbers rounded, for its SQL."""
    r = _em(spark, sf).report
    ids = [F.array_join(c, ",").alias(c) for c in ("kept_series", "dropped_series")]
    fractions = [r6(c).alias(c) for c in ("frac_imputed", "frac_imputed_leading", "frac_imputed_internal")]
    return r.select(PANEL, *ids, "n_iter", "converged", F.round("final_delta", 8).alias("final_delta"), *fractions, "k_factors", "n_kept", "n_dropped", "n_dates")


def q_adf_validation(spark, sf):
    em = _em(spark, sf)
    return VA.build_validation(em.imputed.select(PANEL, SERIES, DATE, VALUE))


def q_many_panel_impute(spark, sf):
    panel, series = I.many_fact_panels(spark, sf)
    raw = O.remove_outliers(panel, P_.outlier_k)
    t = S.transform_all(raw, series)
    em = FA.em_impute(t, series, P_.with_(cells_per_task=2_000))  # small, so that panels of the given tables are dealt too
    return em.report.join(em.imputed, PANEL, "left")  # every panel, also one without kept series


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "panel_build": q_panel_build,
    "outlier_bounds": q_outlier_bounds,
    "remove_outliers": q_remove_outliers,
    **{f"tcode_{c}": make_tcode_query(c) for c in S.TCODES},
    "long_series_band": q_long_series_band,
    "remove_outliers_long": q_remove_outliers_long,
    "wide_and_back": q_wide_and_back,
    "transform_all": q_transform_all,
    "data_card": q_data_card,
    "vintage_path": q_vintage_path,
    "ingest_long": q_ingest_long,
    "series_dim": q_series_dim,
    "missing_fraction": q_missing_fraction,
    "kept_series": q_kept_series,
    "mask": q_mask,
    "standardize": q_standardize,
    "gram_matrix": q_gram_matrix,
    "leading_internal": q_leading_internal,
    "imputation_counts": q_imputation_counts,
    "balanced_series": q_balanced_series,
    "balanced_panel": q_balanced_panel,
    "series_quality": q_series_quality,
    "df_tstat_lag0": q_df_tstat_lag0,
    "contract_violations": q_contract_violations,
    "contract_failures": q_contract_failures,
    "artifact_manifest": q_artifact_manifest,
    "published_artifacts": q_published_artifacts,
    "published_report": q_published_report,
    "vintage_stream": q_vintage_stream,
    "run_summary_counts": q_run_summary_counts,
    "em_pca_impute": q_em_pca_impute,
    "em_wide_impute": q_em_wide_impute,
    "em_wide_rank1": q_em_wide_rank1,
    "em_rank1_refill": q_em_rank1_refill,
    "em_rank1_dealt": q_em_rank1_dealt,
    "em_pca_report": q_em_pca_report,
    "em_report_k8": q_em_report_k8,
    "adf_validation": q_adf_validation,
    "many_panel_impute": q_many_panel_impute,
}


def _tcode_sql(code: int) -> str:
    return (
        Q.chain(Q.PANEL_CTE, Q.CLEAN_CTE, Q.lag_cte())
        + f"SELECT panel_id, series_id, date, round(CAST({Q.tcode_case(str(code))} AS DOUBLE), 6) AS value FROM lagged"
    )


ORACLES: dict[str, str] = {
    "panel_build": Q.chain(Q.PANEL_CTE) + "SELECT panel_id, series_id, date, pos, tcode, value FROM panel",
    # by sorted lists, not by ranks: the median averages the middle two, the quartiles stand at the nearest rank
    "outlier_bounds": Q.chain(Q.PANEL_CTE).rstrip("\n")
    + """,
lists AS (
  SELECT panel_id, series_id, list_sort(list(value) FILTER (WHERE value IS NOT NULL)) AS l, median(value) AS median
  FROM panel GROUP BY panel_id, series_id),
picked AS (
  SELECT panel_id, series_id, len(l) AS n, median,
    l[CAST(floor(0.25 * (len(l) - 1) + 0.5) AS INT) + 1] AS q25, l[CAST(floor(0.75 * (len(l) - 1) + 0.5) AS INT) + 1] AS q75
  FROM lists)
SELECT panel_id, series_id, CAST(n AS BIGINT) AS n_obs, round(median, 6) AS median, round(q25, 6) AS q25,
  round(q75, 6) AS q75, round(median - 10.0 * (q75 - q25), 6) AS lower, round(median + 10.0 * (q75 - q25), 6) AS upper
FROM picked""",
    "remove_outliers": Q.chain(Q.PANEL_CTE, Q.CLEAN_CTE) + "SELECT panel_id, series_id, date, value FROM clean",
    **{f"tcode_{c}": _tcode_sql(c) for c in S.TCODES},
    "transform_all": Q.chain(Q.PANEL_CTE, Q.CLEAN_CTE, Q.TRANSFORMED_CTE)
    + "SELECT panel_id, series_id, date, round(value, 6) AS value FROM transformed",
    "data_card": Q.ALL
    + """SELECT panel_id, series_id, first_obs_date, last_obs_date, n_obs, n_missing_leading, n_missing_internal,
  frac_missing, frac_missing_leading, frac_missing_internal, kept, drop_reason FROM card""",
}


# ---------------------------------------------------------------- oracles for the remaining queries

_CONTRACT_RULES = {
    "raw": ("bad_raw", [("not_null", "date"), ("not_null", "series_id")], ["panel_id", "series_id", "date"]),
    "transformed": ("bad_transformed", [("not_null", "date"), ("not_null", "series_id")], ["panel_id", "series_id", "date"]),
    "mask": ("bad_mask", [("not_null", "date"), ("not_null", "imputed")], ["panel_id", "series_id", "date"]),
    "data_card": (
        "bad_card",
        [("not_null", "series_id"), ("not_null", "kept")]
        + [(r, c) for c in ("n_obs", "n_missing_leading", "n_missing_internal") for r in ("not_null", "ge_0")]
        + [(r, c) for c in ("frac_missing", "frac_missing_leading", "frac_missing_internal") for r in ("not_null", "in_0_1")],
        ["panel_id", "series_id"],
    ),
}


def _spoiled_cells(name: str, src: str, values: str) -> str:
    return f"""
{name} AS (
  SELECT panel_id, series_id, CASE WHEN pos = 7 AND month(date) = 2 THEN NULL ELSE date END AS date, {values} FROM {src}
  UNION ALL SELECT panel_id, series_id, date, {values} FROM {src} WHERE pos = 3 AND month(date) = 7)"""


def _spoiled_card() -> str:
    counts = [
        f"CASE WHEN pos = {9 + k} THEN -1 - {c} WHEN pos = {12 + k} THEN NULL ELSE {c} END AS {c}"
        for k, c in enumerate(("n_obs", "n_missing_leading", "n_missing_internal"))
    ]
    fractions = [
        f"CASE WHEN pos = {15 + k} THEN {c} + 1.5 WHEN pos = {18 + k} THEN NULL ELSE {c} END AS {c}"
        for k, c in enumerate(("frac_missing", "frac_missing_leading", "frac_missing_internal"))
    ]
    return f"""
bad_card AS (
  SELECT panel_id, series_id, CASE WHEN pos = 21 THEN NULL ELSE kept END AS kept, {', '.join(counts + fractions)}
  FROM (SELECT * FROM card UNION ALL SELECT * FROM card WHERE pos = 4) q)
"""


_SPOILED = ",".join(
    [
        "",
        _spoiled_cells("bad_raw", "clean", "value"),
        _spoiled_cells("bad_transformed", "transformed", "value"),
        _spoiled_cells("bad_mask", "mask_pos", "CASE WHEN pos = 8 AND month(date) = 3 THEN NULL ELSE imputed END AS imputed"),
        _spoiled_card(),
    ]
)


def _rule_sql(rule: str, col: str) -> str:
    return {"not_null": f"{col} IS NULL", "ge_0": f"{col} < 0", "in_0_1": f"({col} < 0 OR {col} > 1)"}[rule]


def _contracts_sql() -> str:
    parts = []
    for artifact, (src, rules, keys) in _CONTRACT_RULES.items():
        for rule, col in rules:
            parts.append(f"SELECT '{artifact}' AS artifact, '{rule}' AS rule, '{col}' AS \"column\", CAST(count_if({_rule_sql(rule, col)}) AS BIGINT) AS n FROM {src}")
        k = ", ".join(keys)
        parts.append(
            f"SELECT '{artifact}' AS artifact, 'unique' AS rule, '{'+'.join(keys[1:])}' AS \"column\", "
            f"CAST(coalesce(sum(CASE WHEN c > 1 THEN c - 1 END), 0) AS BIGINT) AS n FROM (SELECT count(*) AS c FROM {src} GROUP BY {k}) q"
        )
    return "\nUNION ALL ".join(parts)


def _failures_sql() -> str:
    parts = []
    for artifact, (src, rules, keys) in _CONTRACT_RULES.items():
        date = "date" if "date" in keys else "CAST(NULL AS DATE)"
        for rule, col in rules:
            value = f"printf('%.4f', {col})" if col.startswith("frac_") else f"CAST({col} AS VARCHAR)"
            value = "CAST(NULL AS VARCHAR)" if rule == "not_null" else value
            parts.append(f"SELECT '{artifact}' AS artifact, '{rule}' AS rule, '{col}' AS \"column\", panel_id, series_id, {date} AS date, {value} AS value, CAST(1 AS BIGINT) AS n FROM {src} WHERE {_rule_sql(rule, col)}")
        parts.append(
            f"SELECT '{artifact}' AS artifact, 'unique' AS rule, '{'+'.join(keys[1:])}' AS \"column\", panel_id, series_id, {date} AS date, CAST(NULL AS VARCHAR) AS value, "
            f"CAST(count(*) - 1 AS BIGINT) AS n FROM {src} GROUP BY {', '.join(keys)} HAVING count(*) > 1"
        )
    return "\nUNION ALL ".join(parts)


def _published_sql() -> str:
    balanced = "JOIN card c ON q.panel_id = c.panel_id AND q.series_id = c.series_id WHERE c.kept AND c.first_obs_date <= DATE '1995-12-01'"
    sources = {
        "raw": "clean",
        "transformed": "em_cells",
        "mask": "em_cells",
        "data_card": "card",
        "validation": "checked",
        "transformed_balanced": f"(SELECT q.* FROM em_cells q {balanced}) b",
        "mask_balanced": f"(SELECT q.* FROM em_cells q {balanced}) b",
    }
    return "\nUNION ALL ".join(f"SELECT panel_id, '{name}' AS artifact, CAST(count(*) AS BIGINT) AS n_rows, {digest_sql(PUBLISHED[name], DIGITS)} FROM {src} GROUP BY panel_id" for name, src in sources.items())


def _manifest_sql() -> str:
    parts = []
    for artifact, src in [("raw", "clean"), ("transformed", "transformed"), ("mask", "mask_rows"), ("data_card", "card")]:
        dates = (
            "strftime(min(date), '%m/%Y') AS date_first, strftime(max(date), '%m/%Y') AS date_last"
            if src != "card"
            else "CAST(NULL AS VARCHAR) AS date_first, CAST(NULL AS VARCHAR) AS date_last"
        )
        parts.append(
            f"SELECT panel_id, '{artifact}' AS artifact, CAST(count(*) AS BIGINT) AS n_rows, "
            f"CAST(count(DISTINCT series_id) AS BIGINT) AS n_series, {dates}, {digest_sql(ARTIFACT_COLUMNS[artifact], DIGITS)} FROM {src} GROUP BY panel_id"
        )
    return "\nUNION ALL ".join(parts)


_MASK_ROWS = (
    ",\nmask_pos AS (SELECT panel_id, series_id, pos, date, value IS NULL AS imputed FROM kept_cells)"
    ",\nmask_rows AS (SELECT panel_id, series_id, date, imputed FROM mask_pos)\n"
)
_ALLM = Q.ALL.rstrip("\n") + _MASK_ROWS
_IMP_COUNTS = """
ic0 AS (
  SELECT panel_id,
    coalesce(string_agg(CASE WHEN kept THEN series_id END, ',' ORDER BY pos), '') AS kept_ids,
    coalesce(string_agg(CASE WHEN NOT kept THEN series_id END, ',' ORDER BY pos), '') AS dropped_ids,
    CAST(max(n_rows) AS BIGINT) AS n_dates, CAST(count_if(kept) AS BIGINT) AS n_kept, CAST(count_if(NOT kept) AS BIGINT) AS n_dropped,
    CAST(sum(CASE WHEN kept THEN n_missing_leading + n_missing_internal ELSE 0 END) AS BIGINT) AS n_imputed,
    CAST(sum(CASE WHEN kept THEN n_missing_leading ELSE 0 END) AS BIGINT) AS n_imputed_leading,
    CAST(sum(CASE WHEN kept THEN n_missing_internal ELSE 0 END) AS BIGINT) AS n_imputed_internal
  FROM card GROUP BY panel_id),
ic AS (
  SELECT *, round(n_imputed / greatest(n_dates * n_kept, 1), 6) AS frac_imputed,
    round(n_imputed_leading / greatest(n_dates * n_kept, 1), 6) AS frac_imputed_leading,
    round(n_imputed_internal / greatest(n_dates * n_kept, 1), 6) AS frac_imputed_internal,
    CAST(CASE WHEN n_kept = 0 THEN 0 ELSE greatest(1, least(8, least(n_dates, n_kept) - 1)) END AS INT) AS k_factors
  FROM ic0)"""

ORACLES.update(
    {
        "vintage_path": f"""WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS ref_date FROM orders)
SELECT ref_date, strftime(ref_date - INTERVAL 1 MONTH, '%Y-%m') AS vintage,
  '{LANDING}/' || strftime(ref_date - INTERVAL 1 MONTH, '%Y-%m') || '-md.csv' AS path,
  lpad(CAST(year(ref_date) AS VARCHAR), 4, '0') || '-' || lpad(CAST(month(ref_date) AS VARCHAR), 2, '0') AS pinned_vintage
FROM o""",
        "ingest_long": Q.chain(Q.PANEL_CTE)
        + f"""SELECT panel_id, series_id, date, CASE WHEN month(date) = 11 AND pos >= {I.SHORT_LINE - 1} THEN NULL ELSE value END AS value
FROM panel WHERE date >= DATE '1959-01-01'""",
        "series_dim": Q.chain(Q.PANEL_CTE) + "SELECT DISTINCT panel_id, series_id, pos, tcode FROM panel",
        "missing_fraction": Q.chain(Q.PANEL_CTE, Q.CLEAN_CTE, Q.TRANSFORMED_CTE)
        + """SELECT panel_id, series_id, CAST(count(*) AS BIGINT) AS n_rows, CAST(count_if(value IS NULL) AS BIGINT) AS n_missing,
  round(avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_frac FROM transformed GROUP BY panel_id, series_id""",
        "kept_series": Q.ALL + "SELECT panel_id, series_id, pos, n_rows, n_missing_leading + n_missing_internal AS n_missing, kept FROM card",
        "mask": _ALLM + "SELECT panel_id, series_id, date, imputed FROM mask_rows",
        "standardize": Q.ALL_STD + "SELECT panel_id, series_id, date, round(z, 6) AS z FROM standardized",
        "gram_matrix": Q.ALL_STD
        + """SELECT a.panel_id, a.series_id AS series_i, b.series_id AS series_j,
  round(sum(coalesce(a.z, 0) * coalesce(b.z, 0)), 6) AS g
FROM standardized a JOIN standardized b ON a.panel_id = b.panel_id AND a.date = b.date
GROUP BY a.panel_id, a.series_id, b.series_id""",
        "leading_internal": Q.ALL + "SELECT panel_id, series_id, n_rows, n_missing_leading, n_missing_internal FROM card WHERE kept",
        "imputation_counts": Q.ALL.rstrip("\n")
        + ","
        + _IMP_COUNTS
        + """
SELECT panel_id, kept_ids, dropped_ids, n_dates, n_kept, n_dropped, n_imputed, n_imputed_leading, n_imputed_internal,
  frac_imputed, frac_imputed_leading, frac_imputed_internal, k_factors FROM ic""",
        "balanced_series": Q.ALL + "SELECT panel_id, series_id FROM card WHERE kept AND first_obs_date <= DATE '1995-12-01'",
        "balanced_panel": _ALLM
        + """SELECT m.panel_id, m.series_id, m.date, m.imputed FROM mask_rows m
JOIN card c ON m.panel_id = c.panel_id AND m.series_id = c.series_id
WHERE c.kept AND c.first_obs_date <= DATE '1995-12-01'""",
        "series_quality": Q.chain(Q.PANEL_CTE, Q.CLEAN_CTE, Q.TRANSFORMED_CTE).rstrip("\n")
        + """,
odd AS (SELECT panel_id, series_id, CASE WHEN pos % 9 = 2 AND month(date) = 6 THEN CAST('Infinity' AS DOUBLE) * CASE WHEN pos > 9 THEN -1 ELSE 1 END ELSE value END AS value FROM transformed)
SELECT panel_id, series_id, CAST(count(value) AS BIGINT) AS n_obs,
  round(count_if(value IS NULL) / greatest(count(*), 1), 4) AS null_rate,
  round(count_if(value IS NULL) / greatest(count(*), 1), 4) > 0.5 AS flag_sparse,
  count_if(isinf(value)) > 0 AS flag_infinite
FROM odd GROUP BY panel_id, series_id""",
        "df_tstat_lag0": Q.chain(Q.PANEL_CTE, Q.CLEAN_CTE, Q.TRANSFORMED_CTE)
        + """, fin AS (SELECT panel_id, series_id, date, value FROM transformed WHERE value IS NOT NULL AND NOT isinf(value) AND NOT isnan(value)),
d AS (SELECT panel_id, series_id, lag(value, 1) OVER w AS x1, value - lag(value, 1) OVER w AS dx
      FROM fin WINDOW w AS (PARTITION BY panel_id, series_id ORDER BY date)),
s AS (SELECT panel_id, series_id, count(*) AS m, regr_sxx(dx, x1) AS sxx, regr_sxy(dx, x1) AS sxy, regr_syy(dx, x1) AS syy
      FROM d WHERE x1 IS NOT NULL GROUP BY panel_id, series_id)
SELECT panel_id, series_id, CAST(m AS BIGINT) AS n_pairs,
  round(CASE WHEN m >= 3 AND sxx > 0 AND syy - (sxy / sxx) * sxy > 0
        THEN (sxy / sxx) / sqrt((syy - (sxy / sxx) * sxy) / (m - 2) / sxx) END, 6) AS df_tstat
FROM s""",
        "contract_violations": _ALLM.rstrip("\n") + _SPOILED + _contracts_sql(),
        "artifact_manifest": _ALLM + _manifest_sql(),
        "run_summary_counts": Q.ALL.rstrip("\n")
        + ","
        + _IMP_COUNTS
        + """
SELECT ic.panel_id, ic.n_dates AS rows, CAST((SELECT count(*) FROM card c WHERE c.panel_id = ic.panel_id) AS BIGINT) AS series_input,
  ic.n_kept AS series_kept, ic.n_dropped AS series_dropped,
  CAST((SELECT count(*) FROM card c WHERE c.panel_id = ic.panel_id AND c.kept AND c.first_obs_date <= DATE '1995-12-01') AS BIGINT) AS balanced_n_series,
  ic.frac_imputed, ic.frac_imputed_leading, ic.frac_imputed_internal
FROM ic""",
        "em_rank1_refill": Q.ALL_STD.replace("WITH ", "WITH RECURSIVE ", 1).rstrip("\n")
        + """,
placed AS (
  SELECT s.*, CAST(dense_rank() OVER (PARTITION BY s.panel_id ORDER BY k.pos) AS INT) AS i
  FROM standardized s JOIN kept k ON s.panel_id = k.panel_id AND s.series_id = k.series_id),
gram AS (
  SELECT a.i, b.i AS j, sum(coalesce(a.z, 0) * coalesce(b.z, 0)) AS g FROM placed a JOIN placed b ON a.date = b.date GROUP BY a.i, b.i),
matrix AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(g ORDER BY j) AS r FROM gram GROUP BY i) q),
power(n, v) AS (
  SELECT 0, list_transform(m, lambda r: CAST(1 + r[1] / 1e9 AS DOUBLE)) FROM matrix
  UNION ALL
  SELECT n + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
  FROM (SELECT n, list_transform(m, lambda r: list_dot_product(r, v)) AS w FROM power, matrix WHERE n < 3000) q),
top AS (SELECT v FROM power WHERE n = 3000),
scores AS (SELECT date, sum(coalesce(z, 0) * v[i]) AS f FROM placed, top GROUP BY date)
SELECT p.panel_id, p.series_id, p.date, p.value IS NULL AS imputed,
  round(CASE WHEN p.value IS NULL THEN s.f * t.v[p.i] * p.sd + p.mu ELSE p.value END, 6) AS value
FROM placed p JOIN scores s ON p.date = s.date, top t""",
    }
)
ORACLES["em_rank1_dealt"] = ORACLES["em_rank1_refill"]

_EM = OE.em_chain(P_.k, P_.max_iter, P_.tol)
ORACLES["em_pca_impute"] = _EM + "SELECT panel_id, series_id, date, imputed, round(z, 6) + 0.0 AS z FROM em_cells"
ORACLES["em_report_k8"] = (
    _EM
    + ","
    + _IMP_COUNTS
    + f"""
SELECT panel_id, kept_ids AS kept_series, dropped_ids AS dropped_series, CAST(n_iter AS INT) AS n_iter, delta < {P_.tol} AS converged,
  round(delta, 8) AS final_delta, frac_imputed, frac_imputed_leading, frac_imputed_internal, k_factors,
  CAST(n_kept AS INT) AS n_kept, CAST(n_dropped AS INT) AS n_dropped, n_dates
FROM ic, em_end"""
)
_CHECKED = """
SELECT c.panel_id, c.series_id, c.n_obs, 0.0::DOUBLE AS null_rate, false AS flag_sparse, false AS flag_infinite,
  round(a.p, 4) AS adf_pvalue, coalesce(a.p >= 0.05, false) AS flag_nonstationary
FROM (SELECT panel_id, series_id, count(*) AS n_obs FROM em_cells GROUP BY panel_id, series_id) c
LEFT JOIN adf a ON a.panel_id = c.panel_id AND a.series_id = c.series_id"""
ORACLES["adf_validation"] = _EM + "," + OE.adf_cte() + _CHECKED
ORACLES["published_artifacts"] = (
    _EM + "," + OE.adf_cte() + ",\nunplaced AS (" + _CHECKED + "),\nchecked AS (SELECT u.*, k.pos FROM unplaced u JOIN kept k ON u.panel_id = k.panel_id AND u.series_id = k.series_id)\n" + _published_sql()
)
ORACLES["published_report"] = (
    _EM
    + ","
    + _IMP_COUNTS
    + f"""
SELECT ic.panel_id, CAST(n_iter AS BIGINT) AS n_iter, delta < {P_.tol} AS converged, CAST(k_factors AS BIGINT) AS k_factors, n_kept, n_dropped, n_dates,
  b.n AS balanced_n_series, '{P_.pipeline_version}' AS pipeline_version, '{P_.balanced_cutoff.isoformat()}' AS balanced_cutoff_date,
  round(delta, 8) AS final_delta, frac_imputed, frac_imputed_leading, frac_imputed_internal, n_dates AS rows,
  (SELECT count(*) FROM card) AS series_input, n_kept AS series_kept, n_dropped AS series_dropped, b.n AS balanced, CAST(n_iter AS BIGINT) AS em_iter, delta < {P_.tol} AS em_converged
FROM ic, em_end, (SELECT count(*) AS n FROM card WHERE kept AND first_obs_date <= DATE '1995-12-01') b"""
)
ORACLES["remove_outliers_long"] = ORACLES["remove_outliers"]
ORACLES["long_series_band"] = """WITH l AS (SELECT list_sort(list(value) FILTER (WHERE value IS NOT NULL)) AS l, median(value) AS median FROM events),
p AS (SELECT len(l) AS n, median, l[CAST(floor(0.25 * (len(l) - 1) + 0.5) AS INT) + 1] AS q25, l[CAST(floor(0.75 * (len(l) - 1) + 0.5) AS INT) + 1] AS q75 FROM l)
SELECT 'events' AS panel_id, 'all' AS series_id, CAST(n AS BIGINT) AS n_obs, round(median, 6) AS median, round(q25, 6) AS q25,
  round(q75, 6) AS q75, round(median - 10.0 * (q75 - q25), 6) AS lower, round(median + 10.0 * (q75 - q25), 6) AS upper FROM p"""
ORACLES["wide_and_back"] = """WITH f AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS series_id,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
d AS (SELECT CAST(d AS DATE) AS date FROM (SELECT min(date) AS lo, max(date) AS hi FROM f) b, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH) AS g(d))
SELECT 'nation_orders' AS panel_id, s.series_id, d.date, f.value
FROM d CROSS JOIN (SELECT DISTINCT series_id FROM f) s LEFT JOIN f ON f.date = d.date AND f.series_id = s.series_id"""
ORACLES["contract_failures"] = _ALLM.rstrip("\n") + _SPOILED + _failures_sql()
_REASONS = {"number": "malformed number", "code": "unknown tcode", "twice": "date stands twice"}
ORACLES["vintage_stream"] = (
    Q.ALL
    + "SELECT v AS panel_id, what, n_rows FROM (SELECT unnest(["
    + ", ".join(f"'{v}'" for v in GOOD_VINTAGES)
    + """]) AS v) g, (
  SELECT 'raw' AS what, count(*) AS n_rows FROM clean
  UNION ALL SELECT 'mask', count(*) FROM kept_cells
  UNION ALL SELECT 'data_card', count(*) FROM card) a
"""
    + "".join(f"UNION ALL SELECT '{v}', 'quarantine: {_REASONS[f]}', CAST(1 AS BIGINT)\n" for v, f in ODD_VINTAGES.items())
)
# the leading direction of the quarters' own products, by power iteration; a step's refill needs no more at k = 1
ORACLES["em_wide_rank1"] = """WITH RECURSIVE facts AS (
  SELECT CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date, l_partkey AS p, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem GROUP BY 1, 2),
dates AS (
  SELECT CAST(d AS DATE) AS date FROM (SELECT min(date) AS lo, max(date) AS hi FROM facts) b, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 3 MONTH) AS g(d)),
grid AS (SELECT d.date, s.p, f.value FROM dates d CROSS JOIN (SELECT DISTINCT p FROM facts) s LEFT JOIN facts f ON f.date = d.date AND f.p = s.p),
moments AS (
  SELECT p, avg(value) AS mu, CASE WHEN stddev_pop(value) < 1e-12 THEN 1.0 ELSE stddev_pop(value) END AS sd
  FROM grid GROUP BY p HAVING avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) <= 0.5),
scaled AS (SELECT g.date, g.p, g.value, (g.value - mu) / sd AS z FROM grid g JOIN moments m ON g.p = m.p),
vectors AS (SELECT date, list(coalesce(z, 0) ORDER BY p) AS r FROM scaled GROUP BY date),
products AS (SELECT a.date, list(list_dot_product(a.r, b.r) ORDER BY b.date) AS k FROM vectors a, vectors b GROUP BY a.date),
square AS (SELECT list(k ORDER BY date) AS m, list(date ORDER BY date) AS dates FROM products),
power(n, u) AS (
  SELECT 0, list_transform(m, lambda r: CAST(1 + r[1] / 1e9 AS DOUBLE)) FROM square
  UNION ALL
  SELECT n + 1, list_transform(w, lambda x: x / sqrt(list_dot_product(w, w)))
  FROM (SELECT n, list_transform(m, lambda r: list_dot_product(r, u)) AS w FROM power, square WHERE n < 5000) q),
top AS (SELECT unnest(dates) AS date, unnest(u) AS u FROM power, square WHERE n = 5000),
scores AS (SELECT s.p, sum(t.u * coalesce(s.z, 0)) AS f FROM scaled s JOIN top t ON s.date = t.date GROUP BY s.p)
SELECT 'part_revenue' AS panel_id, 'P' || lpad(CAST(s.p AS VARCHAR), 12, '0') AS series_id, s.date, s.value IS NULL AS imputed,
  round(CASE WHEN s.value IS NULL THEN t.u * c.f ELSE s.z END, 4) + 0.0 AS z
FROM scaled s JOIN top t ON s.date = t.date JOIN scores c ON s.p = c.p"""
