"""End-to-end panel preparation over every panel of the input at once.

source -> outliers -> tcodes + slice (one exchange by series key) -> reliable
checkpoint (read by imputer, card, validation and contracts) -> EM-PCA (one
small job per iteration) -> card / balanced / validation / report -> contract
checks on every artifact -> writes. The cleaned panel is checkpointed too: it
is both an artifact and the input of the transforms.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macropanel.model import DATE, K, PANEL, SERIES, VALUE, Params, nan_to_null, require_columns
from macropanel.operators import card as C
from macropanel.operators.contracts import check_input, enforce
from macropanel.operators.factors import em_impute
from macropanel.operators.outliers import remove_outliers
from macropanel.operators.stationarity import check_tcodes, transform_all, with_leading_flag
from macropanel.operators.validation import build_validation
from macropanel.session import ensure_checkpoint_dir
from macropanel.sinks import artifacts as W


@dataclass
class Prepared:
    raw: DataFrame  # post-outlier, pre-tcode, all rows
    transformed: DataFrame  # post-tcode, pre-imputation (with ``leading``)
    imputed: DataFrame  # kept series, value + imputed flag
    panel: DataFrame  # kept series, imputed values
    mask: DataFrame
    card: DataFrame
    balanced: DataFrame  # (panel_id, series_id)
    panel_balanced: DataFrame
    mask_balanced: DataFrame
    validation: DataFrame
    report: DataFrame
    summary: DataFrame
    timings: dict


def prepare(panel: DataFrame, series: DataFrame, params: Params = Params()) -> Prepared:
    ensure_checkpoint_dir(panel.sparkSession)
    require_columns(panel, [PANEL, SERIES, DATE, VALUE])
    require_columns(series, [PANEL, SERIES, "pos", "tcode"], "series dimension")
    t0 = time.perf_counter()
    check_tcodes(series)
    panel = nan_to_null(panel)
    check_input(panel)
    raw = remove_outliers(panel, params.outlier_k).checkpoint(eager=True)
    t1 = time.perf_counter()
    transformed = with_leading_flag(transform_all(raw, series, check=False)).checkpoint(eager=True)
    plain = transformed.drop("leading")
    t2 = time.perf_counter()
    # one row per series: card, kept set, EM selection and report counts all derive from it
    counts = C.series_counts(transformed).checkpoint(eager=True)
    em = em_impute(plain, series, params, counts)
    timings = {"clean": t1 - t0, "transform": t2 - t1, **{f"em_{k}": v for k, v in em.timings.items()}}
    card = C.build_data_card(None, series, params.max_missing_frac, counts)
    balanced = C.balanced_series(card, params.balanced_cutoff).checkpoint(eager=True)
    imputed = em.imputed
    out_panel = imputed.select(PANEL, SERIES, DATE, VALUE)
    mask = imputed.select(PANEL, SERIES, DATE, "imputed")
    validation = build_validation(out_panel, card.where("kept").select(*K, "pos"))
    n_bal = balanced.groupBy(PANEL).agg(F.count(F.lit(1)).alias("balanced_n_series"))
    report = (
        em.report.join(n_bal, PANEL, "left")
        .withColumn("balanced_n_series", F.coalesce("balanced_n_series", F.lit(0)).cast("int"))
        .withColumn("pipeline_version", F.lit(params.pipeline_version))
        .withColumn("balanced_cutoff_date", F.lit(params.balanced_cutoff.isoformat()))
    )
    summary = W.run_summary(em.report, balanced, None, series, params.pipeline_version, counts)
    return Prepared(
        raw=raw,
        transformed=transformed,
        imputed=imputed,
        panel=out_panel,
        mask=mask,
        card=card,
        balanced=balanced,
        panel_balanced=C.balanced_projection(out_panel, balanced),
        mask_balanced=C.balanced_projection(mask, balanced),
        validation=validation,
        report=report,
        summary=summary,
        timings=timings,
    )


#: The contract that each artifact is held against (the validation frame has none).
CONTRACT_OF = {
    "raw": "raw",
    "transformed": "imputed",
    "mask": "mask",
    "data_card": "data_card",
    "transformed_balanced": "imputed",
    "mask_balanced": "mask",
}


def write_all(p: Prepared, out_dir: str, now: datetime | None = None) -> DataFrame:
    """Check every frame that is about to be written (raise listing all failures), then write; return the manifest.

    The balanced artifacts are written only when at least one series
    qualifies. ``now`` names the partition of the run: pass the same for a
    retry, and the retry replaces what the first attempt wrote.
    """
    year, month, stamp = W.run_stamp(now)
    out = out_dir.rstrip("/")
    parquet = {"raw": p.raw, "transformed": p.panel, "mask": p.mask, "data_card": p.card, "validation": p.validation}
    if not p.balanced.isEmpty():
        parquet.update({"transformed_balanced": p.panel_balanced, "mask_balanced": p.mask_balanced})
    enforce({name: df for name, df in parquet.items() if name in CONTRACT_OF}, CONTRACT_OF)
    jobs = [(W.write_parquet, df, f"{out}/{name}") for name, df in parquet.items()]
    jobs.append((W.write_json, p.report, f"{out}/imputation"))
    jobs.append((W.write_json, p.summary, f"{out}/summary"))
    # independent writes run as concurrent Spark jobs from driver threads
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(fn, df, path, year, month) for fn, df, path in jobs]:
            f.result()
    spark = p.raw.sparkSession
    panels = p.report.select(F.col(PANEL).alias("_panel"))
    this_run = (F.col("year") == F.lit(year)) & (F.col("month") == F.lit(month))

    def mine(df: DataFrame) -> DataFrame:
        return df.where(this_run).join(panels, F.col(PANEL) == F.col("_panel"), "left_semi").drop("year", "month")

    man = reduce(DataFrame.unionByName, [W.manifest(name, mine(spark.read.parquet(f"{out}/{name}")), stamp, stamp) for name in parquet])
    W.write_parquet(man, f"{out}/manifest", year, month)
    return spark.read.parquet(f"{out}/manifest").where(this_run).join(panels, F.col(PANEL) == F.col("_panel"), "left_semi")
