"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is forced with a no-op write (full execution, nothing collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "panel_build",
    "transform_all",
    "data_card",
    "gram_matrix",
    "df_tstat_lag0",
    "contract_violations",
    "ingest_long",
    "em_pca_impute",
    "em_rank1_dealt",
    "em_wide_rank1",
    "published_artifacts",
    "adf_validation",
    "many_panel_impute",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from macropanel.model import BRAND_PARAMS
    from macropanel.plans.catalog import QUERIES, brand
    from macropanel.plans.inputs import wide_panel
    from macropanel.plans.prepare import prepare, write_all
    from macropanel.session import build_session

    spark = build_session(f"local[{cpus}]", int(cpus))
    QUERIES["data_card"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warms the JVM; not timed
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    # the whole preparation: build, clean, transform, impute, card, validation, contracts and all artifact writes,
    # of the 83 x 25 brand panel and of one of the size the reference figure is for (about 840 x 125)
    for name, build in (("end_to_end", brand), ("end_to_end_wide", wide_panel)):
        t0 = time.perf_counter()
        panel, series = build(spark, sf_dir)
        out = tempfile.mkdtemp(prefix="macropanel-bench-")
        write_all(prepare(panel, series, BRAND_PARAMS), out)
        times[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
