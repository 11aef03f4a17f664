"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to the end without a sink, after one warm-up query, so the figures include planning
and every row, but no transfer of results to Python.
"""

from __future__ import annotations

import json
import os
import sys
import time

from faultline.session import local_session
from faultline.testbed.queries import QUERIES

HEADLINE = [
    "mart_panel_year",
    "mart_product_year",
    "mart_firm_product_year",
    "all_marts",
    "version_rank",
    "keep_first_dedup",
    "clean_adverse_events",
    "clean_recalls",
    "clean_clearances",
    "build_dim_product",
    "lookup_fill",
    "membership_flag",
    "normalize_company_name",
    "denoise_description",
    "mixed_dates",
    "export_category_topn",
    "export_manufacturer_topn",
    "methodology_metrics",
    "value_distribution",
    "qa_uniqueness",
    "qa_volume_shift",
    "pareto_products",
    "firm_concentration",
    "partition_pruning",
    "token_sort",
    "token_set",
    "manufacturer_alias",
    "fuzzy_recall_mapping",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, "faultline-bench")
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("clearances_by_product_year")
    seconds = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
