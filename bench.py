"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, and BENCH_QUERIES
(comma separated) replaces the list of queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from varspark.plans.queries import all_queries
from varspark.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = [
    "q_pair_tumour_normal",
    "q_expected_grid",
    "q_assign_interval",
    "q_exclude_regions",
    "q_pileup_summaries",
    "q_allele_counts",
    "q_normal_candidates",
    "q_gather_calls",
    "q_consolidate_cohort",
    "q_create_pon",
    "q_extend_pon",
    "q_call_pairs",
    "q_merge_stats",
    "q_learn_orientation",
    "q_contamination",
    "q_maf_segments",
    "q_filter_summary",
    "q_task_metrics",
    "q_rerun_set",
]


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINES
    queries["q_classify_samples"](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # not timed
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
