"""Times headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

Each query runs once to warm up and once timed; its result goes to Spark's no-op sink, so nothing is collected.
BENCH_QUERIES, comma-separated, picks others; BENCH_COLD=1 leaves out the warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from loomspan.plans.catalog import QUERIES
from loomspan.session import local_session

HEADLINE = [
    "join01_overlap", "overlap_base_per_feature", "join08_difference", "agg11_coverage", "agg33_window_density", "join09_similar_genes",
    "sel06_greedy_selection", "agg03_chain_sums", "agg04_best_target", "ort03_orthologs", "agg30_group_matrix", "cls02_duplicates",
    "cls11_pair_classes", "agg12_count_by_group", "agg16_medians", "seq01_translate", "join14_read_counts", "join15_joined_exons",
]


def timed(spark, name: str, sf: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [x for x in os.environ.get("BENCH_QUERIES", "").split(",") if x] or HEADLINE
    spark = local_session(cpus, max(8, 2 * int(cpus)) if cpus.isdigit() else 16)
    seconds = {}
    for name in names:
        try:
            if os.environ.get("BENCH_COLD") != "1":
                timed(spark, name, sf)
            seconds[name] = round(timed(spark, name, sf), 3)
            print(name, seconds[name], file=sys.stderr, flush=True)
        except Exception as e:  # one failed query must not hide the others' figures
            print(f"{name}: {str(e)[:300]}", file=sys.stderr)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
