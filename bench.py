"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

A warm-up and up to three warm runs each; a query that has taken 12 seconds in all gets no further run.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from spliceloom.plans.catalog import QUERIES
from spliceloom.session import local_session

HEADLINE = ["include_5prime", "chain_collapse", "inter_merge", "cs_variants", "locus_ids", "mono_in_mono", "tx_join_include", "pbcount_matrix", "existence_matrix", "sv_match_internal", "variant_exact", "mapq_all_pass"]


def main(runs: int = 3) -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "8g")
    took = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
            if len(times) > 1 and sum(times) > 12:
                break
        took[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({"metric": "headline queries, sum of medians of warm runs", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf, "cpus": cpus, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions")}))


if __name__ == "__main__":
    main()
