"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the cores. Every query is run
three times to the no-op sink; the best run counts and the median is printed next to it.
Queries that fit a model or drain a stream do their work when called, so the call is timed as well;
those run once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from recordflow.plans.queries import QUERIES
from recordflow.session import local_session

REPEATED = """
route_messages extract_payload dead_letter_rows conform_ignore conform_reject typed_projection_strict
replay_offset scan_range sql_scan hash_features regression_features anomaly_features scale_params
days_to_close restricted_fields batch_infer
""".split()
ONCE = "batch_append stream_ingest row_id encode_pca regress_score cluster_fit".split()


def timed(spark, query, sf_dir):
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(
        cpus, **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    best, median = {}, {}
    for name in [*REPEATED, *ONCE]:
        if only and name not in only:
            continue
        runs = [timed(spark, QUERIES[name], sf_dir) for _ in range(3 if name in REPEATED else 1)]
        best[name], median[name] = round(min(runs), 3), round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total_best_seconds",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "median": median,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
