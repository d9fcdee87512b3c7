"""Benchmark the headline queries.

Runs each query once to warm up, then ``BENCH_REPEAT`` (default 3) times,
executing the full plan into Spark's no-op sink (nothing is collected to
the driver), and prints ONE JSON line with the median seconds per query.

Env: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPEAT``, ``BENCH_QUERIES`` (comma list, optional).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from costmart.catalog import QUERIES  # noqa: E402
from costmart.session import build_session  # noqa: E402

HEADLINE = ["fact_stay_cost", "stay_mart", "cost_reports", "top_k_per_group", "nested_group", "path_two_hop",
            "corr_matrix", "describe_numeric", "knn_impute", "fuzzy_best_match", "lab_price_list",
            "drug_price_list", "company_doc_queries", "company_graph_queries", "fact_cost_event"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        fn = QUERIES[name]
        runs = []
        try:
            for i in range(repeat + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    runs.append(time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the others' numbers
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"# {name}: FAILED {failed[name]}", file=sys.stderr)
            continue
        times[name] = round(statistics.median(runs), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total_median", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
           "repeat": repeat, "spark": spark.version}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
