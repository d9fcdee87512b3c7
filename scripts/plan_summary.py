"""Print condensed physical plans of the headline queries (AQE off: the static plan).

Usage: python scripts/plan_summary.py [sf_dir] > PLANS.md
Each line keeps the operator and its key arguments; long expressions are cut.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from costmart.catalog import QUERIES  # noqa: E402
from costmart.session import build_session  # noqa: E402

SHOW = ["fact_stay_cost", "top_k_per_group", "nested_group", "lookup_either_column", "modal_value",
        "fuzzy_best_match", "knn_impute", "path_two_hop", "scan_parquet", "fact_cost_event", "stay_mart",
        "cost_reports", "drug_price_list"]
KEEP = re.compile(r"(Exchange|Join|Aggregate|WindowGroupLimit|Window |Scan|Filter|Generate|Union|Sort |TakeOrdered)")


def condense(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/([a-z]+)\.parquet\]", r"\1.parquet", line)
        line = re.sub(r"(PushedFilters: \[[^\]]{0,160})[^\]]*\]", r"\1]", line)
        line = re.sub(r"(ReadSchema: struct<[^>]{0,160})[^>]*>", r"\1>", line)
        out.append(line[:230])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print(f"# Condensed physical plans ({sf_dir}, AQE off, 16 shuffle partitions)\n")
    print("Queries that write small tables on the way show those plans too, in the order in which they ran.\n")
    store = spark._jsparkSession.sharedState().statusStore()
    for name in SHOW:
        before = store.executionsCount()
        df = QUERIES[name](spark, sf_dir)
        plans = [df._jdf.queryExecution().executedPlan().toString()]
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        ran = store.executionsList()
        ran = [e.physicalPlanDescription().split("\n\n")[0] for e in map(ran.apply, range(ran.size())) if e.executionId() >= before]
        print(f"## `{name}`\n\n```text")
        for plan in [*ran[:6], *plans]:
            print("\n".join(condense(plan)[:60]) + "\n")
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
