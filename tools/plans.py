"""Write PLANS.md: operator trees of headline queries as planned at scale.

Auto-broadcast is off (no dimension fits in memory at 100 TB) and AQE is off
so the static plan shows; on a cluster AQE then coalesces partitions, splits
skewed join partitions and may still turn a small runtime side into a
broadcast.

usage: python tools/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from cartlens.plans import catalog  # noqa: E402
from cartlens.session import local_session  # noqa: E402

NOTES = {
    "customer_stats": "Lines are shuffled by part key, then by order key. Customers are joined to "
                      "orders at order granularity. The customer aggregate is partial before its "
                      "shuffle.",
    "category_summary": "Only lineitem and part are read, three line columns. One join shuffle, "
                        "then a partial aggregate.",
    "basket_pairs": "Lines are reduced to (invoice, category, n) with a partial aggregate, and that "
                    "exchange is reused for both sides of the self-join. The final pair aggregate is "
                    "also partial.",
    "customer_features": "Customer metrics are checkpointed (a LogicalRDD), so the rounds of bucket "
                         "counts behind the median and the label all read the customer table, never "
                         "the lines. The single-partition windows cover bucket counts (at most 1024 "
                         "rows) and the last bucket's distinct values.",
    "city_segments": "Lines are pre-aggregated per order before the orders join, and orders per "
                     "customer before the customer join. The global latest order date is a scalar "
                     "subquery. The 25-row nation table is broadcast explicitly.",
    "segment_share": "The share total is a window over the segment counts (one row per segment).",
    "top_category_trend": "One scan of the lines: the report of (month, category), undated lines "
                          "included, ranks its own categories with windows over report rows.",
    "overview": "One scan and one line-level shuffle: grouping sets (Expand) by customer, category, "
                "payment method and month, then one row per panel label.",
}
# Queries that train a model or write files when built.
SKIP = {"value_predictions", "value_auc", "feature_importance", "ingest_roundtrip",
        "ingest_late_files", "ingest_reordered", "ingest_rejects", "report_roundtrip", "report_inventory",
        "shopping_csv", "shopping_csv_reordered", "behaviour_csv"}
KEEP = ("Exchange", "Join", "Aggregate", "Scan", "Window", "Subquery", "TakeOrdered", "Broadcast",
        "LogicalRDD", "Filter", "Sort ", "Project", "Expand", "Generate", "Union")


def tree(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.split("\n"):
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]|\[id=#\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/(\w+\.parquet)\]", r"\1", line)
        line = re.sub(r"(Filter|Project) \[.{80,}", lambda m: m.group(0)[:110] + " ...", line)
        out.append(line[:170])
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    q = catalog.queries()
    print("# Physical plans at scale settings\n")
    print("Generated by `tools/plans.py`. Auto-broadcast is off and AQE is off, so each tree is the "
          "static plan a 100 TB run starts from. "
          "Expression ids are stripped.\n")
    for name, note in NOTES.items():
        print(f"## {name}\n\n{note}\n\n```\n{tree(q[name](spark, sf))}\n```\n")
    print("## Shuffle budget of every registered query\n")
    print("Exchanges in the static plan, subquery plans included. Hash and range exchanges shuffle. "
          "Single-partition exchanges gather a one-row aggregate, a report's few rows or the median's "
          "bucket. Broadcasts carry only bounded frames. Inputs materialised by a checkpoint "
          "(customer metrics, pivot and bubble inputs) were computed before this plan, so their "
          "exchanges are not counted here.\n")
    print("| query | hash | range | single | broadcast | reused |")
    print("|---|---|---|---|---|---|")
    for name in sorted(q):
        if name in SKIP:
            continue
        plan = q[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(p, plan)) for p in (
            r"Exchange hashpartitioning", r"Exchange rangepartitioning", r"Exchange SinglePartition",
            r"BroadcastExchange", r"ReusedExchange")]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")


if __name__ == "__main__":
    main()
