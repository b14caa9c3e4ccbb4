"""Physical-plan properties of the registered queries (the scale contract)."""

import re

import pytest

from cartlens.plans import catalog
from conftest import SF_SMALL

# Queries whose construction trains a model or writes files are covered elsewhere.
SIDE_EFFECTS = {"value_predictions", "value_auc", "feature_importance", "ingest_roundtrip",
                "ingest_late_files", "ingest_reordered", "ingest_rejects", "report_roundtrip", "report_inventory",
                "shopping_csv", "shopping_csv_reordered", "behaviour_csv", "ingest_wide",
                "ingest_layouts", "ingest_ledger", "run_status", "report_set",
                "spend_regression", "spend_errors"}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_auto_broadcast(spark):
    """Plan as at scale: no dimension fits a broadcast, AQE off so the static plan shows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SIDE_EFFECTS))
def test_no_pairs_no_python(spark, no_auto_broadcast, name):
    plan = plan_text(catalog.queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name}: {bad}"
    # Only bounded frames are broadcast when no table fits the threshold: top-k
    # lists, and the 25-row nation table.
    for m in re.finditer(r"BroadcastExchange", plan):
        tail = plan[m.end():m.end() + 600]
        child = tail.split("Exchange")[0]   # the broadcast side, up to the next exchange
        assert ("TakeOrderedAndProject" in tail or "Limit" in tail
                or "nation.parquet" in child), f"{name}: unbounded broadcast"


def test_category_report_reads_only_lines_and_parts(spark):
    plan = plan_text(catalog.queries()["category_summary"](spark, SF_SMALL))
    assert "lineitem.parquet" in plan and "part.parquet" in plan
    assert "customer.parquet" not in plan and "orders.parquet" not in plan
    line_schema = re.search(r"lineitem\.parquet.*?ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in line_schema.split(",")} <= {
        "l_orderkey", "l_partkey", "l_quantity", "l_linenumber"}


def test_aggregates_are_partial_before_shuffle(spark, no_auto_broadcast):
    plan = plan_text(catalog.queries()["customer_stats"](spark, SF_SMALL))
    assert "partial_sum" in plan and "partial_count" in plan
    # lines are shuffled by part key and order key only; customers join orders first
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)
    keys = [re.sub(r"#\d+L?", "", k) for k in keys]
    assert "l_partkey" in keys and "l_orderkey" in keys and "o_custkey" in keys
    assert keys.count("l_orderkey") == 1


def test_basket_pre_aggregates_and_reuses_exchange(spark, no_auto_broadcast):
    plan = plan_text(catalog.queries()["basket_pairs"](spark, SF_SMALL))
    assert "ReusedExchange" in plan
    assert re.search(r"HashAggregate\(keys=\[invoice_no#\d+, category#\d+\]", plan)


def scans(plan, table):
    """Scans of a table that run: a reused exchange repeats no scan."""
    return len(re.findall(rf"FileScan parquet [^\n]*{table}\.parquet", plan))


@pytest.mark.parametrize("name", ["overview", "top_category_trend", "top_category_gender", "profile_table"])
def test_one_pass_over_the_lines(spark, no_auto_broadcast, name):
    plan = plan_text(catalog.queries()[name](spark, SF_SMALL))
    assert scans(plan, "lineitem") == 1, plan


def test_bronze_is_pruned_by_ingest_date(spark, scratch):
    import os

    from cartlens.schemas import SHOPPING
    from cartlens.streaming.ingest import read_landed, run_ingest
    os.makedirs(f"{scratch}/spool")
    with open(f"{scratch}/spool/a.csv", "w") as f:
        f.write(",".join(SHOPPING.fieldNames()) + "\ni1,c1,F,30,A,2,5.5,Cash,1/2/2022\n")
    run_ingest(spark, f"{scratch}/spool", f"{scratch}/bronze", f"{scratch}/ckpt")
    rows = read_landed(spark, f"{scratch}/bronze", SHOPPING, ingest_from="2020-01-01", ingest_to="2999-01-01")
    assert re.search(r"PartitionFilters: \[[^\]]*ingest_date", plan_text(rows)) and rows.count() == 1
    assert read_landed(spark, f"{scratch}/bronze", SHOPPING, ingest_to="2020-01-01").count() == 0


def test_top_k_over_a_wide_domain_orders_no_task_whole(spark, no_auto_broadcast):
    for name in ("top_categories_wide", "top_category_gender_wide", "top_category_trend"):
        plan = plan_text(catalog.queries()[name](spark, SF_SMALL))
        assert "TakeOrderedAndProject" in plan and "Window" not in plan and scans(plan, "lineitem") == 1
