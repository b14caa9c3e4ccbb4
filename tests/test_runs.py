"""Runs that skip and say so; report sets that appear at once."""

import os

import pytest
from pyspark.sql import functions as F

from cartlens.operators import clean, reports
from cartlens.plans import runs
from cartlens.plans.catalog import SEGMENT_THRESHOLDS
from cartlens.sources.files import write_report
from cartlens.sources.report_set import ReportSet
from cartlens.sources.tables import shopping_from_tables
from conftest import SF_SMALL


def states(status):
    return {r.report: r.state for r in status.collect()}


def test_a_missing_column_skips_its_reports_alone(spark, scratch):
    shopping = shopping_from_tables(spark, SF_SMALL).drop("payment_method")
    status = runs.shopping_run(spark, shopping, f"{scratch}/out", SEGMENT_THRESHOLDS)
    by = {r.report: r for r in status.collect()}
    skipped = {name for name, r in by.items() if r.state == "skipped"}
    assert skipped == {"payment_analysis", "payment_age_analysis", "views/payment_share", "views/pivot_age_payment"}
    assert "payment_method" in by["payment_analysis"].reason and "payment_analysis" in by["views/payment_share"].reason
    assert all(r.state == "written" and r.rows > 0 for name, r in by.items() if name not in skipped)
    found = ReportSet(spark, f"{scratch}/out")
    lines = clean.enrich_shopping(shopping)
    want = reports.category_summary(lines)
    assert found.read("category_analysis", want.schema, "parquet").exceptAll(want).count() == 0
    back = found.read("run_status", status.schema, "parquet").collect()
    assert {tuple(r) for r in back} == {tuple(r) for r in status.collect()}


def test_empty_input_and_a_broken_report(spark, scratch):
    shopping = shopping_from_tables(spark, SF_SMALL).where(F.lit(False))
    found = states(runs.shopping_run(spark, shopping, f"{scratch}/out"))
    assert set(found.values()) == {"skipped"}
    one = spark.createDataFrame([(1,)], "a int")
    status = runs.run_reports(spark, {"bad": lambda w: one.select(F.raise_error(F.lit("broken")).alias("x")),
                                      "after": lambda w: w("bad"), "good": lambda w: one}, f"{scratch}/three")
    by = {r.report: r for r in status.collect()}
    assert (by["bad"].state, by["after"].state, by["good"].state, by["good"].rows) == ("failed", "skipped", "written", 1)
    assert "broken" in by["bad"].reason and by["after"].reason == "bad was not written"


def test_a_set_appears_at_once_and_a_killed_run_leaves_the_old_one(spark, scratch):
    found = ReportSet(spark, f"{scratch}/set")
    assert found.current() is None
    with pytest.raises(ValueError, match="no report set"):
        found.read("a", spark.range(1).schema)
    for k in (1, 2):
        version = found.begin()
        for name in ("a", "b"):
            write_report(spark.range(k), f"{version}/{name}")
            # half-way: readers still see the version before
            assert (found.current() is None) if k == 1 else found.read("a", spark.range(1).schema).count() == 1
        found.publish(version)
        assert {found.read(name, spark.range(1).schema).count() for name in ("a", "b")} == {k}
    killed = found.begin()
    write_report(spark.range(9), f"{killed}/a")          # ... and the run is gone
    assert found.read("a", spark.range(1).schema).count() == 2
    assert len(found.versions()) == 3
    with pytest.raises(ValueError, match="nothing was written"):
        found.publish(found.begin())
    oldest = found.versions()[0]
    assert found.prune(keep=1) == [oldest]               # neither the current one nor the newest
    assert found.read("b", spark.range(1).schema).count() == 2
    assert not [f for f in os.listdir(f"{scratch}/set") if f.startswith(".current-") and not f.endswith(".crc")]


def test_a_failed_report_is_not_published(spark, scratch, monkeypatch):
    shopping = shopping_from_tables(spark, SF_SMALL, ["invoice_no", "category", "quantity", "price"])
    only = {"category_analysis": lambda lines: lambda w: reports.category_summary(lines)}
    monkeypatch.setattr(runs, "shopping_plan", lambda lines, t: {n: f(lines) for n, f in only.items()})
    runs.shopping_run(spark, shopping, f"{scratch}/out")
    first = ReportSet(spark, f"{scratch}/out").current()
    monkeypatch.setattr(runs, "shopping_plan", lambda lines, t: {"bad": lambda w: lines.select(F.raise_error(F.lit("no")).alias("x"))})
    assert states(runs.shopping_run(spark, shopping, f"{scratch}/out")) == {"bad": "failed"}
    assert ReportSet(spark, f"{scratch}/out").current() == first
