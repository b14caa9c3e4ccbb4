"""A run of reports that skips what it cannot make and says so.

Each report is built and written on its own: one whose input lacks a column or
depends on a report that was not written, or that has no rows, is skipped; one
that breaks is marked failed; the others go on. The run's status table has one row per
report, and the run's reports are published together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators import basket, reports, views
from ..session import remove_shared, shared_path
from ..sources.files import read_report, write_report
from ..sources.report_set import ReportSet
from .batch import REPORTS, SMALL, materialize_lines

STATUS = "report string, state string, reason string, rows long"


class Unavailable(ValueError):
    """The input of a report is not there."""


def run_reports(spark: SparkSession, plan: dict[str, Callable[[Callable], DataFrame]], path: str,
                fmt: str = "parquet", small=SMALL) -> DataFrame:
    """Write every report of ``plan`` under ``path`` and return the status rows
    (report, state, reason, rows): "written", "skipped" or "failed".

    ``plan``: name -> function of ``written``, which reads back a report of the same
    run by its name. Rows are counted while a report is written, not by a second
    pass; a report without rows is written (a reader finds its header) and skipped
    by those that depend on it.
    """
    status, schemas, rows = [], {}, {}

    def written(name: str) -> DataFrame:
        if not rows.get(name):
            raise Unavailable(f"{name} has no rows" if name in rows else f"{name} was not written")
        return read_report(spark, f"{path}/{name}", schemas[name], fmt)

    for name, make in plan.items():
        try:
            df, count = make(written), Observation()
            write_report(df.observe(count, F.count(F.lit(1)).alias("n")), f"{path}/{name}", fmt=fmt, single_file=name in small)
            schemas[name], rows[name] = df.schema, count.get["n"]
            status.append((name, "written" if rows[name] else "skipped", None if rows[name] else "no rows", rows[name]))
        except ValueError as missing:      # a column or an input that is not there, by name
            status.append((name, "skipped", str(missing), None))
        except Exception as broken:  # noqa: BLE001 - one report's failure is its own
            status.append((name, "failed", f"{type(broken).__name__}: {str(broken)[:500]}", None))
    return spark.createDataFrame(status, STATUS)


def shopping_plan(lines: DataFrame, thresholds: dict | None = None) -> dict[str, Callable]:
    """The shopping reports and the views built from them, by name."""
    made = {
        "customer_segments": lambda w: reports.customer_segments(lines, **(thresholds or {})),
        "segment_counts": lambda w: reports.segment_counts(w("customer_segments")),
        "age_gender_analysis": lambda w: reports.age_gender(w("customer_segments")),
        "category_analysis": lambda w: reports.category_summary(lines),
        "monthly_category_sales": lambda w: reports.month_category(lines),
        "category_preferences": lambda w: reports.category_preferences(lines),
        "payment_analysis": lambda w: reports.payment_summary(lines),
        "payment_age_analysis": lambda w: reports.payment_by_age(lines),
        "daily_sales_pattern": lambda w: reports.weekday_sales(lines),
        "monthly_sales_pattern": lambda w: reports.month_sales(lines),
        "category_pairs": lambda w: basket.basket_pairs(lines),
    }
    shown = {
        "segment_share": lambda w: views.segment_share(w("customer_segments")),
        "age_spending": lambda w: views.age_spending(w("customer_segments")),
        "pivot_age_gender": lambda w: views.pivot_age_gender(w("age_gender_analysis")),
        "top_categories": lambda w: views.top_categories(w("category_analysis")),
        "category_bubble": lambda w: views.category_bubble(w("category_analysis")),
        "payment_share": lambda w: views.payment_share(w("payment_analysis")),
        "pivot_age_payment": lambda w: views.pivot_age_payment(w("payment_age_analysis")),
        "weekday_pattern": lambda w: views.weekday_pattern(w("daily_sales_pattern")),
        "month_pattern": lambda w: views.month_pattern(w("monthly_sales_pattern")),
        "top_category_gender": lambda w: views.top_category_gender(w("category_preferences")),
    }
    assert set(made) == set(REPORTS)
    return made | {f"views/{name}": make for name, make in shown.items()}


def shopping_run(spark: SparkSession, shopping: DataFrame, root: str, thresholds: dict | None = None,
                 fmt: str = "parquet", keep: int = 2) -> DataFrame:
    """A run over shopping lines, with whichever columns they have: parsed once into a
    silver table, every report on its own, then the status table ``run_status``, and
    all of them published as the current set of ``root``. Returns the status rows. A
    run that is killed leaves the set that was current; a run with a failed report is
    not published either. Versions beyond ``keep`` are removed."""
    found, silver = ReportSet(spark, root), shared_path(spark, "silver", "shopping_lines", unique=True)
    version = found.begin()
    lines = materialize_lines(spark, shopping, silver)
    status = run_reports(spark, shopping_plan(lines, thresholds), version, fmt)
    write_report(status, f"{version}/run_status", fmt=fmt, single_file=True)
    if not any(r["state"] == "failed" for r in status.collect()):  # a row per report
        found.publish(version)
        found.prune(keep)
    remove_shared(spark, silver)
    return status
