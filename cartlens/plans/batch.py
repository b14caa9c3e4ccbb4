"""Batch jobs: the three report runs as Spark applications.

``shopping_job``  enriches the shopping lines once, writes them as a Parquet
                  table to the shared folder,
                  then builds every report and view from that table. The
                  table cuts the lineage: a lost executor re-reads files
                  instead of recomputing the parse, and each report prunes
                  its own columns from it.
``value_job``     customer features, median label, forest, AUC, importances.
``behaviour_job`` membership/city segments and the at-risk list.

Reports are written as CSV (header) or Parquet directories; ``single_file``
applies only to reports whose rows are bounded by a fixed domain.

usage: python -m cartlens.plans.batch shopping|value|behaviour INPUT OUTPUT
       [--landed SOURCE_NAME] [--format csv|parquet]
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import basket, clean, reports, value, views
from ..session import checkpointed, remove_shared, shared_path
from ..schemas import BEHAVIOUR_RAW, SHOPPING
from ..sources.files import (read_behaviour, read_report, read_shopping, snake_case_behaviour,
                             write_report)
from ..streaming.ingest import read_landed

# The report folders that existing readers open.
REPORTS = ("customer_segments", "segment_counts", "age_gender_analysis", "category_analysis",
           "monthly_category_sales", "category_preferences", "payment_analysis", "payment_age_analysis",
           "daily_sales_pattern", "monthly_sales_pattern", "category_pairs")
# Reports whose rows are bounded by fixed domains (segments, bands, months,
# weekdays): written as one file. The others grow with the data's categories,
# genders, payment methods or customers and keep their parts.
SMALL = {"segment_counts", "daily_sales_pattern", "monthly_sales_pattern"}


def materialize_lines(spark: SparkSession, shopping: DataFrame, path: str | None = None,
                      partition_by=None) -> DataFrame:
    """Write enriched lines to ``path`` (default: a new folder under the
    shared checkpoint dir), register them as ``shopping_data`` and return the
    table read back.

    Written flat by default: one file per task, no shuffle. With
    ``partition_by`` (e.g. ``("year", "month")``, for time-pruned readers) the
    rows are first range-partitioned on those columns plus the invoice, so
    each task holds a contiguous key range and writes one or two folders
    instead of one file per folder per task; the invoice key spreads a hot
    month over many tasks.
    """
    path = path or shared_path(spark, "silver", "shopping_lines", unique=True)
    lines = clean.enrich_shopping(shopping)
    writer = lines.write.mode("overwrite")
    if partition_by:
        lines = lines.repartitionByRange(*partition_by, "invoice_no")
        writer = lines.write.mode("overwrite").partitionBy(*partition_by)
    writer.parquet(path)
    table = spark.read.schema(lines.schema).parquet(path)
    table.createOrReplaceTempView("shopping_data")
    return table


def shopping_reports(lines: DataFrame, thresholds: dict | None = None,
                     with_basket: bool = True) -> dict[str, DataFrame]:
    """The reports that read the lines; ``segment_reports`` are made from the
    first of them."""
    frames = (reports.customer_segments(lines, **(thresholds or {})), None, None,
              reports.category_summary(lines), reports.month_category(lines),
              reports.category_preferences(lines), reports.payment_summary(lines),
              reports.payment_by_age(lines), reports.weekday_sales(lines), reports.month_sales(lines),
              basket.basket_pairs(lines) if with_basket else None)
    return {name: df for name, df in zip(REPORTS, frames) if df is not None}


def segment_reports(segments: DataFrame) -> dict[str, DataFrame]:
    return {REPORTS[1]: reports.segment_counts(segments), REPORTS[2]: reports.age_gender(segments)}


def report_views(spark: SparkSession, out_dir: str, schemas: dict, lines: DataFrame,
                 fmt: str = "parquet") -> dict[str, DataFrame]:
    """Views built from the written reports. ``schemas``: name -> schema, as
    written. Only the trend's undated rows come from the lines."""
    r = {name: read_report(spark, f"{out_dir}/{name}", schemas[name], fmt) for name in REPORTS[:10]}
    cats = r["category_analysis"]
    return {
        "segment_share": views.segment_share(r["customer_segments"]),
        "age_spending": views.age_spending(r["customer_segments"]),
        "pivot_age_gender": views.pivot_age_gender(r["age_gender_analysis"]),
        "top_categories": views.top_categories(cats),
        "top_category_trend": views.top_category_trend(reports.month_category(lines, undated=True)),
        "category_bubble": views.category_bubble(cats),
        "payment_share": views.payment_share(r["payment_analysis"]),
        "pivot_age_payment": views.pivot_age_payment(r["payment_age_analysis"]),
        "weekday_pattern": views.weekday_pattern(r["daily_sales_pattern"]),
        "month_pattern": views.month_pattern(r["monthly_sales_pattern"]),
        "top_category_gender": views.top_category_gender(r["category_preferences"]),
        "overview": views.overview(r["customer_segments"], cats, r["payment_analysis"],
                                   r["monthly_sales_pattern"]),
    }


def shopping_job(spark: SparkSession, shopping: DataFrame, out_dir: str,
                 thresholds: dict | None = None, fmt: str = "parquet",
                 views_dir: str | None = None, silver_partition_by=None, silver_path: str | None = None) -> list[str]:
    """Parse and enrich once into the silver table, then every report and view.
    A silver table without a ``silver_path`` of the caller's is removed at the end."""
    path = silver_path or shared_path(spark, "silver", "shopping_lines", unique=True)
    lines = materialize_lines(spark, shopping, path, partition_by=silver_partition_by)
    written, schemas = [], {}

    def write(name, df):
        write_report(df, f"{out_dir}/{name}", fmt=fmt, single_file=name in SMALL)
        written.append(name)
        schemas[name] = df.schema

    for name, df in shopping_reports(lines, thresholds).items():
        write(name, df)
    segments = read_report(spark, f"{out_dir}/{REPORTS[0]}", schemas[REPORTS[0]], fmt)
    for name, df in segment_reports(segments).items():
        write(name, df)
    for name, df in report_views(spark, out_dir, schemas, lines, fmt).items():
        write_report(df, f"{views_dir or out_dir + '/views'}/{name}", fmt=fmt)
        written.append(f"views/{name}")
    if silver_path is None:
        remove_shared(spark, path)
    return written


def value_job(spark: SparkSession, shopping: DataFrame, out_dir: str, rel_error: float = 0.001,
              fmt: str = "parquet", features=value.FEATURES) -> dict:
    """Value model run; the input is parsed once, into a silver table that is
    removed at the end. ``features`` defaults to the source's four columns; note
    that ``monetary`` also defines the label, so leave it out to measure how
    well the other columns predict it."""
    prepared = value.prepare_lines(shopping)
    silver = shared_path(spark, "silver", "value_lines", unique=True)
    prepared.write.parquet(silver)
    lines = spark.read.schema(prepared.schema).parquet(silver)
    for key in ("gender", "age_group", "payment_method"):
        write_report(reports.consumption_by(lines, key), f"{out_dir}/consumption_{key}", fmt=fmt)
    metrics = checkpointed(value.customer_metrics(lines))
    customers = value.features_of(metrics, rel_error=rel_error)
    write_report(customers, f"{out_dir}/customer_features", fmt=fmt)
    labelled = read_report(spark, f"{out_dir}/customer_features", customers.schema, fmt)
    vectors = checkpointed(value.value_features(labelled, features))
    write_report(value.split_counts(vectors), f"{out_dir}/split_counts", fmt=fmt, single_file=True)
    train, test = value.split_customers(vectors)
    model = value.value_model(train)
    preds = value.value_predictions(model, test)
    write_report(value.value_auc(preds), f"{out_dir}/auc", fmt=fmt, single_file=True)
    write_report(value.feature_importance(model, features), f"{out_dir}/feature_importance",
                 fmt=fmt, single_file=True)
    for name, df in (("value_counts", views.value_counts(labelled)),
                     ("gender_value_mix", views.gender_value_mix(labelled)),
                     ("monetary_histogram", views.monetary_histogram(labelled))):
        write_report(df, f"{out_dir}/{name}", fmt=fmt)
    remove_shared(spark, silver)
    return {"model": model}


def behaviour_job(spark: SparkSession, behaviour: DataFrame, out_dir: str, fmt: str = "parquet"):
    """The three sheet reports; the sheet is parsed once."""
    path = shared_path(spark, "silver", "behaviour", unique=True)
    behaviour.write.parquet(path)
    behaviour = spark.read.schema(behaviour.schema).parquet(path)
    for name, df in (("membership_segments", reports.membership_segments(behaviour)),
                     ("city_segments", reports.city_segments(behaviour)),
                     ("at_risk_customers", reports.at_risk_customers(behaviour))):
        write_report(df, f"{out_dir}/{name}", fmt=fmt)
    remove_shared(spark, path)


def main(argv=None):
    import argparse

    ap = argparse.ArgumentParser(description="report jobs")
    ap.add_argument("job", choices=["shopping", "value", "behaviour"])
    ap.add_argument("input", help="CSV file/folder, or a bronze folder with --landed")
    ap.add_argument("output")
    ap.add_argument("--landed", metavar="SOURCE_NAME",
                    help="read this landed source from the bronze folder instead of CSV")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"],
                    help="report format (default csv with header, as the source writes)")
    ap.add_argument("--silver-by-month", action="store_true",
                    help="lay the silver table out by year/month folders")
    ap.add_argument("--high-value", type=float, default=reports.HIGH_VALUE)
    ap.add_argument("--frequent", type=int, default=reports.FREQUENT)
    ap.add_argument("--high-ticket", type=float, default=reports.HIGH_TICKET)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"cartlens-{args.job}").getOrCreate()
    thresholds = dict(high_value=args.high_value, frequent=args.frequent,
                      high_ticket=args.high_ticket)
    if args.job == "behaviour":
        src = (snake_case_behaviour(read_landed(spark, args.input, BEHAVIOUR_RAW, args.landed))
               if args.landed else read_behaviour(spark, args.input))
        behaviour_job(spark, src, args.output, fmt=args.format)
        return
    src = (read_landed(spark, args.input, SHOPPING, args.landed) if args.landed
           else read_shopping(spark, args.input))
    if args.job == "shopping":
        shopping_job(spark, src, args.output, thresholds=thresholds, fmt=args.format,
                     silver_partition_by=("year", "month") if args.silver_by_month else None)
    else:
        value_job(spark, src, args.output, fmt=args.format)


if __name__ == "__main__":
    main()
