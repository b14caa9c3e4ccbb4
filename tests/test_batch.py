import os

from pyspark.sql import types as T

from conftest import SF_SMALL

from cartlens.plans import batch
from cartlens.plans.catalog import SEGMENT_THRESHOLDS
from cartlens.sources.files import read_report
from cartlens.sources.tables import behaviour_from_tables, shopping_from_tables


def test_shopping_job_writes_all_reports(spark, scratch):
    out = os.path.join(scratch, "out")
    written = batch.shopping_job(spark, shopping_from_tables(spark, SF_SMALL), out,
                                 thresholds=SEGMENT_THRESHOLDS)
    assert "category_pairs" in written and "views/overview" in written
    seg = spark.read.parquet(f"{out}/customer_segments")
    counts = spark.read.parquet(f"{out}/segment_counts")
    assert seg.count() == sum(r["count"] for r in counts.collect())


def test_value_and_behaviour_jobs(spark, scratch):
    out = os.path.join(scratch, "value")
    batch.value_job(spark, shopping_from_tables(spark, SF_SMALL), out)
    auc = spark.read.parquet(f"{out}/auc").first().value
    assert 0.5 <= auc <= 1.0
    bout = os.path.join(scratch, "behaviour")
    batch.behaviour_job(spark, behaviour_from_tables(spark, SF_SMALL), bout)
    assert spark.read.parquet(f"{bout}/city_segments").count() > 0


def test_materialize_lines_partitioned(spark, scratch):
    path = os.path.join(scratch, "silver")
    lines = batch.materialize_lines(spark, shopping_from_tables(spark, SF_SMALL), path,
                                    partition_by=("year", "month"))
    assert lines.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert spark.table("shopping_data").count() == lines.count()
    months = [d for d in os.listdir(path) if d.startswith("year=")]
    assert months and lines.where("year = 1995 and month = 1").count() > 0


def test_value_job_without_label_column(spark, scratch):
    out = os.path.join(scratch, "value2")
    batch.value_job(spark, shopping_from_tables(spark, SF_SMALL), out,
                    features=["age", "avg_transaction"])
    imp = spark.read.parquet(f"{out}/feature_importance").collect()
    assert sorted(r.feature for r in imp) == ["age", "avg_transaction"]


def test_csv_reports_keep_their_types(spark, scratch):
    out = os.path.join(scratch, "csv")
    batch.shopping_job(spark, shopping_from_tables(spark, SF_SMALL), out,
                       thresholds=SEGMENT_THRESHOLDS, fmt="csv")
    share = read_report(spark, f"{out}/views/segment_share",
                        T._parse_datatype_string("customer_segment string, count long, share_pct double"))
    assert abs(sum(r.share_pct for r in share.collect()) - 100) < 0.5
    seg = read_report(spark, f"{out}/customer_segments",
                      schema=batch.reports.customer_segments(
                          batch.clean.enrich_shopping(shopping_from_tables(spark, SF_SMALL))).schema)
    assert dict(seg.dtypes)["customer_id"] == "string"
