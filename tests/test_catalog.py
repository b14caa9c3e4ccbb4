"""Every registered query runs on the smallest tables; oracle SQL agrees."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from cartlens.plans import catalog, oracle
from conftest import SF_SMALL

FAST_ORACLE = ["customer_segments", "segment_counts", "age_gender", "category_summary",
               "basket_pairs", "customer_features", "membership_segments", "payment_share",
               "monetary_histogram", "pivot_age_payment", "enrich_dates", "overview", "top_category_trend",
               "exact_price", "median_monetary", "score_auc", "split_counts", "value_test_keys",
               "sorted_positions", "shopping_csv_reordered", "profile_schema", "value_predictions", "value_auc",
               "feature_importance", "spend_regression", "spend_errors", "top_category_gender_wide", "payment_top5_share_wide"]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_segment", "count"]
    assert sum(r["count"] for r in df.collect()) == 150


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    model = {"value_predictions", "value_auc", "feature_importance", "spend_regression", "spend_errors"}  # with a session, whose shared folder they read
    assert set(catalog.queries()) - set(oracle.oracle_sql()) in (set(), model)


def _norm(rows):
    def n(v):
        if v is pd.NA or isinstance(v, float) and math.isnan(v):
            return None
        return str(v)[:19] if hasattr(v, "isoformat") else v
    return sorted((tuple(n(x) for x in r) for r in rows), key=lambda r: tuple(str(x) for x in r))


@pytest.mark.parametrize("name", FAST_ORACLE)
def test_matches_oracle_small(spark, name):
    con = duckdb.connect()
    for t in ["nation", "customer", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    ours = _norm(sdf.select(*[f"`{c}`" for c in cols]).collect())
    odf = con.execute(E.oracle_sql()[name]).df()
    if name.startswith("pivot"):
        odf = odf[[c for c in odf.columns if c in sdf.columns or c in ("age_group", "band_order")]]
        odf = odf.dropna(axis=1, how="all")
        cols = sorted(odf.columns)
        ours = _norm(sdf.select(*[f"`{c}`" for c in cols]).collect())
    assert sorted(odf.columns) == cols
    theirs = _norm(odf[cols].itertuples(index=False))
    assert ours == theirs


@pytest.mark.parametrize("name", ["enrich_dates", "customer_segments", "monetary_histogram"])
def test_matches_oracle_small_without_ansi(spark, name):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        test_matches_oracle_small(spark, name)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_planted_faults_reach_the_queries(spark):
    """Invalid dates, nulls and dropped rows exist in the adapted tables."""
    q = catalog.queries()
    dates = q["enrich_dates"](spark, SF_SMALL)
    assert dates.where("NOT valid_date").count() > 0 and dates.where("valid_date").count() > 0
    nulls = {r.column_name: r.null_count for r in q["profile_nulls"](spark, SF_SMALL).collect()}
    assert nulls["invoice_no"] > 0 and nulls["quantity"] > 0 and nulls["price"] > 0
    assert q["clean_drop"](spark, SF_SMALL).count() < 150
    assert q["monetary_histogram"](spark, SF_SMALL).count() == 30
