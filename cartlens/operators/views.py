"""Presentation views over reports: shares, flags, top-k, pivots, histograms.

Inputs are small aggregated reports (one row per key of a bounded domain:
segments, payment methods, categories). A share's total is a window over
those report rows, so the report is computed once and the window sees one
row per key, never the data behind it. Top-k lists are
``orderBy(..).limit(k)`` (a bounded TakeOrderedAndProject), and only those
k-row lists are broadcast. A view that needs two passes over its input
(pivot value discovery, histogram bounds) expects a materialised input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.bands import band_order
from ..functions.dates import month_name, weekday_name
from ..functions.money import as_money, mean, share_pct, total
from .reports import require

# Label text of the value classes.
VALUE_LABELS = {1: "High value customer", 0: "General customer"}


def _report():
    """All rows of an aggregated report (one row per report key)."""
    return Window.partitionBy()


def _top(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(measure), F.asc(key)).limit(n)


def segment_share(segments: DataFrame) -> DataFrame:
    """(customer_segment, count, share_pct)."""
    require(segments, "customer_segment")
    counts = segments.groupBy("customer_segment").count()
    whole = F.sum("count").over(_report())
    return (counts.select("customer_segment", "count", share_pct("count", whole).alias("share_pct"))
            .orderBy(F.desc("count"), "customer_segment"))


def age_spending(segments: DataFrame) -> DataFrame:
    """Mean customer total per age band, in band order: (age_group, band_order, avg_total_spent)."""
    require(segments, "age_group", "total_spent")
    return (segments.groupBy("age_group")
            .agg(mean(as_money("total_spent")).alias("avg_total_spent"))
            .select("age_group", band_order("age_group").alias("band_order"), "avg_total_spent")
            .orderBy("band_order"))


def payment_share(payments: DataFrame) -> DataFrame:
    """(payment_method, transaction_count, share_pct, is_largest); the largest
    is the first by count, ties broken by method."""
    require(payments, "payment_method", "transaction_count")
    whole = F.sum("transaction_count").over(_report())
    rank = F.row_number().over(_report().orderBy(F.desc("transaction_count"), F.asc("payment_method")))
    return (payments.select("payment_method", "transaction_count",
                            share_pct("transaction_count", whole).alias("share_pct"),
                            (rank == 1).alias("is_largest"))
            .orderBy(F.desc("transaction_count"), "payment_method"))


def top_categories(categories: DataFrame, n: int = 10) -> DataFrame:
    require(categories, "category", "total_revenue")
    return _top(categories, "total_revenue", "category", n).select("category", "total_revenue")


def _top_keys(categories: DataFrame, n: int) -> DataFrame:
    return F.broadcast(_top(categories, "total_revenue", "category", n).select("category"))


def _top_by_rollup(report: DataFrame, measure: str, n: int) -> DataFrame:
    """Rows of the ``n`` categories with the greatest sum of ``measure``, ties by
    name. The finer report serves as its own category total: its rows (a few per
    category) are gathered beside the total, and whole categories go through a heap
    of ``n`` per task, then one of them all. The lines are read once, and no task
    orders all categories, however many."""
    rest = [c for c in report.columns if c != "category"]
    whole = (report.where(F.col("category").isNotNull()).groupBy("category")
             .agg(F.sum(as_money(measure)).alias("__total"), F.collect_list(F.struct(*rest)).alias("__rows")))
    top = whole.orderBy(F.desc("__total"), F.asc("category")).limit(n)
    return top.select("category", F.explode("__rows").alias("__row")).select("category", "__row.*")


def top_category_trend(monthly: DataFrame, n: int = 5) -> DataFrame:
    """Monthly revenue series of the top-``n`` categories by revenue. ``monthly``
    is ``reports.month_category(.., undated=True)``: rows without a month count
    towards the ranking and are not part of the series."""
    require(monthly, "month", "category", "monthly_revenue")
    return (_top_by_rollup(monthly, "monthly_revenue", n).where(F.col("month").isNotNull())
            .select("month", "category", "monthly_revenue")
            .orderBy("category", "month"))


def top_category_gender(preferences: DataFrame, n: int = 5, genders=None) -> DataFrame:
    """Spend of the top-``n`` categories pivoted by gender; absent cells are 0.
    Without ``genders`` the values are found by a job of their own."""
    require(preferences, "category", "gender", "total_spent")
    grouped = _top_by_rollup(preferences, "total_spent", n).groupBy("category")
    pivoted = grouped.pivot("gender", genders) if genders else grouped.pivot("gender")
    wide = pivoted.agg(F.sum(as_money("total_spent")).cast("double"))
    return wide.na.fill(0.0).orderBy("category")


def category_bubble(categories: DataFrame, n: int = 5) -> DataFrame:
    """Category volume, revenue and price with an ``is_top`` flag for the top ``n``."""
    require(categories, "category", "total_quantity_sold", "total_revenue", "avg_price")
    top = _top_keys(categories, n).withColumn("is_top", F.lit(True))
    return (categories.join(top, "category", "left")
            .select("category", "total_quantity_sold", "total_revenue", "avg_price",
                    F.coalesce("is_top", F.lit(False)).alias("is_top"))
            .orderBy(F.desc("total_revenue"), "category"))


def weekday_pattern(weekday: DataFrame) -> DataFrame:
    require(weekday, "day_of_week", "total_revenue", "transaction_count")
    return weekday.select("day_of_week", weekday_name("day_of_week").alias("weekday_name"),
                          "total_revenue", "transaction_count").orderBy("day_of_week")


def month_pattern(monthly: DataFrame) -> DataFrame:
    require(monthly, "month", "total_revenue", "transaction_count")
    return monthly.select("month", month_name("month").alias("month_name"), "total_revenue",
                          "transaction_count",
                          F.try_divide("total_revenue", "transaction_count").alias("avg_transaction")
                          ).orderBy("month")


def pivot_age_gender(age_gender_report: DataFrame, genders=None) -> DataFrame:
    """age_group x gender of avg_total_spent, rows in band order."""
    require(age_gender_report, "age_group", "gender", "avg_total_spent")
    g = age_gender_report.groupBy("age_group")
    g = g.pivot("gender", genders) if genders else g.pivot("gender")
    return (g.agg(F.first("avg_total_spent"))
            .withColumn("band_order", band_order("age_group")).orderBy("band_order"))


def pivot_age_payment(payment_age: DataFrame, methods=None) -> DataFrame:
    """age_group x payment_method of usage_count (absent cells stay null)."""
    require(payment_age, "age_group", "payment_method", "usage_count")
    g = payment_age.groupBy("age_group")
    g = g.pivot("payment_method", methods) if methods else g.pivot("payment_method")
    return (g.agg(F.first("usage_count"))
            .withColumn("band_order", band_order("age_group")).orderBy("band_order"))


def value_counts(features: DataFrame) -> DataFrame:
    """(customer_value, value_label, count, percentage)."""
    require(features, "customer_value")
    whole = F.sum("count").over(_report())
    label = F.when(F.col("customer_value") == 1, VALUE_LABELS[1]).otherwise(VALUE_LABELS[0])
    return (features.groupBy("customer_value").count()
            .select("customer_value", label.alias("value_label"), "count",
                    share_pct("count", whole).alias("percentage"))
            .orderBy("customer_value"))


def gender_value_mix(features: DataFrame) -> DataFrame:
    """Per gender: general/high-value counts (0 when absent), total and row shares."""
    require(features, "gender", "customer_value")
    wide = (features.groupBy("gender").pivot("customer_value", [0, 1]).count().na.fill(0)
            .select("gender", F.col("0").alias("general_count"), F.col("1").alias("high_value_count")))
    tot = F.col("general_count") + F.col("high_value_count")
    return (wide.select("*", tot.alias("total"))
            .select("*", share_pct("general_count", "total").alias("general_pct"),
                    share_pct("high_value_count", "total").alias("high_value_pct"))
            .orderBy("gender"))


def payment_top5_share(payments: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most used methods and their share within those ``n``."""
    require(payments, "payment_method", "transaction_count")
    top = _top(payments, "transaction_count", "payment_method", n)
    whole = F.sum("transaction_count").over(_report())
    return (top.select("payment_method", "transaction_count",
                       share_pct("transaction_count", whole).alias("percentage"))
            .orderBy(F.desc("transaction_count"), "payment_method"))


def monetary_histogram(features: DataFrame, bins: int = 30, column: str = "monetary") -> DataFrame:
    """Equal-width histogram between min and max (last bin closed):
    (bin, bin_start, bin_end, count), all ``bins`` rows, empty ones with count 0;
    no row without values. The bounds are a scalar subquery, a second pass over
    ``features``: pass a materialised frame."""
    require(features, column)
    rng = features.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    # the bounds are evaluated once (one projected column) and carried along
    tagged = features.where(F.col(column).isNotNull()).select(F.col(column).alias("v"),
                                                              rng.alias("r"))
    v, lo, hi = F.col("v"), F.col("r.lo"), F.col("r.hi")
    idx = F.when(hi - lo == 0, 0).otherwise(
        F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1))).cast("int")
    counts = (tagged.select(idx.alias("bin"), lo.alias("lo"), hi.alias("hi"))
              .groupBy("bin")
              .agg(F.count("*").alias("count"), F.max("lo").alias("lo"), F.max("hi").alias("hi")))
    # the bins' own rows, one set per histogram: nothing but counts is joined
    whole = counts.agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"), F.map_from_entries(
        F.collect_list(F.struct("bin", "count"))).alias("counts")).where(F.col("lo").isNotNull())
    lo, hi = F.col("lo"), F.col("hi")
    return (whole.select("lo", "hi", "counts", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
            .select("bin", (lo + F.col("bin") * (hi - lo) / bins).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * (hi - lo) / bins).alias("bin_end"),
                    F.coalesce(F.try_element_at("counts", F.col("bin")), F.lit(0)).cast("long").alias("count"))
            .orderBy("bin"))


def overview(segments: DataFrame, categories: DataFrame, payments: DataFrame,
             monthly: DataFrame, n: int = 5) -> DataFrame:
    """Four dashboard panels in long form: (panel, label, value)."""
    seg = segment_share(segments).select(F.lit("segment_share").alias("panel"),
                                         F.col("customer_segment").alias("label"),
                                         F.col("share_pct").alias("value"))
    cat = top_categories(categories, n).select(F.lit("top_categories").alias("panel"),
                                               F.col("category").alias("label"),
                                               F.col("total_revenue").alias("value"))
    pay = payment_share(payments).select(F.lit("payment_share").alias("panel"),
                                         F.col("payment_method").alias("label"),
                                         F.col("share_pct").alias("value"))
    mon = monthly.select(F.lit("monthly_revenue").alias("panel"),
                         F.col("month").cast("string").alias("label"),
                         F.col("total_revenue").alias("value"))
    return seg.unionByName(cat).unionByName(pay).unionByName(mon)


def overview_from_lines(lines: DataFrame, segment, n: int = 5) -> DataFrame:
    """The same panels straight from the lines in one pass: grouping sets by
    customer, category, payment method and month share one scan and one shuffle;
    customers then count towards their segment. ``segment`` is the label column
    over (total_spent, transaction_count, avg_transaction_value)."""
    require(lines, "customer_id", "gender", "age", "category", "payment_method", "month", "invoice_no", "total_amount")
    customer = [F.col(c) for c in ("customer_id", "gender", "age")]
    keys = [*customer, F.col("category"), F.col("payment_method"), F.col("month")]
    sets = [customer, *([k] for k in keys[3:])]
    # grouping_id: a bit per key that is summed away, the first key highest
    bits = [sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if not any(k is x for x in s)) for s in sets]
    grouped = lines.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("gid"), total("total_amount").alias("total_spent"),
        F.count("invoice_no").alias("transaction_count"), mean("total_amount").alias("avg_transaction_value"))
    gid = F.col("gid")
    panel = F.when(gid == bits[0], "segment_share").when(gid == bits[1], "top_categories").when(
        gid == bits[2], "payment_share").otherwise("monthly_revenue")
    label = F.when(gid == bits[0], segment).when(gid == bits[1], F.col("category")).when(
        gid == bits[2], F.col("payment_method")).otherwise(F.col("month").cast("string"))
    rows = (grouped.select(panel.alias("panel"), label.alias("label"), "total_spent", "transaction_count")
            .groupBy("panel", "label")
            .agg(F.count(F.lit(1)).alias("customers"), F.sum("transaction_count").alias("n"),
                 F.max("total_spent").alias("revenue")))
    mine = Window.partitionBy("panel")  # a panel has one row per label
    rank = F.row_number().over(mine.orderBy(F.desc("revenue"), F.asc("label")))
    share = F.col("panel") == "segment_share"
    value = (F.when(share, share_pct("customers", F.sum("customers").over(mine)))
             .when(F.col("panel") == "payment_share", share_pct("n", F.sum("n").over(mine)))
             .otherwise(F.col("revenue")))
    return (rows.withColumn("value", value).withColumn("rank", rank)
            .where((F.col("panel") != "top_categories") | (F.col("rank") <= n))
            .where((F.col("panel") != "monthly_revenue") | F.col("label").isNotNull())
            .select("panel", "label", "value"))
