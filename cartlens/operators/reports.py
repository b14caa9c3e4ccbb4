"""Aggregate reports over shopping lines and the behaviour sheet.

Every report is one ``groupBy().agg()``: Spark runs a partial (map-side)
aggregate before the shuffle, so a key holding a third of all rows still
ships one row per map task. ``transaction_count`` counts non-null invoice
lines, not distinct invoices, as the source reports do. Sorts by a measure
carry the key as tie-breaker so any later ``limit`` is deterministic.

Input ``lines`` is the output of ``clean.enrich_shopping`` (money in decimal).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.bands import band
from ..functions.money import as_money, mean, total

# Default segment thresholds, the segment labels (first rule that
# holds wins, in this order) and the at-risk rule's satisfaction level.
HIGH_VALUE, FREQUENT, HIGH_TICKET = 1000.0, 10, 100.0
SEGMENT_LABELS = ("High Value Customer", "Frequent Customer",
                  "High Ticket Customer", "General Customer")
AT_RISK_DAYS, AT_RISK_LEVEL = 30, "Unsatisfied"


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail early, naming the missing columns, when a report is handed the
    wrong table (e.g. shopping lines where behaviour rows are expected)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; got {df.columns}")
    return df


def customer_stats(lines: DataFrame) -> DataFrame:
    """Per (customer_id, gender, age): transaction_count, total_spent,
    avg_transaction_value (rounded to cents, half up)."""
    require(lines, "customer_id", "gender", "age", "invoice_no", "total_amount")
    return (lines.groupBy("customer_id", "gender", "age")
            .agg(F.count("invoice_no").alias("transaction_count"),
                 total("total_amount").alias("total_spent"),
                 mean("total_amount").alias("avg_transaction_value")))


def segment_label(high_value: float = HIGH_VALUE, frequent: int = FREQUENT, high_ticket: float = HIGH_TICKET):
    """The segment of a customer's rounded measures; the first rule that holds."""
    hv, fr, ht = SEGMENT_LABELS[:3]
    return (F.when(F.col("total_spent") > high_value, hv)
            .when(F.col("transaction_count") > frequent, fr)
            .when(F.col("avg_transaction_value") > high_ticket, ht)
            .otherwise(SEGMENT_LABELS[3]))


def customer_segments(lines: DataFrame, **thresholds) -> DataFrame:
    """Customer stats plus ``customer_segment`` (thresholds as in
    ``segment_label``) and the 7-way ``age_group``."""
    return customer_stats(lines).select(
        "*", segment_label(**thresholds).alias("customer_segment"), band("age", "age7").alias("age_group"))


def segment_counts(segments: DataFrame) -> DataFrame:
    require(segments, "customer_segment")
    return (segments.groupBy("customer_segment").count()
            .orderBy(F.desc("count"), "customer_segment"))


def age_gender(segments: DataFrame) -> DataFrame:
    """Per (age_group, gender): customer_count, avg_total_spent."""
    require(segments, "age_group", "gender", "customer_id", "total_spent")
    return (segments.groupBy("age_group", "gender")
            .agg(F.count("customer_id").alias("customer_count"),
                 mean(as_money("total_spent")).alias("avg_total_spent"))
            .orderBy("age_group", "gender"))


def category_summary(lines: DataFrame) -> DataFrame:
    require(lines, "category", "quantity", "price", "total_amount", "invoice_no")
    return (lines.groupBy("category")
            .agg(F.sum("quantity").alias("total_quantity_sold"),
                 total("total_amount").alias("total_revenue"),
                 F.count("invoice_no").alias("transaction_count"),
                 mean("price", places=6).alias("avg_price"))
            .orderBy(F.desc("total_revenue"), "category"))


def month_category(lines: DataFrame, by_year: bool = False, undated: bool = False) -> DataFrame:
    """Revenue per (month, category) over valid dates; months pool all years
    unless ``by_year``. ``undated`` adds a row per category, with a null month,
    for the lines without a valid date."""
    keys = ["year", "month"] if by_year else ["month"]
    require(lines, *keys, "category", "valid_date", "total_amount")
    return ((lines if undated else lines.where("valid_date"))
            .groupBy(*keys, "category")
            .agg(total("total_amount").alias("monthly_revenue"))
            .orderBy(*keys, F.desc("monthly_revenue"), "category"))


def category_preferences(lines: DataFrame) -> DataFrame:
    require(lines, "category", "gender", "age_group", "total_amount")
    return (lines.groupBy("category", "gender", "age_group")
            .agg(total("total_amount").alias("total_spent"))
            .orderBy("category", "gender", "age_group"))


def payment_summary(lines: DataFrame) -> DataFrame:
    require(lines, "payment_method", "invoice_no", "total_amount")
    return (lines.groupBy("payment_method")
            .agg(F.count("invoice_no").alias("transaction_count"),
                 total("total_amount").alias("total_revenue"),
                 mean("total_amount").alias("avg_transaction_value"))
            .orderBy(F.desc("transaction_count"), "payment_method"))


def payment_by_age(lines: DataFrame) -> DataFrame:
    require(lines, "age_group", "payment_method", "invoice_no")
    return (lines.groupBy("age_group", "payment_method")
            .agg(F.count("invoice_no").alias("usage_count"))
            .orderBy("age_group", F.desc("usage_count"), "payment_method"))


def weekday_sales(lines: DataFrame) -> DataFrame:
    require(lines, "day_of_week", "valid_date", "total_amount", "invoice_no")
    return (lines.where("valid_date")
            .groupBy("day_of_week")
            .agg(total("total_amount").alias("total_revenue"),
                 F.count("invoice_no").alias("transaction_count"))
            .orderBy("day_of_week"))


def month_sales(lines: DataFrame, by_year: bool = False) -> DataFrame:
    require(lines, "month", "valid_date", "total_amount", "invoice_no")
    keys = ["year", "month"] if by_year else ["month"]
    return (lines.where("valid_date")
            .groupBy(*keys)
            .agg(total("total_amount").alias("total_revenue"),
                 F.count("invoice_no").alias("transaction_count"))
            .orderBy(*keys))


# ---- value-model side (lines prepared by ``value.prepare_lines``) ----

def consumption_by(lines: DataFrame, key: str) -> DataFrame:
    """Per ``key``: transaction_count, total_spent, avg_transaction. Ordered by
    the key, except payment methods, which order by count (descending)."""
    require(lines, key, "invoice_no", "total_amount")
    out = (lines.groupBy(key)
           .agg(F.count("invoice_no").alias("transaction_count"),
                total("total_amount").alias("total_spent"),
                mean("total_amount").alias("avg_transaction")))
    if key == "payment_method":
        return out.orderBy(F.desc("transaction_count"), key)
    return out.orderBy(key)


# ---- behaviour sheet ----

def membership_segments(behaviour: DataFrame) -> DataFrame:
    """Per (membership_type, age_group [3-way], city): avg_total_spend (6
    places, half up) and items_purchased. Nulls are dropped first."""
    require(behaviour, "membership_type", "age", "city", "total_spend", "items_purchased")
    df = behaviour.na.drop().withColumn("age_group", band("age", "age3"))
    return (df.groupBy("membership_type", "age_group", "city")
            .agg(mean(as_money("total_spend"), 6).alias("avg_total_spend"),
                 F.sum("items_purchased").alias("items_purchased"))
            .orderBy("membership_type", "age_group", "city"))


def city_segments(behaviour: DataFrame) -> DataFrame:
    require(behaviour, "city", "total_spend", "items_purchased")
    return (behaviour.na.drop().groupBy("city")
            .agg(mean(as_money("total_spend"), 6).alias("avg_total_spend"),
                 F.sum("items_purchased").alias("items_purchased"))
            .orderBy("city"))


def at_risk_customers(behaviour: DataFrame, days: int = AT_RISK_DAYS,
                      level: str = AT_RISK_LEVEL) -> DataFrame:
    """Complete rows whose last purchase is over ``days`` ago and whose
    satisfaction equals ``level``; all columns kept."""
    require(behaviour, "days_since_last_purchase", "satisfaction_level")
    return behaviour.na.drop().where(
        (F.col("days_since_last_purchase") > days) & (F.col("satisfaction_level") == level))
