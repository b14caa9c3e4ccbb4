"""Enrichment, null handling and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.bands import band
from ..functions.dates import parse_day_first
from ..functions.money import as_money, as_price


def enrich_shopping(df: DataFrame, age_scheme="age7") -> DataFrame:
    """Derived shopping columns, for whichever inputs are present:

    - ``price`` as an exact decimal, ``total_amount = quantity * price`` in
      cents (the product is rounded, not the price)
    - ``invoice_date`` parsed day-first (invalid text -> null), ``valid_date``,
      ``month``, ``year``, ``day_of_week`` (1 = Sunday; null when invalid)
    - ``age_group`` from ``age`` in the given band scheme
    """
    cols = set(df.columns)
    out = []
    if "price" in cols:
        out.append(as_price("price").alias("price"))
    if {"price", "quantity"} <= cols:
        out.append(as_money(F.col("quantity") * as_price("price")).alias("total_amount"))
    if "invoice_date" in cols:
        ts = parse_day_first("invoice_date")
        out += [ts.alias("invoice_date"), ts.isNotNull().alias("valid_date"),
                F.month(ts).alias("month"), F.year(ts).alias("year"),
                F.dayofweek(ts).alias("day_of_week")]
    if "age" in cols and age_scheme:
        out.append(band("age", age_scheme).alias("age_group"))
    replaced = {"price", "invoice_date"}
    return df.select(*[c for c in df.columns if c not in replaced], *out)


def clean_drop(df: DataFrame, how: str = "any", subset=None) -> DataFrame:
    """Drop rows with nulls (``how='any'``) or with all-null ``subset``."""
    return df.na.drop(how=how, subset=subset)


def clean_fill(df: DataFrame, number=0, text: str = "unknown") -> DataFrame:
    """Fill nulls by declared type in one projection: every numeric column
    gets ``number``, every string column ``text``; booleans, dates and
    timestamps keep their nulls (a text fill cannot apply to them)."""
    fills = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            fills[f.name] = F.coalesce(F.col(f"`{f.name}`"), F.lit(number).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            fills[f.name] = F.coalesce(F.col(f"`{f.name}`"), F.lit(text))
    return df.select(*[fills.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


def profile_table(df: DataFrame) -> DataFrame:
    """One row: ``row_count``, ``column_count``."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count"))


def profile_schema(df: DataFrame) -> DataFrame:
    """The schema as rows (column_name, data_type, nullable): column metadata
    only, one row per column, built on the driver from ``df.schema``."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, data_type string, nullable boolean")


def profile_nulls(df: DataFrame) -> DataFrame:
    """Null count per column, all columns in one scan: (column_name, null_count)."""
    names = df.columns
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(names)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_count"))
        for i, c in enumerate(names)]))
    return wide.select(stacked.alias("s")).select("s.column_name", "s.null_count")


def profile_ranges(df: DataFrame, columns) -> DataFrame:
    """Min and max of numeric columns in one scan: (column_name, min_value, max_value)."""
    wide = df.agg(*[F.min(c).cast("double").alias(f"lo{i}") for i, c in enumerate(columns)],
                  *[F.max(c).cast("double").alias(f"hi{i}") for i, c in enumerate(columns)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"lo{i}").alias("min_value"),
                 F.col(f"hi{i}").alias("max_value"))
        for i, c in enumerate(columns)]))
    return wide.select(stacked.alias("s")).select("s.*")
