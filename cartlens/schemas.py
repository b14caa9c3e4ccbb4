"""Explicit schemas: no inference in jobs (a CSV scan with inferSchema costs a
full extra pass over the input and changes type with the data)."""

from pyspark.sql import types as T

# Shopping lines as they arrive (one line per purchased item).
SHOPPING = T.StructType([
    T.StructField("invoice_no", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("invoice_date", T.StringType()),  # day first, d/M/yyyy
])

# Customer behaviour sheet, with the header names used by the source files.
BEHAVIOUR_RAW = T.StructType([
    T.StructField("Customer ID", T.LongType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("City", T.StringType()),
    T.StructField("Membership Type", T.StringType()),
    T.StructField("Total Spend", T.DoubleType()),
    T.StructField("Items Purchased", T.IntegerType()),
    T.StructField("Average Rating", T.DoubleType()),
    T.StructField("Discount Applied", T.BooleanType()),
    T.StructField("Days Since Last Purchase", T.IntegerType()),
    T.StructField("Satisfaction Level", T.StringType()),
])

BEHAVIOUR_RENAME = {f.name: f.name.lower().replace(" ", "_") for f in BEHAVIOUR_RAW.fields}

BEHAVIOUR = T.StructType([
    T.StructField(BEHAVIOUR_RENAME[f.name], f.dataType, f.nullable) for f in BEHAVIOUR_RAW.fields
])

# Files as the spool's stream sees them (their content is never read through it).
SPOOL_FILES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

# Ledger written by the spool ingest: one row per file taken.
LEDGER = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("source_modified", T.TimestampType()),
    T.StructField("source_length", T.LongType()),
    T.StructField("ingest_batch", T.LongType()),
])

# Bronze table written by the spool ingest: one row per landed line.
BRONZE = T.StructType([
    T.StructField("line", T.StringType()),
    *[f for f in LEDGER.fields if f.name != "ingest_batch"],
    T.StructField("ingest_batch", T.LongType()),
    T.StructField("ingest_date", T.DateType()),
])


def ddl(schema: T.StructType) -> str:
    """DDL string of a schema, with back-quoted names (for ``from_csv``)."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
