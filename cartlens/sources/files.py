"""File sources and sinks: CSV with explicit schemas, report directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..schemas import BEHAVIOUR_RAW, BEHAVIOUR_RENAME, SHOPPING

CORRUPT = "_corrupt_record"


def _csv(spark: SparkSession, paths, schema: T.StructType, keep_corrupt: bool) -> DataFrame:
    """Columns are bound by header name, in any order; extra columns are dropped.
    The names come from one header line; every file's own header is then checked
    against it, so a file laid out otherwise raises instead of swapping columns.
    A missing or repeated name raises. A folder without any line is empty."""
    def reader():
        return spark.read.option("header", True)

    header = reader().option("inferSchema", False).csv(paths).columns
    if not header:
        header = schema.fieldNames()
    known = {f.name: f for f in schema.fields}
    missing = [n for n in known if header.count(n) != 1]
    if missing:
        raise ValueError(f"columns {missing} are missing or repeated in the header {header} of {paths}")
    layout = [known.get(n, T.StructField(n, T.StringType())) for n in header]
    df = (reader().schema(T.StructType(layout + [T.StructField(CORRUPT, T.StringType())]))
          .option("enforceSchema", False)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT)
          .csv(paths))
    return df.select(*[F.col(f"`{n}`") for n in known], *([CORRUPT] if keep_corrupt else []))


def read_shopping(spark: SparkSession, paths, keep_corrupt: bool = False) -> DataFrame:
    """Shopping lines from CSV file(s) or directories, any Hadoop URI."""
    return _csv(spark, paths, SHOPPING, keep_corrupt)


def snake_case_behaviour(df: DataFrame) -> DataFrame:
    """Sheet header names (``Customer ID``) to snake case (``customer_id``)."""
    return df.select(*[F.col(f"`{c}`").alias(BEHAVIOUR_RENAME.get(c, c)) for c in df.columns])


def read_behaviour(spark: SparkSession, paths, keep_corrupt: bool = False) -> DataFrame:
    """Behaviour sheet from CSV; header names with spaces become snake case."""
    return snake_case_behaviour(_csv(spark, paths, BEHAVIOUR_RAW, keep_corrupt))


def fixed_decimals(df: DataFrame, places: int = 2) -> DataFrame:
    """Fractional columns (double, float, decimal) as fixed text with
    ``places`` decimals and thousands grouping, e.g. ``1,234.50``."""
    frac = (T.DoubleType, T.FloatType, T.DecimalType)
    return df.select(*[F.format_number(F.col(f"`{f.name}`"), places).alias(f.name)
                       if isinstance(f.dataType, frac) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def write_report(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False,
                 mode: str = "overwrite", partition_by=None, decimals: int | None = None) -> None:
    """Write a report directory. ``single_file`` narrows the last stage to one
    task, so use it only for reports whose size is bounded by their key domain.
    ``decimals`` writes fractional columns as fixed text (``fixed_decimals``)."""
    if decimals is not None:
        df = fixed_decimals(df, decimals)
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Read every part file of a report directory with the schema it was
    written with (no inference pass, no types that depend on the data)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).option("enforceSchema", False).csv(path)
    return reader.format(fmt).load(path)


def report_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Data files per report directory under ``root``: (report, files, bytes).

    Lists file metadata through the binary-file source without reading content."""
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", True)
             .load(root)
             .select("path", "length"))
    base = root.rstrip("/").split("://")[-1]
    rel = F.regexp_replace(F.col("path"), "^.*?\\Q" + base + "\\E/", "")
    return (files.select(F.split(rel, "/")[0].alias("report"), "length")
            .groupBy("report")
            .agg(F.count("*").alias("files"), F.sum("length").alias("bytes")))
