"""Helpers that several operators share: staged tables, offsets, Arrow rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import ensure_shared_dir, remove_shared, shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; a session without ``spark.checkpoint.dir`` raises."""
    return shared_path(spark, "llm", name, unique=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back:
    the plan behind it runs once, and a lost executor costs no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete the tables that operators left in the shared folder; for the end of an
    application, when no result that reads them is needed any more."""
    remove_shared(spark, f"{ensure_shared_dir(spark).rstrip('/')}/cartlens/llm")


def text_or_empty(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores behind it as make it no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def with_offsets(counts: DataFrame, key: str, n: str, group: int = 4096) -> DataFrame:
    """(key, n) -> (key, n, offset): how many rows lie in smaller keys. Keys are
    long and dense; windows run per ``group`` keys and then over group totals,
    so no task orders more than max(group, keys / group) rows."""
    part = counts.withColumn("__g", F.floor(F.col(key) / group))
    inner = part.withColumn("__in", F.sum(n).over(Window.partitionBy("__g").orderBy(key)) - F.col(n))
    totals = part.groupBy("__g").agg(F.sum(n).alias("__t"))
    before = totals.withColumn("__before", F.sum("__t").over(Window.orderBy("__g")) - F.col("__t")).drop("__t")
    return (inner.join(before, "__g")
            .withColumn("offset", (F.col("__in") + F.col("__before")).cast("long"))
            .drop("__g", "__in", "__before"))


#: Rows and bytes of the Arrow batches that carry texts to Python workers.
ARROW_ROWS, ARROW_BYTES = 2048, 4 << 20


def map_texts(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow``, in batches small enough for rows with long texts: at the
    default of 10,000 rows a task holds tens of MB several times over (in the JVM's
    direct memory, while its buffers double, and in the worker). The sizes are
    session settings that change no result; smaller ones are left as they are."""
    conf = df.sparkSession.conf
    rows = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "0"))
    if not 0 < rows <= ARROW_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df.mapInArrow(function, schema)


def batch_rows(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into small slices (no copy) so that the Python objects
    made from one slice stay small whatever the session's batch size."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
