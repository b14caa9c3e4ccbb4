"""Spool-directory ingestion with Structured Streaming.

A directory receives text files of any shape. A stream over the directory's
files (their names, times and lengths; the source's checkpointed file log
remembers what was taken, so a restart does not take a file again) hands every
micro-batch to a writer, which lands the lines of exactly these files as
committed Parquet in a folder of the batch, and then appends the files to the
ledger: a table (source_file, source_name, source_modified, source_length,
ingest_batch) beside bronze. Both are written over a batch's own folder, so a
batch that is run again after a failure lands once. Each line becomes a bronze row
with its file's path and name. Files of no bytes have no row in either (no file
source lists them); the stream counts them as taken.

Micro-batches are bounded by files or by bytes, and bronze files by bytes: many
small source files share one, a large one is cut. Optionally files are archived
after their batch. File identity is the path: the same bytes under a new name
are ingested again. Files of any age are taken, also when newer ones were seen
before (so the source's file log is never cut by age). New content under a name
that was already taken, be it as an empty file, is not ingested by the stream; a
drain finds such files by comparing the directory with the ledger, never with the
lines, and fails naming them (``on_redrop="ignore"`` leaves that to the caller, who
finds them with ``redropped``).

``read_landed`` turns the bronze lines of one source back into typed rows.
"""

from __future__ import annotations

import re
import time
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import BRONZE, LEDGER, SPOOL_FILES

#: Longer than any file can be old.
ANY_AGE = "36500d"
#: Source bytes that share a bronze file at most, about.
FILE_BYTES = 256 << 20
#: ... and a fraction of that at least, about, if there are many.
SMALLER = 8


class RedroppedFiles(RuntimeError):
    """Files in the spool whose name was taken before with other content."""


def _file(part: str):
    """The path or name of a row's file, as it is (Spark gives it URL-encoded)."""
    given = F.col(f"_metadata.{part}")
    return F.when(given.contains("%"), F.url_decode(F.replace(given, F.lit("+"), F.lit("%2B")))).otherwise(given)


def ledger_path(bronze_dir: str) -> str:
    """Where the ledger of a bronze folder lies: beside it."""
    return bronze_dir.rstrip("/") + "_ledger"


def spool_files(spark: SparkSession, spool_dir: str, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """Unbounded frame of the directory's files: (path, source_file, source_name,
    source_modified, source_length). Their content is not read. A micro-batch takes
    at most so many files, or files of so many bytes (at least one)."""
    reader = spark.readStream.format("binaryFile").schema(SPOOL_FILES).option("maxFileAge", ANY_AGE)
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("bound a micro-batch by files or by bytes, not by both")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(spool_dir).select("path", _file("file_path").alias("source_file"),
                                         _file("file_name").alias("source_name"),
                                         F.col("modificationTime").alias("source_modified"),
                                         F.col("length").alias("source_length"))


def land_batch(files: DataFrame, batch: int, bronze_dir: str, file_bytes: int = FILE_BYTES) -> None:
    """Land the lines of ``files`` as batch number ``batch``, then enter them in the
    ledger. Written over whatever an earlier attempt at the batch left. Only the
    batch's file names reach the driver, which listed them."""
    spark = files.sparkSession
    files = files.dropDuplicates(["source_file"])  # a replayed batch may name a file twice
    listed = files.select("path", "source_length").collect()
    if not listed:
        return
    names = [re.sub(r"([\\*?\[\]{}])", r"\\\1", f["path"]) for f in listed]  # a name is no pattern
    lines = spark.read.text(names).select(
        F.col("value").alias("line"), _file("file_path").alias("source_file"),
        _file("file_name").alias("source_name"), F.col("_metadata.file_modification_time").alias("source_modified"),
        F.col("_metadata.file_size").alias("source_length"), F.current_date().alias("ingest_date"))
    size = sum(f["source_length"] for f in listed)
    # as many tasks as there are cores, unless their files would be small
    parts = max(1, -(-size // file_bytes), min(spark.sparkContext.defaultParallelism, size * SMALLER // file_bytes))
    (lines.coalesce(parts).write.mode("overwrite").partitionBy("ingest_date").option("compression", "zstd")
     .option("parquet.column.statistics.enabled#line", "false")  # no one looks for lines by their order
     .parquet(f"{bronze_dir.rstrip('/')}/ingest_batch={batch}"))
    files.drop("path").coalesce(1).write.mode("overwrite").parquet(f"{ledger_path(bronze_dir)}/ingest_batch={batch}")


def ingest_spool(spark: SparkSession, spool_dir: str, bronze_dir: str, checkpoint_dir: str,
                 max_files_per_trigger: int | None = None, archive_dir: str | None = None,
                 available_now: bool = True, processing_time: str | None = None,
                 max_bytes_per_trigger: int | None = None, file_bytes: int = FILE_BYTES) -> StreamingQuery:
    """Start the spool -> bronze stream. With ``available_now`` it drains what
    is there (in micro-batches of the bound given) and stops; otherwise it polls
    every ``processing_time``."""
    files = spool_files(spark, spool_dir, max_files_per_trigger, max_bytes_per_trigger, archive_dir)
    writer = (files.writeStream.option("checkpointLocation", checkpoint_dir)
              .foreachBatch(lambda batch, number: land_batch(batch, number, bronze_dir, file_bytes)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_ledger(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """The files taken so far, one row per file and micro-batch."""
    return spark.read.schema(LEDGER).parquet(ledger_path(bronze_dir))


def redropped(spark: SparkSession, spool_dir: str, bronze_dir: str, drained: float | None = None) -> DataFrame:
    """(source_file, source_modified, source_length) of spool files whose name is
    in the ledger with another time or length only. ``drained``: when the last
    complete drain began (seconds since 1970); files older than that which are not
    in the ledger were taken while they were empty and are given too. Lists the
    spool without reading it, and reads no lines."""
    there = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(spool_dir)
             .select(_file("file_path").alias("source_file"),
                     F.col("modificationTime").alias("source_modified"), F.col("length").alias("source_length")))
    taken = read_ledger(spark, bronze_dir).groupBy("source_file").agg(
        F.collect_set(F.struct("source_modified", "source_length")).alias("taken"))  # as often as a path was taken: once, or after a replay
    both = there.join(taken, "source_file", "left")
    other = ~F.array_contains("taken", F.struct("source_modified", "source_length"))
    old = F.lit(False) if drained is None else F.col("source_modified") < F.timestamp_micros(F.lit(int(drained * 1_000_000)))
    return both.where(F.coalesce(other, old)).select(*there.columns)


def run_ingest(spark: SparkSession, spool_dir: str, bronze_dir: str, checkpoint_dir: str,
               on_redrop: str = "fail", **kwargs) -> StreamingQuery:
    """Drain the spool once, wait for the stream to finish, and look for names
    that came back with new content (``on_redrop``: "fail" or "ignore")."""
    began = time.time()
    query = ingest_spool(spark, spool_dir, bronze_dir, checkpoint_dir, available_now=True, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if on_redrop == "fail" and query.recentProgress:
        again = [r.source_file for r in redropped(spark, spool_dir, bronze_dir, began).limit(20).collect()]
        if again:
            raise RedroppedFiles(f"taken before with other content, give them new names: {again}")
    return query


#: A field behind its comma: quoted (a quote inside is doubled, so that one quoted part
#: follows another, or has a backslash before it), or everything up to the next comma.
_FIELD = r',(?:(?:"[^"\\]*(?:\\.[^"\\]*)*+")++(?!")|[^,]*)'


def _cuts(line):
    """A CSV line as an array of its fields, however many: split at commas; a line with a
    quote is cut by pattern, and each of its fields still has its comma and quotes."""
    return (F.when(line.contains('"'), F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(0)))
            .otherwise(F.split(line, ",")))


def _plain(f):
    """The text of a field of ``_cuts``: one split at commas holds none."""
    inner = F.substr(f, F.lit(3), F.length(f) - 3)
    return (F.when(~f.startswith(","), f)
            .when(f.rlike(r'^,".*"$') & (F.length(f) > 2), F.regexp_replace(inner, r'\\(.)|"(")', "$1$2"))
            .otherwise(F.substr(f, F.lit(2))))


def fields(line):
    """A CSV line as an array of its texts, however many: split at commas; a line
    with a quote is cut by pattern, and quotes are taken off. A quote that is not
    closed is an ordinary character."""
    return F.transform(_cuts(F.col(line) if isinstance(line, str) else line), _plain)


def _norm(c):
    return F.regexp_replace(F.lower(c), r'[\s"\ufeff]', "")


def _literal(c: str) -> str:
    """A pattern of this character alone."""
    return c if c.isalnum() else "\\" + c if c.isascii() else f"\\x{{{ord(c):x}}}"


def _header_test(names: list[str]):
    """Whether ``line`` names every one of ``names`` (normalised). Only lines that hold
    the first name at all are looked at closely, and for it only those with every
    character of it that has no case."""
    line, gap = F.col("line"), "[ \t\"\ufeff]*+"
    near = F.lower("line").rlike(gap.join(map(_literal, names[0])))
    for c in sorted({c for c in names[0] if c.isascii() and not c.isalpha()}):
        near = line.contains(c) & near
    tokens = F.transform(fields("line"), _norm)
    return F.when(near, F.array_size(F.array_except(F.array(*map(F.lit, names)), tokens)) == 0).otherwise(False)


def _landed(spark, bronze_dir, source_name, source_like, ingest_from, ingest_to) -> DataFrame:
    bronze = spark.read.schema(BRONZE).parquet(bronze_dir)   # declared: no footer job
    if ingest_from is not None:
        bronze = bronze.where(F.col("ingest_date") >= F.lit(ingest_from).cast("date"))
    if ingest_to is not None:
        bronze = bronze.where(F.col("ingest_date") <= F.lit(ingest_to).cast("date"))
    if source_name is not None:
        bronze = bronze.where(F.col("source_name") == source_name)
    if source_like is not None:
        bronze = bronze.where(F.col("source_name").like(source_like))
    line, ends = F.col("line"), ("\r", "\r\x85", "\r\u2028", "\r\u2029")  # "$" may stand before a line's end
    returned = reduce(or_, [line.endswith(e) for e in ends])
    bronze = bronze.withColumn("line", F.when(returned, F.regexp_replace("line", "\r$", "")).otherwise(line))
    return bronze.where(F.trim("line") != "")


def _names(schema: T.StructType) -> list[str]:
    return ["".join(n.lower().split()) for n in schema.fieldNames()]


def _layouts(bronze: DataFrame, names: list[str]) -> DataFrame:
    """(source_file, width, places): how many columns each file's header has and at
    which of them the ``names`` stand; one row per file with a header line."""
    heads = (bronze.where(_header_test(names)).groupBy("source_file").agg(F.min("line").alias("head"))
             .withColumn("tokens", F.transform(fields("head"), _norm)))
    return heads.select("source_file", F.array_size("tokens").alias("width"),
                        F.array(*[F.array_position("tokens", n).cast("int") for n in names]).alias("places"))


def landed_layouts(spark: SparkSession, bronze_dir: str, schema: T.StructType, source_name: str | None = None,
                   source_like: str | None = None, ingest_from=None, ingest_to=None) -> DataFrame:
    """(width, places, files): the distinct header layouts of the landed files, with the
    places (from 1) of the columns of ``schema`` in them."""
    bronze = _landed(spark, bronze_dir, source_name, source_like, ingest_from, ingest_to)
    return _layouts(bronze, _names(schema)).groupBy("width", "places").agg(F.count(F.lit(1)).alias("files"))


def read_landed(spark: SparkSession, bronze_dir: str, schema: T.StructType,
                source_name: str | None = None, source_like: str | None = None,
                header: bool = True, keep_source: bool = False, keep_rejects: bool = False,
                ingest_from=None, ingest_to=None) -> DataFrame:
    """Typed rows of the landed lines of one source (exact ``source_name`` or a
    SQL ``LIKE`` pattern), from the bronze partitions between ``ingest_from`` and
    ``ingest_to`` (dates, inclusive).

    With ``header``, a file's header is its line that names every column of
    ``schema``, in any order and with any number of others between; the file's
    lines are bound by those names, and a file without such a line raises.
    Without, columns are in schema order. Lines may have any number of fields: one
    is cut at its own commas, and a field beyond its end is null. Blank and header
    lines are dropped. A field that does not parse is null; ``keep_rejects`` adds
    ``rejected``, true for such lines.
    """
    bronze, names = _landed(spark, bronze_dir, source_name, source_like, ingest_from, ingest_to), _names(schema)
    if header:
        # one row per file, which the drain's driver has listed: the lines themselves stay where they are
        bronze = bronze.where(~_header_test(names)).join(F.broadcast(_layouts(bronze, names)), "source_file", "left")
        missing = F.raise_error(F.concat(F.lit(f"no header line with {schema.fieldNames()} in "), "source_file"))
        places = F.coalesce("places", missing.cast("array<int>"))
    else:
        places = F.array(*[F.lit(k + 1) for k in range(len(names))])
    # a line is cut once; quotes are taken off the fields that are read
    cells = bronze.withColumn("cells", _cuts(F.col("line"))).withColumn("places", places)
    text = [F.nullif(_plain(F.get("cells", F.get("places", F.lit(k)) - 1)), F.lit("")) for k in range(len(names))]
    cast = [t.try_cast(f.dataType) for t, f in zip(text, schema.fields)]
    rejected = F.greatest(*[(t.isNotNull() & c.isNull()) for t, c in zip(text, cast)], F.lit(False))
    return cells.select(*[c.alias(f.name) for c, f in zip(cast, schema.fields)],
                        *(["source_file", "ingest_date"] if keep_source else []),
                        *([rejected.alias("rejected")] if keep_rejects else []))


def landed_rejects(spark: SparkSession, bronze_dir: str, schema: T.StructType, **kwargs) -> DataFrame:
    """(source_file, lines, rejected): lines per file, and those with a field that
    does not parse."""
    rows = read_landed(spark, bronze_dir, schema, keep_source=True, keep_rejects=True, **kwargs)
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("lines"),
                                           F.count_if("rejected").alias("rejected"))


def main(argv=None):
    """``python -m cartlens.streaming.ingest SPOOL BRONZE CHECKPOINT [options]``"""
    import argparse

    ap = argparse.ArgumentParser(description="spool folder -> bronze Parquet")
    ap.add_argument("spool")
    ap.add_argument("bronze")
    ap.add_argument("checkpoint")
    ap.add_argument("--max-files-per-trigger", type=int)
    ap.add_argument("--max-bytes-per-trigger", type=int)
    ap.add_argument("--file-bytes", type=int, default=FILE_BYTES, help="source bytes per bronze file")
    ap.add_argument("--archive-dir")
    ap.add_argument("--every", help="keep polling at this interval, e.g. '30 seconds'")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("cartlens-ingest").getOrCreate()
    opts = dict(max_files_per_trigger=args.max_files_per_trigger, archive_dir=args.archive_dir,
                max_bytes_per_trigger=args.max_bytes_per_trigger, file_bytes=args.file_bytes)
    if args.every:
        ingest_spool(spark, args.spool, args.bronze, args.checkpoint, available_now=False,
                     processing_time=args.every, **opts).awaitTermination()
    else:
        run_ingest(spark, args.spool, args.bronze, args.checkpoint, **opts)


if __name__ == "__main__":
    main()
