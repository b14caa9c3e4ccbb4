"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition makes one sorted run of digests. Runs are exchanged in
rounds of ``FAN_IN``: round r merges the runs whose numbers agree after r
divisions by ``FAN_IN``, and each merged entry keeps the surviving identifier
and the number of rows behind it. An entry is one per (run, digest), so a text
that a third of all rows carry reaches a round with at most one entry per run.
The winners then travel back down the same tree, again one entry per run, and
meet the rows on (run, digest).

"Verified": rows fall together only if SHA-256, a second independent 64-bit
hash and the byte length of the text all agree, at every level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import free_names, staged, text_or_empty

#: Runs that take part in the exchange, and how many merge into one per round.
RUNS, FAN_IN = 64, 8

KEY = ["digest", "check", "n_bytes"]


def digest_runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One sorted run per input partition: (doc_id, row, run, digest, check,
    n_bytes). ``row`` tells repeated rows apart."""
    text = text_or_empty(text_col)
    return (docs.select(F.col(id_col).alias("doc_id"), text.alias("__t"))
            .select("doc_id",
                    F.monotonically_increasing_id().alias("row"),
                    F.pmod(F.spark_partition_id(), F.lit(RUNS)).cast("int").alias("run"),
                    F.unhex(F.sha2("__t", 256)).alias("digest"),
                    F.xxhash64("__t").alias("check"),
                    F.octet_length("__t").alias("n_bytes"))
            .sortWithinPartitions("run", *KEY))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "max") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row.

    Texts are equal when their UTF-8 bytes are; null counts as empty. Of equal
    texts the row with the largest (``keep="max"``) or smallest ("min") doc_id
    stays. Null ids lose against any id and stay only where the whole group has
    none. Repeated rows (same id and text) count in group_size and exactly one
    of them has kept = true. An empty table gives an empty result; other
    columns, whatever their names, are not read.
    """
    if keep not in ("max", "min"):
        raise ValueError("keep is 'max' or 'min'")
    rows = staged(digest_runs(docs, id_col, text_col), "digest_runs")
    best = F.max if keep == "max" else F.min
    has = F.col("doc_id").isNotNull() if keep == "max" else F.col("doc_id").isNull()

    def merge(runs, divide):
        return (runs.groupBy((F.col("run") / divide).cast("int").alias("run"), *KEY)
                .agg(best("keeper").alias("keeper"), F.sum("rows").alias("rows")))

    levels = [merge(rows.select("run", *KEY, F.struct(has.alias("has"), "doc_id", "row").alias("keeper"),
                                F.lit(1).cast("long").alias("rows")), 1)]
    width = RUNS
    while width > 1:
        levels.append(merge(levels[-1], FAN_IN))
        width = -(-width // FAN_IN)
    down = levels.pop()
    while levels:
        wider = levels.pop().select("run", *KEY, (F.col("run") / FAN_IN).cast("int").alias("parent"))
        down = wider.join(down.withColumnRenamed("run", "parent"), ["parent", *KEY]).drop("parent")
    return (rows.join(down, ["run", *KEY])
            .select("doc_id", F.col("keeper.doc_id").alias("keep_id"),
                    F.col("rows").alias("group_size"),
                    (F.col("row") == F.col("keeper.row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, all columns under any names. Of equal texts
    (null counts as empty) the row of the largest or smallest id stays; rows
    repeated with id and text come once; null ids lose against any id; empty in,
    empty out."""
    own, other_id, other = free_names(docs, "own_sha", "alive_id", "alive_sha")
    alive = (exact_dedup(docs, id_col, text_col, keep).where("kept")
             .select(F.col("doc_id").alias(other_id), F.col("text_sha256").alias(other)))
    rows = docs.withColumn(own, F.sha2(text_or_empty(text_col), 256))
    return (rows.join(alive, F.col(id_col).eqNullSafe(F.col(other_id)) & (F.col(own) == F.col(other)), "left_semi")
            .dropDuplicates([id_col, own]).drop(own))
