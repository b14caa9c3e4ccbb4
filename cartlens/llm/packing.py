"""Packing into optimal length buckets and token-budget batches.

The global length histogram decides the bucket bounds: a dynamic program finds
the bounds that pad least. Inside each bucket, rows form batches whose padded
size stays within the token budget. Row numbers come from per-cell counts, so
a bucket that holds a third of all rows is never ordered in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import staged

#: Length buckets, tokens of a batch, and the step lengths are rounded up to
#: before the dynamic program sees them (1: exact lengths; hardware may want more).
BUCKETS, TOKEN_BUDGET, STEP = 16, 65_536, 1
#: Rows of a bucket that one task numbers, about.
CELL_ROWS = 20_000


def optimal_bounds(lengths, counts, k: int) -> list[int]:
    """Upper bounds (inclusive, ascending, the last is the greatest length) of at
    most ``k`` buckets with the least total padding. ``lengths`` ascend. The cost
    satisfies the quadrangle inequality, so each layer is solved by divide and
    conquer over the split points: O(k D log D) for D lengths."""
    x = np.asarray(lengths, dtype=np.float64)
    c = np.concatenate([[0.0], np.cumsum(np.asarray(counts, dtype=np.float64))])
    s = np.concatenate([[0.0], np.cumsum(x * np.asarray(counts, dtype=np.float64))])
    d = len(x)
    if not d:
        return []

    def cost(i, j):  # lengths i..j-1 padded to x[j-1]
        return x[j - 1] * (c[j] - c[i]) - (s[j] - s[i])

    best = np.full(d + 1, np.inf)
    best[0] = 0.0
    froms = []
    for _ in range(min(k, d)):
        new, cut = np.full(d + 1, np.inf), np.zeros(d + 1, dtype=np.int64)
        new[0] = 0.0
        todo = [(1, d, 0, d - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(a, min(b, mid - 1) + 1)
            total = best[i] + cost(i, mid)
            at = int(np.argmin(total))
            new[mid], cut[mid] = total[at], i[at]
            todo += [(lo, mid - 1, a, int(i[at])), (mid + 1, hi, int(i[at]), b)]
        best = new
        froms.append(cut)
    bounds, j = [], d
    for cut in reversed(froms):
        if j == 0:
            break
        bounds.append(int(x[j - 1]))
        j = int(cut[j])
    return bounds[::-1]


def pack(lengths: DataFrame, n_buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET,
         step: int = STEP, seed: int = 17) -> DataFrame:
    """(doc_id, length) -> (doc_id, length, bucket, bucket_length, batch, slot).

    Every row lands in the first bucket whose ``bucket_length`` holds it; a
    batch is at most max(1, token_budget // bucket_length) rows, numbered per
    bucket from 0, all full but the last. Rows of a bucket come in a seeded
    random order. A null length counts as 0; length 0 rows pad to one step so
    that batches stay bounded. A text longer than the budget is a batch of its
    own (whole, never cut). Null or repeated ids are rows like any other.
    Empty in, empty out. The histogram, one row per rounded length, is what
    reaches the driver: at most (longest text / step) rows.
    """
    rows = staged(lengths.select(
        "doc_id", F.greatest(F.coalesce(F.col("length").cast("long"), F.lit(0)), F.lit(0)).alias("length"),
        F.greatest(F.ceil(F.coalesce(F.col("length"), F.lit(0)) / step) * step, F.lit(step))
        .cast("long").alias("padded"),
        F.xxhash64(F.lit(seed), "doc_id", F.monotonically_increasing_id()).alias("key")), "packing_rows")
    hist = rows.groupBy("padded").agg(F.count(F.lit(1)).alias("n")).orderBy("padded").collect()
    bounds = optimal_bounds([r["padded"] for r in hist], [r["n"] for r in hist], n_buckets)
    sizes = np.zeros(len(bounds) + 1, dtype=np.int64)
    for r in hist:
        sizes[int(np.searchsorted(bounds, r["padded"]))] += r["n"]
    bucket, length, cells = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("long")
    for b in reversed(range(len(bounds))):
        here = F.col("padded") <= bounds[b]
        bucket = F.when(here, F.lit(b)).otherwise(bucket)
        length = F.when(here, F.lit(bounds[b]).cast("long")).otherwise(length)
        cells = F.when(here, F.lit(int(-(-sizes[b] // CELL_ROWS))).cast("long")).otherwise(cells)
    celled = (rows.withColumn("bucket", bucket).withColumn("bucket_length", length)
              .withColumn("cell", F.pmod(F.col("key"), cells)))
    counts = celled.groupBy("bucket", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("bucket").orderBy("cell")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("bucket", "cell").orderBy("key", "doc_id")) - 1
    capacity = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("bucket_length")))
    return (celled.withColumn("place", place).join(before, ["bucket", "cell"])
            .withColumn("rank", F.col("place") + F.col("before"))
            .select("doc_id", "length", "bucket", "bucket_length",
                    F.floor(F.col("rank") / capacity).cast("long").alias("batch"),
                    F.pmod(F.col("rank"), capacity).cast("long").alias("slot")))


def word_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, length): words between white space, whole texts."""
    text = F.trim(F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"\s+", " "))
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.when(text == "", F.lit(0)).otherwise(
                           F.length(text) - F.length(F.translate(text, " ", "")) + 1).cast("long").alias("length"))
