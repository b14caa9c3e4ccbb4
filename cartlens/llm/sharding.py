"""Sharding by a two-pass external shuffle.

Pass 1 scatters every row into a memory-sized bucket by a seeded hash of its id
and place in the input. Pass 2 Fisher-Yates-shuffles each bucket in one task
and writes it. A bucket's place in the whole order is the number of rows in the
buckets before it, so the buckets laid end to end are one uniform random order;
shards are equal slices of that order.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import new_path, staged, text_or_empty, with_offsets

#: Bytes of text a bucket holds on average; a task holds one bucket in memory.
BUCKET_BYTES = 16 << 20


def fisher_yates(n: int, rng: np.random.Generator) -> list[int]:
    """A uniform random order of range(n)."""
    order = list(range(n))
    draws = rng.random(n).tolist()
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return order


def shard_documents(docs: DataFrame, n_shards: int, path: str | None = None, seed: int = 17,
                    bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Write (doc_id, text, slot) under ``path``/shard=k and return the written
    table with its ``shard`` column.

    Law ``rows``: shard counts differ by at most one; ``slot`` runs gapless from
    0 in each shard. The order depends on the seed and on the input's rows and
    file layout, so ``docs`` should be a stored table. Null ids and texts,
    empty texts and repeated rows are rows like any other (nulls stay null);
    the place in the input spreads repeated rows over all buckets. An empty
    table writes no shard; other columns are not read.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    spark = docs.sparkSession
    path = path or new_path(spark, "shards")
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .withColumn("key", F.xxhash64(F.lit(seed), F.col("doc_id"), F.monotonically_increasing_id()))
    total = keyed.agg(F.sum(F.octet_length(text_or_empty("text")) + 8).alias("b"),
                      F.count(F.lit(1)).alias("n")).first()
    n_rows, n_buckets = total["n"], max(1, math.ceil((total["b"] or 0) / bucket_bytes))
    bucketed = keyed.withColumn("bucket", F.pmod(F.col("key"), F.lit(n_buckets)))
    counts = bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = staged(with_offsets(counts, "bucket", "n"), "bucket_offsets")

    def permute(pdf: pd.DataFrame) -> pd.DataFrame:
        n, offset, bucket = len(pdf), int(pdf["offset"].iat[0]), int(pdf["bucket"].iat[0])
        if n != int(pdf["n"].iat[0]):
            raise RuntimeError("the input changed between the two passes")
        pdf = pdf.sort_values("key", kind="stable")
        pdf = pdf.iloc[fisher_yates(n, np.random.default_rng([seed, bucket]))]
        position = offset + np.arange(n, dtype=np.int64)
        shard = position * n_shards // n_rows
        first = -(-shard * n_rows // n_shards)
        return pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "text": pdf["text"].to_numpy(),
                             "slot": position - first, "shard": shard.astype("int32")})

    id_type = keyed.schema["doc_id"].dataType.simpleString()
    out = (bucketed.join(offsets, "bucket").groupBy("bucket")
           .applyInPandas(permute, f"doc_id {id_type}, text string, slot long, shard int"))
    out.write.partitionBy("shard").parquet(path)
    return spark.read.schema(out.schema).parquet(path)
