"""Classes of linked rows: equal rows as one set, connected components of sets
by alternating large-star and small-star rounds, and the way back to the rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import staged

#: Parts that the rows of one set and the sets of one class are dealt to.
RUNS = 64
#: Edges at most that one task finishes; more go through the rounds.
FEW_EDGES = 1 << 16


def least_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of places 0 to n - 1 the least that each reaches by the links i - j."""
    root = np.arange(n)
    while True:
        now = root.copy()
        np.minimum.at(now, i, root[j])
        np.minimum.at(now, j, root[i])
        now = now[now]
        if (now == root).all():
            return root
        root = now


def _in_one_task(edges: DataFrame) -> DataFrame:
    """``components`` of at most FEW_EDGES edges (u, v)."""

    def run(batches):
        parts = [(part.column("u").to_numpy(), part.column("v").to_numpy()) for part in batches if part.num_rows]
        if parts:
            u, v = map(np.concatenate, zip(*parts))
            ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
            root = ids[least_reachable(len(ids), at[:len(u)], at[len(u):])]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(root, pa.int64())], ["id", "root"])

    return edges.coalesce(1).mapInArrow(run, "id long, root long")


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Edges (u, v) of long ids -> (id, root): the smallest id each id reaches.

    Only ids with an edge to another id appear. Each round shortens the trees
    (O(log^2 n) rounds); minima are taken with map-side partial aggregates, and
    the joins' hot ids are split by adaptive execution. Every round is written
    to the shared folder; only a count and a checksum reach the driver. At most
    FEW_EDGES edges, from the start or after a round, are finished in one task:
    rounds over so little are all plans and threads of the driver's. Null
    ends and self loops are left out; no edges give an empty result.
    """
    known = edges.where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v)))
    now = staged(known.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if mark["n"] == 0 or (mark["n"], mark["x"]) == seen:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
        if mark["n"] <= FEW_EDGES:
            return staged(_in_one_task(now), "few_edges")
        seen = (mark["n"], mark["x"])
        # large star: every greater neighbour moves to the smallest neighbour
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # ... and each id keeps its own way to the smallest neighbour
        large = large.unionByName(least.where(F.col("m") < F.col("u")).select("u", F.col("m").alias("v"))).distinct()
        large = staged(large, "large_star")
        # small star: every smaller neighbour moves to the smallest one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        now = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small_star")


def sets_of(rows: DataFrame, values: list[str], keep: list[str]) -> DataFrame:
    """(doc_id, row, digest, ...) -> one row per digest: (digest, keeper, copies,
    sid, *values). ``keeper`` is the row of the smallest id (nulls last) with the
    columns ``keep``; ``sid`` its row number. Two steps, so that a digest of a
    third of all rows reaches the second with at most RUNS rows."""
    keeper = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", *keep)
    least = [F.min(c).alias(c) for c in ("keeper", *values)]
    return (rows.select("digest", F.pmod("row", F.lit(RUNS)).alias("run"), keeper.alias("keeper"), *values)
            .groupBy("run", "digest").agg(F.count(F.lit(1)).alias("copies"), *least)
            .groupBy("digest").agg(F.sum("copies").alias("copies"), *least)
            .withColumn("sid", F.col("keeper.row")))


def settle(rows: DataFrame, sets: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with (class_id, n_links, kept) from links (sid, root, links)
    between sets: the smallest id of the class, the other rows linked to, and
    whether this row has that id. Sets of a class and rows of a set travel in
    RUNS parts."""
    classes = components(links, "sid", "root")
    counts = links.groupBy("sid").agg(F.sum("links").alias("links"))
    tied = staged(sets.select("sid", "digest", "keeper", "copies")
                  .join(classes.withColumnRenamed("id", "sid"), "sid", "left").join(counts, "sid", "left")
                  .select("digest", "keeper", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                          F.coalesce("root", "sid").alias("root"), F.pmod("sid", F.lit(RUNS)).alias("part")), "set_classes")
    best = (tied.groupBy("root", "part").agg(F.min("keeper").alias("best"))
            .groupBy("root").agg(F.min("best").alias("best"), F.collect_set("part").alias("parts")))
    best = best.select("root", "best", F.explode("parts").alias("part"))
    by_set = tied.join(best, ["root", "part"]).select(
        "digest", "best", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    dealt = rows.withColumn("run", F.pmod("row", F.lit(RUNS)))
    by_part = dealt.select("digest", "run").distinct().join(by_set, "digest")
    return (dealt.join(by_part, ["run", "digest"])
            .withColumn("class_id", F.col("best.doc_id")).withColumn("kept", F.col("row") == F.col("best.row"))
            .drop("run", "best"))
