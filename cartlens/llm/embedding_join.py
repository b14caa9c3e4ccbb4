"""Embedding near-duplicates: an exact metric range join on angles.

Vectors belong to the cell of their nearest pivot. Two vectors within the
radius r (the angle of the cosine threshold) can lie in different cells, so a
vector also visits every later cell j that the triangle inequality leaves open:

* its angle to pivot j is at most the cell's covering radius plus r, and
* it exceeds the angle to its own pivot by at most 2 r.

Cells are cut into blocks of bounded size by hash; a block's task holds its own
vectors and streams the visitors past them, so every pair is compared once.
Only link counts and a spanning forest leave a task. In many dimensions few
cells are closed by these bounds unless the data are clustered: the work can
then approach all pairs, in blocks, but never the memory of a task.
"""

from __future__ import annotations

import hashlib
import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_rows, map_texts, staged
from .components import settle, sets_of
from .ngram_join import least_reachable

#: Pivots at most, vectors they are chosen from (smallest hashes), vectors of a
#: block, and visitors of one task about.
MAX_PIVOTS, SAMPLE, BLOCK, VISITORS = 256, 4096, 2048, 1 << 17
#: Slack for rounding in bounds, and the band in which a cosine is taken again.
SLACK, BAND = 1e-6, 1e-9

SET = "sid long, copies long, dim int, vec binary"


def usable(v) -> np.ndarray | None:
    """The vector in double precision; None if null, empty, zero or not finite."""
    if v is None or not len(v) or any(x is None for x in v):
        return None
    x = np.array(v, dtype=np.float64)
    return x if np.isfinite(x).all() and np.any(x) else None


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=-1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=-1, keepdims=True))


def cosine(x: np.ndarray, y: np.ndarray) -> float:
    """The same value on every machine: exactly rounded sums."""
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def farthest_first(x: np.ndarray, k: int) -> np.ndarray:
    """k of the unit vectors, each the farthest from those before it."""
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(k, len(x)):
        at = int(np.argmin(near))
        if near[at] > 1 - 1e-9:
            break
        chosen.append(at)
        near = np.maximum(near, x @ x[at])
    return x[chosen]


def angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1.0, 1.0))


def _vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    from_table = rows.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                             F.col(vec_col).cast("array<double>").alias("v"))

    def run(batches):
        for part in batch_rows(batches):
            found = [usable(v) for v in part.column("v").to_pylist()]
            data = [None if x is None else x.tobytes() for x in found]
            digest = [None if d is None else hashlib.blake2b(d, digest_size=16).digest() for d in data]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row"), pa.array(digest, pa.binary()),
                 pa.array([0 if x is None else len(x) for x in found], pa.int32()), pa.array(data, pa.binary())],
                ["doc_id", "row", "digest", "dim", "vec"])

    kind = from_table.schema["doc_id"].dataType.simpleString()
    return map_texts(from_table, run, f"doc_id {kind}, row long, digest binary, dim int, vec binary")


def _by_dim(part: pa.RecordBatch):
    """(dim, places, unit vectors) of a batch; a table has one dim as a rule."""
    dims = part.column("dim").to_numpy()
    data = part.column("vec").to_pylist()
    for d in np.unique(dims).tolist():
        at = np.flatnonzero(dims == d)
        yield d, at, unit(np.stack([np.frombuffer(data[i], dtype=np.float64) for i in at]))


def choose_pivots(sets: DataFrame, n: int) -> dict[int, np.ndarray]:
    """dim -> pivots, from at most SAMPLE vectors."""
    sample = sets.orderBy(F.xxhash64("sid"), "sid").limit(SAMPLE).select("dim", "vec").collect()
    by: dict[int, list] = {}
    for r in sample:
        by.setdefault(r["dim"], []).append(np.frombuffer(r["vec"], dtype=np.float64))
    k = min(MAX_PIVOTS, -(-n // BLOCK))
    return {d: farthest_first(unit(np.stack(v)), k) for d, v in by.items()}


def assigned(sets: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Sets with their cell and the angle to its pivot (cell 0 and pi where no
    pivot has their dimension)."""

    def run(batches):
        for part in batch_rows(batches, 2048):
            cell, theta = np.zeros(part.num_rows, np.int32), np.full(part.num_rows, math.pi)
            for d, at, x in _by_dim(part):
                if d in pivots:
                    a = angles(x, pivots[d])
                    cell[at] = a.argmin(axis=1)
                    theta[at] = a.min(axis=1)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell), pa.array(theta)],
                                             [*part.schema.names, "cell", "theta"])

    return sets.mapInArrow(run, SET + ", cell int, theta double")


def dealt(sets: DataFrame, pivots: dict, cells: dict, radius: float, splits: int) -> DataFrame:
    """One row per block a vector lives in (visitor 0, once per split of the
    block's visitors) or visits (visitor 1). ``cells``: (dim, cell) -> (first
    block, blocks, covering radius), blocks numbered per dim."""
    slack = SLACK

    def run(batches):
        for part in batch_rows(batches, 512):
            sid, cell = part.column("sid").to_numpy(), part.column("cell").to_numpy()
            theta = part.column("theta").to_numpy()
            src, block, split, visitor = [], [], [], []
            for d, at, x in _by_dim(part):
                known = sorted((c, *v) for (dim, c), v in cells.items() if dim == d)
                number = {c: i for i, (c, *_) in enumerate(known)}
                open_ = np.ones((len(at), len(known)), dtype=bool)
                if d in pivots:
                    a = angles(x, pivots[d][[c for c, *_ in known]])
                    cover = np.array([r for *_, r in known])
                    open_ = (a <= cover + radius + slack) & (a <= theta[at][:, None] + 2 * radius + slack)
                # splitmix-like spread of the row number over blocks and splits
                h = (sid[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                for i, k in enumerate(at.tolist()):
                    c = number[int(cell[k])]
                    first, n = known[c][1], known[c][2]
                    own = first + int(h[i] % np.uint64(n))
                    lane = int((h[i] >> np.uint64(33)) % np.uint64(splits))
                    for s in range(splits):
                        src.append(k), block.append(own), split.append(s), visitor.append(0)
                    visits = [*range(own + 1, first + n)]
                    for j in np.flatnonzero(open_[i, c + 1:]).tolist():
                        _, f, m, _ = known[c + 1 + j]
                        visits += range(f, f + m)
                    src += [k] * len(visits)
                    block += visits
                    split += [lane] * len(visits)
                    visitor += [1] * len(visits)
            rows = part.select(["sid", "copies", "dim", "vec"]).take(pa.array(src, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(block, pa.int32()), pa.array(split, pa.int32()), pa.array(visitor, pa.int32())],
                ["sid", "copies", "dim", "vec", "block", "split", "visitor"])

    return sets.mapInArrow(run, SET + ", block int, split int, visitor int")


def linked_pairs(x: np.ndarray, y: np.ndarray, raw_x, raw_y, threshold: float, same: bool):
    """(i, j) with cosine >= threshold; near the threshold the cosine is taken
    again with exactly rounded sums."""
    g = x @ y.T
    if same:
        g[np.tril_indices(len(x))] = -2
    i, j = np.nonzero(g >= threshold - BAND)
    for k in np.flatnonzero(np.abs(g[i, j] - threshold) <= BAND).tolist():
        g[i[k], j[k]] = cosine(raw_x[i[k]], raw_y[j[k]])
    keep = g[i, j] >= threshold
    return i[keep], j[keep]


def joined(rows: DataFrame, threshold: float) -> DataFrame:
    """Dealt rows -> (sid, root, links) per task and stretch of visitors."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["dim", "block", "split"]
    placed = rows.repartition(n, *key).sortWithinPartitions(*key, "visitor", "sid")

    def stretches(batches):
        for part in batch_rows(batches, 1024):
            dims, blocks, splits, visitors = (part.column(c).to_numpy() for c in (*key, "visitor"))
            change = np.flatnonzero((np.diff(dims) != 0) | (np.diff(blocks) != 0) | (np.diff(splits) != 0)
                                    | (np.diff(visitors) != 0)) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), part.num_rows]):
                if a < b:
                    piece = part.slice(a, b - a)
                    raw = np.stack([np.frombuffer(v, dtype=np.float64) for v in piece.column("vec").to_pylist()])
                    yield ((dims[a], blocks[a], splits[a]), int(visitors[a]), piece.column("sid").to_numpy(),
                           piece.column("copies").to_numpy(), raw)

    def found(sid, copies, i, j):
        links = np.zeros(len(sid), dtype=np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = least_reachable(len(sid), i, j)
        at = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(sid[at]), pa.array(sid[root[at]]), pa.array(links[at])],
                                          ["sid", "root", "links"])

    def run(batches):
        for (_, _, split), group in groupby(stretches(batches), key=lambda s: s[0]):
            home, raw, copies, units = [], [], [], None
            for _, visitor, sid, n_copies, vectors in group:
                if not visitor:
                    home.append(sid), raw.append(vectors), copies.append(n_copies)
                    continue
                if not home:
                    break  # a block without vectors of its own
                if units is None:
                    home, raw, copies = [np.concatenate(home)], [np.concatenate(raw)], [np.concatenate(copies)]
                    units = unit(raw[0])
                i, j = linked_pairs(unit(vectors), units, vectors, raw[0], threshold, False)
                if len(i):
                    at = np.unique(j)  # the visited ones, numbered after the visitors
                    yield found(np.concatenate([sid, home[0][at]]), np.concatenate([n_copies, copies[0][at]]), i,
                                len(sid) + np.searchsorted(at, j))
            if home and split == 0:  # the block's own pairs, in stretches
                sid, vectors, n_copies = np.concatenate(home), np.concatenate(raw), np.concatenate(copies)
                units = unit(vectors)
                for a in range(0, len(sid), 1024):
                    x = slice(a, a + 1024)
                    i, j = linked_pairs(units[x], units[x], vectors[x], vectors[x], threshold, True)
                    if len(i):
                        yield found(sid[x], n_copies[x], i, j)
                    for b in range(a + 1024, len(sid), 1024):
                        y = slice(b, b + 1024)
                        i, j = linked_pairs(units[x], units[y], vectors[x], vectors[y], threshold, False)
                        if len(i):
                            yield found(np.concatenate([sid[x], sid[y]]), np.concatenate([n_copies[x], n_copies[y]]), i,
                                        len(sid[x]) + j)

    return placed.mapInArrow(run, "sid long, root long, links long")


def cosine_join(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id",
                vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Rows link if the cosine of their vectors, in double precision, is at least
    ``threshold`` (greater than 0). ``n_links`` counts the other rows linked
    directly, equal vectors included; ``component_id`` is the smallest vec_id
    (nulls last) reachable by links, itself included; one row of a component,
    with that id, is kept. Vectors that are null, empty, zero or hold null or
    non-finite numbers link with nothing and are kept; so do vectors of
    different dimensions. Null or repeated ids and repeated rows are rows like
    any other; other columns are not read; empty in, empty out.
    """
    radius = math.acos(threshold)
    rows = staged(_vectors(vectors, id_col, vec_col), "vectors")
    good = rows.where("digest IS NOT NULL")
    sets = staged(sets_of(good, ["dim", "vec"], []), "vector_sets")
    n = sets.count()
    plain = sets.select("sid", "copies", "dim", "vec")
    pivots = choose_pivots(plain, max(1, n))
    homes = staged(assigned(plain, pivots), "vector_cells")
    cells, first = {}, {}
    for r in sorted(homes.groupBy("dim", "cell").agg(  # one row per pivot at most
            F.count(F.lit(1)).alias("n"), F.max("theta").alias("r")).collect(), key=lambda r: (r["dim"], r["cell"])):
        blocks = -(-r["n"] // BLOCK)
        cells[r["dim"], r["cell"]] = (first.get(r["dim"], 0), blocks, r["r"])
        first[r["dim"]] = first.get(r["dim"], 0) + blocks
    links = staged(joined(dealt(homes, pivots, cells, radius, max(1, -(-n // VISITORS))), threshold), "vector_links")
    settled = settle(good.drop("vec", "dim"), sets, links)
    alone = rows.where("digest IS NULL").select(F.col("doc_id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                                                F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return settled.select(F.col("doc_id").alias("vec_id"), "n_links", F.col("class_id").alias("component_id"),
                          "kept").unionByName(alone)
