"""N-gram Jaccard join: a MinHash LSH forest with exact verification.

Documents with the same shingle set are one *set*; a set has one label per tree,
``DEPTH`` min-hashes of two bytes. All labels of a tree, sorted, are its prefix
trie: sets that share a prefix are neighbours in that order. The matched depth t
is the same for every set, fixed in advance: the longest of at most ``DEPTH`` at
which the recall at the threshold, 1 - (1 - s^t)^trees, reaches the target; sets
next to each other that share that much are joined, and connected runs over all
trees are the candidate groups. The order is cut by
range partitions of equal size, so no bucket, however full, lies in one task.

Groups are verified exactly, every pair once: big groups are cut into cells by
set size and hash, and pairs of cells are compared in tasks of bounded size.
Only link counts and a spanning forest leave a task, never all pairs.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import batch_rows, free_names, map_texts, staged
from .components import components, least_reachable, settle, sets_of
from .shingles import mix, shingle_set

#: Trees, min-hashes of a label, and the recall wanted for a pair at the threshold.
TREES, DEPTH, RECALL = 20, 6, 0.9999
#: Shingles and sets of a cell: a verifying task holds two cells.
CELL_SHINGLES, CELL_SETS = 1 << 17, 512


def prefix_length(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold is found with ``recall``."""
    t = depth
    while t > 1 and 1 - (1 - threshold ** t) ** trees < recall:
        t -= 1
    return t


def labels_of(shingles: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[bytes]:
    """One label per tree: ``depth`` min-hashes, two bytes each."""
    k = trees * depth
    a = mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)
    b = mix(a)
    least = np.full(k, np.iinfo(np.uint64).max, dtype=np.uint64)
    step = max(1, (1 << 17) // k)
    for at in range(0, len(shingles), step):
        part = a[:, None] * shingles[None, at:at + step] + b[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    two = (mix(least) >> np.uint64(48)).astype(">u2").tobytes()
    return [two[i:i + 2 * depth] for i in range(0, len(two), 2 * depth)]


def _signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("thash", F.xxhash64("text"))

    def run(batches):
        for part in batch_rows(batches):
            digests, sizes, labels = [], [], []
            for text in part.column("text").to_pylist():
                s = shingle_set(text)
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sizes.append(len(s))
                labels.append(labels_of(s) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("row"), part.column("thash"), pa.array(digests, pa.binary()),
                 pa.array(sizes, pa.int32()), pa.array(labels, pa.list_(pa.binary()))],
                ["doc_id", "row", "thash", "digest", "size", "labels"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, run, f"doc_id {kind}, row long, thash long, digest binary, size int, labels array<binary>")


def candidate_edges(sets: DataFrame, length: int) -> DataFrame:
    """(sid, labels) -> (u, v): sets next to each other in a tree's sorted order
    whose labels share ``length`` min-hashes."""
    nodes = sets.select("sid", F.posexplode("labels").alias("tree", "label"))
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (nodes.repartitionByRange(n, "tree", "label", "sid").sortWithinPartitions("tree", "label", "sid"))
    width = 2 * length

    def run(batches):
        last = first = None
        for part in batches:
            if not part.num_rows:
                continue
            sid = part.column("sid").to_numpy()
            tree = part.column("tree").to_numpy()
            label = part.column("label").to_pylist()
            prefix = [x[:width] for x in label]
            same = [prefix[i] == prefix[i - 1] and tree[i] == tree[i - 1] for i in range(1, len(sid))]
            at = np.flatnonzero(same)
            u, v = sid[at], sid[at + 1]
            if last is not None and last[0] == tree[0] and last[1] == prefix[0]:
                u, v = np.append(u, last[2]), np.append(v, sid[0])
            if first is None:
                first = (int(tree[0]), prefix[0], int(sid[0]))
            last = (int(tree[-1]), prefix[-1], int(sid[-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.nulls(len(u), pa.int32()),
                 pa.nulls(len(u), pa.int32()), pa.nulls(len(u), pa.binary()), pa.nulls(len(u), pa.int32()),
                 pa.nulls(len(u), pa.binary())], ["u", "v", "part", "tree1", "label1", "tree2", "label2"])
        if first is not None:  # the rims, to join partitions
            yield pa.RecordBatch.from_arrays(
                [pa.array([first[2]], pa.int64()), pa.array([last[2]], pa.int64()),
                 pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([first[0]], pa.int32()),
                 pa.array([first[1]], pa.binary()), pa.array([last[0]], pa.int32()), pa.array([last[1]], pa.binary())],
                ["u", "v", "part", "tree1", "label1", "tree2", "label2"])

    found = staged(ordered.mapInArrow(run, "u long, v long, part int, tree1 int, label1 binary, tree2 int, label2 binary"),
                   "trie_edges")
    inner = found.where("part IS NULL").select("u", "v").distinct()
    order = Window.orderBy("part")  # one row per partition
    rims = (found.where("part IS NOT NULL")
            .select("u", "tree1", "label1", F.lag("v").over(order).alias("v"), F.lag("tree2").over(order).alias("t"),
                    F.lag("label2").over(order).alias("l"))
            .where("v IS NOT NULL AND t = tree1 AND l = label1").select("u", "v"))
    return inner.unionByName(rims)


def compare(shingles: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: Fraction):
    """(i, j) of the pairs left x right (places in ``shingles``; upper triangle if
    they are the same) with Jaccard similarity >= threshold, exactly."""
    size = np.array([len(s) for s in shingles], dtype=np.int64)
    owner = np.repeat(np.arange(len(shingles)), size)
    _, column, count = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], number[column[use]]
    n, step = int(shared.sum()), 4096
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    inter = np.zeros((len(left), len(right)), dtype=np.float32)
    cuts = np.searchsorted(column, np.arange(0, n + step, step))
    for k in range(len(cuts) - 1):
        lo, hi = cuts[k], cuts[k + 1]
        x = np.zeros((len(shingles), min(step, n - k * step)), dtype=np.float32)
        x[owner[lo:hi], column[lo:hi] - k * step] = 1
        inter += x[left] @ x[right].T
    inter = np.rint(inter).astype(np.int64)
    union = size[left][:, None] + size[right][None, :] - inter
    linked = (inter * threshold.denominator >= union * threshold.numerator) & (inter > 0)
    if left is right:
        linked = np.triu(linked, 1)
    i, j = np.nonzero(linked)
    return left[i], right[j]


def verified(members: DataFrame, docs: DataFrame, id_col: str, text_col: str, threshold: Fraction) -> DataFrame:
    """(sid, group, doc_id, thash, size, copies) -> (sid, root, links): per set and
    pair of cells, the smallest set it reaches there and its links to rows."""
    growth = math.log(1 / float(threshold))
    total = members.groupBy("group").agg(F.count(F.lit(1)).alias("g_sets"), F.sum("size").alias("g_shingles"))
    whole = (F.col("g_sets") <= CELL_SETS) & (F.col("g_shingles") <= CELL_SHINGLES)
    # similar sets differ in size by at most one step of 1 / threshold
    level = F.when(whole, F.lit(0)).otherwise(F.floor(F.log(F.col("size")) / growth).cast("int"))
    members = members.join(total, "group").withColumn("level", level).drop("g_sets", "g_shingles")
    members = staged(members, "join_members")
    cells = members.groupBy("group", "level").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / CELL_SETS), F.ceil(F.sum("size") / CELL_SHINGLES)).cast("int").alias("n"))
    above = cells.select("group", (F.col("level") - 1).alias("level"), F.col("n").alias("n_above"))
    below = cells.select("group", (F.col("level") + 1).alias("level"), F.col("n").alias("n_below"))
    cells = cells.join(above, ["group", "level"], "left").join(below, ["group", "level"], "left")

    def cell(lvl, k):
        return lvl.cast("long") * (1 << 32) + k.cast("long")

    own = F.pmod(F.xxhash64("sid"), F.col("n")).cast("int")

    def meet(n, make):
        some = F.coalesce(n, F.lit(0))
        return F.when(some > 0, F.transform(F.sequence(F.lit(0), F.greatest(some - 1, F.lit(0))), make)).otherwise(
            F.array().cast("array<struct<a: bigint, b: bigint>>"))

    lvl, k = F.col("level"), F.col("own")
    pairs = F.concat(
        meet(F.col("n"), lambda s: F.struct(cell(lvl, F.least(s, k)).alias("a"), cell(lvl, F.greatest(s, k)).alias("b"))),
        meet(F.col("n_above"), lambda s: F.struct(cell(lvl, k).alias("a"), cell(lvl + 1, s).alias("b"))),
        meet(F.col("n_below"), lambda s: F.struct(cell(lvl - 1, s).alias("a"), cell(lvl, k).alias("b"))))
    placed = (members.join(cells, ["group", "level"]).withColumn("own", own)
              .select("sid", "group", "doc_id", "thash", "copies", cell(lvl, k).alias("cell"), pairs.alias("pairs")))
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"),
                        F.xxhash64(F.col(text_col).cast("string")).alias("__hash"))
    found = (placed.join(texts, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("thash") == F.col("__hash")))
             .select("sid", "group", "copies", "cell", "pairs", "text"))

    def shingle(batches):
        for part in batch_rows(batches):
            sets = [shingle_set(t).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("sid", "group", "copies", "cell", "pairs")),
                                              pa.array(sets, pa.binary())],
                                             ["sid", "group", "copies", "cell", "pairs", "shingles"])

    pair_type = "array<struct<a: bigint, b: bigint>>"
    sets = map_texts(found, shingle, f"sid long, group long, copies long, cell long, pairs {pair_type}, shingles binary")
    dealt = sets.select("sid", "group", "copies", "cell", "shingles", F.explode("pairs").alias("p")).select(
        "sid", "group", "copies", "cell", "shingles", "p.a", "p.b")
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "group", "a", "b").sortWithinPartitions("group", "a", "b", "sid")

    def rows(batches):
        for part in batch_rows(batches):
            cols = [part.column(c).to_pylist() for c in ("group", "a", "b", "sid", "copies", "cell", "shingles")]
            yield from zip(*cols)

    def run(batches):
        out: list[tuple[int, int, int]] = []
        for (_, a, b), group in groupby(rows(batches), key=lambda r: r[:3]):
            sid, copies, cells, sets = [], [], [], []
            for r in group:
                if not sid or sid[-1] != r[3]:  # a repeated row reads its text again
                    sid.append(r[3])
                    copies.append(r[4])
                    cells.append(r[5])
                    sets.append(np.frombuffer(r[6], dtype=np.uint64))
            if len(sid) < 2:
                continue
            place = np.array(cells)
            left = np.flatnonzero(place == a)
            right = left if a == b else np.flatnonzero(place == b)
            if not len(left) or not len(right):
                continue
            i, j = compare(sets, left, right, threshold)
            if len(i):
                weight = np.array(copies, dtype=np.int64)
                links = np.zeros(len(sid), dtype=np.int64)
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                root = least_reachable(len(sid), i, j)
                out += [(sid[k], sid[root[k]], int(links[k])) for k in np.flatnonzero(links).tolist()]
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["sid", "root", "links"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["sid", "root", "links"])

    return dealt.mapInArrow(run, "sid long, root long, links long")


def jaccard_join(docs: DataFrame, threshold: float = 0.8, recall: float = RECALL, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, thash, class_id, n_links, kept), one row per input row.

    Rows link if the Jaccard similarity of their five-word shingle sets is at
    least ``threshold``. ``n_links`` counts the other rows a row links with,
    equal ones included; ``class_id`` is the smallest doc_id (nulls last) of the
    rows it reaches by links, itself included; one row of each class, with that
    id, is kept. ``thash``: xxhash64 of the text, to find the row again.

    A linked pair is missed with a probability of at most 1 - recall at the
    threshold (less above it, and less where other links join both). Texts of
    one to four words have one shingle; null texts and texts without words link
    with nothing and are kept. Null and repeated ids and repeated rows are rows
    like any other; other columns are not read; empty in, empty out.
    """
    limit = Fraction(threshold).limit_denominator(10_000)
    rows = staged(_signatures(docs, id_col, text_col), "signatures")
    sets = staged(sets_of(rows.where("digest IS NOT NULL"), ["size", "labels"], ["thash"]), "shingle_sets")

    groups = components(candidate_edges(sets, prefix_length(threshold, recall=recall)))
    members = (sets.join(groups, sets["sid"] == groups["id"])
               .select("sid", F.col("root").alias("group"), "keeper.doc_id", "keeper.thash", "size", "copies"))
    links = staged(verified(members, docs, id_col, text_col, limit), "jaccard_links")
    with_words = settle(rows.where("digest IS NOT NULL").drop("labels", "size"), sets, links)
    without = rows.where("digest IS NULL").select("doc_id", "thash", F.col("doc_id").alias("class_id"),
                                                  F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"))
    return with_words.select(*without.columns).unionByName(without)


def drop_near_copies(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns under any names: one of each class,
    the smallest id (null ids last). Null texts and texts without words stay; rows
    repeated with id and text come once, those without words too; empty in, empty out."""
    own, other_id, other = free_names(docs, "own_hash", "alive_id", "alive_hash")
    alive = (jaccard_join(docs, threshold, id_col=id_col, text_col=text_col).where("kept")
             .select(F.col("doc_id").alias(other_id), F.coalesce("thash", F.lit(0)).alias(other)))
    rows = docs.withColumn(own, F.coalesce(F.xxhash64(F.col(text_col).cast("string")), F.lit(0)))
    return (rows.join(alive, F.col(id_col).eqNullSafe(F.col(other_id)) & (F.col(own) == F.col(other)), "left_semi")
            .dropDuplicates([id_col, own]).drop(own))
