"""Vector code compression: a codebook per part of the vector, learned by
member-resident Lloyd rounds.

Vectors are cut into consecutive parts; each part row lives with its owner, the
bucket of (position, entry, salt) in a bucketed table. An owner sums its resident
members without any exchange, and the sums of the salts of an entry are added up.
After an update the owners assign their members anew: those that keep their entry
stay where they are, and only those that change it take part in the next shuffle,
to their new owner. The salts (a hash of the row number) are as many as keep an
owner at ``SALT_ROWS`` rows if all rows had one entry, so that no entry is too
large for a task, however many rows it holds.

All arithmetic is on integers: floor(scale * component), exact squared distances,
floor means. The result does not depend on the layout of the input.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import remove_shared
from .common import new_path, staged

#: Parts of a vector, entries of a codebook, rounds, and what a component is multiplied by.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Integers saturate at this size, so that sums of squares stay exact.
LIMIT = 1 << 26
#: Rows of one entry that share a salt, and part rows of a bucket on the average.
SALT_ROWS, BUCKET_ROWS = 512, 1 << 17
#: Vectors whose distances are computed at a time.
CHUNK = 2048

OWNER = ["position", "entry", "salt"]


class Codebooks(NamedTuple):
    """``entries``: per position an int64 array (entry, component); ``dim``: the
    length of the vectors; ``moved``: part rows that changed owner, per later round."""

    entries: list
    dim: int
    moved: list

    @property
    def sha256(self) -> str:
        """SHA-256 (lowercase hex) of all components as decimals, joined by commas, by
        position, entry and place."""
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel().tolist()).encode()).hexdigest()


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str | None = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, row, v): each component as floor(scale * x), saturated at
    +-LIMIT. Rows without a vector, with an empty one, or with a null or
    non-finite component are left out."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    return (vectors.where(F.coalesce(finite & (F.size(x) > 0), F.lit(False)))
            .select(F.col(id_col).alias("vec_id"), label.alias("label"),
                    F.monotonically_increasing_id().alias("row"), whole.alias("v")))


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each row of ``x``: the nearest entry, ties to the
    lower index. Exact: in doubles while all sums stay below 2^53, else in int64."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)), 1)
    kind = np.float64 if 4 * x.shape[1] * top * top < 1 << 53 else np.int64
    x, c = x.astype(kind), entries.astype(kind)
    d = (c * c).sum(1) - 2 * (x @ c.T)
    best = d.argmin(1)
    return best, (d[np.arange(len(x)), best] + (x * x).sum(1)).astype(np.int64)


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _cut(x: np.ndarray, dim: int, parts: int) -> list[np.ndarray]:
    """The parts of each row; the last one is padded with zeros if need be."""
    width = -(-dim // parts)
    x = np.pad(x.astype(np.int64), ((0, 0), (0, width * parts - dim)))
    return [x[:, p * width:(p + 1) * width] for p in range(parts)]


def _chunks(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            yield batch.slice(start, CHUNK)


class _Layer:
    """A bucketed table in the shared folder, so that a scan knows where the rows of
    an owner lie."""

    def __init__(self, rows: DataFrame, buckets: int):
        self.spark = rows.sparkSession
        self.path, self.name = new_path(self.spark, "vector_members"), f"vector_members_{uuid.uuid4().hex}"
        rows.write.format("parquet").bucketBy(buckets, *OWNER).option("path", self.path).saveAsTable(self.name)

    @property
    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_shared(self.spark, self.path)


def _first_owners(vectors: DataFrame, entries: list, dim: int, salts: int) -> DataFrame:
    """One row per part: (row, position, entry, salt, c0, c1, ...)."""
    width, parts = entries[0].shape[1], len(entries)
    sent = vectors.sparkSession.sparkContext.broadcast(entries)  # parts * entries * width integers
    names = ["row", *OWNER, *(f"c{i}" for i in range(width))]

    def run(batches):
        for batch in _chunks(batches):
            row, salt = batch.column("row"), batch.column("salt")
            for position, x in enumerate(_cut(_matrix(batch.column("v")), dim, parts)):
                entry, _ = nearest(x, sent.value[position])
                yield pa.RecordBatch.from_arrays(
                    [row, pa.array(np.full(len(x), position, np.int32)), pa.array(entry.astype(np.int32)), salt,
                     *(pa.array(x[:, i].astype(np.int32)) for i in range(width))], names)

    salted = vectors.select("row", "v", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt"))
    return salted.mapInArrow(run, "row long, position int, entry int, salt int"
                             + "".join(f", c{i} int" for i in range(width)))


def _assigned(members: DataFrame, entries: list) -> DataFrame:
    """``members`` with ``next``: the nearest entry now."""
    width = entries[0].shape[1]
    sent = members.sparkSession.sparkContext.broadcast(entries)  # parts * entries * width integers

    def run(batches):
        for batch in _chunks(batches):
            position = batch.column("position").to_numpy()
            x = np.stack([batch.column(f"c{i}").to_numpy() for i in range(width)], 1).astype(np.int64)
            to = np.empty(len(x), np.int32)
            for p in np.unique(position):
                here = position == p
                to[here], _ = nearest(x[here], sent.value[p])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to)], [*batch.schema.names, "next"])

    return members.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema) + ", next int")


def member_sums(members: list[DataFrame]) -> DataFrame:
    """(position, entry, n, c0, c1, ...) of the tables of ``members``: each owner sums
    its residents where they lie (a bucketed scan, no exchange), then the owners of an
    entry are added up, one row per entry and task."""
    places = [c for c in members[0].columns if c[0] == "c"]
    per_owner = [m.groupBy(*OWNER).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in places])
                 for m in members]
    return (reduce(DataFrame.unionByName, per_owner).groupBy("position", "entry")
            .agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in places]))


def _updated(entries: list, sums: DataFrame) -> list:
    """Each entry becomes the floor of its members' mean; one without members stays.
    At most parts * entries rows reach the driver."""
    new = [e.copy() for e in entries]
    for r in sums.collect():
        new[r["position"]][r["entry"]] = [r[f"c{i}"] // r["n"] for i in range(new[0].shape[1])]
    return new


def learn_codebooks(vectors: DataFrame, parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks of ``integer_vectors`` after ``rounds`` Lloyd rounds from the
    vectors of the smallest ``n_entries`` ids (null ids last, ties by the vector).

    The smallest id's vector sets the length; vectors of another length are left
    out. Fewer vectors than entries make smaller codebooks; no vectors make empty
    ones. ``vectors`` is read several times: pass a written table.
    """
    spark = vectors.sparkSession
    order = [F.col("vec_id").asc_nulls_last(), "v"]
    smallest = vectors.orderBy(*order).select(F.size("v").alias("dim")).first()
    dim = smallest["dim"] if smallest else 0
    if not dim:
        return Codebooks([np.zeros((0, 0), np.int64)] * parts, 0, [])
    alike = vectors.where(F.size("v") == dim)
    start = np.array([r["v"] for r in alike.orderBy(*order).select("v").limit(n_entries).collect()], dtype=np.int64)
    entries = [x.copy() for x in _cut(start, dim, parts)]
    n = alike.count()
    salts, buckets = -(-n // SALT_ROWS), max(8, -(-n * parts // BUCKET_ROWS))

    def settle(rows):  # the shuffle to the owners
        return _Layer(rows.repartition(buckets, *OWNER), buckets)

    moved: list[int] = []
    layers = [settle(_first_owners(alike, entries, dim, salts))] if rounds else []
    members = [layer.rows for layer in layers]
    for k in range(rounds):
        if k:
            kept = _Layer(_assigned(reduce(DataFrame.unionByName, members), entries), buckets)  # written where it was read: no exchange
            gone = kept.rows.where(F.col("next") != F.col("entry")).withColumn("entry", F.col("next")).drop("next")
            came = settle(gone)
            for layer in layers:
                layer.drop()
            layers = [kept, came]
            moved.append(came.rows.count())
            members = [kept.rows.where(F.col("next") == F.col("entry")).drop("next"), came.rows]
        entries = _updated(entries, member_sums(members))
    for layer in layers:
        layer.drop()
    return Codebooks(entries, dim, moved)


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error), one row per vector of the codebooks' length:
    ``code`` holds each part's nearest entry as two hex digits (more for codebooks
    of over 256 entries), ``error`` the squared distances summed over the parts."""
    rows = vectors.select("vec_id", "label", "v").where(F.size("v") == books.dim)
    sent = vectors.sparkSession.sparkContext.broadcast(books.entries)  # parts * entries * width integers
    dim, digits = books.dim, max(2, len(f"{max(len(books.entries[0]) - 1, 0):x}"))

    def run(batches):
        for batch in _chunks(batches):
            if not batch.num_rows:
                continue
            found = [nearest(x, e) for x, e in zip(_cut(_matrix(batch.column("v")), dim, len(sent.value)), sent.value)]
            codes = ["".join(f"{k:0{digits}x}" for k in code) for code in zip(*(f[0].tolist() for f in found))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()),
                 pa.array(sum(f[1] for f in found), pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
             scale: int = SCALE, parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256), one row per kept vector.

    Null and empty vectors, and vectors with a null or non-finite component, are
    left out, as are vectors of another length than the smallest id's. Repeated
    rows each get their code, ids may be null or repeat, ties go to the lower
    entry; ``label_error`` sums ``error`` over equal labels, nulls together. Other
    columns, whatever their names, are not read; empty in, empty out.
    """
    spark: SparkSession = vectors.sparkSession
    whole = staged(integer_vectors(vectors, id_col, vector_col, label_col, scale), "vector_integers")
    books = learn_codebooks(whole, parts, n_entries, rounds)
    codes = staged(encode(whole, books), "vector_codes")
    totals = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return (codes.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
            .withColumn("codebooks_sha256", F.lit(books.sha256)))
