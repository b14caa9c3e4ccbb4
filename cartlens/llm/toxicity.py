"""Toxicity by nearest labelled examples.

A bounded sample of labelled documents becomes TF-IDF vectors over all its terms;
document frequencies come from all documents, and a term weighs more the more its
presence goes with the label (phi coefficient on that sample). A term is known by a
64-bit hash. The vectors are kept as an inverted index cut into small blocks of
examples that are alike: rare terms as postings, the most frequent terms as one
matrix per block with the greatest weight of each term in it.

Documents are searched in batches. The rare terms, whose weights are the greatest,
come first; the block maxima of the others then bound what an example of a block
can reach. The blocks of the greatest bounds are opened, and after them only those
whose bound reaches the k-th similarity found. The candidates' cosines are summed
once more in double precision. Votes weighted by similarity, put through a logistic
curve, are the score; the curve is fitted on a fifth of the examples with an index
that has seen neither their texts nor their labels.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import shingles
from .common import batch_rows, map_texts, staged

#: Labelled documents an index holds at most (those with the smallest hashes), and
#: terms of theirs together; the weight of a term that says nothing about the label.
MAX_EXAMPLES, MAX_POSTINGS, FLOOR = 8192, 8_000_000, 0.02
#: A word of more bytes also counts as its stem, so many bytes.
STEM = 6
#: Examples of a block, terms kept as matrices at most, blocks opened first, documents
#: searched at a time, neighbours that vote, neighbours given as evidence.
BLOCK, DENSE, FIRST, BATCH, NEIGHBOURS, EVIDENCE = 64, 1024, 2, 64, 16, 3
#: Bytes of a slice, and parts that the slices are dealt to, when an index goes to the driver.
SLICE, SLICES = 1 << 18, 32
#: Examples that others are grouped around, so that like ones share a block.
LEADERS = 16
#: More than the rounding error of a similarity in single precision.
SLACK = 1e-5


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(terms, counts): each distinct word and each distinct stem of a longer word, as
    sorted 64-bit hashes, and how often it occurs."""
    return np.unique(np.concatenate(shingles.word_hashes(text or "", STEM)), return_counts=True)


def terms_of(text: str | None) -> Counter:
    """``term_counts`` as {term: count}."""
    return Counter(dict(zip(*(x.tolist() for x in term_counts(text)))))


class Neighbour(NamedTuple):
    similarity: float
    example: int


def spans(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """start[0], ..., end[0] - 1, start[1], ..., end[1] - 1, ... in one array."""
    n = end - start
    return np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)


class Index:
    """Block-max inverted index of the examples' unit vectors.

    Example e has the terms ``term[first[e]:first[e + 1]]`` with their ``weight``.
    Everything else that a search reads is made from that once per process.
    """

    def __init__(self, ids, labels, vectors, idf: np.ndarray, terms, ties=None):
        """``terms``: sorted; ``vectors``: per example arrays (term numbers, weights);
        ``idf``: what a term's count is multiplied by; ``ties``: per example the number
        by which equal similarities are ordered (its id if not given)."""
        self.terms, self.idf = np.asarray(terms, dtype=np.uint64), np.asarray(idf, dtype=float)
        strong = [tuple(t[np.argsort(-w, kind="stable")[:3]].tolist()) for t, w in vectors]
        # examples alike in frequent terms, label and strongest terms lie together: tight block maxima
        group = alike(vectors, len(self.terms))
        order = sorted(range(len(ids)), key=lambda e: (labels[e], group[e], strong[e], ids[e]))
        self.ids = np.array([ids[e] for e in order], dtype=np.int64)
        self.labels = np.array([labels[e] for e in order], dtype=np.float64)
        ties = self.ids if ties is None else np.array([ties[e] for e in order])
        self.rank = np.empty(len(order), dtype=np.int64)
        self.rank[np.lexsort((self.ids, ties))] = np.arange(len(order))
        self.first = np.concatenate([[0], np.cumsum([len(vectors[e][0]) for e in order])]).astype(np.int64)
        self.term = np.concatenate([np.zeros(0, np.int32)] + [vectors[e][0] for e in order]).astype(np.int32)
        self.weight = np.concatenate([np.zeros(0, np.float32)] + [vectors[e][1].astype(np.float32) for e in order])
        self.curve, self.none = (0.0, 0.0), 0.0  # see calibration
        self.opened = self.blocks = 0

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "made"}

    def _make(self) -> None:
        """Blocks, matrices of the frequent terms and postings of the others."""
        if "made" in self.__dict__:
            return
        n = len(self.ids)
        self.n_blocks = max(1, -(-n // BLOCK))
        df = np.bincount(self.term, minlength=len(self.terms))
        often = np.argsort(-df, kind="stable")[:DENSE]
        often = often[df[often] > max(n // 64, 1)]
        self.column = np.full(len(self.terms), -1, dtype=np.int64)
        self.column[often] = np.arange(len(often))
        place = np.repeat(np.arange(n), np.diff(self.first))
        column = self.column[self.term]
        dense = column >= 0
        rows = np.zeros((self.n_blocks * BLOCK, len(often)), dtype=np.float32)
        rows[place[dense], column[dense]] = self.weight[dense]
        self.rows, self.tiles = rows, rows.reshape(self.n_blocks, BLOCK, len(often))
        self.tops = np.ascontiguousarray(self.tiles.max(1, initial=0).T)
        rare, at = self.term[~dense], place[~dense]
        by = np.argsort(rare, kind="stable")
        self.place, self.impact = at[by].astype(np.int32), self.weight[~dense][by].astype(np.float64)
        self.cut = np.searchsorted(rare[by], np.arange(len(self.terms) + 1))
        self.made = True

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(term numbers, weights) of the unit TF-IDF vector; empty if no term occurs."""
        return self.weigh(*term_counts(text))

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t, n = known(self.terms, terms, counts)
        return t, unit((1 + np.log(n)) * self.idf[t])

    def search(self, queries: list, k: int = NEIGHBOURS) -> list[list[Neighbour]]:
        """For each (term numbers, weights) the exact k examples of greatest positive
        cosine, ties by the examples' own order."""
        self._make()
        size, n = len(queries), self.n_blocks * BLOCK
        often, rare = np.zeros((size, self.rows.shape[1]), dtype=np.float32), np.zeros((size, n))
        for i, (t, w) in enumerate(queries):
            c = self.column[t]
            often[i, c[c >= 0]] = w[c >= 0]
            t, w = t[c < 0], w[c < 0]
            posting = spans(self.cut[t], self.cut[t + 1])
            rare[i] = np.bincount(self.place[posting], np.repeat(w, self.cut[t + 1] - self.cut[t]) * self.impact[posting], n)
        bound = often @ self.tops + rare.reshape(size, self.n_blocks, BLOCK).max(2)
        similarity = np.zeros((size, n), dtype=np.float32)
        first = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST]
        done = np.zeros(bound.shape, dtype=bool)
        np.put_along_axis(done, first, True, axis=1)
        self._open(done & (bound > 0), often, rare, similarity)
        # the k-th similarity in the blocks opened first bounds the k-th of all from below
        seen = np.take_along_axis(similarity.reshape(size, self.n_blocks, BLOCK), first[:, :, None], axis=1).reshape(size, -1)
        floor = np.partition(seen, -k, axis=1)[:, -k] if seen.shape[1] >= k else np.zeros(size)
        self._open(~done & (bound > 0) & (bound >= floor[:, None] - SLACK), often, rare, similarity)
        self.blocks += bound.size
        query, example = np.nonzero((similarity > 0) & (similarity >= floor[:, None] - SLACK))
        cut = np.searchsorted(query, np.arange(size + 1))
        return [self._best(often[i], rare[i], similarity[i], example[cut[i]:cut[i + 1]], k) for i in range(size)]

    def _open(self, which: np.ndarray, often: np.ndarray, rare: np.ndarray, similarity: np.ndarray) -> None:
        """Compare each query with the examples of the blocks that ``which`` names for it."""
        self.opened += int(which.sum())
        for b in np.flatnonzero(which.any(0)).tolist():
            some, here = np.flatnonzero(which[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
            if 2 * len(some) > len(which):  # cheaper for the whole batch than to gather rows
                np.add(rare[:, here], often @ self.tiles[b].T, out=similarity[:, here], casting="same_kind")
            else:
                similarity[some, here] = rare[some, here] + often[some] @ self.tiles[b].T

    def _best(self, often, rare, similarity, examples, k: int) -> list[Neighbour]:
        """The best k of ``examples``, whose cosines are summed in double precision."""
        if len(examples) > k:
            found = similarity[examples]
            examples = examples[found >= np.partition(found, -k)[-k] - SLACK]
        cosine = (rare[examples] + self.rows[examples].astype(np.float64) @ often.astype(np.float64)).round(12)
        best = np.lexsort((self.rank[examples], -cosine))[:k]
        return [Neighbour(float(cosine[i]), int(examples[i])) for i in best if cosine[i] > 0]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> list[Neighbour]:
        return self.search([(terms, weights)], k)[0]

    def neighbours(self, texts: list) -> list[list[Neighbour]]:
        """The neighbours of each text, searched BATCH at a time."""
        return [near for start in range(0, len(texts), BATCH)
                for near in self.search([self.vector(text) for text in texts[start:start + BATCH]])]

    def vote(self, near: list[Neighbour]) -> float:
        total = sum(x.similarity for x in near)
        return sum(x.similarity * self.labels[x.example] for x in near) / total

    def score(self, near: list[Neighbour]) -> float:
        if not near:
            return self.none
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, a * (self.vote(near) - 0.5) + b))))


def alike(vectors: list, n_terms: int) -> list[int]:
    """A group for each vector: the leader, of LEADERS spread over the list, whose
    direction in the most frequent terms is nearest."""
    if not vectors:
        return []
    df = np.bincount(np.concatenate([t for t, _ in vectors]), minlength=n_terms)
    column = np.full(n_terms, -1)
    often = np.argsort(-df, kind="stable")[:DENSE // 4]
    column[often] = np.arange(len(often))
    x = np.zeros((len(vectors), max(len(often), 1)), dtype=np.float32)
    for row, (t, w) in zip(x, vectors):
        c = column[t]
        row[c[c >= 0]] = w[c >= 0]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return (x @ x[::-(-len(x) // LEADERS)].T).argmax(1).tolist()


def unit(w: np.ndarray) -> np.ndarray:
    """``w`` over its length, as numbers that single precision holds."""
    return (w / math.sqrt(float(w @ w))).astype(np.float32).astype(np.float64) if len(w) else w


def known(table: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted ``table``, count) of those ``terms`` that it holds."""
    if not len(table):
        return np.zeros(0, np.int64), counts[:0]
    at = np.minimum(np.searchsorted(table, terms), len(table) - 1)
    found = table[at] == terms
    return at[found], counts[found]


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """(a, b) of sigmoid(a (x - 0.5) + b) by Newton steps with a small ridge
    (towards a = 8, b = 0, which keeps the vote's order where data are few); a
    step is halved until the loss falls."""
    def loss(a, b):
        z = a * (x - 0.5) + b
        return float(np.sum(np.logaddexp(0, z) - y * z)) + ridge / 2 * ((a - 8) ** 2 + b * b)

    a, b = 8.0, 0.0
    for _ in range(50 if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(a * (x - 0.5) + b, -500, 500)))
        g = np.array([(p - y) @ (x - 0.5) + ridge * (a - 8), (p - y).sum() + ridge * b])
        s = p * (1 - p)
        h = np.array([[s @ (x - 0.5) ** 2 + ridge, s @ (x - 0.5)], [s @ (x - 0.5), s.sum() + ridge]])
        step, before = np.linalg.solve(h, g), loss(a, b)
        while loss(a - step[0], b - step[1]) > before and abs(step).max() > 1e-12:
            step /= 2
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def calibration(votes: list, labels: list) -> tuple[tuple[float, float], float]:
    """The curve fitted on the votes (None without a neighbour) of examples with these
    labels, and the score without a neighbour, which leans to clean."""
    blind = [y for v, y in zip(votes, labels) if v is None]
    seen = [(v, y) for v, y in zip(votes, labels) if v is not None]
    return (logistic_fit(np.array([v for v, _ in seen]), np.array([y for _, y in seen], dtype=float)),
            float(sum(blind)) / (len(blind) + 1))


def _example_terms(rows: DataFrame) -> DataFrame:
    """(doc_id, label, tie, text) -> (doc_id, label, tie, size, terms, tf): the terms'
    hashes and their 32-bit counts."""
    keep = ["doc_id", "label", "tie"]

    def run(batches):
        for part in batch_rows(batches):
            found = [term_counts(text) for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), pa.array([len(t) for t, _ in found], pa.int64()),
                 pa.array([t.tobytes() for t, _ in found], pa.binary()),
                 pa.array([n.astype("<i4").tobytes() for _, n in found], pa.binary())], [*keep, "size", "terms", "tf"])

    return map_texts(rows.select(*keep, "text"), run, "doc_id long, label int, tie long, size long, terms binary, tf binary")


def document_frequencies(docs: DataFrame, terms: np.ndarray, text_col: str = "text") -> tuple[int, np.ndarray]:
    """(documents, documents that hold each of the sorted ``terms``) over all of
    ``docs``; one partial row per term and slice, summed by Spark."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)  # at most max_postings numbers
    size = len(terms)

    def run(batches):
        seen = np.zeros(size + 1, dtype=np.int64)
        for part in batch_rows(batches):
            for text in part.column("text").to_pylist():
                t, n = term_counts(text)
                seen[known(sent.value, t, n)[0]] += 1
                seen[size] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], ["term", "df"])

    counts = (map_texts(docs.select(F.col(text_col).cast("string").alias("text")), run, "term int, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).toArrow())
    sent.destroy()
    total = np.zeros(size + 1, dtype=np.int64)
    total[counts["term"].to_numpy()] = counts["df"].to_numpy()
    return int(total[size]), total[:size]


def association(term: np.ndarray, label: np.ndarray, pos: int, neg: int, size: int) -> np.ndarray:
    """|phi| of each of ``size`` terms: the correlation of its presence with the
    label, from the (term, label) of each example that holds it."""
    n = np.bincount(term, minlength=size).astype(float)
    a = np.bincount(term, weights=label, minlength=size)
    return (np.abs(a * (neg - (n - a)) - (n - a) * (pos - a))
            / np.sqrt(float(pos) * neg * np.maximum(n, 1.0) * np.maximum(pos + neg - n, 1.0)))


class _Examples(NamedTuple):
    ids: list
    labels: np.ndarray
    ties: list
    terms: list   # per example: hashes
    counts: list  # per example: how often

    def of(self, use: np.ndarray) -> "_Examples":
        at = np.flatnonzero(use).tolist()
        return _Examples([self.ids[e] for e in at], self.labels[use], *([x[e] for e in at] for x in self[2:]))


def build(examples: _Examples, table: np.ndarray, n: int, df: np.ndarray) -> Index:
    """The index of these examples: weights from their labels and the frequencies ``df``
    of the terms ``table`` in ``n`` documents. Without both classes it is empty."""
    pos = int(examples.labels.sum())
    neg = len(examples.ids) - pos
    if not pos or not neg:
        none = (np.zeros(0, np.int64), np.zeros(0))
        return Index(examples.ids, examples.labels, [none] * len(examples.ids), np.zeros(0), np.zeros(0, np.uint64), examples.ties)
    terms = np.unique(np.concatenate(examples.terms))
    places = [np.searchsorted(terms, t).astype(np.int32) for t in examples.terms]
    term = np.concatenate(places)
    label = np.repeat(examples.labels.astype(np.float32), [len(t) for t in places])
    weight = FLOOR + association(term, label, pos, neg, len(terms))
    del term, label
    idf = (np.log((1 + n) / (1 + df[np.searchsorted(table, terms)])) + 1) * weight
    # example by example, so that a task holds few arrays of all postings at a time
    vectors = [(t, unit((1 + np.log(c)) * idf[t]).astype(np.float32)) for t, c in zip(places, examples.counts)]
    return Index(examples.ids, examples.labels, vectors, idf, terms, examples.ties)


class Fitted:
    """An index as it left the task that built it, with the curve fitted on it. It is
    unpacked where it is used; the driver passes it on as it is."""

    def __init__(self, state: bytes, curve=(0.0, 0.0), none: float = 0.0):
        self.state, self.curve, self.none = state, curve, none

    def __getstate__(self):
        return self.state, self.curve, self.none

    def __setstate__(self, found):
        self.state, self.curve, self.none = found

    @property
    def index(self) -> Index:
        if "_index" not in self.__dict__:
            self._index = Index.__new__(Index)
            self._index.__dict__.update(pickle.loads(self.state), curve=self.curve, none=self.none)
        return self._index

    def __getattr__(self, name):
        if name.startswith("__"):
            raise AttributeError(name)
        return getattr(self.index, name)


def sent_index(rows: DataFrame, fitted: Fitted):
    """Broadcast an index, whose size is checked: MAX_POSTINGS terms of examples, each with
    its place in the vocabulary and its weight, and as many vocabulary entries at most."""
    if len(fitted.state) > 32 * MAX_POSTINGS + 128 * MAX_EXAMPLES + 65_536:
        raise ValueError(f"an index of {len(fitted.state)} bytes is too large to broadcast")
    return rows.sparkSession.sparkContext.broadcast(fitted)


def _in_one_task(rows: DataFrame, make) -> bytes:
    """``make(examples)`` of the written example rows, at most max_examples of them with
    max_postings terms, in a task: the driver gets its bytes only."""

    def run(batches):
        parts = [part for part in batches if part.num_rows]
        column = {c: [x for part in parts for x in part.column(c)] for c in ("doc_id", "label", "tie", "terms", "tf")}
        examples = _Examples([x.as_py() for x in column["doc_id"]], np.array([x.as_py() for x in column["label"]], dtype=float),
                             [x.as_py() for x in column["tie"]], [np.frombuffer(x.as_buffer(), "<u8") for x in column["terms"]],
                             [np.frombuffer(x.as_buffer(), "<i4") for x in column["tf"]])
        made = make(examples)
        for at in range(0, max(len(made), 1), SLICE):
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([made[at:at + SLICE]], pa.binary())], ["at", "value"])

    # many small results: the driver's JVM holds one of them several times over
    found = rows.coalesce(1).mapInArrow(run, "at long, value binary").repartition(SLICES, "at").toArrow()
    if not found.num_rows:
        return make(_Examples([], np.zeros(0), [], [], []))
    slices = dict(zip(found["at"].to_pylist(), found["value"].to_pylist()))
    return b"".join(slices[at] for at in sorted(slices))


def votes_of(fitted: Fitted, rows: DataFrame) -> pa.Table:
    """(label, vote) of written example rows; null without a neighbour."""
    sent = sent_index(rows, fitted)

    def run(batches):
        index = sent.value.index
        for part in batch_rows(batches, BATCH):
            pairs = zip(part.column("terms").to_pylist(), part.column("tf").to_pylist())
            near = index.search([index.weigh(np.frombuffer(t, "<u8"), np.frombuffer(n, "<i4")) for t, n in pairs])
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.array([index.vote(x) if x else None for x in near], pa.float64())], ["label", "vote"])

    found = rows.select("label", "terms", "tf").mapInArrow(run, "label int, vote double").toArrow()
    sent.destroy()
    return found


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_examples: int = MAX_EXAMPLES, max_postings: int = MAX_POSTINGS) -> Fitted:
    """The index of at most ``max_examples`` labelled documents (smallest id
    hashes) with ``max_postings`` terms together. Null ids and labels are no
    examples; an id labelled twice counts once, with its greatest label; of equal
    texts with equal labels one (the smallest id) stays; without both classes every
    score is the same. Built in tasks; the driver passes on the packed index, its
    vocabulary and the calibration votes."""
    labelled = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
                .groupBy(F.col(id_col).alias("__id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
                .orderBy(F.xxhash64("__id"), "__id").limit(max_examples))
    sample = staged(labelled, "toxic_labels")  # at most max_examples rows of 12 bytes: broadcast below
    rows = (docs.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).select("doc_id", "label", "text"))
    key = F.coalesce(F.sha2("text", 256), F.col("doc_id").cast("string"))
    rows = (rows.groupBy(key.alias("key"), "label").agg(F.min(F.struct("doc_id", "text")).alias("one"))
            .select("one.doc_id", "label", F.xxhash64("key").alias("tie"), "one.text"))
    # at most max_examples rows: terms in tasks, then a running total over their numbers
    terms = staged(_example_terms(rows), "toxic_terms")
    upto = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "tie"))
    kept = terms.select("doc_id", "tie", upto.alias("upto")).where(F.col("upto") <= max_postings).drop("upto")
    terms = staged(terms.join(F.broadcast(kept), ["doc_id", "tie"]), "toxic_examples")
    table = np.frombuffer(_in_one_task(
        terms, lambda x: np.unique(np.concatenate([np.zeros(0, np.uint64), *x.terms])).tobytes()), np.uint64)
    known_terms = docs.sparkSession.sparkContext.broadcast((table, *document_frequencies(docs, table, text_col)))

    def packed(of):
        return lambda x: pickle.dumps(build(of(x), *known_terms.value).__getstate__())

    def unseen(x):  # by the text's hash, so that equal texts fall together
        return x.of(np.array([t % 5 != 0 for t in x.ties], dtype=bool))

    blind = Fitted(_in_one_task(terms, packed(unseen)))
    votes = votes_of(blind, terms.where(F.pmod("tie", F.lit(5)) == 0))
    del blind
    whole = _in_one_task(terms, packed(lambda x: x))
    known_terms.destroy()
    return Fitted(whole, *calibration(votes["vote"].to_pylist(), votes["label"].to_pylist()))


def score(docs: DataFrame, index: Fitted, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, evidence), one row per input row.

    ``evidence``: the nearest examples as (doc_id, label, similarity). Null and
    empty texts, and texts without any indexed term, get the score of such
    examples and no evidence. The score depends on the text alone; ids may be
    null or repeat; other columns are not read; empty in, empty out.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sent = sent_index(docs, index)

    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("similarity", pa.float64())]))

    def run(batches):
        index = sent.value.index
        for part in batch_rows(batches):
            found = index.neighbours(part.column("text").to_pylist())
            scores = [index.score(near) for near in found]
            shown = [[{"doc_id": int(index.ids[x.example]), "label": int(index.labels[x.example]),
                       "similarity": x.similarity} for x in near[:EVIDENCE]] for near in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(shown, kind)],
                ["doc_id", "score", "predicted", "evidence"])

    return map_texts(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int, "
                                "evidence array<struct<doc_id: long, label: int, similarity: double>>")


def drop_toxic(docs: DataFrame, index: Fitted, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5, all columns under any names, in
    one pass. Null and empty texts are judged like texts without an indexed term;
    repeated rows are judged alike; empty in, empty out."""
    sent = sent_index(docs, index)

    def run(batches):
        index = sent.value.index
        for part in batch_rows(batches):
            near = index.neighbours(part.column(text_col).to_pylist())
            yield part.filter(pa.array([index.score(x) < 0.5 for x in near], pa.bool_()))

    return map_texts(docs, run, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """Rows kept for testing: crc32 of the id as text, modulo 5, is 0 (null ids are not)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))
