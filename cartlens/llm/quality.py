"""Quality classifier learned from positives and unlabelled text.

Trusted positives are documents labelled good (a bounded sample of them); the
unlabelled text is every document. Negative labels are never read. A document
becomes one vector of its style: how bytes of eight classes follow each other,
and shares (repetition, capitals, symbols, word length, ...) on a piecewise
linear basis. The vectors are written once; every step of the fit is one pass
over them that returns a loss, a gradient and a Hessian summed by Spark.

1. A logistic curve tells half of the positives from the unlabelled documents.
2. The class prior is the least ratio, over all cuts of its score, of the
   unlabelled share to the share of the other positives above the cut (with the
   confidence terms of both shares): above the best cut nearly all unlabelled
   documents are positives.
3. The non-negative unbiased risk ``prior P+ + max(0, U- - prior P-)`` with logistic
   loss is minimised by Newton steps. With this loss ``P+ - P-`` is linear, so the
   risk is the larger of two convex functions; a step is shortened until it falls.

The score is the logistic curve of the margin.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import shingles
from .common import batch_rows, map_texts, staged

#: Labelled positives a fit reads at most (those of the smallest id hashes).
MAX_POSITIVES = 20_000
#: Ridge (over the number of positives), width in which the larger risk is smoothed,
#: passes of a fit at most, cuts of the positives' scores, confidence level of the
#: prior's bound, and the score from which a document is predicted good.
RIDGE, SMOOTH, PASSES, CUTS, DELTA, THRESHOLD = 2.0, 0.01, 14, 400, 0.1, 0.7
#: Knots of the piecewise linear basis, and bytes described at a time.
KNOTS = np.array([0.0, 0.01, 0.03, 0.08, 0.2, 0.4, 0.7, 1.0])
CHUNK = 1 << 18
LOWER, UPPER, DIGIT, BLANK, LINE, POINT, SYMBOL, BEYOND = range(8)


def _classes() -> np.ndarray:
    """The class of each byte."""
    kind = np.full(256, SYMBOL, dtype=np.uint8)
    for letters, of in (("abcdefghijklmnopqrstuvwxyz", LOWER), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER),
                        ("0123456789", DIGIT), (" \t", BLANK), ("\n\r", LINE), (".,;:!?'\"()-", POINT)):
        kind[list(letters.encode())] = of
    kind[128:] = BEYOND
    return kind


_CLASS = _classes()
SHARES = 12
WIDTH = 64 + SHARES * len(KNOTS)


def repetition(words: np.ndarray) -> tuple[float, float, float]:
    """Shares of words seen before, of runs of five words seen before, and of the
    most frequent word."""
    n = len(words)
    if not n:
        return 0.0, 0.0, 0.0
    _, counts = np.unique(words, return_counts=True)
    width = min(n, shingles.WORDS)
    runs = np.zeros(n - width + 1, dtype=np.uint64)
    for j, place in enumerate(shingles.tables().places[:width]):
        runs += words[j:n - width + 1 + j] * place
    return 1 - len(counts) / n, 1 - len(np.unique(runs)) / len(runs), counts.max() / n


def describe(text: str | None) -> np.ndarray:
    """The WIDTH features of a text; of the whole of it, in bounded memory per CHUNK."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    pairs, singles, n = np.zeros(64), np.zeros(8), max(len(data), 1)
    for start in range(0, len(data), CHUNK):
        kind = _CLASS[data[start:start + CHUNK + 1]]
        pairs += np.bincount(kind[:-1] * 8 + kind[1:], minlength=64)
        singles += np.bincount(kind[:CHUNK], minlength=8)
    words = shingles.word_hashes(text or "")
    letters = singles[LOWER] + singles[UPPER] + singles[BEYOND]
    shares = np.array([
        math.log1p(len(words)) / 14, (letters + singles[DIGIT]) / max(len(words), 1) / 16, *repetition(words),
        singles[UPPER] / max(letters, 1), singles[DIGIT] / n, singles[POINT] / n, singles[SYMBOL] / n,
        singles[BEYOND] / n, 10 * singles[LINE] / n, singles[BLANK] / n]).clip(0, 1)
    at = np.clip(np.searchsorted(KNOTS, shares, side="right") - 1, 0, len(KNOTS) - 2)
    part = (shares - KNOTS[at]) / (KNOTS[at + 1] - KNOTS[at])
    hats = np.zeros((SHARES, len(KNOTS)))
    hats[np.arange(SHARES), at], hats[np.arange(SHARES), at + 1] = 1 - part, part
    return np.concatenate([np.sqrt(pairs / n), hats.ravel()]).astype(np.float32)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x), one row per input row: ``x`` holds the features as 32-bit floats."""

    def run(batches):
        for part in batch_rows(batches):
            x = [describe(text).tobytes() for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(x, pa.binary())], ["doc_id", "x"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_texts(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f4").reshape(-1, WIDTH).astype(np.float64)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class Sums(NamedTuple):
    """Means of softplus(z), its gradient and its Hessian over rows x, z = x w."""

    loss: float
    gradient: np.ndarray
    hessian: np.ndarray


def sums(x: np.ndarray, w: np.ndarray) -> Sums:
    z = x @ w
    p = sigmoid(z)
    return Sums(softplus(z).sum(), p @ x, (x * (p * (1 - p))[:, None]).T @ x)


def _totals(rows: DataFrame, n: int, partial) -> np.ndarray:
    """``partial(x)``, ``n`` numbers of each slice of feature rows, added up: one row
    per number and task, summed by Spark."""

    def run(batches):
        total = np.zeros(n)
        for part in batch_rows(batches, 2048):
            total += partial(_matrix(part.column("x")))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(total)], ["k", "v"])

    found = (rows.select("x").mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow())
    total = np.zeros(n)
    total[found["k"].to_numpy()] = found["v"].to_numpy()
    return total


def unlabelled(rows: DataFrame, w: np.ndarray) -> Sums:
    """``sums`` over all feature rows, as means."""
    upper = np.triu_indices(WIDTH)

    def partial(x):
        s = sums(x, w)
        return np.concatenate([[len(x), s.loss], s.gradient, s.hessian[upper]])

    t = _totals(rows, 2 + WIDTH + len(upper[0]), partial)
    n = max(t[0], 1.0)
    half = np.zeros((WIDTH, WIDTH))
    half[upper] = t[2 + WIDTH:] / n
    return Sums(t[1] / n, t[2:2 + WIDTH] / n, half + half.T - np.diag(np.diag(half)))


def newton(objective, w: np.ndarray, passes: int = PASSES, tolerance: float = 1e-6) -> np.ndarray:
    """Minimise by Newton steps, shortened until the value falls; ``objective(w)`` gives
    (value, gradient, Hessian) and is evaluated at most ``passes`` times."""
    value, g, h = objective(w)
    step, scale = np.linalg.solve(h, g), 1.0
    for _ in range(passes - 1):
        found, g2, h2 = objective(w - scale * step)
        if found < value:
            done = value - found < tolerance
            w, value, scale = w - scale * step, found, 1.0
            if done:
                break
            step = np.linalg.solve(h2, g2)
        else:
            scale /= 4
            if scale < 1e-3:
                break
    return w


def contrast(positives: np.ndarray, all_sums, w: np.ndarray) -> np.ndarray:
    """The logistic curve that tells positives from the unlabelled rows, both of weight one half."""
    n = len(positives)
    ridge = RIDGE / n

    def objective(w):
        u, p = all_sums(w), sums(-positives, w)
        return ((u.loss + p.loss / n) / 2 + ridge / 2 * w @ w, (u.gradient + p.gradient / n) / 2 + ridge * w,
                (u.hessian + p.hessian / n) / 2 + ridge * np.eye(len(w)))

    return newton(objective, w)


def nonnegative_risk(positives: np.ndarray, prior: float, all_sums, w: np.ndarray) -> np.ndarray:
    """Minimise prior P+ + max(0, U- - prior P-): the larger of prior P+ and the
    unbiased risk, which with logistic loss is U- minus the prior's mean margin. The
    larger of the two is taken smoothly (off by at most SMOOTH log 2), so that Newton
    steps also work where they are equal."""
    mean, n = positives.mean(0), len(positives)
    ridge = RIDGE / n

    def objective(w):
        u, p = all_sums(w), sums(-positives, w)
        unbiased, floor = u.loss - prior * mean @ w, prior * p.loss / n
        g_unbiased, g_floor = u.gradient - prior * mean, prior * p.gradient / n
        share = float(sigmoid(np.float64((unbiased - floor) / SMOOTH)))  # of the unbiased risk
        apart = g_unbiased - g_floor
        value = floor + SMOOTH * float(softplus(np.float64((unbiased - floor) / SMOOTH)))
        h = share * u.hessian + (1 - share) * prior * p.hessian / n + share * (1 - share) / SMOOTH * np.outer(apart, apart)
        return (value + ridge / 2 * w @ w, share * g_unbiased + (1 - share) * g_floor + ridge * w,
                h + ridge * np.eye(len(w)))

    return newton(objective, w)


def class_prior(positive_scores: np.ndarray, above, n_unlabelled: float) -> float:
    """The share of positives among the unlabelled: the least, over cuts at quantiles
    of the positives' scores, of unlabelled share over positive share above the cut,
    chosen with the confidence terms of both. ``above(cuts)``: unlabelled rows per cut."""
    cuts = np.unique(np.quantile(positive_scores, np.linspace(0, 1, CUTS, endpoint=False), method="lower"))
    p = np.array([(positive_scores >= c).mean() for c in cuts])
    u = above(cuts) / max(n_unlabelled, 1.0)
    slack = math.sqrt(math.log(4 / DELTA) / 2) * (1 / math.sqrt(max(n_unlabelled, 1.0)) + 1 / math.sqrt(len(positive_scores)))
    best = int(np.argmin((u + slack) / p))
    return float(min(max(u[best] / p[best], 0.01), 0.99))


class Model(NamedTuple):
    """``weights`` None: nothing learned, every score is one half."""

    weights: np.ndarray | None
    prior: float


def positives_of(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                 max_positives: int = MAX_POSITIVES) -> np.ndarray:
    """Feature rows of at most ``max_positives`` labelled positives (smallest id
    hashes), one per id, in the order of the hashes. Null ids and labels do not count."""
    known = (labels.where(F.col(id_col).isNotNull() & (F.col(label_col) > 0)).select(F.col(id_col).alias("id")).distinct()
             .orderBy(F.xxhash64("id"), "id").limit(max_positives))
    sample = F.broadcast(staged(known, "quality_positives"))  # at most max_positives ids
    found = (rows.join(sample, F.col("doc_id") == F.col("id")).groupBy("id").agg(F.min("x").alias("x"))
             .select(F.xxhash64("id").alias("h"), "id", "x").toArrow().sort_by([("h", "ascending"), ("id", "ascending")]))
    return _matrix(found["x"])


def fit(rows: DataFrame, positives: np.ndarray) -> Model:
    """The model from feature rows of all documents (a written table: about 20 passes)
    and of trusted positives; without two positives or any rows there is nothing to learn."""
    n = float(rows.count())
    if len(positives) < 2 or not n:
        return Model(None, 0.5)

    def all_sums(w):
        return unlabelled(rows, w)

    w = contrast(positives[::2], all_sums, np.zeros(WIDTH))

    def above(cuts):
        def partial(x):
            below = np.bincount(np.searchsorted(cuts, x @ w, side="right"), minlength=len(cuts) + 1)
            return below[::-1].cumsum()[::-1][1:].astype(float)

        return _totals(rows, len(cuts), partial)

    prior = class_prior(positives[1::2] @ w, above, n)
    return Model(nonnegative_risk(positives, prior, all_sums, w).round(6), prior)


def score(rows: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted), one row per feature row."""
    weights = np.zeros(WIDTH) if model.weights is None else model.weights

    def run(batches):
        for part in batch_rows(batches, 2048):
            p = sigmoid(_matrix(part.column("x")) @ weights)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    return rows.select("doc_id", "x").mapInArrow(
        run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", max_positives: int = MAX_POSITIVES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted), one row per row of ``docs``, learned from ``docs``
    and the positives in ``labels`` (which holds training rows only).

    The score depends on the text alone: null counts as empty, an empty text is
    scored like any other, long texts are described whole, equal texts score the
    same. Ids may be null or repeat (as a positive an id counts once); other columns
    are not read. Without positives every score is 0.5; an empty table gives an
    empty result.
    """
    rows = staged(features(docs, id_col, text_col), "quality_features")
    return score(rows, fit(rows, positives_of(rows, labels, id_col, label_col, max_positives)), threshold)


def held_out(doc_id: str = "doc_id"):
    """Rows kept for testing: crc32 of the id as text, modulo 4, is 2 (null ids are not)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))
