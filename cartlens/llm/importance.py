"""Target-distribution importance resampling by overlapped scanning for n-grams.

The separators of a text are collapsed to single spaces; then one regular
expression per length, with overlapped matches and lookarounds at the word
boundaries, emits every run of n words as a span of the collapsed text, and the
spans' bytes go straight into CRC-32 buckets. A document's buckets are written
once as 16- or 32-bit numbers; the corpus counts are partial histograms, one row
per bucket and task, and the gains are one number per bucket, broadcast (their
count is a parameter). Documents are weighed from the written buckets, so a text
is scanned once. The best share of them is drawn after adding Gumbel noise: a
range exchange by (score, id) and counts per range give every rank, so no task
orders more than a range.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from .common import batch_rows, map_texts, staged

#: Bytes that part words, as a character class: everything of ASCII but letters and digits.
SEPARATORS, WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: Shortest and longest run of words, buckets, words of a document that can be
#: drawn, documents drawn of a hundred, the noise's seed.
MIN_N, MAX_N, BUCKETS, MIN_WORDS, PERCENT, SEED = 1, 1, 10_000, 20, 10, 2024
#: Characters of a text that are scanned at a time (words are never cut).
CHUNK = 1 << 16

_LOWER = {c: c + 32 for c in range(65, 91)}
_GAP = regex.compile(SEPARATORS + "+")


def collapsed(text: str | None) -> str:
    """The words of ``text``, A-Z in lower case, with single spaces between."""
    return _GAP.sub(" ", (text or "").translate(_LOWER)).strip(" ")


def patterns(min_n: int = MIN_N, max_n: int = MAX_N) -> list:
    """One expression per length: a run of n words between word boundaries."""
    return [regex.compile(rf"(?<!{WORD}){WORD}++(?: {WORD}++){{{n - 1}}}(?!{WORD})") for n in range(min_n, max_n + 1)]


def spans(line: str, pattern) -> list[str]:
    """Every run of words that ``pattern`` finds in a collapsed text, also where they overlap."""
    return [m.group() for m in pattern.finditer(line, overlapped=True)]


def _windows(line: str, n: int):
    """Cuts of ``line`` of about CHUNK characters, each with the n - 1 words after it,
    so that every run of n words lies in exactly one of them."""
    start = 0
    while (end := line.find(" ", start + CHUNK)) >= 0:
        after = end
        for _ in range(n - 1):
            after = line.find(" ", after + 1) if after >= 0 else after
        yield line[start:after] if after >= 0 else line[start:]
        start = end + 1
    yield line[start:]


def bucket_list(line: str, compiled, min_n: int, buckets: int) -> list[int]:
    """The bucket of each run of words of a collapsed text."""
    return [crc32(s.encode("utf-8", "surrogatepass")) % buckets
            for n, pattern in enumerate(compiled, min_n) for part in _windows(line, n) for s in spans(part, pattern)]


def scanned(texts: DataFrame, text_col: str, keep: list[str], min_n: int = MIN_N, max_n: int = MAX_N,
            buckets: int = BUCKETS) -> DataFrame:
    """``keep``, n_words, n_features and ``found``: the buckets of a text's runs of
    words, repeats included, as unsigned numbers of 2 bytes (4 for over 65,536 buckets)."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches):
        compiled = patterns(min_n, max_n)
        for part in batch_rows(batches):
            words, sizes, found = [], [], []
            for text in part.column("__text").to_pylist():
                line = collapsed(text)
                rows = np.array(bucket_list(line, compiled, min_n, buckets), dtype=kind)
                words.append(line.count(" ") + 1 if line else 0)
                sizes.append(len(rows))
                found.append(rows.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(found, pa.binary())], [*keep, "n_words", "n_features", "found"])

    rows = texts.select(*keep, F.col(text_col).cast("string").alias("__text"))
    kept = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in keep)
    return map_texts(rows, run, f"{kept}n_words long, n_features long, found binary")


def _numbers(part, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all rows, number of them per row) of a batch of ``scanned``."""
    texts = part.column("found").to_pylist()
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    return np.frombuffer(b"".join(texts), dtype=kind), np.array([len(t) // kind.itemsize for t in texts], dtype=np.int64)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features lie in each bucket: one row per bucket and task, summed by
    Spark; ``buckets`` numbers reach the driver."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for part in batch_rows(batches):
            total += np.bincount(_numbers(part, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counts = (found.select("found").mapInArrow(run, "bucket long, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    total = np.zeros(buckets, dtype=np.int64)
    total[counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of (t + 1) (S + B) / ((s + 1) (T + B))) per bucket, B buckets."""
    b, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + b) / ((s + 1) * (t_all + b))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def weighed(found: DataFrame, gain: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` and ``weight``: the sum of the gains of a row's features."""
    sent = found.sparkSession.sparkContext.broadcast(gain)  # one number per bucket
    buckets = len(gain)

    def run(batches):
        for part in batch_rows(batches, 1024):
            at, sizes = _numbers(part, buckets)
            upto = np.concatenate([[0], np.cumsum(sent.value[at])])
            end = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(upto[end] - upto[end - sizes])],
                                             [*keep, "weight"])

    kept = "".join(f"{c} {found.schema[c].dataType.simpleString()}, " for c in keep)
    return found.select(*keep, "found").mapInArrow(run, f"{kept}weight long")


def noise(id_col: str, seed: int = SEED):
    """floor(1000 times a Gumbel draw): from the first 32 bits of SHA-256 of ``seed:id``
    (a null id as the empty text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(u)))


def ranked(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` (a written table) with ``rank`` 1, 2, 3, ... in ``order``, which must
    tell all rows apart: ranges of that order, then ranks inside each range after
    the rows of the ranges before."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = staged(rows.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()), name)
    sizes = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))  # one row per range
    before = sizes.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
    return (ranges.withColumn("__place", F.row_number().over(Window.partitionBy("__range").orderBy(*order)))
            .join(F.broadcast(before), "__range")  # at most ``parts`` rows
            .withColumn("rank", (F.col("__place") + F.col("__before")).cast("long"))
            .drop("__range", "__place", "__before"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", min_n: int = MIN_N, max_n: int = MAX_N, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row per input row: how much more
    likely its n-grams are in ``target`` than in ``docs``, and for the rows drawn
    (``percent`` of a hundred of those with ``min_words`` words, the greatest scores)
    their rank; null for the others.

    Words are runs of ASCII letters, digits and all characters beyond ASCII. Null
    and empty texts have no features and a weight of 0. Equal scores go to the
    smaller id, null ids last; repeated rows are rows of their own. An empty
    target leaves gains that only spread the mass evenly; an empty table gives an
    empty result; other columns, whatever their names, are not read.
    """
    if not 1 <= min_n <= max_n:
        raise ValueError("lengths are 1 <= min_n <= max_n")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text_col).alias("text"))
    settings = dict(min_n=min_n, max_n=max_n, buckets=buckets)
    source = staged(scanned(docs, "text", ["doc_id", "row"], **settings), "resample_source")
    wanted = staged(scanned(target.select(F.col(target_col).alias("text")), "text", [], **settings), "resample_target")
    gain = gains(bucket_counts(source, buckets), bucket_counts(wanted, buckets))
    kept = ["doc_id", "row", "n_words", "n_features"]
    scored = staged(weighed(source, gain, kept).withColumn("score", F.col("weight") + noise("doc_id", seed)), "resample_scores")
    able = F.col("n_words") >= min_words
    drawn = F.floor(scored.agg(F.count_if(able)).scalar() * percent / 100)
    out = ["doc_id", "n_features", "weight", "score"]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    first = ranked(scored.where(able).drop("n_words"), order, "resample_ranges")
    return (first.select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
            .unionByName(scored.where(~able).select(*out, F.lit(None).cast("long").alias("rank"))))
