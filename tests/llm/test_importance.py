import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cartlens.llm import importance as im

SCHEMA = "doc_id long, text string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, lo, hi):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i:i + n]) for n in range(lo, hi + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, lo=1, hi=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    def bucket(f):
        return crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in docs for f in features(t, lo, hi)[1])
    t = Counter(bucket(f) for x in target for f in features(x, lo, hi)[1])
    s_all, t_all, rows = s.total(), t.total(), []
    for i, text in docs:
        n, found = features(text, lo, hi)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
                     for b in map(bucket, found))
        h = int(sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: k for k, r in enumerate(able[:percent * len(able) // 100], 1)}
    return {r[0]: (r[2], r[3], r[4], rank.get(r[0])) for r in rows}


def result(df):
    return {r.doc_id: (r.n_features, r.weight, r.score, r.rank) for r in df.collect()}


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    words = ["The", "Ärger", "x1", "of", "über", "Straße", "deep", "99", "naïve", "日本", "and"]
    seps = [" ", ", ", "\n\n", " -- ", "!", "\t"]
    return [(i, "".join(words[rng.integers(len(words))] + seps[rng.integers(len(seps))] for _ in range(rng.integers(0, 60))))
            for i in range(n)]


@pytest.mark.parametrize("lo,hi,buckets", [(1, 1, 10_000), (1, 3, 500), (2, 2, 100_000)])
def test_equals_plain_version(spark, lo, hi, buckets):
    docs, target = corpus(200), [t for _, t in corpus(20, 5)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = result(im.resample(df, wanted, min_n=lo, max_n=hi, buckets=buckets))
    assert found == plain(docs, target, lo, hi, buckets)
    assert sum(r[3] is not None for r in found.values()) > 5


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60), st.integers(1, 4))
def test_overlapped_spans_are_all_runs_of_words(text, n):
    assert im.spans(im.collapsed(text), im.patterns(n, n)[0]) == features(text, n, n)[1]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_long_texts_are_scanned_whole(monkeypatch, n):
    monkeypatch.setattr(im, "CHUNK", 40)
    text = " ".join(t for _, t in corpus(60, 2)) + " " + "z" * 200 + " end of it"
    found = im.bucket_list(im.collapsed(text), im.patterns(n, n), n, 997)
    assert sorted(found) == sorted(crc32(f.encode()) % 997 for f in features(text, n, n)[1])


def test_nulls_empty_ties_repeats_and_other_columns(spark):
    long = "word " * 30
    rows = [(1, None), (2, ""), (3, "?!"), (4, long), (4, long), (None, long), (5, "w" * 300_000), (6, "Some Words")]
    df = (spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("found", F.lit(1))
          .withColumn("__text", F.lit(2)).withColumn("score", F.lit(0)).withColumn("__range", F.lit(7)))
    found = im.resample(df, spark.createDataFrame([("word",), (None,)], "text string"), percent=100).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert [(r.n_features, r.weight, r["rank"]) for i in (1, 2, 3) for r in by[i]] == [(0, 0, None)] * 3
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3]
    assert by[4][0].score == by[4][1].score and abs(by[4][0]["rank"] - by[4][1]["rank"]) == 1
    assert by[5][0].n_features == 1 and by[5][0]["rank"] is None


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a b")], SCHEMA)
    assert im.resample(none, one).collect() == []
    assert [(r.n_features, r["rank"]) for r in im.resample(one, none, min_words=1, percent=100).collect()] == [(2, 1)]


def test_lengths_are_checked(spark):
    with pytest.raises(ValueError):
        im.resample(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], SCHEMA), min_n=2, max_n=1)
