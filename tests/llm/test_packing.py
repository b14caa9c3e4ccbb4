"""Bucket bounds against an exhaustive dynamic program; batches' shape."""

import numpy as np
from hypothesis import given, settings, strategies as st

from cartlens.llm import packing as pk

from .test_pipeline import check_packing


def plain_cost(lengths, counts, k):
    d = len(lengths)
    best = [0.0] + [float("inf")] * d
    for _ in range(min(k, d)):
        best = [0.0] + [min(best[i] + sum(counts[m] * (lengths[j - 1] - lengths[m]) for m in range(i, j))
                            for i in range(j)) for j in range(1, d + 1)]
    return best[d]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 300), st.integers(1, 50), min_size=1, max_size=14), st.integers(1, 6))
def test_bounds_are_optimal(hist, k):
    lengths = sorted(hist)
    counts = [hist[x] for x in lengths]
    bounds = pk.optimal_bounds(lengths, counts, k)
    assert len(bounds) <= k and bounds == sorted(set(bounds)) and bounds[-1] == lengths[-1]
    padding = sum(n * (bounds[int(np.searchsorted(bounds, x))] - x) for x, n in zip(lengths, counts))
    assert padding == plain_cost(lengths, counts, k)


def test_rows_nulls_ties_and_hot_lengths(spark, monkeypatch):
    monkeypatch.setattr(pk, "CELL_ROWS", 50)
    rows = [(k, 40) for k in range(900)] + [(k, k) for k in range(300)] + [(None, 7), (None, None), (1, 0), (1, 10**6)]
    df = spark.createDataFrame([(i, n, "x", 1) for i, n in rows], "doc_id long, length long, bucket string, cell int")
    got = pk.pack(df, n_buckets=5, token_budget=1000).collect()
    assert len(got) == len(rows)
    check_packing(got, 5, 1000)
    assert sorted((r.doc_id or 0, r.length) for r in got) == sorted((i or 0, n or 0) for i, n in rows)
    assert pk.pack(df.where("doc_id < 0")).count() == 0


def test_word_lengths(spark):
    texts = ["", None, " a  b\n", "one", "\t", "x " * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.length for r in pk.word_lengths(docs).collect()} == {
        i: len((t or "").split()) for i, t in enumerate(texts)}


def test_padding_is_the_least_over_exact_lengths(spark):
    nine = spark.createDataFrame([(k, 9) for k in range(50)], "doc_id long, length long")
    assert {r.bucket_length for r in pk.pack(nine).collect()} == {9}
    hist = {9: 40, 11: 3, 13: 20, 17: 5, 30: 2, 31: 9}
    rows = [(k, n) for k, n in enumerate(n for n, times in hist.items() for _ in range(times))]
    got = pk.pack(spark.createDataFrame(rows, "doc_id long, length long"), n_buckets=3).collect()
    assert sum(r.bucket_length - r.length for r in got) == plain_cost(list(hist), list(hist.values()), 3)
