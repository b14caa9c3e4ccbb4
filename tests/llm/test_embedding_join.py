"""The metric range join against all pairs."""

import math

import numpy as np
import pytest

from cartlens.llm import embedding_join as ej
from cartlens.llm.common import table


def brute(rows, threshold):
    good = [(k, ej.usable(v)) for k, (_, v) in enumerate(rows)]
    good = [(k, x) for k, x in good if x is not None]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, x) in enumerate(good):
        for b, y in good[n + 1:]:
            if len(x) == len(y) and ej.cosine(x, y) >= threshold:
                links[a] += 1
                links[b] += 1
                root[find(b)] = find(a)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), (True, 0)), (i is None, i or 0))
    return [(i, links[k], None if least[find(k)][0] else least[find(k)][1]) for k, (i, _) in enumerate(rows)]


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("block,visitors", [(2048, 1 << 17), (13, 40)])
def test_join_equals_all_pairs(spark, block, visitors, monkeypatch):
    monkeypatch.setattr(ej, "BLOCK", block)
    monkeypatch.setattr(ej, "VISITORS", visitors)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    x = [c + rng.normal(size=16) * s for c in centres for s in rng.uniform(0, 0.45, 14)]
    x += list(rng.normal(size=(60, 16)))
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(900 + k, rows[3][1]) for k in range(20)] + [(950, (np.array(rows[3][1]) * 7).tolist())]
    rows += [(None, rows[5][1]), (None, rows[5][1]), (7, rows[9][1]), (960, None), (961, []), (962, [0.0] * 16),
             (963, [math.nan] + [1.0] * 15), (964, [None] + [1.0] * 15), (965, [math.inf] * 16), (966, [1.0, 0.0]),
             (967, [0.9, math.sqrt(0.19)]), (968, [3.0, 4.0]), (969, [4.0, 3.0]), (970, [1e200, 1e200]), (971, [1e-300, 1e-300])]
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows],
                               "vec_id long, embedding array<double>, cell int, digest string").repartition(5)
    got = ej.cosine_join(df, 0.9).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == sorted(brute(rows, 0.9), key=key)
    assert all(r.vec_id == r.component_id for r in got if r.kept)
    assert ej.cosine_join(df.where("vec_id < 0")).count() == 0


def test_bounds_leave_clusters_apart():
    rng = np.random.default_rng(1)
    x = ej.unit(np.concatenate([c + rng.normal(size=(50, 64)) * 0.01 for c in rng.normal(size=(8, 64))]))
    pivots = ej.farthest_first(x, 8)
    a = ej.angles(x, pivots)
    open_ = a <= a.min(axis=1, keepdims=True) + 2 * math.acos(0.9)
    assert len(pivots) == 8 and open_.sum() < 2 * len(x)


def test_given_table(spark):
    df = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in ej.cosine_join(df).collect())
    assert got == sorted(brute(rows, 0.9))
