"""Components against a plain union-find."""

import random

from cartlens.llm import components as components_
from cartlens.llm.components import components


def plain(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {x: find(x) for x in root}


def test_random_graphs_paths_and_stars(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(2500, i) for i in range(2000, 2300)] + [(5, 5), (None, 3)]
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.id: r.root for r in got} == plain(edges)
    assert len(got) == len({r.id for r in got})


def test_no_edges(spark):
    assert components(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0


def test_few_edges_are_finished_in_one_task(spark, monkeypatch):
    """The same classes by rounds and in one task; few edges cost two written tables, not two a round."""
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(-k, -k - 1) for k in range(2, 60)]
    found, written = {}, []
    staged = components_.staged
    monkeypatch.setattr(components_, "staged", lambda df, name: written.append(name) or staged(df, name))
    for most in (1 << 16, 100, 0):  # at once, after some rounds if any, by rounds alone
        monkeypatch.setattr(components_, "FEW_EDGES", most)
        written.clear()
        found[most] = sorted(tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect())
        assert (len(written) == 2) == (most == 1 << 16)
    assert found[1 << 16] == found[100] == found[0]
