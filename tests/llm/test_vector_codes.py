import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlens.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=4, k=256, rounds=4, scale=1024):
    """Lloyd rounds in plain numpy -> {vec_id: (code, error, label_error, sha)}."""
    good = sorted((i, tuple(int(np.floor(scale * c)) for c in v), y) for i, v, y in rows
                  if v is not None and all(c is not None and np.isfinite(c) for c in v))
    x = np.array([g[1] for g in good])
    w = x.shape[1] // parts
    cuts = [x[:, p * w:(p + 1) * w] for p in range(parts)]
    books = [c[:k].copy() for c in cuts]

    def assign(c, b):
        d = ((c[:, None] - b[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        for c, b in zip(cuts, books):
            a, _ = assign(c, b)
            for e in set(a.tolist()):
                b[e] = c[a == e].sum(0) // int((a == e).sum())
    found = [assign(c, b) for c, b in zip(cuts, books)]
    sha = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    errors = sum(f[1] for f in found)
    by_label = {}
    for g, e in zip(good, errors.tolist()):
        by_label[g[2]] = by_label.get(g[2], 0) + e
    return {g[0]: ("".join(f"{f[0][i]:02x}" for f in found), int(errors[i]), by_label[g[2]], sha)
            for i, g in enumerate(good)}


def result(df, **kwargs):
    return {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in vc.compress(df, **kwargs).collect()}


def test_equals_plain_lloyd_on_any_layout(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) + 3 * (i % 7)).tolist(), [None, 1, 2][i % 3]) for i in range(300)]
    expected = plain(rows, k=20)
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5), n_entries=20) == expected
    assert result(spark.createDataFrame(rows[::-1], SCHEMA).coalesce(1), n_entries=20) == expected


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = [(5, [0.1, 0.2, 0.3, 0.4], 1), (1, None, 1), (2, [0.1, None, 0.3, 0.4], 1), (3, [0.1, float("nan"), 0.0, 0.0], 1),
            (4, [float("inf"), 0.0, 0.0, 0.0], 1), (6, [], 1), (7, [0.0, 0.0], None), (8, [-0.1, -0.2, -0.3, -0.4], None),
            (5, [0.1, 0.2, 0.3, 0.4], 1), (None, [0.1, 0.2, 0.3, 0.4], None), (9, [1e30, -1e30, 0.0, 0.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("entry", F.lit(1)).withColumn("c0", F.lit(2))
    found = vc.compress(df).collect()
    assert sorted((r.vec_id or -1) for r in found) == [-1, 5, 5, 8, 9]
    assert {r.error for r in found} == {0}  # fewer vectors than entries: each is its own entry
    same = {r.code for r in found if r.vec_id in (5, None)}
    assert same == {"00000000"}  # ties go to the lower entry


def test_empty(spark):
    assert vc.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vc.compress(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).collect() == []


def test_length_that_parts_do_not_divide(spark):
    rows = [(i, [float(i % 5), 1.0, 2.0, 3.0, float(i % 3)], 0) for i in range(40)]
    found = vc.compress(spark.createDataFrame(rows, SCHEMA), n_entries=40).collect()
    assert len(found) == 40 and {r.error for r in found} == {0}


def test_residents_are_summed_without_an_exchange_and_only_movers_migrate(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist(), 0) for i in range(600)]
    whole = vc.staged(vc.integer_vectors(spark.createDataFrame(rows, SCHEMA)), "test_vectors")
    books = vc.learn_codebooks(whole, n_entries=16)
    assert len(books.moved) == 3 and all(0 <= m < 4 * 600 for m in books.moved)
    assert books.moved[-1] < books.moved[0]
    first = vc._Layer(vc._first_owners(whole, books.entries, 8, 2).repartition(8, *vc.OWNER), 8)
    plan = vc.member_sums([first.rows])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # of the owners' sums, not of the members
    first.drop()


def test_one_entry_with_every_row_is_spread_over_salts(spark):
    whole = vc.staged(vc.integer_vectors(spark.createDataFrame([(i, [0.5] * 4, 0) for i in range(2000)], SCHEMA)), "test_hot")
    owners = vc._first_owners(whole, [np.full((1, 1), 512)] * 4, 4, -(-2000 // vc.SALT_ROWS)).groupBy(*vc.OWNER).count()
    assert owners.agg(F.max("count")).first()[0] < 2 * vc.SALT_ROWS
    assert {r.error for r in vc.encode(whole, vc.learn_codebooks(whole)).collect()} == {0}


@pytest.mark.parametrize("size", [1, 1 << 26])
def test_nearest_is_exact_for_small_and_large_integers(size):
    rng = np.random.default_rng(3)
    x, e = rng.integers(-size, size + 1, (50, 16)), rng.integers(-size, size + 1, (20, 16))
    d = ((x[:, None].astype(object) - e[None].astype(object)) ** 2).sum(2)
    best, dist = vc.nearest(x, e)
    assert best.tolist() == d.argmin(1).tolist() and dist.tolist() == d.min(1).tolist()
