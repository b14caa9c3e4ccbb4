"""The two-pass shuffle: whole, balanced, gapless, seeded and mixed."""

from collections import Counter

import numpy as np
import pytest

from cartlens.llm import sharding as sh
from cartlens.llm.queries import op4_sharding

ROWS = [(k, f"text {k}" * (k % 9)) for k in range(900)] + [(2000 + k, "hot") for k in range(400)]
ROWS += [(None, "hot")] * 30 + [(None, None)] * 20 + [(5, ""), (5, ""), (6, "x" * 100_000)]


def frame(spark):
    return spark.createDataFrame([(i, t, 1, "s") for i, t in ROWS], "doc_id long, text string, shard int, slot string")


@pytest.mark.parametrize("n_shards,bucket_bytes", [(24, 2048), (7, 1 << 20), (3000, 4096)])
def test_whole_balanced_and_gapless(spark, n_shards, bucket_bytes):
    got = sh.shard_documents(frame(spark), n_shards, bucket_bytes=bucket_bytes).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(ROWS)
    sizes = Counter(r.shard for r in got)
    low = len(ROWS) // n_shards
    assert set(sizes) <= set(range(n_shards)) and set(sizes.values()) <= {low, low + 1}
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))


def test_seed_decides_and_order_is_mixed(spark, scratch):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    docs.write.parquet(f"{scratch}/docs")
    docs = spark.read.parquet(f"{scratch}/docs")

    def order(seed):
        rows = sh.shard_documents(docs, 10, seed=seed, bucket_bytes=4096).collect()
        return [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]

    one = order(1)
    assert one == order(1) and one != order(2)
    assert abs(np.corrcoef(one, range(4000))[0, 1]) < 0.06
    shards = np.array([i // 400 for i in range(4000)])
    assert all(abs(np.mean(np.array(one)[shards == s]) - 2000) < 250 for s in range(10))


def test_fisher_yates_is_uniform():
    rng = np.random.default_rng(3)
    seen = Counter(tuple(sh.fisher_yates(4, rng)) for _ in range(24_000))
    assert len(seen) == 24 and all(abs(n - 1000) < 160 for n in seen.values())
    assert sh.fisher_yates(0, rng) == [] and sh.fisher_yates(1, rng) == [0]


def test_empty_and_query(spark):
    assert sh.shard_documents(frame(spark).where("doc_id < 0"), 5).count() == 0
    with pytest.raises(ValueError):
        sh.shard_documents(frame(spark), 0)
    got = op4_sharding(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    assert set(Counter(r.shard for r in got).values()) == {8, 9}
