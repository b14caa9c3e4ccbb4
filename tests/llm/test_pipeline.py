"""The pipeline against brute-force versions of its stages."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from cartlens.llm import packing as pk, toxicity as tx
from cartlens.llm.common import table

from .test_ngram_join import brute

SF = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark, scratch):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    step = docs
    kept = []
    for name, stage in cp.STAGES:
        step = stage(spark, step, SF)
        step.write.parquet(f"{scratch}/{name}")
        step = spark.read.parquet(f"{scratch}/{name}")
        if name != "packing":
            assert step.columns == docs.columns
            assert all(rows[r.doc_id] == r for r in step.collect())
        kept.append(sorted(r.doc_id for r in step.select("doc_id").collect()))
    index = tx.fit(docs, table(spark, SF, "labels").where(~tx.held_out()))
    clean = sorted(i for i, r in rows.items() if index.score(index.nearest(*index.vector(r.text))) < 0.5)
    assert kept[0] == clean and 0 < len(clean) < len(rows)
    best = {}
    for i in clean:
        best[rows[i].text] = max(i, best.get(rows[i].text, i))
    assert kept[1] == sorted(best.values())
    classes = brute([(i, rows[i].text) for i in kept[1]])
    assert kept[2] == sorted(i for i, (c, _) in zip(kept[1], classes) if c == i)
    assert kept[3] == kept[2]
    packed = step.collect()
    lengths = {i: len(rows[i].text.split()) for i in kept[2]}
    assert {r.doc_id: r.length for r in packed} == lengths
    check_packing(packed, pk.BUCKETS)
    assert sorted(r.doc_id for r in cp.run(spark, SF).collect()) == kept[3]


def check_packing(packed, k, budget=pk.TOKEN_BUDGET):
    batches = {}
    for r in packed:
        assert r.length <= r.bucket_length
        batches.setdefault((r.bucket, r.batch), []).append(r)
    last = {}
    for (b, n), rs in batches.items():
        last[b] = max(last.get(b, 0), n)
    for (b, n), rs in batches.items():
        room = max(1, budget // rs[0].bucket_length)
        assert sorted(r.slot for r in rs) == list(range(len(rs))) and len(rs) <= room
        assert len(rs) == room or n == last[b]
        assert n == 0 or (b, n - 1) in batches
    assert len(last) <= k


#: Nulls, an empty and a very long text, repeated rows, and columns under names that stages use.
EDGE = [(1, "good calm prose of an ordinary kind that nobody minds at all", "en", "a", 1), (2, None, None, None, None),
        (3, "", "en", "a", 0), (4, "word " * 60_000, "en", "a", 1), (5, "some text that is here twice with its id", "en", "b", 2),
        (5, "some text that is here twice with its id", "en", "b", 2), (None, "a text without an id of its own", "en", "c", 3)]


def edge_docs(spark, rows=EDGE):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit(c) for c in ("__id", "__sha", "__own_sha", "__hash", "__kept", "kept", "row", "key", "sid")})


@pytest.mark.parametrize("name,left", [("toxicity", 7), ("exact_dedup", 5), ("near_dedup", 6)])
def test_filtering_stages_take_nulls_repeats_and_clashing_columns(spark, name, left):
    docs = edge_docs(spark)
    found = dict(cp.STAGES)[name](spark, docs, SF)
    assert found.columns == docs.columns
    rows = found.collect()
    assert len(rows) == left and all(r["__own_sha"] == "__own_sha" and r["sid"] == "sid" for r in rows)
    assert {1, 4, 5, None} <= {r.doc_id for r in rows}


def test_packing_stage_takes_nulls_repeats_and_clashing_columns(spark):
    found = cp.packing(spark, edge_docs(spark), SF).collect()
    assert sorted((r.doc_id or -1, r.length) for r in found) == [(-1, 8), (1, 12), (2, 0), (3, 0), (4, 60_000), (5, 9), (5, 9)]
    assert len({(r.bucket, r.batch, r.slot) for r in found}) == len(found)


@pytest.mark.parametrize("name", [name for name, _ in cp.STAGES])
def test_every_stage_takes_an_empty_table(spark, name):
    assert dict(cp.STAGES)[name](spark, edge_docs(spark, []), SF).collect() == []
