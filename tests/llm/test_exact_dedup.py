"""Tree-merged exact dedup against a plain grouping."""

import hashlib

import pytest

from cartlens.llm import exact_dedup as ed

ROWS = [(k, f"text {k % 40}") for k in range(300)] + [(1000 + k, "hot") for k in range(200)]
ROWS += [(None, "hot"), (None, "only nulls"), (None, "only nulls"), (7, "text 3"), (7, "text 7"), (7, "text 7"),
         (501, None), (502, ""), (503, None), (504, " "), (505, "Text 3"), (506, "x" * 200_000), (507, "x" * 200_000)]


def plain(rows, keep):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    best = {t: (max if keep == "max" else min)([i for i in ids if i is not None], default=None)
            for t, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in rows), key=key)


def key(r):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("runs,fan_in", [(64, 8), (5, 2)])
def test_equals_plain_grouping(spark, keep, runs, fan_in, monkeypatch):
    monkeypatch.setattr(ed, "RUNS", runs)
    monkeypatch.setattr(ed, "FAN_IN", fan_in)
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in ROWS],
                                 "doc_id long, text string, digest string, run int").repartition(9)
    got = ed.exact_dedup(docs, keep=keep).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == plain(ROWS, keep)
    alive = [r for r in got if r.kept]
    assert all(r.doc_id == r.keep_id for r in alive)
    assert len(alive) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in alive})


def test_rows_that_stay_keep_their_columns(spark):
    docs = spark.createDataFrame([(i, t, f"own {i}", 2) for i, t in ROWS],
                                 "doc_id long, text string, kept string, __sha int")
    docs = docs.withColumnRenamed("__sha", "text_sha256")
    got = ed.drop_exact_copies(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    want = {t or "" for _, t in ROWS}
    assert sorted((r.text or "") for r in rows) == sorted(want)
    assert all(r.kept == f"own {r.doc_id}" for r in rows)


def test_empty_and_native(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ed.exact_dedup(docs).count() == 0 and ed.drop_exact_copies(docs).count() == 0
    plan = ed.exact_dedup(spark.createDataFrame(ROWS, "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    with pytest.raises(ValueError):
        ed.exact_dedup(docs, keep="first")


def test_any_column_names_are_kept(spark):
    names = ["__sha", "__id", "__own_sha", "own_sha", "alive_id", "alive_sha", "kept", "run", "digest"]
    rows = [(i, t, *[f"{n} {i}" for n in names]) for i, t in ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    left = ed.drop_exact_copies(docs)
    assert left.columns == docs.columns
    for r in left.collect():
        assert all(r[n] == f"{n} {r.doc_id}" for n in names)
    assert left.count() == len({t or "" for _, t in ROWS})
