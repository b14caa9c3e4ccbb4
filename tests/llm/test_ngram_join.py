"""The forest join against brute force over all pairs of shingle sets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlens.llm import ngram_join as nj
from cartlens.llm.common import table
from cartlens.llm.shingles import shingle_set


def plain_set(text):
    words = re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, limit=0.8):
    """{place: (class id, links)} by an inverted index over plain shingles."""
    sets = [plain_set(t) for _, t in rows]
    at = {}
    for k, s in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(k)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, s in enumerate(sets):
        seen = {}
        for x in s:
            for o in at[x]:
                if o > k:
                    seen[o] = seen.get(o, 0) + 1
        for o, both in seen.items():
            if both >= limit * (len(s) + len(sets[o]) - both):
                links[k] += 1
                links[o] += 1
                a, b = find(k), find(o)
                root[b] = a
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), (True, 0)), (i is None, i if i is not None else 0))
    return [(None if least[find(k)][0] else least[find(k)][1], links[k]) for k in range(len(rows))]


def test_shingle_sets_match_plain_ones():
    rng = random.Random(2)
    texts = ["", "one", "One, TWO three", "a b c d e", "a b c d e f a b c d e f", "é ñ 日本 x-y z", "x" * 200_000 + " b c d e f"]
    texts += [" ".join(rng.choices("ab cd ef gh".split(), k=rng.randint(0, 40))) for _ in range(200)]
    texts.append(" ".join(rng.choices(["word", "other", "thing"], k=60_000)))
    for text in texts:
        assert len(shingle_set(text)) == len(plain_set(text)), text[:50]
    assert (shingle_set("A  b,c D\ne") == shingle_set("a b c d e")).all()


def test_min_hashes_estimate_jaccard():
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(0, 2**63, 900).astype(np.uint64))
    a, b = x[:700], x[200:]
    la, lb = b"".join(nj.labels_of(a)), b"".join(nj.labels_of(b))
    same = np.mean(np.frombuffer(la, ">u2") == np.frombuffer(lb, ">u2"))
    assert abs(same - 500 / len(x)) < 0.15


def variants(rng):
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    out = []
    for _ in range(60):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("cell_sets", [512, 7])
def test_join_equals_brute_force(spark, cell_sets, monkeypatch):
    monkeypatch.setattr(nj, "CELL_SETS", cell_sets)
    rng = random.Random(4)
    texts = variants(rng) + variants(rng)
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(1, 90))) for _ in range(150)]
    texts += ["same words here"] * 9 + ["Same, words here!"] + ["", None, " ", "!!", "", None] + ["x " * 30_000] * 2
    rows = [(None if k % 37 == 0 else k // 2 if k % 11 == 0 else 1000 + k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], "doc_id long, text string, size string, row int")
    got = nj.jaccard_join(docs).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    with_words = [(i, *w) for (i, t), w in zip(rows, want) if plain_set(t)]
    wordless = [(i, i, 0) for i, t in rows if not plain_set(t)]
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=key) == sorted(with_words + wordless, key=key)
    for r in got:
        if r.kept:
            assert r.doc_id == r.class_id
    n_classes = len(brute_roots(rows)) + len(wordless)
    assert sum(r.kept for r in got) == n_classes


def brute_roots(rows):
    sets = [(k, plain_set(t)) for k, (_, t) in enumerate(rows) if plain_set(t)]
    root = {k: k for k, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, o in sets[n + 1:]:
            both = len(s & o)
            if both >= 0.8 * (len(s) + len(o) - both):
                root[find(b)] = find(a)
    return {find(k) for k, _ in sets}


def test_whole_small_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.class_id, r.n_links) for r in nj.jaccard_join(docs).collect()}
    assert got == {i: w for (i, _), w in zip(rows, brute(rows))}
    left = nj.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == sorted(i for i, (c, _) in got.items() if c == i)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nj.jaccard_join(docs).count() == 0 and nj.drop_near_copies(docs.where(F.lit(True))).count() == 0


def test_any_column_names_are_kept(spark):
    names = ["__id", "__hash", "__kept", "own_hash", "alive_id", "alive_hash", "sid", "thash"]
    texts = ["one two three four five six seven eight nine ten"] * 2 + [None, None, "", "another text of its own entirely here"]
    rows = [(i, t, *[f"{n} {i}" for n in names]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    left = nj.drop_near_copies(docs)
    assert left.columns == docs.columns
    got = left.collect()
    assert sorted(r.doc_id for r in got) == [0, 2, 3, 4, 5]
    assert all(r[n] == f"{n} {r.doc_id}" for r in got for n in names)
