"""The window network: gradients, brute-force scores, and what it learns."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlens.llm import pseudo_lm as lm
from cartlens.llm.common import table


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(3)
    net = lm.Network(rng.normal(0, 0.3, len(lm.Network().flat)).astype(np.float64))
    context, target = rng.integers(0, lm.VOCAB + 1, (9, 4)), rng.integers(0, lm.VOCAB, 9)
    loss, g = net.gradient(context, target)
    assert loss == pytest.approx(-net.log_probs(context, target).mean())
    for i in [*np.argsort(-abs(g.flat))[:30], *rng.integers(0, len(g.flat), 10)]:
        old = net.flat[i]
        net.flat[i] = old + 1e-4
        up = -net.log_probs(context, target).mean()
        net.flat[i] = old - 1e-4
        down = -net.log_probs(context, target).mean()
        net.flat[i] = old
        assert g.flat[i] == pytest.approx((up - down) / 2e-4, abs=1e-5)


def plain_score(text, words, net):
    ids = [words[w] for w in lm.tokens(text)]
    total = 0.0
    for i, t in enumerate(ids):
        around = [ids[k] if 0 <= k < len(ids) else lm.VOCAB for k in (i - 2, i - 1, i + 1, i + 2)]
        h = np.tanh(np.concatenate([net.embed[k] for k in around]).astype(float) @ net.hidden + net.hidden_0)
        c, m = divmod(t, lm.MEMBERS)
        for z, at in ((h @ net.cls + net.cls_0, c), (h @ net.own[c] + net.own_0[c], m)):
            total += z[at] - np.log(np.exp(z - z.max()).sum()) - z.max()
    return len(ids), total


def test_probabilities_sum_to_one():
    net = lm.Network.fresh()
    net.own[:] = np.random.default_rng(1).normal(size=net.own.shape)
    context = np.tile([[5, 9, lm.VOCAB, 70]], (lm.VOCAB, 1))
    assert np.exp(net.log_probs(context, np.arange(lm.VOCAB)).astype(float)).sum() == pytest.approx(1, abs=1e-4)


def test_learns_order_and_beats_counts(spark, monkeypatch):
    monkeypatch.setattr(lm, "STRIDE", 2)
    monkeypatch.setattr(lm, "TRAINER_POSITIONS", 20_000)
    rng = random.Random(6)
    subject, verb, thing = (["the %s" % w for w in "cat dog bird fox".split()], "sees likes hears".split(),
                            "bread milk corn fish".split())

    def text():
        return " ".join(f"{rng.choice(subject)} {rng.choice(verb)} {rng.choice(thing)} ." for _ in range(40))

    rows = [(i, text()) for i in range(500)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows] + [(None, None, 1), (900, "", 1), (901, "Zzz!", 1)],
                                 "doc_id long, text string, pll int").repartition(3)
    words, net = lm.fit(docs)
    fresh = text().split()
    mixed = rng.sample(fresh, len(fresh))
    test = spark.createDataFrame([(1, " ".join(fresh), 0), (2, " ".join(mixed), 0), (None, None, 0), (4, "", 0), (4, "x " * 20_000, 0)],
                                 "doc_id long, text string, key int")
    got = {(r.doc_id, r.n_tokens): r for r in lm.score(test, words, net).collect()}
    good, bad = got[1, len(fresh)], got[2, len(fresh)]
    assert good.mean_pll > bad.mean_pll + 1
    counts = Counter(w for _, t in rows for w in lm.tokens(t))
    unigram = np.mean([np.log(counts[w] / sum(counts.values())) for w in fresh])
    assert good.mean_pll > unigram + 0.5
    for text_, r in ((" ".join(fresh), good), (" ".join(mixed), bad), ("x " * 20_000, got[4, 20_000])):
        n, want = plain_score(text_, words, net)
        assert r.n_tokens == n and r.pll == pytest.approx(want, rel=1e-3)
    assert got[None, 0].pll == 0 and got[None, 0].mean_pll is None and (4, 0) in got
    again = lm.fit(docs.repartition(7))[1]
    assert np.abs(again.flat - net.flat).max() < 1e-6


def test_counts_cover_all_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.word: r.n for r in lm.word_counts(docs).collect()}
    want = Counter(w for r in docs.collect() for w in lm.tokens(r.text))
    assert got == want


def test_empty(spark):
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    words, net = lm.fit(docs.where(F.lit(False)))
    assert words == {} and lm.score(docs, words, net).first().pll == 0
    assert lm.score(docs.where(F.lit(False)), words, net).count() == 0


def test_every_word_has_its_own_probability(spark, monkeypatch):
    monkeypatch.setattr(lm, "HASHED", lm.VOCAB - 2)  # two words have their own id
    texts = ["a a a a b b b rare rare rare scarce " + " ".join(f"w{k}" for k in range(4000)), "a b rare", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = lm.word_counts(docs)
    words, net = lm.fit(docs, counts=counts)
    assert set(words) == {"a", "b"}
    n = Counter(w for t in texts for w in lm.tokens(t))
    ids = {}
    for w in n.keys() - {"a", "b"}:
        ids.setdefault(words[w], []).append(w)
    test = spark.createDataFrame([(1, "a rare b scarce rare"), (1, "a rare b scarce rare"), (2, "qqqq a"), (None, None)],
                                 "doc_id long, text string")
    got = lm.score(test, words, net, counts=counts).collect()
    plain = {r.doc_id: r for r in lm.score(test, words, net).collect()}

    def share(w):
        same = ids.get(words[w], [])
        total = sum(n[x] for x in same) + len(same)
        spelled = -(len(w) + 1) * np.log(257) + (np.log(len(same) / total) if same else 0)
        return np.log(n[w] / total) if w in n else spelled

    assert len(got) == 4 and len({r.pll for r in got if r.doc_id == 1}) == 1
    for r in got:
        add = {1: 2 * share("rare") + share("scarce"), 2: share("qqqq"), None: 0}[r.doc_id]
        assert r.pll == pytest.approx(plain[r.doc_id].pll + add, abs=1e-5)
    kinds = lm.with_shares(spark.createDataFrame([(w,) for w in n if w not in words], "word string"), counts, words)
    assert kinds.count() == len(n) - 2  # all words of the corpus, however many


def test_every_position_is_a_target(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdefgh", k=n)) for n in (1, 2, 15, 16, 700, 1300)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words, _ = lm.fit(docs)
    rows = lm.positions(docs, words).collect()
    got = Counter(tuple(x) for r in rows for k in range(max(lm.STRIDE, lm.ROUNDS))
                  for x in lm.targets(r.ids, k % lm.STRIDE).tolist())
    want = Counter()
    for text in texts:
        ids = np.array([words[w] for w in lm.tokens(text)], dtype=np.int64)
        want.update(tuple(x) for x in np.concatenate([lm.contexts(ids), ids[:, None]], axis=1).tolist())
    assert got == want and sum(r.n for r in rows) == sum(want.values())
    only = docs.where("doc_id = 0")  # no target in the second round
    assert lm.fit(only)[1].flat.any()


def test_every_trainer_has_a_network_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(lm, "TRAINER_POSITIONS", 200)
    seen = []
    averaged = lm._averaged

    def watch(spark_, parts):
        seen.append(sorted((r.trainer, r.weight) for r in parts.select("trainer", "weight").collect()))
        return averaged(spark_, parts)

    monkeypatch.setattr(lm, "_averaged", watch)
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, " ".join(rng.choices("abcdefgh", k=50))) for i in range(200)], "doc_id long, text string")
    lm.fit(docs)
    trainers = -(-10_000 // (lm.STRIDE * 200))
    for round_ in seen:  # as many rows as trainers, however many of them a task reads
        assert [t for t, _ in round_] == list(range(trainers))
        assert max(w for _, w in round_) < 3 * 10_000 / lm.STRIDE / trainers
    assert sum(w for round_ in seen for _, w in round_) == 10_000


def test_training_and_scoring_share_one_coded_pass(spark, monkeypatch):
    """The same network and scores from the staged ids as from the texts, which are then cut into tokens once."""
    rng = random.Random(12)
    texts = [" ".join(rng.choices(["a", "b", "c", *(f"w{k}\u00e9" for k in range(300))], k=n)) for n in (1, 40, 600, 1200)]
    docs = spark.createDataFrame([*enumerate(texts), (1, texts[1]), (None, None), (9, "")], "doc_id long, text string")
    monkeypatch.setattr(lm, "HASHED", lm.VOCAB - 2)
    counts = lm.word_counts(docs)
    words = lm.own_words(counts)
    codes = lm.staged_codes(docs, words)
    for r in codes.collect():
        found = lm.tokens(texts[r.doc_id] if r.doc_id in range(4) else None)
        assert np.frombuffer(r.ids, "<u2").tolist() == [words[w] for w in found]
        assert dict(zip(r.rare, r.times)) == Counter(w for w in found if w not in words)
    plain, net = lm.fit(docs, counts=counts)[1], lm.fit(docs, counts=counts, codes=codes)[1]
    assert np.array_equal(plain.flat, net.flat)
    want = sorted(map(str, lm.score(docs, words, net, counts=counts).collect()))
    monkeypatch.setattr(lm, "tokens", None)  # no text is read again
    assert sorted(map(str, lm.score(docs, words, net, counts=counts, codes=codes).collect())) == want
    plan = lm.with_shares(docs.select(F.col("text").alias("word")), counts, words)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan


def test_steps_reuse_their_memory():
    rng = np.random.default_rng(5)
    net = lm.Network.fresh()
    context, target = rng.integers(0, lm.VOCAB + 1, (lm.STEP, 4)), rng.integers(0, lm.VOCAB, lm.STEP)
    _, first = net.gradient(context, target)
    kept, room = first.flat.copy(), {k: id(v) for k, v in net.working.items()}
    _, second = net.gradient(context[:7], target[:7])
    assert {k: id(v) for k, v in net.working.items()} == room and second is first
    assert np.array_equal(net.gradient(context, target)[1].flat, kept)  # nothing is left of the step between


def test_frequent_rarer_words_are_summed_while_texts_are_coded(spark, monkeypatch):
    """Only words below the known ones are listed for the join, and the scores are the same."""
    rng = random.Random(21)
    texts = [" ".join(rng.choices(["a", "b", "c", "d", *(f"w{k}é" for k in range(300))], [90, 80, 40, 30] + [1] * 300, k=n))
             for n in (30, 400, 900)]
    docs = spark.createDataFrame([*enumerate(texts), (1, texts[1]), (None, None), (9, ""), (10, "once c")], "doc_id long, text string")
    monkeypatch.setattr(lm, "HASHED", lm.VOCAB - 2)
    counts = lm.word_counts(docs)
    words, net = lm.fit(docs, counts=counts)
    monkeypatch.setattr(lm, "KNOWN", 2)
    known = lm.known_shares(counts, words)
    assert sorted(known.places) == ["c", "d"]
    want = {r.word: r.share for r in lm.with_shares(spark.createDataFrame([("c",), ("d",)], "word string"), counts, words).collect()}
    assert {w: known.shares[k - lm.VOCAB] for w, k in known.places.items()} == want
    plain, codes = lm.staged_codes(docs, words), lm.staged_codes(docs, words, counts=counts)
    listed = {w for r in codes.collect() for w in r.rare}
    assert "once" in listed and not listed & {"a", "b", "c", "d"}
    assert sorted(map(str, codes.select("doc_id", "ids").collect())) == sorted(map(str, plain.select("doc_id", "ids").collect()))
    got = [sorted(map(str, lm.score(docs, words, net, counts=counts, codes=x).collect())) for x in (plain, codes)]
    assert got[0] == got[1]
    assert not lm.known_shares(counts, words, 0).places  # none, rather than some of one count
    assert not lm.known_shares(counts.where("false"), words).places


def test_texts_are_cut_by_array_into_the_same_tokens():
    rng = random.Random(31)
    kinds = lm.char_kinds()
    odd = [None, "", "\n", " a", "a\n", "ΑΣ", "ΟΔΟΣ ΣΑΣ", "İx", "é_é!!..  x　日本 語、x", "\x1c\x85a​b", "😀😀a😀", ""]
    odd += ["".join(chr(rng.choice([rng.randrange(128), rng.randrange(0xd800), rng.randrange(0xe000, 0x110000)]))
                    for _ in range(rng.randrange(40))) for _ in range(300)]
    for texts in ([], [None], [""], odd, odd[::-1], ["a b", "", None, "A.b\t"]):
        found, sizes = lm.cut(texts, kinds)
        want = [lm.tokens(t) for t in texts]
        found.validate(full=True)
        assert found.to_pylist() == [w for x in want for w in x] and sizes.tolist() == [len(x) for x in want]


def test_counting_and_coding_hold_no_object_per_token(spark, monkeypatch):
    rng = random.Random(32)
    texts = [" ".join(rng.choices(["a", "b", "ß!", *(f"W{k}é" for k in range(200))], k=n)) for n in (1, 30, 600, 900)] + ["", None, "?"]
    docs = spark.createDataFrame([*enumerate(texts), (1, texts[1])], "doc_id long, text string").repartition(2)
    every = {r.doc_id: lm.tokens(r.text) for r in docs.collect()}
    want = Counter(w for r in docs.collect() for w in lm.tokens(r.text))
    monkeypatch.setattr(lm, "tokens", None)
    monkeypatch.setattr(lm, "HASHED", lm.VOCAB - 2)
    for held in (lm.HELD_WORDS, 100, 1):  # merged and passed on more than once
        monkeypatch.setattr(lm, "HELD_WORDS", held)
        counts = lm.word_counts(docs)
        assert {r.word: r.n for r in counts.collect()} == want
    words = lm.own_words(counts)
    monkeypatch.setattr(lm, "KNOWN", 60)
    known = lm.known_shares(counts, words)
    assert known.places
    for r in lm.encode(docs, words, known=known).collect():
        found = every[r.doc_id]
        assert np.frombuffer(r.ids, "<u2").tolist() == [words[w] for w in found]
        assert dict(zip(r.rare, r.times)) == Counter(w for w in found if w not in words and w not in known.places)
        assert r.add == sum(int(known.shares[known.places[w] - lm.VOCAB]) for w in found if w in known.places)
