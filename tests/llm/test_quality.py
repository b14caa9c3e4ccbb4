import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlens.llm import quality as q
from cartlens.llm.common import staged, table

SF = "/root/testdata/sf0.1"
DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int"


def prose(rng, n):
    return " ".join("".join("aeioulnrst"[k] for k in rng.integers(0, 10, rng.integers(2, 9))) for _ in range(n)).capitalize() + "."


def corpus(n=600, good=0.7, seed=0):
    """(doc_id, text, good): prose, or the same prose shouted or with symbols."""
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        text, fine = prose(rng, int(rng.integers(10, 80))), rng.random() < good
        rows.append((i, text if fine else text.upper() if i % 2 else text.replace(" ", "$$ "), int(fine)))
    return rows


def brute_risk(x, positives, w, prior):
    u = np.mean([np.logaddexp(0, float(r @ w)) for r in x])
    p_minus = np.mean([np.logaddexp(0, float(r @ w)) for r in positives])
    p_plus = np.mean([np.logaddexp(0, -float(r @ w)) for r in positives])
    return prior * p_plus + max(0.0, u - prior * p_minus) + q.RIDGE / len(positives) / 2 * float(w @ w)


def test_learns_from_positives_alone_and_estimates_the_prior(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS).repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3 == 0], LABELS)
    feats = staged(q.features(docs), "test_quality")
    positives = q.positives_of(feats, labels)
    model = q.fit(feats, positives)
    share = sum(y for *_, y in rows) / len(rows)
    assert abs(model.prior - share) < 0.08
    found = {r.doc_id: r.score for r in q.score(feats, model).collect()}
    right = np.mean([(found[i] >= 0.5) == bool(y) for i, _, y in rows if i % 3])
    assert right > 0.97
    # negative labels are never read
    flipped = labels.where("quality = 1")
    assert (q.positives_of(feats, flipped) == positives).all()


def test_sums_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = corpus(40, seed=2)
    feats = q.features(spark.createDataFrame([r[:2] for r in rows], DOCS).repartition(3))
    x = np.array([q.describe(t) for _, t, _ in rows], dtype=float)
    w = rng.normal(size=q.WIDTH)
    found = q.unlabelled(feats, w)
    z = x @ w
    p = 1 / (1 + np.exp(-z))
    assert found.loss == pytest.approx(np.mean([np.log(1 + np.exp(v)) for v in z]))
    assert np.allclose(found.gradient, sum(pi * xi for pi, xi in zip(p, x)) / len(x))
    assert np.allclose(found.hessian, sum(pi * (1 - pi) * np.outer(xi, xi) for pi, xi in zip(p, x)) / len(x))


def test_gradient_of_the_logistic_sum_matches_differences():
    rng = np.random.default_rng(3)
    x, w, e = rng.normal(size=(30, 5)), rng.normal(size=5), 1e-6
    s = q.sums(x, w)
    for k in range(5):
        d = np.eye(5)[k] * e
        assert s.gradient[k] == pytest.approx((q.sums(x, w + d).loss - q.sums(x, w - d).loss) / (2 * e), rel=1e-4)
        assert np.allclose(s.hessian[k], (q.sums(x, w + d).gradient - q.sums(x, w - d).gradient) / (2 * e), rtol=1e-3, atol=1e-4)


@pytest.mark.parametrize("prior", [0.3, 0.7, 0.95])
def test_risk_falls_to_a_minimum_and_is_never_negative(prior):
    rows = corpus(200, seed=4)
    x = np.array([q.describe(t) for _, t, _ in rows], dtype=float)
    positives = x[[k for k, r in enumerate(rows) if r[2]]][:80]

    def all_sums(w):
        s = q.sums(x, w)
        return q.Sums(s.loss / len(x), s.gradient / len(x), s.hessian / len(x))

    start = np.zeros(q.WIDTH)
    w = q.nonnegative_risk(positives, prior, all_sums, start)
    end = brute_risk(x, positives, w, prior)
    assert 0 <= end < brute_risk(x, positives, start, prior)
    rng = np.random.default_rng(5)
    assert all(brute_risk(x, positives, w + rng.normal(size=len(w)) * 0.05, prior) > end - q.SMOOTH * np.log(2) for _ in range(20))


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(6)
    for share in (0.2, 0.5, 0.9):
        u = np.where(rng.random(20_000) < share, rng.normal(3, 1, 20_000), rng.normal(-3, 1, 20_000))
        found = q.class_prior(rng.normal(3, 1, 3000), lambda cuts: np.array([(u >= c).sum() for c in cuts], float), len(u))
        assert abs(found - share) < 0.05


def test_whole_texts_are_described(monkeypatch):
    text = "ab CD 1!\n$" * 50 + "Ü"
    whole = q.describe(text)
    monkeypatch.setattr(q, "CHUNK", 7)
    assert np.allclose(q.describe(text), whole)
    assert not np.allclose(q.describe(text + "$" * 400), whole)


def test_nulls_empty_long_repeats_and_other_columns(spark):
    rows = corpus(60, seed=7)
    docs = [r[:2] for r in rows] + [(0, rows[0][1]), (None, rows[0][1]), (900, None), (901, ""), (902, "long " * 100_000)]
    df = spark.createDataFrame(docs, DOCS).withColumn("x", F.lit("?")).withColumn("id", F.lit(1)).withColumn("quality", F.lit(0))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 1), (None, 1), (3, None)], LABELS)
    found = q.classify(df, labels.withColumn("text", F.lit("x"))).collect()
    assert len(found) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= q.THRESHOLD) for r in found)
    score = {}
    for r in found:
        score.setdefault(r.doc_id, []).append(r.score)
    assert len(set(score[0] + score[None])) == 1 and score[900] == score[901]


def test_empty_tables_and_no_positives(spark):
    docs, none = spark.createDataFrame([(1, "Some text.")], DOCS), spark.createDataFrame([], LABELS)
    assert q.classify(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1)], LABELS)).collect() == []
    assert [tuple(r) for r in q.classify(docs, none).collect()] == [(1, 0.5, 0)]
    assert [r.score for r in q.classify(docs, spark.createDataFrame([(1, 0), (7, 1)], LABELS)).collect()] == [0.5]


def test_held_out_labels_of_the_given_tables(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    found = q.classify(docs, labels.where(~q.held_out())).join(labels.where(q.held_out()), "doc_id").toPandas()
    good = found.quality == 1
    assert good.sum() > 500 and (~good).sum() > 100
    assert (found.predicted[good] == 1).mean() > 0.98 and (found.predicted[~good] == 0).mean() > 0.95
