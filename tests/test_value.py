import bisect
import random
import struct

import pytest
from pyspark.sql import functions as F

from cartlens.operators import value, views


def metrics_df(spark, values):
    rows = [(f"c{i}", "F", 30, "Youth", 1, v, v) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "customer_id string, gender string, age int, age_group string, frequency long, "
              "monetary double, avg_transaction double")


def lower_median(values):
    vals = sorted(v for v in values if v is not None)
    return vals[(len(vals) + 1) // 2 - 1] if vals else None


@pytest.mark.parametrize("values", [
    [5.0, 1.0, 3.0],                 # odd
    [4.0, 1.0, 3.0, 2.0],            # even: lower median
    [2.0, 2.0, 2.0, 1.0, 3.0],       # ties at the median
    [7.0],
    [1.0, None, 2.0],
])
def test_exact_median(spark, values):
    df = metrics_df(spark, values)
    assert value.median_monetary(df, rel_error=0.0).first()[0] == lower_median(values)


def test_exact_median_large_and_skewed(spark):
    rnd = random.Random(3)
    vals = [round(rnd.uniform(0, 1000), 2) for _ in range(20000)]
    vals += [500.0] * 10000               # a third of all values equal
    df = metrics_df(spark, vals)
    got = value.median_monetary(df, rel_error=0.0, bits=4).first()[0]
    assert got == lower_median(vals)


@pytest.mark.parametrize("seed,n,bits", [
    (1, 1, 16), (2, 2, 16), (3, 997, 8), (4, 1000, 13), (5, 5000, 16), (6, 3000, 20),
])
def test_exact_median_stress(spark, seed, n, bits):
    rnd = random.Random(seed)
    shape = seed % 3
    if shape == 0:
        vals = [round(rnd.uniform(0, 100), 2) for _ in range(n)]
    elif shape == 1:
        vals = [float(rnd.choice([5, 5, 5, 7])) for _ in range(n)]       # bracket of equal values
    else:
        vals = [round(rnd.gauss(50, 0.05), 2) for _ in range(n)]          # dense cluster
    got = value.median_monetary(metrics_df(spark, vals), rel_error=0.0, bits=bits).first()[0]
    assert got == lower_median(vals)


def test_approx_median_is_close(spark):
    vals = [float(i) for i in range(1, 10001)]
    got = value.median_monetary(metrics_df(spark, vals), rel_error=0.001).first()[0]
    assert abs(got - 5000) <= 10


def test_label_strictly_greater(spark):
    df = metrics_df(spark, [1.0, 2.0, 2.0, 3.0])
    out = value.label_value(df, value.median_monetary(df, rel_error=0.0))
    assert sorted((r.monetary, r.customer_value) for r in out.collect()) == [
        (1.0, 0), (2.0, 0), (2.0, 0), (3.0, 1)]


def test_value_views(spark):
    df = value.label_value(metrics_df(spark, [1.0, 2.0, 3.0]),
                           value.median_monetary(metrics_df(spark, [1.0, 2.0, 3.0]), rel_error=0.0))
    counts = [tuple(r) for r in views.value_counts(df).collect()]
    assert counts == [(0, "General customer", 2, 66.7), (1, "High value customer", 1, 33.3)]
    mix = views.gender_value_mix(df).first()
    assert (mix.general_count, mix.high_value_count, mix.total, mix.general_pct) == (2, 1, 3, 66.7)
    hist = views.monetary_histogram(df, bins=4).collect()
    assert [(r.bin, r["count"]) for r in hist] == [(0, 1), (1, 0), (2, 1), (3, 1)]


def test_model_end_to_end(spark):
    rnd = random.Random(1)
    vals = [rnd.uniform(0, 100) for _ in range(300)]
    rows = [(f"c{i}", "F", 20 + i % 40, "Youth", 1 + i % 7, v, v / 3) for i, v in enumerate(vals)]
    m = spark.createDataFrame(rows, "customer_id string, gender string, age int, age_group string, "
                                    "frequency long, monetary double, avg_transaction double")
    feats = value.label_value(m, value.median_monetary(m, rel_error=0.0))
    vectors = value.value_features(feats)
    counts = value.split_counts(vectors).first()
    train, test = value.split_customers(vectors)
    assert counts.vectors == 300 and counts.train == train.count() and counts.test == test.count()
    model = value.value_model(train, num_trees=10, max_depth=3)
    preds = value.value_predictions(model, test)
    auc = value.value_auc(preds).first().value
    assert 0.9 <= auc <= 1.0
    imp = value.feature_importance(model).collect()
    assert [r.feature for r in imp][0] in ("monetary", "avg_transaction")
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9


def test_split_is_stable_under_repartition(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("customer_id"))
    a = {r.customer_id for r in value.split_customers(df)[0].collect()}
    b = {r.customer_id for r in value.split_customers(df.repartition(7))[0].collect()}
    assert a == b and 700 < len(a) < 900


def test_empty_training_set_raises(spark):
    m = metrics_df(spark, [1.0]).limit(0)
    vectors = value.value_features(value.label_value(m, value.median_monetary(m, rel_error=0.0)))
    with pytest.raises(ValueError):
        value.value_model(vectors)


def test_forest_does_not_depend_on_the_layout(spark):
    rnd = random.Random(2)
    rows = [(f"c{i}", 20 + rnd.randrange(50), rnd.randrange(9), rnd.uniform(0, 100), rnd.uniform(0, 9), i % 2)
            for i in range(400)]
    df = value.value_features(spark.createDataFrame(
        rows, "customer_id string, age int, frequency long, monetary double, avg_transaction double, "
              "customer_value int"))
    found = [value.value_model(df.repartition(n), num_trees=8, max_depth=4).featureImportances.toArray().tolist()
             for n in (1, 4, 8)]
    assert found[0] == found[1] == found[2]


def test_no_median_no_label(spark):
    df = metrics_df(spark, [None, None])
    out = value.label_value(df, value.median_monetary(df, rel_error=0.0)).collect()
    assert [r.customer_value for r in out] == [None, None]


def test_rank_auc_equals_pairs(spark):
    rnd = random.Random(9)
    rows = [(round(rnd.gauss(0, 1), 1), rnd.randint(0, 1)) for _ in range(700)] + [(None, 1), (2.0, None)]
    got = value.rank_auc(spark.createDataFrame(rows, "s double, y int"), "s", "y", buckets=5).first().auc
    pos = [s for s, y in rows if y == 1 and s is not None]
    neg = [s for s, y in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12
    one = spark.createDataFrame([(1.0, 1)], "s double, y int")
    assert value.rank_auc(one, "s", "y").first().auc is None


def test_ordered_bits_are_the_ieee_bits(spark):
    rnd = random.Random(4)
    vals = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.2250738585072009e-308, 1.7976931348623157e308,
            float("inf"), float("-inf"), 0.1, 2.0 ** 52, 2.0 ** 53 - 1, 1e15, 3.0, 7.999999999999999]
    vals += [struct.unpack("<d", struct.pack("<q", rnd.getrandbits(63) % (2047 << 52)))[0] * rnd.choice([1, -1]) for _ in range(500)]
    vals += [2.0 ** e for e in range(-1074, 1024)]
    vals += [float(f"1.{k}e{e}") for e in range(-30, 30) for k in (0, 5, 9)]
    df = spark.createDataFrame([(v,) for v in vals], "v double").withColumn("key", value.ordered_bits(F.col("v")))
    for r in df.collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.key == (-bits if r.v < 0 else bits), r.v
    assert spark.createDataFrame([(float("nan"),)], "v double").select(value.ordered_bits(F.col("v"))).first()[0] == (1 << 63) - 1


def test_an_outlier_does_not_defeat_the_median(spark):
    rnd = random.Random(5)
    for vals in ([1e15] + [round(rnd.uniform(0, 100), 2) for _ in range(4001)],
                 [-1e300, float("inf")] + [rnd.gauss(0, 1e-9) for _ in range(999)],
                 [-5.0] * 700 + [-4.0] * 300 + [1e15]):
        assert value.exact_median(spark.createDataFrame([(v,) for v in vals], "v double"), "v") == lower_median(vals)
    with pytest.raises(ValueError):
        value.exact_median(spark.range(1), "id", bits=0)


def test_skewed_scores_do_not_meet_in_one_bucket(spark):
    rnd = random.Random(6)
    rows = [(rnd.random() * 1e-6, rnd.randint(0, 1)) for _ in range(3000)] + [(1.0, 1)]
    df = spark.createDataFrame(rows, "s double, y int")
    pos, neg = sorted(s for s, y in rows if y), sorted(s for s, y in rows if not y)
    want = sum(bisect.bisect_left(neg, p) for p in pos) / (len(pos) * len(neg))
    assert abs(value.rank_auc(df, "s", "y", buckets=32).first().auc - want) < 1e-12
    cuts = df.agg(F.percentile_approx("s", [k / 32 for k in range(1, 32)], 640)).first()[0]
    sizes = [sum(a < s <= b for s, _ in rows) for a, b in zip([-1, *cuts], [*cuts, 2])]
    assert max(sizes) < 2 * len(rows) / 32


def test_nodes_score_and_weigh_like_the_model(spark, scratch):
    rnd = random.Random(7)
    rows = [(f"c{i}", 20 + rnd.randrange(50), rnd.randrange(9), rnd.uniform(0, 100), rnd.uniform(0, 9),
             int(rnd.random() < 0.3 + 0.4 * (i % 2))) for i in range(500)]
    df = value.value_features(spark.createDataFrame(
        rows, "customer_id string, age int, frequency long, monetary double, avg_transaction double, customer_value int"))
    model = value.value_model(df, num_trees=12)
    nodes = value.forest_nodes(model, f"{scratch}/forest")
    assert nodes.where("feature IS NULL").count() == nodes.where("feature IS NOT NULL").count() + 12
    want = {r.customer_id: r.p_high for r in value.value_predictions(model, df).collect()}
    scored = value.score_nodes(df, nodes)
    assert all(abs(r.p_high - want[r.customer_id]) < 1e-12 for r in scored.collect())
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
    found = {r.feature: r.importance for r in value.node_importance(nodes).collect()}
    for r in value.feature_importance(model).collect():
        assert abs(found.get(r.feature, 0.0) - r.importance) < 1e-12
    auc = value.value_auc(value.value_predictions(model, df)).first().value
    assert abs(value.rank_auc(scored.withColumn("p", F.round("p_high", 9)), "p", "customer_value").first().auc - auc) < 1e-9


def test_regression_nodes_and_errors(spark, scratch):
    rnd = random.Random(8)
    rows = [(f"c{i}", 20 + i % 50, i % 9, round(10.0 * (i % 9) + rnd.uniform(0, 5), 2), rnd.uniform(0, 9)) for i in range(400)]
    df = value.value_features(spark.createDataFrame(
        rows, "customer_id string, age int, frequency long, monetary double, avg_transaction double"), value.SPEND_FEATURES)
    model = value.spend_model(df, num_trees=8)
    nodes = value.forest_nodes(model, f"{scratch}/spend", value.SPEND_FEATURES)
    want = {r.customer_id: r.prediction for r in model.transform(df).collect()}
    scored = value.score_nodes(df, nodes, "prediction")
    found = scored.collect()
    assert all(abs(r.prediction - want[r.customer_id]) < 1e-9 for r in found)
    errors = value.regression_errors(scored).first()
    off = [round(r.monetary, 2) - round(r.prediction, 2) for r in found]
    mean = sum(r.monetary for r in found) / len(found)
    assert errors.n == 400 and errors.rmse == pytest.approx((sum(e * e for e in off) / 400) ** 0.5, abs=1e-6)
    assert errors.mae == pytest.approx(sum(map(abs, off)) / 400, abs=1e-6)
    assert errors.r2 == pytest.approx(1 - sum(e * e for e in off) / sum((r.monetary - mean) ** 2 for r in found), abs=1e-9)
    same = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0), (None, 1.0)], "monetary double, prediction double")
    flat = value.regression_errors(same).first()
    assert (flat.n, flat.rmse, flat.r2) == (2, 1.0, None)
    none = value.regression_errors(same.limit(0)).first()
    assert (none.n, none.rmse, none.r2) == (0, None, None)
    with pytest.raises(ValueError):
        value.spend_model(df.limit(0))
