"""Customer features, the median split and the random-forest value model."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.money import mean, total
from .clean import clean_fill, enrich_shopping

# The model's feature columns and settings.
FEATURES = ["age", "frequency", "monetary", "avg_transaction"]
TREES, DEPTH, TRAIN_PCT, SPLIT_SEED = 50, 5, 80, 42
# What the spend regression learns from: the features without the spend itself.
SPEND_FEATURES = ["age", "frequency", "avg_transaction"]


def prepare_lines(shopping: DataFrame) -> DataFrame:
    """Value-model preparation: fill nulls by type, money columns, 4-way age band."""
    return enrich_shopping(clean_fill(shopping), age_scheme="age4")


def customer_metrics(lines: DataFrame) -> DataFrame:
    """Per (customer_id, gender, age, age_group): frequency, monetary, avg_transaction."""
    return (lines.groupBy("customer_id", "gender", "age", "age_group")
            .agg(F.count("invoice_no").alias("frequency"),
                 total("total_amount").alias("monetary"),
                 mean("total_amount").alias("avg_transaction")))


def ordered_bits(x):
    """A double as a long of the same order: its IEEE bits, negated below zero. Both
    zeros are 0; NaN is the greatest. Made by exact arithmetic with powers of two."""
    size = F.abs(x)
    near = F.floor(F.log2(size))                      # may be off by one
    scaled = size / F.pow(F.lit(2.0), near)
    exponent = near + F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    whole, bits = F.pow(F.lit(2.0), exponent), F.lit(1 << 52)
    normal = (exponent + 1023) * bits + F.floor((size / whole - 1) * bits)
    tiny = F.floor(size / F.lit(5e-324))              # below the least normal number
    key = (F.when(size == 0, F.lit(0).cast("long")).when(size < 2.2250738585072014e-308, tiny)
           .when(size < float("inf"), normal).otherwise(F.lit(2047 << 52)))
    return F.when(F.isnan(x), F.lit((1 << 63) - 1)).when(x < 0, -key).otherwise(key)


def exact_median(rows: DataFrame, column: str, bits: int = 16) -> float | None:
    """The exact lower median (rank ceil(n / 2)) of a double column, None without
    values, by radix selection.

    Each round counts the rows per digit of ``bits`` bits of ``ordered_bits``, among
    those that share the digits found so far; the running count over at most
    2 ^ bits digits names the next one, and the round's one row reaches the driver.
    However the values lie, no task orders more rows than that, and no outlier makes
    a round useless. A round whose digit holds one value only is the last. Reads
    ``rows`` once a round (at most 64 / bits): pass a materialised frame.
    """
    if not 1 <= bits <= 20:
        raise ValueError("a digit has 1 to 20 bits")
    left = (rows.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
            .withColumn("key", ordered_bits(F.col("v"))))
    before, k = 0, None
    for shift in reversed(range(0, 64, bits)):
        cells = left.groupBy(F.shiftright("key", shift).alias("prefix")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)) + before
        rank = F.floor((F.sum("n").over(Window.partitionBy()) + 1) / 2) if k is None else F.lit(k)
        found = (cells.withColumns({"upto": upto, "k": rank}).where(F.col("upto") >= F.col("k"))
                 .orderBy("prefix").limit(1).collect())
        if not found:
            return None
        cell = found[0]
        if cell["lo"] == cell["hi"]:
            return cell["lo"]
        before, k = cell["upto"] - cell["n"], cell["k"]
        left = left.where(F.shiftright("key", shift) == cell["prefix"])
    return cell["lo"]


def median_monetary(metrics: DataFrame, rel_error: float = 0.001, column: str = "monetary", bits: int = 16) -> DataFrame:
    """One row, one column ``median_monetary`` (null without values).

    ``rel_error > 0``: the quantile sketch (``percentile_approx``), bounded in
    memory and merged from partial aggregates. ``rel_error == 0``: the exact lower
    median (the ``percentile_disc(0.5)`` value), found at once by ``exact_median``.
    """
    if rel_error > 0:
        return (metrics.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
                .agg(F.percentile_approx("v", 0.5, int(round(1.0 / rel_error))).cast("double").alias("median_monetary")))
    return metrics.sparkSession.createDataFrame([(exact_median(metrics, column, bits),)], "median_monetary double")


def median_rank_error(metrics: DataFrame, rel_error: float = 0.001, column: str = "monetary") -> DataFrame:
    """One row: ``within``, whether the sketched median's rank is at most
    ``rel_error`` * n (and one row) away from the middle."""
    m = median_monetary(metrics, rel_error, column).scalar()
    vals = metrics.select(F.col(column).alias("v"), m.alias("m")).where(F.col("v").isNotNull())
    counts = vals.agg(F.count("*").alias("n"), F.count_if(F.col("v") < F.col("m")).alias("below"),
                      F.count_if(F.col("v") <= F.col("m")).alias("upto"))
    slack, middle = F.col("n") * rel_error + 1, F.col("n") / 2
    return counts.select(((F.col("below") <= middle + slack) & (F.col("upto") >= middle - slack)).alias("within"))


def label_value(metrics: DataFrame, median: DataFrame, column: str = "monetary") -> DataFrame:
    """``customer_value`` = 1 when ``column`` is strictly above the median
    (a scalar subquery: no join, no driver round trip), else 0; null without a
    median."""
    threshold = median.select("median_monetary").scalar()
    return metrics.withColumn("__median", threshold).withColumn(
        "customer_value", F.when(F.col("__median").isNull(), None).when(F.col(column) > F.col("__median"), 1)
        .otherwise(0).cast("int")).drop("__median")


def customer_features(lines: DataFrame, rel_error: float = 0.001) -> DataFrame:
    """Customer metrics labelled against their median. Lazy: the metrics are read
    once for the label and again for the median, so jobs materialise
    ``customer_metrics`` first and call ``features_of``."""
    return features_of(customer_metrics(lines), rel_error)


def features_of(metrics: DataFrame, rel_error: float = 0.001) -> DataFrame:
    return label_value(metrics, median_monetary(metrics, rel_error))


def value_features(features: DataFrame, columns=FEATURES) -> DataFrame:
    """Assemble the feature vector; rows with a null feature are skipped."""
    return VectorAssembler(inputCols=list(columns), outputCol="features",
                           handleInvalid="skip").transform(features)


def split_flag(key: str = "customer_id", train_pct: int = 80, seed: int = 42):
    """True for the training share. The leading 32 bits of an MD5 of seed and
    key, so the split does not move with partitioning or task retries the way
    ``randomSplit`` does, and any engine can repeat it."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100 < train_pct


def split_customers(vectors: DataFrame, key: str = "customer_id", train_pct: int = 80,
                    seed: int = 42):
    flag = split_flag(key, train_pct, seed)
    return vectors.where(flag), vectors.where(~flag)


def split_counts(vectors: DataFrame, key: str = "customer_id", train_pct: int = 80,
                 seed: int = 42) -> DataFrame:
    """One row: ``vectors``, ``train``, ``test`` in a single pass."""
    flag = split_flag(key, train_pct, seed)
    return vectors.agg(F.count("*").alias("vectors"), F.count_if(flag).alias("train"),
                       F.count_if(~flag).alias("test"))


def value_model(train: DataFrame, num_trees: int = TREES, max_depth: int = DEPTH, seed: int = SPLIT_SEED,
                label: str = "customer_value", key: str = "customer_id",
                partitions: int = 32) -> RandomForestClassificationModel:
    """The forest draws its bootstrap samples per partition, so the training rows
    are first laid out by ``key`` in ``partitions`` sorted partitions: the same
    rows and seed give the same forest on any input layout."""
    if train.isEmpty():
        raise ValueError("no feature vectors to train the value model on")
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                maxDepth=max_depth, seed=seed)
    # the copy leaves the training summary behind, which holds the session: once that has
    # observed a frame (``plans.runs``), a model with its summary cannot be sent to tasks
    return rf.fit(_laid_out(train, key, partitions)).copy()


def _laid_out(train: DataFrame, key: str, partitions: int) -> DataFrame:
    return train.repartition(partitions, key).sortWithinPartitions(key, *[
        c for c in train.columns if c not in (key, "features")])


def spend_model(train: DataFrame, num_trees: int = TREES, max_depth: int = DEPTH, seed: int = SPLIT_SEED,
                label: str = "monetary", key: str = "customer_id", partitions: int = 32) -> RandomForestRegressionModel:
    """A forest that predicts a customer's spend, over vectors of the other features;
    laid out like the value model's rows."""
    if train.isEmpty():
        raise ValueError("no feature vectors to train the spend model on")
    rf = RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=num_trees, maxDepth=max_depth, seed=seed)
    return rf.fit(_laid_out(train, key, partitions))


def regression_errors(rows: DataFrame, label: str = "monetary", prediction: str = "prediction") -> DataFrame:
    """One row (n, rmse, mae, r2) over money columns, in one pass. Squares and sums are
    of whole cents, so they are exact and do not depend on the order; ``r2`` is null
    where all labels are equal. Rows without a label or a prediction are left out."""
    def cents(c):
        return F.round(F.col(c).cast("decimal(20,6)") * 100, 0).cast("decimal(18,0)")

    pairs = rows.select(cents(label).alias("y"), cents(prediction).alias("p")).where(F.col("y").isNotNull() & F.col("p").isNotNull())
    off = F.col("y") - F.col("p")

    def total(c):
        return F.sum(c.cast("decimal(38,0)"))

    sums = pairs.agg(F.count(F.lit(1)).alias("n"), total(off * off).alias("sse"), total(F.abs(off)).alias("sae"),
                     total(F.col("y")).alias("sy"), total(F.col("y") * F.col("y")).alias("syy"))
    n = F.col("n").cast("double")
    sse, sae, sy, syy = (F.col(c).cast("double") for c in ("sse", "sae", "sy", "syy"))
    return sums.select("n", (F.sqrt(F.try_divide(sse, n)) / 100).alias("rmse"), (F.try_divide(sae, n) / 100).alias("mae"),
                       (1 - F.try_divide(sse, syy - F.try_divide(sy * sy, n))).alias("r2"))


def value_predictions(model, test: DataFrame, label: str = "customer_value") -> DataFrame:
    return model.transform(test).select(
        "customer_id", label, F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("p_high"), "rawPrediction")


def forest_nodes(model, path: str, columns=FEATURES) -> DataFrame:
    """A forest as a table, written to ``path``: one row per node (tree, node, feature,
    threshold, left, right, gain, rows, p_high, prediction). A row goes left if its
    ``feature`` is at most ``threshold``; leaves have neither feature nor children.
    ``rows``: training rows in the node; ``p_high``: their share of label 1 (null for
    a regression); ``prediction``: their majority label, or their mean."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    node, names = F.col("nodeData"), F.array(*[F.lit(c) for c in columns])
    inner, stats = node["leftChild"] >= 0, node["impurityStats"]
    share = stats[1] / (stats[0] + stats[1]) if isinstance(model, RandomForestClassificationModel) else F.lit(None).cast("double")
    table = spark.read.parquet(f"{path}/model/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        F.when(inner, F.get(names, node["split"]["featureIndex"])).alias("feature"),
        F.when(inner, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, node["leftChild"]).alias("left"), F.when(inner, node["rightChild"]).alias("right"),
        F.when(inner, node["gain"]).otherwise(0.0).alias("gain"), node["rawCount"].cast("double").alias("rows"),
        share.alias("p_high"), node["prediction"].alias("prediction"))
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    return spark.read.schema(table.schema).parquet(f"{path}/nodes")


def score_nodes(rows: DataFrame, nodes: DataFrame, leaf: str = "p_high") -> DataFrame:
    """``rows`` with the column ``leaf``, its mean over the leaves a row reaches:
    "p_high" of a classification, "prediction" of a regression.

    Each tree becomes one nested conditional column, so rows are scored where they
    lie, without a join or a Python worker. The nodes (trees x 2 ^ (depth + 1) at
    most) are read by the driver."""
    trees: dict[int, dict] = {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r

    def walk(tree, at):
        r = tree[at]
        if r["feature"] is None:
            return F.lit(r[leaf])
        return F.when(F.col(r["feature"]) <= F.lit(r["threshold"]), walk(tree, r["left"])).otherwise(walk(tree, r["right"]))

    total = reduce(lambda a, b: a + b, [walk(trees[t], 0) for t in sorted(trees)])
    return rows.withColumn(leaf, total / F.lit(float(len(trees))))


def node_importance(nodes: DataFrame) -> DataFrame:
    """(feature, importance), most important first: gain times rows of the nodes that
    split on it, as shares of each tree, summed over trees, as shares of all."""
    cut = nodes.where(F.col("feature").isNotNull()).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"))
    share = F.try_divide(F.col("g"), F.sum("g").over(Window.partitionBy("tree")))
    of = cut.withColumn("share", F.coalesce(share, F.lit(0.0))).groupBy("feature").agg(F.sum("share").alias("share"))
    return (of.select("feature", F.try_divide(F.col("share"), F.sum("share").over(Window.partitionBy())).alias("importance"))
            .orderBy(F.desc("importance"), "feature"))


def value_auc(predictions: DataFrame, label: str = "customer_value") -> DataFrame:
    """Area under ROC as a one-row DataFrame (metric, value), from every distinct
    score whatever the size (no down-sampled curve)."""
    spark = predictions.sparkSession
    auc = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol=label,
                                        metricName="areaUnderROC", numBins=0).evaluate(predictions)
    return spark.createDataFrame([("areaUnderROC", float(auc))], "metric string, value double")


def rank_auc(rows: DataFrame, score: str, label: str, buckets: int = 256) -> DataFrame:
    """One row ``auc``: the share of (positive, negative) pairs that ``score`` puts
    in order, ties as half; null without both classes. Exact: rows are counted per
    score; the scores are cut at sketched quantiles of themselves, so that no bucket
    holds much more than its share of them however they are spread, and running
    totals go over the buckets and inside each. Null scores and labels are left out."""
    known = rows.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        F.col(score).cast("double").alias("s"), F.col(label).alias("y"))
    counts = known.groupBy("s").agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("n"))
    cuts = counts.agg(F.percentile_approx("s", [k / buckets for k in range(1, buckets)], 20 * buckets).alias("c")).scalar()
    counts = counts.withColumn("c", cuts).select("s", "p", "n", F.size(F.filter("c", lambda c: c < F.col("s"))).alias("b"))
    totals = counts.groupBy("b").agg(F.sum("n").alias("t")).select(
        "b", (F.sum("t").over(Window.orderBy("b")) - F.col("t")).alias("before"))  # at most ``buckets`` rows
    inside = F.sum("n").over(Window.partitionBy("b").orderBy("s")) - F.col("n")
    wins = counts.withColumn("inside", inside).join(totals, "b").select(
        "p", "n", (F.col("p") * (2 * (F.col("inside") + F.col("before")) + F.col("n"))).cast("decimal(38,0)").alias("w"))
    both = wins.agg(F.sum("w").alias("w"), F.sum("p").cast("decimal(19,0)").alias("p"),
                    F.sum("n").cast("decimal(19,0)").alias("n"))
    return both.select(F.try_divide(F.col("w").cast("double"), (F.col("p") * F.col("n") * 2).cast("double")).alias("auc"))


def feature_importance(model, columns=FEATURES) -> DataFrame:
    """(feature, importance), most important first. Model metadata, one row per feature."""
    spark = SparkSession.active()
    rows = [(c, float(w)) for c, w in zip(columns, model.featureImportances.toArray())]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature"))
