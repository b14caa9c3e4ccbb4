"""URL filter: rules first, then logistic regression on hashed character
n-grams of host and path, trained from a small labelled URL table."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .common import staged

#: n-gram lengths, hashed features, and the most labelled URLs a fit reads
#: (beyond that, those with the smallest hashes).
GRAMS, FEATURES, MAX_LABELLED = (3, 4, 5), 1 << 16, 20_000
REGULARISATION, ITERATIONS = 1e-3, 50

ALLOW, BLOCK = "allow", "block"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    empty without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1),
                       string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest rule ``host/path`` that fits the host (or a parent domain) and
    starts the path; null without one."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def grams(text: Column, tag: str) -> Column:
    """The text's distinct n-grams, edges marked, with a tag in front."""
    whole = F.concat(F.lit("\u0002"), text, F.lit("\u0003"))

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(whole) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(tag), F.substr(whole, i, F.lit(n))))

    return F.array_distinct(F.concat(*[of(n) for n in GRAMS]))


def features(urls: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """``urls`` with the hashed vector ``__features``."""
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="__grams", outputCol="__features")
    listed = urls.withColumn("__grams", F.concat(grams(F.col(host), "h"), grams(F.col(path), "p")))
    return hashing.transform(listed).drop("__grams")


def fit_url_model(labelled: DataFrame, max_rows: int = MAX_LABELLED):
    """Fit on (url, label): label 1 is to be blocked. Reads at most ``max_rows``
    rows with a label; returns a Spark model, or the constant probability of
    label 1 if there are no rows (0.0) or only one class."""
    known = (labelled.where(F.col("label").isNotNull())
             .select("url", F.col("label").cast("double").alias("label"),
                     F.xxhash64("url", "label").alias("key"))
             .orderBy("key", "url", "label").limit(max_rows))
    rows = staged(known, "url_labels")
    classes = [r["label"] for r in rows.select("label").distinct().orderBy("label").limit(2).collect()]
    if len(classes) < 2:
        return classes[0] if classes else 0.0
    train = features(rows.select("key", "label", url_host(F.col("url")).alias("host"),
                                 url_path(F.col("url")).alias("path")))
    # one ordered partition of at most max_rows rows: the same fit on any layout
    train = train.repartition(1).sortWithinPartitions("key", "host", "path", "label")
    return LogisticRegression(featuresCol="__features", labelCol="label", regParam=REGULARISATION,
                              maxIter=ITERATIONS).fit(train.select("__features", "label"))


def judge_urls(pages: DataFrame, model, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url",
               threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, p_block), one row per input row.

    ``rules`` maps ``host/path`` to "allow" or "block"; the longest that fits
    decides, else the model: block where its probability reaches ``threshold``.
    Null URLs and those without ``://`` have an empty host and path and are
    judged like any other; ids may be null or repeat; other columns are not
    read; empty in, empty out.
    """
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("__url"))
    urls = urls.select("page_id", F.coalesce(url_host(F.col("__url")), F.lit("")).alias("host"),
                       F.coalesce(url_path(F.col("__url")), F.lit("")).alias("path"))
    if isinstance(model, float):
        scored = urls.withColumn("p_block", F.lit(model))
    else:
        scored = model.transform(features(urls)).withColumn(
            "p_block", F.element_at(vector_to_array("probability"), 2))
    rule = rule_of(F.col("host"), F.col("path"), list(rules))
    by_rule = F.lit(None).cast("string")
    for name, verdict in rules.items():
        by_rule = F.when(F.col("rule") == name, F.lit(verdict)).otherwise(by_rule)
    by_model = F.when(F.col("p_block") >= threshold, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return (scored.withColumn("rule", rule)
            .select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_model).alias("verdict"), "p_block"))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, label): pages whose path ends in the number of a document with a
    quality label; label 1 where that quality is 0."""
    number = F.regexp_extract(url_path(F.col("url")), r"/(\d{1,18})(?:\.html)?/?$", 1)
    page = pages.select("url", number.try_cast("long").alias("__doc"))
    truth = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("__q"))
    return (page.where(F.col("__doc").isNotNull()).join(truth, F.col("__doc") == F.col("doc_id"))
            .select("url", (F.col("__q") == 0).cast("int").alias("label")))
