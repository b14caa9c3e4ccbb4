"""Corpus pipeline: documents -> toxicity filter -> exact dedup -> near-copy
join -> packed batches. Each stage works on everything its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartlens.llm import toxicity as tx
from cartlens.llm.common import staged, table
from cartlens.llm.exact_dedup import drop_exact_copies
from cartlens.llm.ngram_join import drop_near_copies
from cartlens.llm.packing import pack, word_lengths


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5 stay; the index learns from the labels
    outside the held-out fifth. Rows keep all their columns, whatever their names: the
    verdict is computed beside them in the same pass, so nothing is joined. Null and
    empty texts, which have no neighbour, stay where few such examples are toxic;
    repeated rows are judged alike; whole texts are judged, however long; an empty
    table stays empty."""
    labels = table(spark, sf_dir, "labels")
    return tx.drop_toxic(docs, tx.fit(docs, labels.where(~tx.held_out())))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each exact text stays: the largest doc_id. Null counts as empty, so of
    null and empty texts one stays; null ids lose against any id; rows repeated with
    id and text come once; columns keep their names; an empty table stays empty."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-copy class stays: the smallest doc_id (null ids last).
    Null texts and texts without words have no copies and stay; rows repeated with id
    and text come once; columns keep their names; an empty table stays empty."""
    return drop_near_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining row's length bucket, batch and slot. Null and empty texts have
    length 0 and pad to one step; a text longer than the token budget is a batch of
    its own; repeated rows and null ids are rows like any other; other columns are
    not read; an empty table gives an empty result."""
    return pack(word_lengths(docs))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", packing)]

#: Classifier scores and hashed signatures have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
