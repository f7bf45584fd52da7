"""A pipeline from raw documents to packed training sequences, built from the operators of
``tidemark.llm``. Each stage is written as Parquet and read again, so a lost executor costs no
more than the stage it was lost in. The working tables of a stage are removed when the next one
begins, as its result is written by then.

Defined results, by stage: a null or empty text has less than 50 words and is rejected by the first
stage, so no later one sees it; very long texts are judged, compared and packed whole. A document
whose posterior or score is exactly one half is kept, and toxic. Of rows with one text, the smallest
identifier stays, of near duplicates the smallest identifier of the group; rows that repeat an
identifier and differ in text are documents of their own. An empty table gives an empty result.
Columns that documents have beyond the key and the text are carried, whatever their names."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import content_sort, dominance_packing, jaccard_join, quality_rules, toxicity
from tidemark.llm.workload import BYTE_BPE
from tidemark.session import durable, forget, owned, release


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base check and the voting rules keep."""
    return quality_rules.good_documents(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic. The classifier learns from the labelled documents that are
    not held out."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out()))
    return toxicity.clean_documents(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text."""
    return content_sort.distinct_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.distinct_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences."""
    return dominance_packing.packed(docs, BYTE_BPE)


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage that first removes what the stages before it left, but for what its input reads."""

    @functools.wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, "pipeline", docs)
        with owned("pipeline"):
            return work(spark, docs, sf_dir)

    return stage


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", _stage(quality)),
    ("toxicity", _stage(clean)),
    ("exact_dedup", _stage(exact_dedup)),
    ("ngram_jaccard_join", _stage(near_dedup)),
    ("best_fit_packing", _stage(pack)),
]

#: Expectation maximisation, the classifier and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    written = None
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name)
        if written is not None:
            forget(written)
        written = docs
    release(spark, "pipeline", docs)
    return docs
