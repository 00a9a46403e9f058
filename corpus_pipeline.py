"""A training corpus from raw documents, stage by stage.

Each stage takes the documents that the one before it kept and returns
those that it keeps, with their columns; the last one mixes what is left
and returns, per document, how often the mix takes its words.  ``run``
writes each stage's documents as Parquet into the shared checkpoint folder
and reads them back, so a lost executor never costs an earlier stage; a
stage's documents are removed when the next one's stand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.llm.common import store_at, table
from agora.llm.decontaminate import drop_contaminated
from agora.llm.exact_dedup import drop_copies
from agora.llm.lang_id import drop_rejected, train_language_model
from agora.llm.mixing import mix_sources
from agora.llm.simhash import drop_near_copies
from agora.operators.keys import in_scratch, remove, scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language the classifier (fitted
    on a bounded sample of all labelled ones) rejects, go."""
    return drop_rejected(docs, train_language_model(docs, F.lit(True)))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts one stays, with the smallest ``doc_id`` (null last)."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one row stays, with the smallest ``doc_id`` (null last)."""
    return drop_near_copies(docs, shingle_words=3, radius=2, judge_null_ids=True)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row with a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document left."""
    return mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language), ("exact dedup", exact_copies), ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", decontaminated), ("mixing sources to target weights", mixed)]

#: A trained classifier, XXH64 fingerprints and a pseudorandom mix are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):  # what a stage stores on its way goes once its documents stand
            docs, path = store_at(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            remove(spark, before)
        before = path
    in_scratch(path)  # the last stage's result still reads it
    return STAGES[-1][1](spark, docs, sf_dir)
