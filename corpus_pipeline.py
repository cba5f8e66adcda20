"""From raw documents to packed training sequences, in stages that each write a table.

Each stage works on all rows that the stage before it kept and is written before the next
one reads it, so a lost executor repeats tasks of one stage. All but the last return the
columns of the documents. A document may come with a null in any column, without words, or
more than once: language and quality stages drop texts without words, the near-duplicate
stage keeps one row of each group of similar texts (and every row without an id, which has
no group), the mixing stage repeats rows, and the last one packs what is there.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketry.llm import jaccard, langid, mixing, packing, rules
from basketry.llm.scratch import importable, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Calibrated probability of the language below which a document is rejected.
LEAST_LANGUAGE_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    importable(spark)
    return langid.recognised(docs, LEAST_LANGUAGE_SCORE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules of their language and source."""
    return rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle sets with a similarity of 0.8."""
    importable(spark)
    return jaccard.distinct_documents(docs, width=5, threshold="0.8")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources meet their target weights."""
    return mixing.mixed(docs, weights=(5, 2, 1), share=1.5, max_epochs=2.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of 4096 tokens."""
    importable(spark)
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(docs, tokenizer, capacity=4096, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("jaccard_join", near_duplicates),
    ("water_filling", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Models, sketches and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
