"""The registered query of each operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    ann,
    binary,
    conversations,
    crf,
    hmm,
    jaccard,
    langid,
    licenses,
    mixing,
    oracles,
    packing,
    ranking,
    rules,
    substrings,
)
from basketry.llm.scratch import importable

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return importable(spark).read.parquet(f"{folder}/documents.parquet")


def op1_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    vectors = importable(spark).read.parquet(f"{folder}/embeddings.parquet")
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0, k=20, dim=64, tables=8, probes=24)


def _remainder(divisor: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    model = langid.train(langid.labelled_rows(docs, _remainder(3) != 1), per_language=500)
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.predict(rows, model, "doc_id", "held_out")


def op3_license_templates(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summarised(licenses.scan(_documents(spark, folder), "doc_id"), "doc_id")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = rules.verdicts(_documents(spark, folder))
    return rows.select("doc_id", *rules.COUNTS, "base_failed", "kept")


def op5_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    remainder = _remainder(5)
    return hmm.scored(_documents(spark, folder), remainder != 1, remainder == 1, states=4, rounds=4)


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(_documents(spark, folder), tokenizer, capacity=4096, end_id=1)


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(_documents(spark, folder), width=3, threshold="0.9")


def op8_water_filling(spark: SparkSession, folder: str) -> DataFrame:
    planned = mixing.plan(_documents(spark, folder), (5, 2, 1), share=1.5, max_epochs=2.0)
    return planned.select("doc_id", "size", "source_size", "target", "taken")


def op9_line_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    field = crf.train(docs, labels, _remainder(5) != 0, per_label=1500)
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    scored = crf.predict(rows, field, "doc_id", "held_out")
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return binary.token_files(_documents(spark, folder), tokenizer, end_id=0)


def op11_edit_lattice(spark: SparkSession, folder: str) -> DataFrame:
    rows = importable(spark).read.parquet(f"{folder}/conversations.parquet")
    repairs = conversations.repaired(conversations.damaged(rows), F.col("gone"))
    return conversations.digest(repairs)


def op12_seed_and_extend(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.without_repeats(_documents(spark, folder), length=13)
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return kept.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


def op13_impact_lists(spark: SparkSession, folder: str) -> DataFrame:
    items = importable(spark).read.parquet(f"{folder}/benchmark.parquet")
    return ranking.search(_documents(spark, folder), items, k=50)


_SIMILAR_SETS = r"""WITH RECURSIVE listed AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1),
            lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
        ELSE [] END) AS shingle
    FROM listed
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles AS a JOIN shingles AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * common.n >= 90 * (x.n + y.n - common.n)
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reached.doc_id, both_ways.b FROM reached JOIN both_ways ON both_ways.a = reached.other
)
SELECT listed.doc_id, coalesce(max(sizes.n), 0) AS n_shingles, min(reached.other) AS component_id
FROM listed LEFT JOIN sizes ON sizes.doc_id = listed.doc_id
JOIN reached ON reached.doc_id = listed.doc_id
GROUP BY listed.doc_id"""


def queries() -> dict[str, Query]:
    return {
        "op1_cross_polytope": op1_cross_polytope,
        "op2_language_id": op2_language_id,
        "op3_license_templates": op3_license_templates,
        "op4_quality_rules": op4_quality_rules,
        "op5_hidden_markov": op5_hidden_markov,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_water_filling": op8_water_filling,
        "op9_line_crf": op9_line_crf,
        "op10_token_files": op10_token_files,
        "op11_edit_lattice": op11_edit_lattice,
        "op12_seed_and_extend": op12_seed_and_extend,
        "op13_impact_lists": op13_impact_lists,
    }


def oracle_sql() -> dict[str, str]:
    """What SQL can express; models, sketches, seeded hashes and tokenizers it cannot."""
    return {
        "op7_jaccard_join": _SIMILAR_SETS,
        "op11_edit_lattice": oracles.REPAIRED_CONVERSATIONS,
        "op12_seed_and_extend": oracles.WITHOUT_REPEATS,
        "op13_impact_lists": oracles.RANKED_DOCUMENTS,
    }
