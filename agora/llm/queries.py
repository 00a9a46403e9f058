"""The operators as registered queries, over whole tables, and the DuckDB
SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.llm import oracle
from agora.llm.common import table
from agora.llm.decontaminate import find_contamination, hit_words
from agora.llm.exact_dedup import exact_dedup
from agora.llm.html_text import html_text
from agora.llm.lang_id import identify_language, train_language_model
from agora.llm.line_dedup import line_dedup
from agora.llm.lm_score import held_out, lm_scores
from agora.llm.mixing import mix_sources
from agora.llm.pii import KINDS, find_pii, span_list, train_pii_model
from agora.llm.ranked_search import ranked_search
from agora.llm.simhash import simhash_dedup
from agora.llm.substring_dedup import substring_dedup
from agora.llm.suffix_dedup import suffix_dedup
from agora.llm.vector_codes import compress_vectors


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(table(spark, sf_dir, "pages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), held_out(7, 2))


def op4_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_language_model(docs, ~held_out(5, 0))
    return identify_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(5, 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"), shingle_words=3, radius=2)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_pii(docs, train_pii_model(docs)).withColumn("base", F.filter("spans", lambda s: s["base"]))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
                        span_list(F.col("spans")).alias("spans"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), window=10).drop("text")
    return found.withColumn("n_hit", hit_words(F.col("hits"))).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), window=20).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), window=100).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compress_vectors(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)
    errors = found.rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return found.rows.join(errors, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"), min_chars=20, min_docs=3).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_html_text, op2_mix_sources, op3_lm_score, op4_lang_id, op5_exact_dedup, op6_simhash, op7_pii,
    op8_decontaminate, op9_substring_dedup, op10_suffix_dedup, op11_vector_codes,
    op12_ranked_search, op13_line_dedup)}

ORACLE_SQL = {"op5_exact_dedup": oracle.EXACT_DEDUP, "op8_decontaminate": oracle.DECONTAMINATE,
              "op9_substring_dedup": oracle.SUBSTRING_DEDUP,
              "op11_vector_codes": oracle.vector_codes(parts=16, entries=64, rounds=2),
              "op12_ranked_search": oracle.RANKED_SEARCH,
              "op13_line_dedup": oracle.LINE_DEDUP}
