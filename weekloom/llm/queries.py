"""Named queries of the package: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import hard_negatives, language, line_rules, mixing, near_text, near_vectors, oracle, pieces, prefix_trie, privacy, token_counts, token_file, toxicity, winnow
from weekloom.llm.common import crc_mod, new_path, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    model = language.fit(docs, ~held_out)
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.linked(table(spark, sf_dir, "embeddings"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), new_path(spark, "token-cache"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.joined(table(spark, sf_dir, "documents"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edits(table(spark, sf_dir, "documents"))


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-file")
    token_file.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_file.document_digests(spark, path)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "evidence")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op10_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.spans_of(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = prefix_trie.trie(table(spark, sf_dir, "conversations"), heads=6)
    digests = prefix_trie.end_digests(ends)
    nothing = F.lit(hashlib.sha256().hexdigest())
    return nodes.join(digests, prefix_trie.KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), "embedding")
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op13_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.cleaned(table(spark, sf_dir, "documents")).drop("clean_text", "faults")


def llm_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_language, op2_near_vectors, op3_token_counts, op4_ngram_join, op5_pieces, op6_fingerprints, op7_token_file, op8_toxicity, op9_source_mixing,
        op10_private_data, op11_prefix_trie, op12_hard_negatives, op13_line_rules,
    )}


def llm_sql() -> dict[str, str]:
    return oracle.all_sql()
