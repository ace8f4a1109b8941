"""A corpus pipeline: toxicity, near duplicates, personal data, mixing, encoding.

Each stage takes (spark, docs, sf_dir) with docs (doc_id, text, lang, source, n_chars) and
returns what it keeps with the same columns; the last returns the encoded pieces. Nulls,
empty and very long texts, ties, repeated rows and empty tables have the results that the
operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import mixing, near_text, pieces, privacy, toxicity
from weekloom.llm.common import quoted, stored, table, text_or_empty, unused


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text isn't predicted to be toxic; a text's prediction is the same under every id."""
    (text_key,) = unused(docs, "text_key")
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    rejected = scored.where("predicted = 1").select(F.col("text_key").alias(text_key)).distinct()
    return docs.withColumn(text_key, F.unhex(F.md5(text_or_empty()))).join(rejected, text_key, "left_anti").select(*quoted(docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id (null last); of rows with equal id and text, one."""
    key, digest, held = unused(docs, "key", "digest", "held")
    parts = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text")]
    rows = docs.withColumns({key: F.xxhash64(*parts), digest: F.unhex(F.md5(F.to_json(F.struct("doc_id", "text"))))})
    linked = near_text.joined(rows.select(F.col(key).alias("doc_id"), "text"))
    groups = linked.groupBy(F.col("doc_id").alias(key)).agg(F.min("component_id").alias("group"))
    ids = rows.groupBy(key).agg(F.min("doc_id").alias("id"), (F.min(digest) != F.max(digest)).alias(held))
    first = F.min(F.struct(F.col("id").isNull(), "id", key))[key]
    heads = groups.join(ids, key).groupBy("group").agg(first.alias(key)).select(key)
    # different rows that share a 64-bit key stay, whatever their links
    heads = heads.union(ids.where(held).select(key)).distinct()
    return rows.join(heads, key, "left_semi").dropDuplicates([digest]).select(*quoted(docs.columns))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what discloses it generalised."""
    return privacy.sanitised(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each stretch of a document that a slot takes."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded_sha256 of each row of the mix."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("private_data", sanitise),
    ("mixing", mix),
    ("pieces", encode),
]

#: Regular expressions with tests on their matches, and Viterbi paths, have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
