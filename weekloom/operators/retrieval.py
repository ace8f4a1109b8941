"""Similarity search over the document index."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.fixed_values import NAMED_STORE_PATTERN, SEARCH_HITS
from weekloom.functions.vectors import dot

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

BLOCK_QUESTIONS = 1024
RANK_DIGITS = 9  # ranks ignore the last bits, which depend on summation order


def named_stores(question: Column) -> Column:
    """Store numbers named in a question, as an array."""
    found = F.regexp_extract_all(question, F.lit(NAMED_STORE_PATTERN), F.lit(1))
    return F.array_distinct(F.transform(found, lambda n: n.try_cast("bigint")))


def semantic_search(index: DataFrame, question_vector: Column, key: str, k: int = SEARCH_HITS) -> DataFrame:
    """The k documents with the largest dot product; ties by ``key``."""
    best = _scored(index, question_vector).orderBy(F.desc_nulls_last("RAW"), key).limit(k)
    return best.withColumn("score", F.round("RAW", 3)).drop("RAW", "vector")


def _scored(index: DataFrame, question_vector: Column) -> DataFrame:
    """Add RAW, the dot product with the question (a literal or scalar column)."""
    asked = index.withColumn("ASKED", question_vector)
    return asked.withColumn("RAW", F.round(dot(F.col("vector"), F.col("ASKED")), RANK_DIGITS)).drop("ASKED")


def hybrid_search(
    index: DataFrame, question: Column, question_vector: Column, key: str, k: int = SEARCH_HITS
) -> DataFrame:
    """Documents of the stores named in the question first, then by similarity."""
    named = F.coalesce(F.array_contains(named_stores(question), F.col("store_nbr")), F.lit(False))
    scored = _scored(index, question_vector).withColumn("NAMED", named)
    best = scored.orderBy(F.desc("NAMED"), F.desc_nulls_last("RAW"), key).limit(k)
    matched_by = F.when(F.col("NAMED"), "store filter").otherwise("semantic")
    return best.withColumns({"score": F.round("RAW", 3), "matched_by": matched_by}).drop("RAW", "NAMED", "vector")


def batch_search(
    index: DataFrame, questions: DataFrame, key: str, k: int = SEARCH_HITS, block: int = BLOCK_QUESTIONS
) -> DataFrame:
    """Hybrid top k for a table of questions (QUESTION_ID, QUESTION, VECTOR).

    Questions and documents are dealt to blocks of about ``block`` rows on the executors;
    each pair of blocks meets in one task by an equi-join on both numbers, keeps its own
    top k per question, and a window picks the best of them. Exact, and nothing passes
    through the driver. Rows without a vector are never found and ask nothing.
    """
    asked = questions.where(F.col("VECTOR").isNotNull()).select(
        "QUESTION_ID", F.coalesce(named_stores(F.col("QUESTION")), F.array().cast("array<bigint>")).alias("STORES"),
        F.transform("VECTOR", lambda x: x.cast("double")).alias("ASKED"))
    docs = index.where(F.col("vector").isNotNull()).select(
        F.col(key).cast("bigint").alias("DOC"), "store_nbr", F.transform("vector", lambda x: x.cast("double")).alias("vector"))
    blocks = {
        "QUESTION_BLOCK": F.ceil(asked.agg(F.count(F.lit(1))).scalar() / block).cast("int"),
        "DOC_BLOCK": F.ceil(docs.agg(F.count(F.lit(1))).scalar() / block).cast("int"),
    }

    def dealt(rows: DataFrame, own: str, other: str, name: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.greatest(blocks[other], F.lit(1)) - 1))
        return rows.withColumn(own, F.pmod(F.xxhash64(name), blocks[own]).cast("int")).withColumn(other, every)

    pairs = ["QUESTION_BLOCK", "DOC_BLOCK"]
    left = dealt(asked, "QUESTION_BLOCK", "DOC_BLOCK", "QUESTION_ID").groupBy(*pairs)
    right = dealt(docs, "DOC_BLOCK", "QUESTION_BLOCK", "DOC").groupBy(*pairs)
    candidates = left.cogroup(right).applyInPandas(
        lambda q, d: _best_of_blocks(q, d, k), "QUESTION_ID bigint, DOC bigint, store_nbr bigint, RAW double, NAMED boolean")
    order = Window.partitionBy("QUESTION_ID").orderBy(F.desc("NAMED"), F.desc("RAW"), "DOC")
    best = candidates.withColumn("RANK", F.row_number().over(order)).where(F.col("RANK") <= k)
    return best.select(
        "QUESTION_ID", "RANK", F.col("DOC").alias(key), "store_nbr", F.round("RAW", 3).alias("score"),
        F.when(F.col("NAMED"), "store filter").otherwise("semantic").alias("matched_by"),
    )


def _best_of_blocks(questions: pd.DataFrame, docs: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best documents of one block for each question of another."""
    columns = ["QUESTION_ID", "DOC", "store_nbr", "RAW", "NAMED"]
    if not len(questions) or not len(docs):
        return pd.DataFrame(columns=columns)
    scores = np.round(np.stack(questions["ASKED"].to_numpy()) @ np.stack(docs["vector"].to_numpy()).T, RANK_DIGITS)
    keys, stores = docs["DOC"].to_numpy(), docs["store_nbr"].to_numpy(float)
    rows, places, flags = [], [], []
    for j, names in enumerate(questions["STORES"]):
        named = np.isin(stores, np.asarray(names, dtype=float)) if len(names) else np.zeros(len(docs), bool)
        chosen = []
        for group in (np.flatnonzero(named), np.flatnonzero(~named)):
            if len(group) > k:  # all that tie with the k-th, then in order of key
                group = group[scores[j, group] >= np.partition(scores[j, group], -k)[-k]]
            chosen.append(group[np.lexsort((keys[group], -scores[j, group]))])
        best = np.concatenate(chosen)[:k]
        rows.append(np.full(len(best), j))
        places.append(best)
        flags.append(named[best])
    row, place = np.concatenate(rows), np.concatenate(places)
    return pd.DataFrame({
        "QUESTION_ID": questions["QUESTION_ID"].to_numpy()[row], "DOC": keys[place],
        "store_nbr": pd.array(docs["store_nbr"].to_numpy()[place], dtype="Int64"),
        "RAW": scores[row, place], "NAMED": np.concatenate(flags),
    })
