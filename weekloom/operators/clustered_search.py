"""Exact top k over many documents by clusters with distance bounds.

Documents are dealt to the nearest of a fixed number of centroids. A document of a cluster
scores at most the centroid's score plus the question's length times the cluster's radius
(Cauchy and Schwarz, or the triangle inequality for unit vectors). Each question first asks
the clusters with the highest bounds until they hold k documents; the k-th score found
there decides which other clusters can still matter, and only those are asked. So a
question meets the clusters that its bound cannot rule out, not every document.

Documents of stores that a question names come first. They are found the same way, in cells
of a store and a cluster, and only in the stores that are named.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.fixed_values import SEARCH_HITS
from weekloom.operators.retrieval import RANK_DIGITS, named_stores
from weekloom.session import scratch_path
from weekloom.sources.tables import overwrite_table, read_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: Documents that centroids are fitted on, at most; documents per cluster aimed at; most clusters; documents in a block.
SAMPLE, PER_CLUSTER, MOST_CLUSTERS, BLOCK = 16_384, 512, 1024, 1024
QUESTIONS = 1024
ANY_STORE = -1
#: Scores are compared rounded, bounds with this much room.
MARGIN = 2.0 * 10**-RANK_DIGITS

_CELL = ["CELL_STORE", "CLUSTER"]
_FOUND = "QUESTION_ID bigint, NAMED boolean, DOC bigint, store_nbr bigint, RAW double"


def k_means(points: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    draw = np.random.default_rng(5)
    centres = points[draw.permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        nearest = _nearest(points, centres)[0]
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre and the distance to it."""
    squares = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
    number = squares.argmin(axis=1)
    return number, np.sqrt(((points - centres[number]) ** 2).sum(axis=1))


class ClusteredIndex:
    """Documents in blocks of their cells, stored, and the size and radius of each cell."""

    def __init__(self, index: DataFrame, key: str, sample: int = SAMPLE, per_cluster: int = PER_CLUSTER, block: int = BLOCK):
        """index: key, store_nbr, vector (all of one length); documents without one, or with missing elements, are not found.

        At most ``sample`` vectors, drawn by hash, and the centroids pass through the driver.
        """
        spark = index.sparkSession
        docs = index.where(F.forall("vector", lambda x: x.isNotNull())).select(
            F.col(key).cast("bigint").alias("DOC"), F.col("store_nbr").cast("bigint").alias("store_nbr"),
            F.transform("vector", lambda x: x.cast("double")).alias("vector"))
        total = docs.count()
        drawn = docs.orderBy(F.xxhash64("DOC")).limit(sample).select("vector").collect() if total <= sample else docs.where(
            F.pmod(F.xxhash64("DOC"), F.lit(1 << 30)) < int((1 << 30) * sample / total)).limit(2 * sample).select("vector").collect()
        points = np.array([r[0] for r in drawn]) if drawn else np.zeros((1, 1))
        clusters = min(MOST_CLUSTERS, max(1, math.ceil(total / per_cluster)), len(points))
        self.centres = centres = k_means(points, clusters)

        def dealt(parts):
            for part in parts:
                number, away = _nearest(np.stack(part["vector"].to_numpy()), centres) if len(part) else (np.empty(0, int), np.empty(0))
                yield part.assign(CLUSTER=number.astype("int32"), AWAY=away)

        rows = self._stored(docs.mapInPandas(dealt, "DOC bigint, store_nbr bigint, vector array<double>, CLUSTER int, AWAY double"), "clusters")
        # Every document stands in two cells: its cluster's, and that of its store within the cluster.
        both = rows.withColumn("CELL_STORE", F.explode(F.array(F.lit(ANY_STORE).cast("bigint"), F.col("store_nbr")))).where("CELL_STORE IS NOT NULL")
        self.cells = self._stored(both.groupBy(*_CELL).agg(
            F.count(F.lit(1)).alias("SIZE"), F.max("AWAY").alias("RADIUS"), F.ceil(F.count(F.lit(1)) / block).cast("int").alias("BLOCKS")), "cells")
        sized = both.join(self.cells.select(*_CELL, "BLOCKS"), _CELL)
        placed = sized.withColumn("BLOCK", F.pmod(F.xxhash64("DOC"), F.col("BLOCKS")).cast("int"))
        self.blocks = self._stored(placed.groupBy(*_CELL, "BLOCK").agg(F.collect_list(F.struct("DOC", "store_nbr", "vector")).alias("HELD")), "blocks")

    @staticmethod
    def _stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(df.sparkSession, f"search-{name}")
        overwrite_table(df, path)
        return read_table(df.sparkSession, path, df.schema)


def clustered_search(index: ClusteredIndex, questions: DataFrame, key: str, k: int = SEARCH_HITS) -> DataFrame:
    """Hybrid top k for a table of questions (QUESTION_ID, QUESTION, VECTOR), as ``batch_search`` gives it."""
    centres = index.centres
    asked = index._stored(questions.where(F.col("VECTOR").isNotNull()).select(
        F.col("QUESTION_ID").cast("bigint").alias("QUESTION_ID"), F.transform("VECTOR", lambda x: x.cast("double")).alias("ASKED"),
        F.coalesce(named_stores(F.col("QUESTION")), F.array().cast("array<bigint>")).alias("STORES")), "asked")

    def against_centres(parts):
        for part in parts:
            vectors = np.stack(part["ASKED"].to_numpy()) if len(part) else np.zeros((0, centres.shape[1]))
            yield part.assign(MIDDLES=list(vectors @ centres.T), LENGTH=np.sqrt((vectors**2).sum(axis=1)))

    middles = asked.mapInPandas(against_centres, "QUESTION_ID bigint, ASKED array<double>, STORES array<bigint>, MIDDLES array<double>, LENGTH double")
    stores = F.explode(F.array_union(F.array(F.lit(ANY_STORE).cast("bigint")), F.array_compact("STORES")))
    wanted = middles.withColumn("CELL_STORE", stores)
    # The clusters of no store are as many as the centroids; those of a store are met by an equi-join on it.
    bound = F.element_at("MIDDLES", F.col("CLUSTER") + 1) + F.col("LENGTH") * F.col("RADIUS") * (1 + 1e-12) + MARGIN
    pairs = wanted.join(index.cells, "CELL_STORE").select(
        "QUESTION_ID", "ASKED", *_CELL, "BLOCKS", "SIZE", (F.col("CELL_STORE") != ANY_STORE).alias("NAMED"), bound.alias("BOUND"))
    by_bound = Window.partitionBy("QUESTION_ID", "NAMED").orderBy(F.desc("BOUND"), *_CELL)
    before = F.sum("SIZE").over(by_bound.rowsBetween(Window.unboundedPreceding, -1))
    pairs = index._stored(pairs.withColumn("FIRST", F.coalesce(before, F.lit(0)) < k), "pairs")
    first = index._stored(_asked_blocks(index, pairs.where("FIRST"), k), "first")
    kth = first.withColumn("PLACE", F.row_number().over(_best("QUESTION_ID", "NAMED"))).where(F.col("PLACE") == k).select(
        "QUESTION_ID", "NAMED", F.col("RAW").alias("KTH"))
    rest = pairs.where("NOT FIRST").join(kth, ["QUESTION_ID", "NAMED"], "left").where(F.col("KTH").isNull() | (F.col("BOUND") >= F.col("KTH")))
    found = first.unionByName(_asked_blocks(index, rest.drop("KTH"), k))
    # A named document may also be among the best of all.
    best = found.groupBy("QUESTION_ID", "DOC", "store_nbr", "RAW").agg(F.max("NAMED").alias("NAMED"))
    order = Window.partitionBy("QUESTION_ID").orderBy(F.desc("NAMED"), F.desc("RAW"), "DOC")
    ranked = best.withColumn("RANK", F.row_number().over(order)).where(F.col("RANK") <= k)
    return ranked.select(
        "QUESTION_ID", "RANK", F.col("DOC").alias(key), "store_nbr", F.round("RAW", 3).alias("score"),
        F.when(F.col("NAMED"), "store filter").otherwise("semantic").alias("matched_by"))


def _best(*keys: str):
    return Window.partitionBy(*keys).orderBy(F.desc("RAW"), "DOC")


def _asked_blocks(index: ClusteredIndex, pairs: DataFrame, k: int) -> DataFrame:
    """The k best documents of every cell that a question asks; blocks and groups of questions meet one by one."""
    place = [*_CELL, "BLOCK", "PART"]
    groups = F.greatest(F.ceil(pairs.agg(F.count_distinct("QUESTION_ID")).scalar() / QUESTIONS), F.lit(1)).cast("int")
    asked = pairs.withColumn("BLOCK", F.explode(F.sequence(F.lit(0), F.col("BLOCKS") - 1))).select(
        *_CELL, "BLOCK", F.pmod(F.xxhash64("QUESTION_ID"), groups).cast("int").alias("PART"), "QUESTION_ID", "NAMED", "ASKED")
    met = asked.select(*_CELL, "BLOCK", F.col("PART").alias("ASKING")).distinct()
    data = index.blocks.join(met, [*_CELL, "BLOCK"])

    def meet(questions: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        columns = ["QUESTION_ID", "NAMED", "DOC", "store_nbr", "RAW"]
        if not len(questions) or not len(held):
            return pd.DataFrame(columns=columns)
        docs = held["HELD"].iloc[0]
        keys, stores = np.array([d["DOC"] for d in docs]), [d["store_nbr"] for d in docs]
        scores = np.round(np.stack(questions["ASKED"].to_numpy()) @ np.stack([d["vector"] for d in docs]).T, RANK_DIGITS)
        out = []
        for question, named, own in zip(questions["QUESTION_ID"], questions["NAMED"], scores):
            at = np.arange(len(keys)) if len(keys) <= k else np.flatnonzero(own >= np.partition(own, -k)[-k])
            out += [(question, named, keys[i], stores[i], own[i]) for i in at[np.lexsort((keys[at], -own[at]))][:k]]
        frame = pd.DataFrame(out, columns=columns)
        frame["store_nbr"] = frame["store_nbr"].astype("Int64")
        return frame

    return asked.groupBy(*place).cogroup(data.groupBy(*place[:-1], "ASKING")).applyInPandas(meet, _FOUND)
