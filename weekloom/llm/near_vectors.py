"""Near-duplicate vectors by product quantisation.

Unit vectors are dealt to the inverted list of their nearest coarse centroid; the residual
is cut into subspaces, each coded by its nearest codeword. A vector probes every list that
can hold a vector near enough: with distance t belonging to the cosine threshold, a vector
of another cell is at least as far as the plane between both centroids. Within a list,
distances to the codes are summed from one table per query and subspace; a code whose
distance exceeds t by more than its own coding error cannot be near enough. The rest is
ranked by exact cosine in double precision. Both bounds hold for all data, so no link is
lost, whatever the sample that centroids and codewords are fitted on.

Equal vectors of a label form a class, compared once. Lists are compared in blocks within
the tasks, which give link counts and a spanning forest of links, never a group's pairs.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component,
or whose label is null, link with nothing; vectors of different lengths never link; a row
with a null id counts as a link of its copies but names no class; repeated rows are copies;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, stored
from weekloom.llm.components import components, spanning

THRESHOLD = 0.98
#: Vectors that centroids and codewords are fitted on, at most; vectors per list; most lists.
SAMPLE, PER_LIST, MOST_LISTS = 16_384, 4096, 1024
SUBSPACES, CODEWORDS, BLOCK = 8, 256, 512
ROUNDING = 1e-9


def k_means(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    random = np.random.default_rng(11)
    centres = points[random.permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        nearest = squared(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        n = np.bincount(nearest, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0)


class Quantiser:
    """Coarse centroids and a codebook per subspace, for vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centroids = k_means(sample, min(lists, len(sample)))
        near = squared(sample, self.centroids).argmin(axis=1)
        self.cuts = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        residuals = sample - self.centroids[near]
        self.books = [k_means(residuals[:, a:b], min(CODEWORDS, len(sample))) for a, b in zip(self.cuts, self.cuts[1:])]

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, coding error, distances to all centroids) of unit vectors."""
        distances = squared(units, self.centroids)
        lists = distances.argmin(axis=1)
        rest = units - self.centroids[lists]
        codes = np.empty((len(units), len(self.books)), np.uint8)
        error = np.zeros(len(units))
        for s, (book, a, b) in enumerate(zip(self.books, self.cuts, self.cuts[1:])):
            codes[:, s] = squared(rest[:, a:b], book).argmin(axis=1)
            error += ((rest[:, a:b] - book[codes[:, s]]) ** 2).sum(axis=1)
        return lists, codes, np.sqrt(error), distances

    def probes(self, lists: np.ndarray, distances: np.ndarray, reach: float) -> np.ndarray:
        """Which lists of a number not below its own each vector must look into."""
        gaps = np.sqrt(squared(self.centroids, self.centroids))[lists]
        own = np.take_along_axis(distances, lists[:, None], 1)
        far = np.divide(distances - own, 2 * gaps, out=np.zeros_like(distances), where=gaps > 0)
        return (far <= reach + ROUNDING) & (np.arange(len(self.centroids))[None, :] >= lists[:, None])

    def table_distances(self, queries: np.ndarray, number: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries to the coded vectors of list ``number``, by table lookup."""
        rest = queries - self.centroids[number]
        total = np.zeros((len(queries), len(codes)))
        for s, (book, a, b) in enumerate(zip(self.books, self.cuts, self.cuts[1:])):
            total += squared(rest[:, a:b], book)[:, codes[:, s]]
        return np.sqrt(total)


def unpacked(column, kind: str) -> np.ndarray:
    """Vectors scaled by a power of two each: cosines stay the same to the bit, squares cannot overflow."""
    out = np.stack([np.frombuffer(x, kind) for x in column.to_pylist()]).astype(float)
    return np.ldexp(out, -np.frexp(np.abs(out).max(axis=1))[1][:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def cleaned(vectors: DataFrame, kind: str) -> DataFrame:
    """vec_id, label, dim, vector (bytes; null where the vector or label links with nothing)."""
    def work(batches):
        for batch in batches:
            packed, dims = [], []
            for label, values in zip(batch.column("label").to_pylist(), batch.column("embedding").to_pylist()):
                good = label is not None and values and None not in values
                v = np.array(values if good else [0], kind) + np.array(0, kind)
                good = good and bool(np.isfinite(v).all() and v.any())
                packed.append(v.tobytes() if good else None)
                dims.append(len(v) if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())],
                names=["vec_id", "label", "dim", "vector"])

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    return map_batches(rows, work, "vec_id long, label long, dim int, vector binary")


def fitted(classes: DataFrame, kind: str, lists: int, sample: int) -> dict[int, Quantiser]:
    """A quantiser per vector length, on at most ``sample`` classes drawn by hash from all."""
    place = F.xxhash64("vector", "label")
    total = max(1, classes.count())
    part = classes.where(F.pmod(place, F.lit(1 << 30)) < int(min(1.0, 1.2 * sample / total + 1e-6) * (1 << 30)))
    by_dim: dict[int, list[np.ndarray]] = {}
    for r in part.select("dim", "vector").orderBy(place).limit(sample).collect():
        by_dim.setdefault(r.dim, []).append(r.vector)
    return {dim: Quantiser(unit(unpacked(pa.array(rows, pa.binary()), kind)), lists) for dim, rows in by_dim.items()}


def linked(vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, per_list: int = PER_LIST,
           block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    kind = "<f8" if "double" in dict(vectors.dtypes)["embedding"] else "<f4"
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    rows = stored(cleaned(vectors, kind), "pq-rows")
    classes = stored(rows.where("vector IS NOT NULL").groupBy("label", "dim", "vector").agg(
        F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("weight")), "pq-classes")
    named = classes.where("class_id IS NOT NULL")
    lists = min(MOST_LISTS, max(8, math.ceil(named.count() / per_list)))
    quantisers = spark.sparkContext.broadcast(fitted(named, kind, lists, sample))

    def quantiser(dim: int) -> Quantiser:
        known = quantisers.value
        if dim not in known:  # a length outside the sample: one list, and codes that exclude nothing
            known[dim] = Quantiser(np.zeros((1, dim)), 1)
        return known[dim]

    def encode(batches):
        for batch in batches:
            dims = np.array(batch.column("dim").to_pylist())
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                q = quantiser(dim)
                own, codes, error, distances = q.encode(unit(unpacked(part.column("vector"), kind)))
                at = [np.flatnonzero(x).tolist() for x in q.probes(own, distances, reach)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("class_id", "weight", "label", "dim", "vector")), pa.array(own, pa.int32()),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(at, pa.list_(pa.int32()))],
                    names=["class_id", "weight", "label", "dim", "vector", "list", "codes", "error", "probes"])

    coded = stored(map_batches(named, encode, "class_id long, weight long, label long, dim int, vector binary, list int, "
                               "codes binary, error double, probes array<int>"), "pq-codes")
    place = ["label", "dim", "list"]
    queries = coded.select("class_id", "weight", "label", "dim", "vector", F.col("list").alias("own"), F.explode("probes").alias("list"))
    data_blocks = coded.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("data_blocks"))
    query_blocks = queries.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("query_blocks"))
    blocks = stored(data_blocks.join(query_blocks, place), "pq-blocks")
    number = F.xxhash64("class_id")
    data = coded.drop("probes").join(blocks, place).select(
        *place, F.pmod(number, F.col("data_blocks")).cast("int").alias("data_block"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"),
        "class_id", "weight", "vector", F.lit(-1).alias("own"), "codes", "error")
    asked = queries.join(blocks, place).select(
        *place, F.explode(F.sequence(F.lit(0), F.col("data_blocks") - 1)).alias("data_block"),
        F.pmod(number, F.col("query_blocks")).cast("int").alias("query_block"),
        "class_id", "weight", "vector", "own", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"))

    def compare(key, table):
        dim, number = key[1].as_py(), key[2].as_py()
        asks = pc.greater_equal(table.column("own"), 0)
        q, d = table.filter(asks), table.filter(pc.invert(asks))
        none = {"a": pa.int64(), "b": pa.int64(), "n": pa.int64(), "link": pa.bool_()}
        if not q.num_rows or not d.num_rows:
            return pa.table({k: pa.array([], t) for k, t in none.items()})
        x, y = unpacked(q.column("vector"), kind), unpacked(d.column("vector"), kind)
        x_norm, y_norm = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
        q_id, d_id = (np.array(t.column("class_id").to_pylist(), np.int64) for t in (q, d))
        q_weight, d_weight = (np.array(t.column("weight").to_pylist(), np.int64) for t in (q, d))
        codes = np.stack([np.frombuffer(c, np.uint8) for c in d.column("codes").to_pylist()])
        near = quantiser(dim).table_distances(unit(x), number, codes) <= reach + np.array(d.column("error").to_pylist()) + ROUNDING
        same = np.array(q.column("own").to_pylist()) == number
        near &= ~same[:, None] | (q_id[:, None] < d_id[None, :])
        ids = np.unique(np.concatenate([q_id, d_id]))
        q_at, d_at = np.searchsorted(ids, q_id), np.searchsorted(ids, d_id)
        counts, kept = np.zeros(len(ids), np.int64), []
        for i in np.flatnonzero(near.any(axis=1)):
            j = np.flatnonzero(near[i])
            j = j[(y[j] @ x[i]) / (y_norm[j] * x_norm[i]) >= threshold]
            if len(j):
                counts[q_at[i]] += d_weight[j].sum()
                np.add.at(counts, d_at[j], q_weight[i])
                kept += zip([int(q_at[i])] * len(j), d_at[j].tolist())
                kept = spanning(len(ids), kept) if len(kept) > 8 * len(ids) else kept
        forest = spanning(len(ids), kept)
        hit = np.flatnonzero(counts)
        return pa.table({
            "a": pa.array(np.concatenate([ids[hit], ids[[i for i, _ in forest]]]).astype(np.int64)),
            "b": pa.array(np.concatenate([np.full(len(hit), -1), ids[[j for _, j in forest]]]).astype(np.int64)),
            "n": pa.array(np.concatenate([counts[hit], np.zeros(len(forest), np.int64)])),
            "link": pa.array(np.arange(len(hit) + len(forest)) >= len(hit)),
        })

    units = data.unionByName(asked)
    found = stored(units.groupBy("label", "dim", "list", "data_block", "query_block").applyInArrow(
        compare, "a long, b long, n long, link boolean"), "pq-found")
    counts = found.where("NOT link").groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("found"))
    groups = components(found.where("link").select("a", "b")).withColumnRenamed("node", "class_id")
    known = classes.join(counts, "class_id", "left").join(groups, "class_id", "left")
    out = rows.join(known, ["label", "dim", "vector"], "left")
    component = F.coalesce("component", "class_id", "vec_id")
    return out.select(
        "vec_id", (F.coalesce("found", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
