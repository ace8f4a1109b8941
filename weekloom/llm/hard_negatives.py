"""Hard negatives by an inverted multi-index.

Vectors become whole numbers, so scores (inner products) are exact. Each vector is cut into
two halves; a codebook for each half space gives a pair of words, the cell. For a query, a
half score is at most that of the word's centroid plus the query's length times the word's
radius, which is taken over all vectors. A heap visits cells by the sum of both bounds,
largest first; a cell whose scores all lie above every open window is passed over. A window
is certified when the next bound is below its lower end or below the worst of its k best;
a query stops when all its windows are. Results are those of comparing everything, whatever
the sample that the codebooks are fitted on.

The search goes in rounds, each with more rows than the last: open queries name their next
cells, cells (in blocks) and queries (in blocks) meet in a shuffle, the k best of each
window are kept. A heap is taken up again from its last cell, so a round holds no more
than one heap of one codebook's size. A cell may hold any share of the vectors: its blocks
do not grow.

Defined results: rows with a null id, label or vector, or with a null or non-finite
component (also after scaling) take no part; vectors of different lengths never meet; an
empty vector scores 0 with others of its kind; repeated rows are one row; rows that share an
id but differ take part each, and are not each other's positives or negatives; ties go to
the smaller id; an anchor without a positive, or with a negative positive score, has no row;
scores beyond 2**62 in size are given as that; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, stored
from weekloom.llm.near_vectors import k_means, squared

#: Vectors that codebooks are fitted on, at most; vectors per cell aimed at; words per half, at most.
SAMPLE, PER_CELL, MOST_WORDS = 16_384, 256, 512
#: Vectors in a block of a cell and queries that meet it at once.
BLOCK, QUERIES = 1024, 1024
#: Rows that a query's first round looks at, growth by round, cells of a round at most.
FIRST, GROWTH, CELLS = 4096, 16, 32_768
LARGEST = 1 << 62


# --- vectors and scores ------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as two or eight bytes each."""
    small = not len(values) or np.abs(values).max() < 1 << 15
    return values.astype("<i2" if small else "<f8").tobytes()


def unpacked(rows: list[bytes], dim: int) -> np.ndarray:
    if not dim:
        return np.zeros((len(rows), 0))
    return np.stack([np.frombuffer(x, "<i2" if len(x) == 2 * dim else "<f8").astype(float) for x in rows])


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a with all rows of b."""
    largest = (np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if largest[0] * largest[1] * a.shape[1] < 1 << 53:
        return (a @ b.T).astype(np.int64)
    exact = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
    out = [[max(-LARGEST, min(LARGEST, sum(x * y for x, y in zip(p, q)))) for q in exact[1]] for p in exact[0]]
    return np.array(out, np.int64).reshape(len(a), len(b))


def members(vectors: DataFrame, scale: float) -> DataFrame:
    """vec_id, label, dim, vector (floor of scale * component, packed), key (a digest of the row), each row once."""
    def work(batches):
        for batch in batches:
            dims, out = [], []
            for values in batch.column("embedding").to_pylist():
                good = values is not None and None not in values
                with np.errstate(over="ignore"):
                    v = np.floor(scale * np.array(values if good else [], np.float64))
                good = good and bool(np.isfinite(v).all())
                dims.append(len(v) if good else None)
                out.append(packed(v) if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                names=["vec_id", "label", "dim", "vector"])

    rows = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    found = map_batches(rows, work, "vec_id long, label long, dim int, vector binary").where("vector IS NOT NULL").distinct()
    key = F.unhex(F.md5(F.concat(F.concat_ws(":", "vec_id", "label").cast("binary"), "vector")))
    return found.withColumn("key", key)


# --- the index ---------------------------------------------------------------------


class Halves:
    """A codebook for each half of vectors of one length, and what the cells hold."""

    def __init__(self, sample: np.ndarray, words: int):
        self.cut = (sample.shape[1] + 1) // 2
        self.books = [k_means(x, min(words, len(x))) for x in (sample[:, : self.cut], sample[:, self.cut :])]
        self.counts = np.zeros((len(self.books[0]), len(self.books[1])), np.int64)
        self.radii = [np.full(len(book), -1.0) for book in self.books]

    def parts(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[:, : self.cut], vectors[:, self.cut :]

    def encode(self, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(nearest word, distance to it) in each half."""
        out = []
        for part, book in zip(self.parts(vectors), self.books):
            word = squared(part, book).argmin(axis=1)
            out.append((word, np.sqrt(((part - book[word]) ** 2).sum(axis=1))))
        return out

    def bounds(self, query: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(smallest, largest) possible half score for each word; words without vectors have a largest of -inf."""
        out = []
        for part, book, radius in zip(self.parts(query[None, :]), self.books, self.radii):
            middle, reach = book @ part[0], np.sqrt((part[0] ** 2).sum()) * np.maximum(radius, 0)
            margin = 1e-9 * (np.abs(middle) + reach) + 1e-6
            out.append((middle - reach - margin, np.where(radius < 0, -np.inf, middle + reach + margin)))
        return out


def visited(halves: Halves, query: np.ndarray, after: tuple[float, int, int] | None):
    """(bound, place, place, word, word) of all cells, by the sum of both half bounds, largest first, from ``after`` on.

    The heap holds the next cell of each word of the first half.
    """
    (_, high1), (_, high2) = halves.bounds(query)
    first, second = np.argsort(-high1, kind="stable"), np.argsort(-high2, kind="stable")
    first, second = first[np.isfinite(high1[first])], second[np.isfinite(high2[second])]
    up1, up2 = high1[first], high2[second]
    heap = []
    for i, u in enumerate(up1.tolist()):
        j = 0
        if after is not None:
            sums = u + up2
            j = int(np.searchsorted(-sums, -after[0], "left"))
            while j < len(up2) and (-float(sums[j]), i, j) <= (-after[0], after[1], after[2]):
                j += 1
        if j < len(up2):
            heap.append((-float(u + up2[j]), i, j))
    heapq.heapify(heap)
    while heap:
        bound, i, j = heap[0]
        yield -bound, i, j, int(first[i]), int(second[j])
        if j + 1 < len(up2):
            heapq.heapreplace(heap, (-float(up1[i] + up2[j + 1]), i, j + 1))
        else:
            heapq.heappop(heap)


class Index:
    """Blocks of cells as a table, and the directory that queries are planned with."""

    def __init__(self, rows: DataFrame, sample: int = SAMPLE, per_cell: int = PER_CELL, block: int = BLOCK):
        """rows: members(). The directory has at most MOST_WORDS**2 counts per vector length."""
        spark = rows.sparkSession
        total = rows.count()
        words = min(MOST_WORDS, max(1, round(math.sqrt(total / per_cell))))
        share = int(min(1.0, 1.2 * sample / max(1, total) + 1e-6) * (1 << 30))
        place = F.xxhash64("key")
        by_dim: dict[int, list[bytes]] = {}
        for r in rows.where(F.pmod(place, F.lit(1 << 30)) < share).select("dim", "vector").orderBy(place).limit(sample).collect():
            by_dim.setdefault(r.dim, []).append(r.vector)
        halves = {dim: Halves(unpacked(found, dim), words) for dim, found in by_dim.items()}
        for r in rows.select("dim").distinct().collect():  # a length outside the sample: one cell
            halves.setdefault(r.dim, Halves(np.zeros((1, r.dim)), 1))
        fitted = spark.sparkContext.broadcast(halves)

        def encode(batches):
            for batch in batches:
                dims = np.array(batch.column("dim").to_pylist())
                for dim in np.unique(dims).tolist():
                    part = batch.filter(pa.array(dims == dim))
                    (w1, d1), (w2, d2) = fitted.value[dim].encode(unpacked(part.column("vector").to_pylist(), dim))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(w1, pa.int32()), pa.array(w2, pa.int32()), pa.array(d1), pa.array(d2)],
                        names=[*part.schema.names, "w1", "w2", "d1", "d2"])

        columns = "vec_id long, label long, dim int, vector binary, key binary"
        coded = stored(map_batches(rows.select("vec_id", "label", "dim", "vector", "key"), encode, f"{columns}, w1 int, w2 int, d1 double, d2 double"), "multi-codes")
        for r in coded.groupBy("dim", "w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).collect():
            h = halves[r.dim]
            h.counts[r.w1, r.w2] = r.n
            h.radii[0][r.w1], h.radii[1][r.w2] = max(h.radii[0][r.w1], r.d1), max(h.radii[1][r.w2], r.d2)
        self.directory = directory = spark.sparkContext.broadcast(halves)
        self.block = block

        def place_in_blocks(batches):
            for batch in batches:
                out = []
                for dim, w1, w2, key in zip(*(batch.column(c).to_pylist() for c in ("dim", "w1", "w2", "key"))):
                    out.append(int.from_bytes(key[:8], "big") % max(1, -(-int(directory.value[dim].counts[w1, w2]) // block)))
                columns = [batch.column(c) for c in ("dim", "w1", "w2", "vec_id", "label", "vector")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.int32())], names=["dim", "w1", "w2", "vec_id", "label", "vector", "block"])

        placed = map_batches(coded.select("dim", "w1", "w2", "vec_id", "label", "vector", "key"), place_in_blocks,
                             "dim int, w1 int, w2 int, vec_id long, label long, vector binary, block int")
        # About ``block`` vectors each, whatever a cell holds.
        self.blocks = stored(placed.groupBy("dim", "w1", "w2", "block").agg(F.collect_list(F.struct("vec_id", "label", "vector")).alias("held")), "multi-index")


# --- the search --------------------------------------------------------------------

_QUERY = "key binary, anchor_id long, label long, dim int, vector binary"
_STATE = f"{_QUERY}, windows array<struct<lo: long, hi: long>>, best array<struct<window: int, score: long, vec_id: long>>, last struct<bound: double, i: int, j: int>, done boolean"


def narrowed(windows: list[dict], best: list[dict], k: int) -> list[dict]:
    """The windows, from what a score must reach to be among the k best of each."""
    out = []
    for number, w in enumerate(windows):
        found = sorted((b["score"] for b in best if b["window"] == number), reverse=True)
        out.append({"lo": max(w["lo"], found[k - 1]) if len(found) >= k else w["lo"], "hi": w["hi"]})
    return out


def planned(state: DataFrame, index: Index, k: int, budget: int) -> DataFrame:
    """The state with the next cells of each open query: at most ``budget`` rows beyond one cell."""
    directory = index.directory
    cell, window = (pa.list_(pa.struct(x)) for x in ([("w1", pa.int32()), ("w2", pa.int32())], [("lo", pa.int64()), ("hi", pa.int64())]))
    place = pa.struct([("bound", pa.float64()), ("i", pa.int32()), ("j", pa.int32())])

    def work(batches):
        for batch in batches:
            cells, asks, lasts, dones = [], [], [], []
            for row in batch.to_pylist():
                halves, after, taken, rows, done, windows = directory.value[row["dim"]], row["last"], [], 0, row["done"], []
                if not done:
                    query = unpacked([row["vector"]], row["dim"])[0]
                    windows = narrowed(row["windows"], row["best"], k)
                    needs = [(w["lo"], w["hi"]) for w in windows if w["lo"] <= w["hi"]]
                    (low1, _), (low2, _) = halves.bounds(query)
                    done = True
                    for bound, i, j, w1, w2 in visited(halves, query, after and (after["bound"], after["i"], after["j"])):
                        if not needs or bound < min(f for f, _ in needs):
                            break
                        if rows >= budget or len(taken) >= CELLS:
                            done = False
                            break
                        after = {"bound": bound, "i": i, "j": j}
                        low = low1[w1] + low2[w2]
                        if halves.counts[w1, w2] and any(bound >= f and low <= hi for f, hi in needs):
                            taken.append({"w1": w1, "w2": w2})
                            rows += int(halves.counts[w1, w2])
                cells.append(taken), asks.append(windows), lasts.append(after), dones.append(done)
            keep = [batch.column(c) for c in ("key", "anchor_id", "label", "dim", "vector", "windows", "best")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(lasts, place), pa.array(dones, pa.bool_()), pa.array(cells, cell), pa.array(asks, window)],
                names=["key", "anchor_id", "label", "dim", "vector", "windows", "best", "last", "done", "cells", "asks"])

    return map_batches(state, work, f"{_STATE}, cells array<struct<w1: int, w2: int>>, asks array<struct<lo: long, hi: long>>", 256)


def compared(asked: DataFrame, index: Index, k: int, same: bool) -> DataFrame:
    """key, window, score, vec_id: the k best of each window in each block that a query asks for."""
    place = ["dim", "w1", "w2", "block", "group"]
    kinds = [("key", pa.binary()), ("window", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())]

    def meet(key, queries, data):
        out = []
        if queries.num_rows and data.num_rows:
            dim = key[0].as_py()
            held = data.column("held").to_pylist()[0]
            ids, labels = (np.array([h[c] for h in held], np.int64) for c in ("vec_id", "label"))
            vectors, rows = unpacked([h["vector"] for h in held], dim), queries.to_pylist()
            found = scores(unpacked([q["vector"] for q in rows], dim), vectors)
            for q, own in zip(rows, found):
                fits = (labels == q["label"] if same else labels != q["label"]) & (ids != q["anchor_id"])
                for number, w in enumerate(q["asks"]):
                    at = np.flatnonzero(fits & (own >= w["lo"]) & (own <= w["hi"]))
                    if len(at) > k:
                        at = at[own[at] >= np.partition(own[at], -k)[-k]]
                    at = at[np.lexsort((ids[at], -own[at]))[:k]]
                    out += [(q["key"], number, int(own[x]), int(ids[x])) for x in at]
        columns = list(zip(*out)) or [()] * 4
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], names=[c for c, _ in kinds])

    wanted = asked.select(*place[:4], F.col("group").alias("asking")).distinct()
    data = index.blocks.join(wanted, place[:4])
    return asked.groupBy(*place).cogroup(data.groupBy(*place[:4], "asking")).applyInArrow(meet, "key binary, window int, score long, vec_id long")


def search(queries: DataFrame, index: Index, k: int, same: bool, first: int = FIRST) -> DataFrame:
    """The k best vectors within each window of each query.

    queries: key, anchor_id, label, dim, vector, windows (of scores, both ends in). ``same``: vectors of the
    query's label, else of any other one; never those of the query's own id. Gives the queries with best
    (window, score, vec_id), unordered.
    """
    state = queries.withColumns({
        "best": F.array().cast("array<struct<window: int, score: long, vec_id: long>>"),
        "last": F.lit(None).cast("struct<bound: double, i: int, j: int>"), "done": F.lit(False)})
    budget = first
    while True:
        state = stored(planned(state, index, k, budget), "multi-plan")
        open_queries = state.where("size(cells) > 0").count()
        if not open_queries:
            return state.select("key", "anchor_id", "label", "dim", "vector", "windows", "best")
        groups = -(-open_queries // QUERIES)
        directory, block = index.directory, index.block

        def blocks_of(batches):
            for batch in batches:
                counts = [-(-int(directory.value[d].counts[a, b]) // block) for d, a, b in zip(*(batch.column(c).to_pylist() for c in ("dim", "w1", "w2")))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int32())], names=[*batch.schema.names, "blocks"])

        cells = state.where("size(cells) > 0").select(
            "key", "anchor_id", "label", "dim", "vector", "asks", F.explode("cells").alias("cell")).select(
            "key", "anchor_id", "label", "dim", "vector", "asks", "cell.w1", "cell.w2")
        counted = map_batches(cells, blocks_of, f"{_QUERY}, asks array<struct<lo: long, hi: long>>, w1 int, w2 int, blocks int", 2000)
        asked = counted.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks").withColumn(
            "group", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
        found = compared(asked, index, k, same)
        before = state.select("key", F.explode("best").alias("b")).select("key", "b.window", "b.score", "b.vec_id")
        place = F.row_number().over(Window.partitionBy("key", "window").orderBy(F.desc("score"), "vec_id"))
        best = found.unionByName(before).withColumn("place", place).where(F.col("place") <= k).groupBy("key").agg(
            F.collect_list(F.struct("window", "score", "vec_id")).alias("found"))
        state = state.drop("cells", "asks").join(best, "key", "left").withColumn("best", F.coalesce("found", "best")).drop("found")
        budget *= GROWTH


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: float = 256.0, first: int = FIRST) -> DataFrame:
    """Hard negatives of each row of vectors (vec_id, label, embedding) that ``is_anchor`` (on vec_id, label) names.

    An anchor's positives are its best other rows of the same label. For each, the best rows of other labels
    with low % <= negative score / positive score <= high %: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.
    """
    rows = stored(members(vectors, scale), "multi-rows")
    index = Index(rows)
    anything = F.array(F.struct(F.lit(-LARGEST).alias("lo"), F.lit(LARGEST).alias("hi")))
    anchors = rows.where(is_anchor).select("key", F.col("vec_id").alias("anchor_id"), "label", "dim", "vector", anything.alias("windows"))
    liked = search(anchors, index, positives, True, first)
    # Whole hundreds and the rest apart, so that no product overflows.
    share = lambda percent, up: (
        f"{percent} * ((p.score - pmod(p.score, 100)) div 100) + ({percent} * pmod(p.score, 100) + {up}) div 100")
    windows = F.expr(f"transform(pairs, p -> named_struct('lo', {share(low, 99)}, 'hi', {share(high, 0)}))")
    liked = liked.withColumn("pairs", F.array_sort(F.transform("best", lambda b: F.struct(
        (-b["score"]).alias("down"), b["vec_id"].alias("vec_id"), b["score"].alias("score")))))
    asked = stored(liked.withColumn("windows", windows), "multi-liked")
    disliked = search(asked.drop("pairs", "best"), index, negatives, False, first).select("key", "best")
    pairs = asked.select("key", "anchor_id", F.posexplode("pairs").alias("window", "p"))
    found = disliked.select("key", F.explode("best").alias("b")).select("key", "b.window", F.col("b.score").alias("negative_score"), F.col("b.vec_id").alias("negative_id"))
    ranked = found.join(pairs, ["key", "window"]).select(
        "key", "window", "anchor_id", F.col("p.vec_id").alias("positive_id"), "negative_id", F.col("p.score").alias("positive_score"), "negative_score")
    order = Window.partitionBy("key", "window").orderBy(F.desc("negative_score"), "negative_id")
    return ranked.select("anchor_id", "positive_id", F.row_number().over(order).alias("rank"), "negative_id", "positive_score", "negative_score")
