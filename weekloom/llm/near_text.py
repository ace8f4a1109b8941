"""N-gram Jaccard join of documents, with Bayesian pruning of candidates.

Texts are sets of five-word shingles, compared by 64-bit hashes. Texts with equal sets form
a class, joined once. Classes that agree in all MinHash values of a band are candidates.
Their MinHash values are then compared in steps: after each step, the posterior probability
that the Jaccard similarity reaches the threshold, under a uniform prior, is looked up by
the number of agreeing values, and the pair is dropped where it is below the tolerance. The
rest is verified on the exact sets.

Buckets with more than ``hot`` classes emit no pairs: their classes are linked to the
bucket's smallest one, and whoever is connected through such links or through pairs that
survived is compared, all in all, in blocks within the tasks. Tasks give each class's
number of links and a spanning forest of links, never the pairs of a group.

Defined results: documents without a word, or null texts, link with nothing and stay alone;
a text of fewer than five words is one shingle; repeated rows and copies count as links of
each other; rows with a null id take part, but name no class; a document id that has
several texts stands for all of them; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, mix64, shingle_hashes, stored, text_or_empty, word_hashes
from weekloom.llm.components import components, spanning

SHINGLE, THRESHOLD = 5, 0.8
#: 40 bands of 5 values miss a pair at the threshold with a probability of 1.2e-7.
BANDS, ROWS = 40, 5
#: Values compared per step; least posterior probability of reaching the threshold. All steps lose 8.5e-6 of pairs at the threshold.
STEP, TOLERANCE = 20, 1e-6
HOT, BLOCK = 32, 256
_RANDOM = np.random.default_rng(20240229)
_A = _RANDOM.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: str, n: int = SHINGLE) -> np.ndarray:
    return shingle_hashes(word_hashes(text.encode()), n)


def signature(found: np.ndarray) -> np.ndarray:
    """The MinHash values of a set of hashes, 16 bits of each."""
    out = np.full(len(_A), 0xFFFFFFFF, np.uint64)
    low = mix64(found) >> np.uint64(32)
    with np.errstate(over="ignore"):
        for start in range(0, len(low), 512):
            np.minimum(out, ((_A[:, None] * low[None, start : start + 512] + _B[:, None]) >> np.uint64(32)).min(axis=1), out=out)
    return out.astype(np.uint16)


@lru_cache
def least_agreements(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """Per step, the fewest agreeing values of those seen with which a pair goes on.

    With m of n agreeing and a uniform prior the similarity is Beta(m + 1, n - m + 1)
    distributed; the tail beyond the threshold is the chance of at most m hits in n + 1
    trials at the threshold.
    """
    from math import comb

    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out.append(m)
    return tuple(out)


def pruned(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (left[i], right[j]) of signatures stay, comparing STEP values at a time."""
    alive, agreed = np.arange(len(i)), np.zeros(len(i), np.int16)
    for step, least in enumerate(least_agreements()):
        part = slice(step * STEP, (step + 1) * STEP)
        agreed = agreed + (left[i[alive], part] == right[j[alive], part]).sum(axis=1, dtype=np.int16)
        stay = agreed >= least
        alive, agreed = alive[stay], agreed[stay]
    return alive


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether the exact Jaccard similarity of two sorted sets reaches the threshold."""
    if min(len(a), len(b)) < threshold * max(len(a), len(b)) - 1e-9:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common >= threshold * (len(both) - common) - 1e-9


# --- classes and their candidates -----------------------------------------------------

def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, class_key (digest of the set of shingles), signature; both null without words."""
    def work(batches):
        for batch in batches:
            keys, values = [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                values.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(values, pa.binary())],
                                             names=["doc_id", "class_key", "signature"])

    return map_batches(docs.select("doc_id", text_or_empty().alias("text")), work, "doc_id long, class_key binary, signature binary", 500)


def banded(classes: DataFrame) -> DataFrame:
    """class_id, bucket: a key per band of each class's signature."""
    def work(batches):
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, BANDS, ROWS).astype(np.uint64)
            with np.errstate(over="ignore"):
                keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), values.shape[:2])
                for row in range(ROWS):
                    keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, :, row])
            ids = np.repeat(np.array(batch.column("class_id").to_pylist(), np.int64), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys.reshape(-1).view(np.int64))], names=["class_id", "bucket"])

    return map_batches(classes.select("class_id", "signature"), work, "class_id long, bucket long")


def candidates(classes: DataFrame, hot: int) -> tuple[DataFrame, DataFrame]:
    """(pairs a < b that share a bucket of at most ``hot`` classes, links of larger buckets to their smallest class)."""
    rows = banded(classes)
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("class_id").alias("least")).where("n > 1")
    rows = stored(rows.join(shared, "bucket"), "near-buckets")
    links = rows.where((F.col("n") > hot) & (F.col("class_id") > F.col("least"))).select(
        F.col("class_id").alias("a"), F.col("least").alias("b")).distinct()
    # classes that large buckets connect are compared anyway: their smaller buckets emit no pairs of them
    groups = components(links).withColumnRenamed("node", "class_id")
    cold = rows.where(F.col("n") <= hot).join(groups, "class_id", "left")
    member = F.struct("class_id", F.coalesce("component", "class_id").alias("group"))
    cold = cold.groupBy("bucket").agg(F.sort_array(F.collect_list(member)).alias("ids"))
    firsts = cold.select("ids", F.posexplode("ids").alias("at", "one"))
    others = F.filter(F.slice("ids", F.col("at") + 2, F.size("ids")), lambda x: x["group"] != F.col("one.group"))
    pairs = firsts.select("one", F.explode(others).alias("two")).select(F.col("one.class_id").alias("a"), F.col("two.class_id").alias("b"))
    return pairs.distinct(), links


def surviving(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that Bayesian pruning keeps."""
    def work(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("x", "y"))
                at = np.arange(batch.num_rows)
                stay = pa.array(pruned(x, y, at, at))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(stay), batch.column("b").take(stay)], names=["a", "b"])

    values = classes.select("class_id", "signature")
    joined = pairs.join(values.toDF("a", "x"), "a").join(values.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return map_batches(joined, work, "a long, b long", 4000)


# --- verification in blocks -----------------------------------------------------------

def verified(docs: DataFrame, groups: DataFrame, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """(class_id, n_links to other classes' documents; links a, b of a spanning forest).

    ``groups`` has class_id, component and weight (documents of the class). The classes of
    a component are cut into blocks by hash, and every pair of blocks is one unit of work,
    wherever Spark puts it; pairs within it are pruned again and verified on exact sets.
    """
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    members = groups.join(sizes, "component").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    members = members.withColumn("mine", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    members = stored(members, "near-members").where("weight > 0")
    # Spark may drop other documents by a Bloom filter before the shuffle, however small the table
    docs.sparkSession.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    texts = docs.select(F.col("doc_id").alias("class_id"), text_or_empty().alias("text"))
    full = stored(_with_sets(texts.join(members, "class_id")), "near-sets")

    # a block goes to the units with every block, smaller number first
    units = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"low": F.least("mine", "other"), "high": F.greatest("mine", "other")}).drop("other", "blocks")

    def compare(key, table):
        component, low, high = (k.as_py() for k in key)
        ids = np.array(table.column("class_id").to_pylist(), np.int64)
        order = np.argsort(ids, kind="stable")
        order = order[np.concatenate([[True], np.diff(ids[order]) > 0])] if len(order) else order
        ids = ids[order]
        side = np.array(table.column("mine").to_pylist())[order]
        weight = np.array(table.column("weight").to_pylist(), np.int64)[order]
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        sets = [sets[o] for o in order]
        values = np.stack([signature(s) for s in sets])
        counts, kept = np.zeros(len(ids), np.int64), []
        first, second = np.flatnonzero(side == low), np.flatnonzero(side == high)
        for i in first:
            j = second[second > i] if low == high else second
            alive = j[pruned(values, values, np.full(len(j), i), j)]
            for o in alive:
                if similar(sets[i], sets[o], threshold):
                    counts[i] += weight[o]
                    counts[o] += weight[i]
                    kept.append((int(i), int(o)))
        forest = spanning(len(ids), kept)
        linked = np.flatnonzero(counts)
        a = np.concatenate([ids[linked], ids[[x for x, _ in forest]]])
        b = np.concatenate([np.full(len(linked), -1), ids[[x for _, x in forest]]])
        n = np.concatenate([counts[linked], np.zeros(len(forest), np.int64)])
        kind = np.concatenate([np.zeros(len(linked), bool), np.ones(len(forest), bool)])
        return pa.table({"a": pa.array(a.astype(np.int64)), "b": pa.array(b.astype(np.int64)), "n": pa.array(n), "link": pa.array(kind)})

    found = units.groupBy("component", "low", "high").applyInArrow(compare, "a long, b long, n long, link boolean")
    found = stored(found, "near-found")
    counts = found.where("NOT link").groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("n_links"))
    return counts, found.where("link").select("a", "b")


def _with_sets(rows: DataFrame) -> DataFrame:
    def work(batches):
        for batch in batches:
            sets = [shingles(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sets, pa.binary())], names=[*names, "set"])

    names = ["class_id", "component", "weight", "blocks", "mine"]
    return map_batches(rows.select(*names, "text"), work, "class_id long, component long, weight long, blocks int, mine int, set binary", 500)


def joined(docs: DataFrame, threshold: float = THRESHOLD, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id, n_links, component_id, kept for each row of docs (doc_id, text).

    class_id is the smallest id with the same set of shingles, n_links the number of other
    rows with a similarity of at least the threshold, component_id the smallest id that
    links lead to, kept whether the row's id is that one.
    """
    rows = stored(sketched(docs), "near-rows")
    told = rows.where("class_key IS NOT NULL")
    classes = stored(told.groupBy("class_key").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("weight"), F.first("signature").alias("signature")), "near-classes")
    named = classes.where("class_id IS NOT NULL").groupBy("class_id").agg(
        F.sum("weight").alias("weight"), F.first("signature").alias("signature"))
    pairs, hubs = candidates(named, hot)
    links = surviving(pairs, named).unionByName(hubs)
    groups = components(links).withColumnRenamed("node", "class_id").join(named.select("class_id", "weight"), "class_id")
    counts, forest = verified(docs, groups, threshold, block)
    reach = components(forest).withColumnRenamed("node", "class_id")
    known = classes.select("class_key", "class_id", "weight").join(counts, "class_id", "left").join(reach, "class_id", "left")
    out = rows.select("doc_id", "class_key").join(known, "class_key", "left")
    class_id = F.coalesce("class_id", "doc_id")
    component = F.coalesce("component", class_id)
    return out.select(
        "doc_id", class_id.alias("class_id"),
        (F.coalesce("n_links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
