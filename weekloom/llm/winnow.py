"""Document fingerprints by winnowing.

Every k-gram of code points has a rolling hash. From every window of w consecutive hashes
the smallest is kept, the rightmost one on ties, with its position. Two texts that share
any k + w - 1 code points in a row share a kept hash, and no shared run shorter than k is
ever reported.

Defined results: a text shorter than k is one gram; an empty or null text has an empty
fingerprint; two empty fingerprints are alike by 1, an empty and another by 0. Documents
are ordered by descending doc_id, null ids last, equal ids by text; the last is followed by
the first, a single document by itself. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, mix64, powers, text_or_empty

GRAM, WINDOW = 20, 30
#: Hashes hold 40 bits, the other 24 hold a place within a stretch of a text.
_PLACES = 1 << 24
_STRETCH = 1 << 20


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """40-bit hashes of all runs of k code points, rolled along the text."""
    n = len(codes) - k + 1
    up, down = powers(len(codes) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        raw = (total[k:] - total[:-k]) * down[:n]
    return mix64(raw) >> np.uint64(24)


def window_minima(keys: np.ndarray, w: int) -> np.ndarray:
    """The smallest key of each window of w, by doubling spans."""
    spans, width = keys, 1
    while width * 2 <= w:
        spans = np.minimum(spans[:-width], spans[width:])
        width *= 2
    return np.minimum(spans[: len(keys) - w + 1], spans[w - width :]) if width < w else spans


def fingerprint(text: str, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) that winnowing keeps, in order of position."""
    codes = code_points(text)
    if not len(codes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    k = min(k, len(codes))
    found_hashes, found_places, last = [], [], -1
    for start in range(0, max(1, len(codes) - k + 1), _STRETCH):
        hashes = gram_hashes(codes[start : start + _STRETCH + k + w - 2], k)
        if start and len(hashes) < w:
            break
        backwards = np.uint64(_PLACES - 1) - np.arange(len(hashes), dtype=np.uint64)
        minima = window_minima(hashes << np.uint64(24) | backwards, min(w, len(hashes)))
        kept = minima[np.concatenate([[True], minima[1:] != minima[:-1]])]
        places = start + (_PLACES - 1) - (kept & np.uint64(_PLACES - 1)).astype(np.int64)
        new = places > last
        found_hashes.append(kept[new] >> np.uint64(24))
        found_places.append(places[new])
        last = int(places[-1])
    return np.concatenate(found_hashes), np.concatenate(found_places)


def encoded(found: tuple[np.ndarray, np.ndarray]) -> str:
    """A fingerprint as text: per kept gram 10 hex digits of hash and 10 of position."""
    out = np.empty((len(found[0]), 10), np.uint8)
    for column, values in ((0, found[0]), (5, found[1].astype(np.uint64))):
        out[:, column : column + 5] = values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
    return out.tobytes().hex()


def decoded(text: str) -> list[tuple[int, int]]:
    return [(int(text[i : i + 10], 16), int(text[i + 10 : i + 20], 16)) for i in range(0, len(text), 20)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Dice's coefficient of the two sets of hashes (sorted, distinct)."""
    if not len(a) and not len(b):
        return 1.0
    return 2.0 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def edited_text(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """doc_id, places array<struct<hash, position>> for each row of docs (doc_id, text)."""
    def work(batches):
        kind = pa.list_(pa.struct([("hash", pa.int64()), ("position", pa.int64())]))
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                hashes, places = fingerprint(text, k, w)
                rows.append([{"hash": h, "position": p} for h, p in zip(hashes.tolist(), places.tolist())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "places"])

    return map_batches(docs.select("doc_id", text_or_empty().alias("text")), work,
                       "doc_id long, places array<struct<hash: long, position: long>>")


def in_parts(rows: DataFrame, key: str) -> DataFrame:
    """Rows with a part number, parts in descending order of key, and each part's successor repeated at its end.

    Parts are cut at quantiles of the key, four per shuffle partition. The row that follows
    a part, the first one of the next part that has rows (after the last: the first), goes
    to it too, marked ``extra``. Only one key per part passes through the driver.
    """
    spark = rows.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x > F.col(key))) if cuts else F.lit(0)
    rows = rows.withColumn("part", part)
    tops = sorted(rows.groupBy("part").agg(F.max(key).alias("top")).collect())
    successors = [(tops[(i + 1) % len(tops)].top, r.part) for i, r in enumerate(tops)]
    extra = spark.createDataFrame(successors, "top long, goes_to int")
    repeated = rows.join(F.broadcast(extra), F.col(key) == F.col("top")).drop("top", "part").withColumnRenamed("goes_to", "part")
    return rows.withColumn("extra", F.lit(0)).unionByName(repeated.withColumn("extra", F.lit(1)))


def edits(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text takes its end from the document that follows in descending order of
    doc_id. Texts are shuffled once, into sorted parts that stream through the tasks.
    """
    lowest = -(1 << 63)
    rows = docs.select("doc_id", text_or_empty().alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("place"))
    ordered = in_parts(rows, "place").repartition("part").sortWithinPartitions("part", "extra", F.desc("place"), "text")

    def work(batches):
        held = None
        for batch in batches:
            out = []
            for doc, text, part, extra in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "extra"))):
                if held is not None and held[2] != part:
                    held = None
                if held is None and extra:
                    continue
                found = fingerprint(text, k, w)
                now = (doc, text, part, found, np.unique(found[0]))
                if held is not None:
                    edited = edited_text(held[1], text)
                    theirs = fingerprint(edited, k, w)
                    out.append((
                        held[0], len(held[1]), hashlib.sha256(edited.encode()).hexdigest(), encoded(held[3]), encoded(theirs),
                        likeness(held[4], np.unique(theirs[0])), likeness(held[4], now[4]),
                    ))
                held = None if extra else now
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    names = [c.split()[0] for c in schema.split(", ")]
    return map_batches(ordered, work, schema, 500)
