"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters, over lower-case letters with other runs as one space,
are hashed to a fixed number of places. Document frequencies cover all rows that may be
learned from. The weights are fitted by follow-the-regularised-leader with L1 and L2
penalties on a bounded sample per language, drawn by hash; a part of the sample is kept
back to fit the temperature that the scores are softened or sharpened with.

Defined results: `und` with score 0 where the text is null or has no letters, or where
nothing could be learned; empty tables give no rows; repeated rows are each predicted;
equal scores go to the first language in order; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, mix64, stored

ORDERS, PLACES = (1, 2, 3), 1 << 15
#: Texts per language that the weights and the temperature are fitted on.
SAMPLE, KEPT_BACK, EPOCHS = 1000, 5, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
UNKNOWN = "und"
_STRETCH = 1 << 20
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters, kept per process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def plain(text: str) -> np.ndarray:
    """Code points of the lower-case text, every run of other characters as one space; empty if no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint64)
    inside = letters()[codes]
    if not inside.any():
        return codes[:0]
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    kept[0] = True
    return np.where(inside, codes, np.uint64(32))[kept]


def gram_counts(text: str, places: int = PLACES) -> tuple[np.ndarray, np.ndarray]:
    """(places, counts) of the text's n-grams."""
    codes, counts = plain(text), np.zeros(places, np.int64)
    shift = np.uint64(64 - places.bit_length() + 1)
    for start in range(0, len(codes), _STRETCH):
        rolled = None
        for order in range(1, max(ORDERS) + 1):
            part = codes[start + order - 1 : start + _STRETCH + order - 1]
            rolled = part if rolled is None else rolled[: len(part)] << np.uint64(21) | part
            if order in ORDERS and len(part):
                counts += np.bincount((mix64(rolled + np.uint64(order << 8)) >> shift).astype(np.int64), minlength=places)
    found = np.flatnonzero(counts)
    return found, counts[found]


def weighted(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(found[1])) * idf[found[0]]
    norm = np.sqrt((values * values).sum())
    return values / norm if norm else values


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], places: int, classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (places + 1, classes) by FTRL-proximal; the last row is the intercept. Rows: places, values, class."""
    z = np.zeros((places + 1, classes))
    n = np.zeros((places + 1, classes))

    def weights(at):
        weak = np.abs(z[at]) <= L1
        return np.where(weak, 0.0, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, values, label = np.append(rows[i][0], places), np.append(rows[i][1], 1.0), rows[i][2]
            w = weights(at)
            wrong = softmax(values @ w)
            wrong[label] -= 1
            gradient = values[:, None] * wrong[None, :]
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - step * w
            n[at] += gradient**2
    return weights(slice(None))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t):
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, ratio = np.log(0.02), np.log(50.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


class Model:
    def __init__(self, names: list[str], idf: np.ndarray, weights: np.ndarray, heat: float):
        self.names, self.idf, self.weights, self.heat = names, idf.astype(np.float32), weights.astype(np.float32), heat

    def predict(self, text: str | None) -> tuple[str, float]:
        found = gram_counts(text or "", len(self.idf))
        if not len(found[0]) or not self.names:
            return UNKNOWN, 0.0
        logits = weighted(found, self.idf) @ self.weights[found[0]] + self.weights[-1]
        p = softmax(logits.astype(float) / self.heat)
        best = int(p.argmax())
        return self.names[best], float(min(1.0, p[best]))


def document_frequencies(texts: DataFrame, places: int) -> tuple[np.ndarray, int]:
    """(texts that hold each place, texts), over all rows of texts (text)."""
    def work(batches):
        seen, rows = np.zeros(places, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen[gram_counts(text, places)[0]] += 1
                rows += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(seen[at], rows), pa.int64())],
                                         names=["place", "n"])

    out, rows = np.zeros(places), 0
    for r in map_batches(texts, work, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        if r.place < 0:
            rows = r.n
        else:
            out[r.place] = r.n
    return out, rows


def fit(docs: DataFrame, learn: Column, places: int = PLACES, sample: int = SAMPLE) -> Model:
    """A model from docs (text, lang) where ``learn`` holds and neither is null."""
    rows = docs.where(learn & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    seen, total = document_frequencies(rows.select("text"), places)
    idf = np.log((1 + total) / (1 + seen)) + 1
    # one row per language, stored: Spark sees its size, and texts need no shuffle to meet it
    sizes = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("size")), "languages")
    place = F.xxhash64("text")
    # twice as many as wanted by hash, so that no language brings all its texts to the shuffle, then the exact number
    drawn = rows.join(sizes, "lang").where(F.pmod(place, F.lit(1 << 30)) < (F.lit(2.0 * sample) / F.col("size") * (1 << 30)) + 100)
    drawn = drawn.withColumn("place", place)
    ranked = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))).where(F.col("rank") <= sample)

    def work(batches):
        for batch in batches:
            found = [gram_counts(t, places) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("lang"), batch.column("rank"), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                pa.array([f[1] for f in found], pa.list_(pa.int32()))], names=["lang", "rank", "at", "counts"])

    counted = map_batches(ranked.select("text", "lang", "rank"), work, "lang string, rank int, at array<int>, counts array<int>", 200)
    found = sorted(stored(counted, "language-sample").collect(), key=lambda r: (r.lang, r.rank))
    names = sorted({r.lang for r in found})
    fitted, kept_back = [], []
    for r in found:
        at = np.array(r["at"], np.int64)
        if len(at):
            values = weighted((at, np.array(r["counts"])), idf)
            (kept_back if r["rank"] % KEPT_BACK == 0 else fitted).append((at, values, names.index(r.lang)))
    weights = train(fitted, places, len(names))
    logits = np.stack([v @ weights[at] + weights[-1] for at, v, _ in kept_back]) if kept_back else np.empty((0, len(names)))
    return Model(names, idf, weights, temperature(logits, np.array([c for _, _, c in kept_back], int)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for each row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([f[0] for f in found], pa.string()),
                                              pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, lang_pred string, score double")
