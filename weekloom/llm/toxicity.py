"""Toxicity by nearest labelled examples.

The words of the labelled examples, all of them, span a TF-IDF space. Document frequencies
come from all documents. A word's idf is scaled by (t - c) / (t + c), where t and c are the
shares of toxic and other examples that hold it, smoothed towards each other by
``SMOOTHING`` texts and never below ``LEAST_LEAD``, so every word counts. A text's score is
the distance-weighted vote of the labelled examples nearest by exact cosine, found through
an inverted index in blocks of like examples. Lists of words that few of a block's examples
hold are read; for words that are common in a block, the block with the most of their postings
is dealt with first, multiplied out for many texts at once, then every other one whose bound
reaches the neighbours found: the most that the lists read give one of its examples, and the sum over
the common words of weight times the largest weight in the block. Sums in single precision tell who
may be among the nearest; their cosines are computed in double precision. Votes are calibrated
on the examples themselves, each left out of its own vote.

Fitted on a bounded sample: at most ``examples`` different labelled texts per label, drawn
by hash from all that there are. Everything else covers all rows.

Defined results: a text without any word of the examples (also empty or null) has no
neighbours and scores the share of toxic labels, 0 where nothing is labelled; a document
with several labels is toxic if one of them is; null labels are unlabelled; empty tables
give no rows; repeated rows are each scored; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, span_hashes, stored, text_or_empty

EXAMPLES, NEIGHBOURS, BLOCK = 20_000, 25, 4096
#: Words in more than this share of a block's examples are common there.
COMMON = 1 / 10
#: Postings that are weighed at once when an index arrives.
PART = 1 << 20
#: Cells of a matrix that a text is multiplied with in the time in which one posting is read.
CELLS = 250
#: Texts that are asked for at once.
GROUP = 64
SMOOTHING, LEAST_LEAD, THRESHOLD = 8.0, 0.05, 0.7
#: Added to distances, so that an equal text doesn't outweigh all others.
SOFTENING = 0.05
#: Words and rounds of the grouping of like examples.
SKETCH, ROUNDS = 256, 8
#: Texts whose answer a worker remembers, for copies.
REMEMBERED = 4096
_WORD = re.compile(r"[^\W\d_]+")
_TABLES: dict[str, np.ndarray] = {}
EVIDENCE = "array<struct<doc_id: long, cosine: double, toxic: int>>"


def letters() -> np.ndarray:
    """Whether a code point may stand in a word, made once per process."""
    if "letters" not in _TABLES:
        table = np.zeros(0x110000, bool)
        for found in _WORD.finditer("".join(map(chr, range(0x110000)))):
            table[found.start() : found.end()] = True
        _TABLES["letters"] = table
    return _TABLES["letters"]


def hashed(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 64-bit hashes of a text's different words, runs of letters in lower case, and how often it holds each."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = letters()[codes]
    edges = np.flatnonzero(np.diff(inside))
    hashes = np.sort(span_hashes(codes, edges[::2], edges[1::2]))
    first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
    return hashes[first], np.diff(first, append=len(hashes)).astype(np.int32)


def spans(lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """The numbers from each low to before its high, end to end."""
    sizes = highs - lows
    ends = np.cumsum(sizes)
    out = np.repeat(lows - ends + sizes, sizes)
    run = _TABLES.get("run", out[:0])
    if len(run) < len(out):
        run = _TABLES["run"] = np.arange(2 * len(out))
    out += run[: len(out)]
    return out


def reached(sums: np.ndarray, k: int) -> float:
    """A value that at least k of the sums reach: the k-th largest, or that of the largest of slices; 0 if there are fewer."""
    if len(sums) <= k:
        return 0.0
    if len(sums) >= 64 * k:
        sums = sums[: len(sums) // 32 * 32].reshape(32, -1).max(0)
    return max(0.0, float(np.partition(sums, -k)[-k]))


# --- fitting ------------------------------------------------------------------------------

def labelled(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """text_key, doc_id, toxic, place (a hash to draw by): one row per different labelled text among the rows to learn from."""
    marks = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    keys = docs.where(learn).select("doc_id", F.unhex(F.md5(text_or_empty())).alias("text_key"))
    rows = keys.join(marks, "doc_id").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    return rows.withColumn("place", F.xxhash64("text_key"))


def drawn(docs: DataFrame, marked: DataFrame, examples: int) -> tuple[DataFrame, dict[int, int]]:
    """(rows of marked that are examples; different labelled texts by label)."""
    sizes = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = marked.limit(0)
    for toxic, n in sorted(sizes.items()):
        # about a tenth more than wanted by hash, then the exact number
        some = F.pmod("place", F.lit(1 << 30)) < int(min(1.0, examples / n * 1.1 + 1e-6) * (1 << 30))
        parts = parts.union(marked.where((F.col("toxic") == toxic) & some).orderBy("place").limit(examples))
    # at most ``examples`` rows per label
    return stored(parts, "toxic-chosen"), sizes


def words_in(docs: DataFrame, chosen: DataFrame) -> np.ndarray:
    """Sorted hashes of all words of the examples."""
    def work(batches):
        for batch in batches:
            words = np.unique(np.concatenate([np.empty(0, np.uint64), *(hashed(t)[0] for t in batch.column("text").to_pylist())]))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64))], names=["word"])

    keys = docs.select("doc_id", F.unhex(F.md5(text_or_empty())).alias("text_key"), text_or_empty().alias("text"))
    texts = keys.join(F.broadcast(chosen.select("doc_id", "text_key")), ["doc_id", "text_key"]).select("text")
    words = map_batches(texts, work, "word long").distinct().toArrow().column("word").to_numpy()
    return np.sort(words.view(np.uint64))


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.offsets.to_numpy().astype(np.int64), column.values.to_numpy(zero_copy_only=False)


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, text_key (digest of the text), terms, counts: which words of the vocabulary (sorted hashes) a text holds how often."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches):
        for batch in batches:
            terms, counts = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
            for text in batch.column("text").to_pylist():
                hashes, n = hashed(text)
                at = np.searchsorted(shared.value, hashes)
                known = at < len(shared.value)
                known[known] = shared.value[at[known]] == hashes[known]
                terms.append(at[known].astype(np.int32))
                counts.append(n[known])
            offsets = pa.array(np.cumsum([len(t) for t in terms]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c))) for c in (terms, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *lists], names=["doc_id", "text_key", "terms", "counts"])

    rows = docs.select("doc_id", F.unhex(F.md5(text_or_empty())).alias("text_key"), text_or_empty().alias("text"))
    return map_batches(rows, work, "doc_id long, text_key binary, terms array<int>, counts array<int>", 500)


def document_frequencies(found: DataFrame, terms: int) -> np.ndarray:
    """How many rows hold each term, counted per task before the shuffle."""
    def work(batches):
        held = np.zeros(terms, np.int64)
        for batch in batches:
            offsets, values = _lists(batch.column("terms"))
            held += np.bincount(values[offsets[0] : offsets[-1]], minlength=terms)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], names=["term", "n"])

    seen = np.zeros(terms)
    if terms:
        rows = map_batches(found.select("terms"), work, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        seen[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return seen


class Index:
    """Examples as unit TF-IDF vectors in inverted lists, cut into blocks of like examples.

    A list is a run of postings by position, and positions go by block. Words that many examples of a block hold are
    also laid out as a matrix of the block, which is multiplied with many texts at once where that costs less than reading lists.
    Only what the rest follows from is sent: list sizes, places, counts and idf.
    """

    def __init__(self, idf: np.ndarray, examples: list[tuple], block: int = BLOCK, common: float = COMMON):
        """examples: (doc_id, toxic, terms, counts), numbered as they come; ``block`` is how many a block holds on average,
        ``common`` a share of a block."""
        n, idf = len(examples), np.asarray(idf, float)
        group = like(examples, idf, block)
        order = np.argsort(group, kind="stable").astype(np.int32)
        position = np.empty(n, np.int32)
        position[order] = np.arange(n)
        held = np.bincount(group)
        kind = np.min_scalar_type(max((int(np.max(e[3], initial=0)) for e in examples), default=0))
        term = np.concatenate([np.empty(0, np.int32), *(np.asarray(examples[i][2], np.int32) for i in order)])
        count = np.concatenate([np.empty(0, kind), *(np.asarray(examples[i][3], kind) for i in order)])
        at = np.repeat(np.arange(n, dtype=np.min_scalar_type(max(0, n - 1))), [len(examples[i][2]) for i in order])
        by_term = np.argsort(term, kind="stable")
        self._known({
            "idf": idf, "bounds": np.concatenate([[0], np.cumsum(held[held > 0])]), "common": common, "number": order, "position": position,
            "ids": np.array([e[0] for e in examples], np.int64), "toxic": np.array([e[1] for e in examples], np.int8),
            "sizes": np.bincount(term, minlength=len(idf)).astype(np.int32), "at": at[by_term], "count": count[by_term]})

    def __getstate__(self) -> dict:
        return self.sent

    def _known(self, sent: dict) -> None:
        self.sent = sent
        vars(self).update({k: v for k, v in sent.items() if k not in ("sizes", "at", "count")})

    def __setstate__(self, sent: dict) -> None:
        """What searches need besides, made where the index arrives."""
        self._known(sent)
        n, sizes, bounds, at, count = len(self.ids), sent["sizes"], self.bounds, sent["at"], sent["count"]
        self.sent = {}
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.logs = 1 + np.log(np.arange(int(count.max(initial=0)) + 1).clip(1))
        # the same postings by example, for cosines in double precision
        term = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        by_example = np.argsort(at, kind="stable")
        self.terms, self.term_counts = term[by_example], count[by_example]
        self.begins = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))])
        del by_example
        parts, squares = [slice(low, low + PART) for low in range(0, len(at), PART)], np.zeros(n)
        for part in parts:
            squares += np.bincount(at[part], (self.logs[count[part]] * self.idf[term[part]]) ** 2, n)
        self.scale = 1 / np.sqrt(np.maximum(squares, 1e-300))
        # a posting's weight and place side by side, read as one
        self.postings = np.empty((len(at), 2), np.int32)
        weight = self.postings.view(np.float32)[:, 0]
        self.postings[:, 1] = at
        for part in parts:
            weight[part] = self.logs[count[part]] * self.idf[term[part]] * self.scale[at[part]]
        del term
        # words that are common in a block, and their postings by block
        often = np.flatnonzero(sizes > (np.diff(bounds).min() if n else 0) * sent["common"])
        cuts = [self.starts[t] + np.searchsorted(at[self.starts[t] : self.starts[t + 1]], bounds) for t in often]
        self.cuts = np.array(cuts, np.int64).reshape(len(often), len(bounds))
        self.dense = np.diff(self.cuts) > sent["common"] * np.diff(bounds)
        some = self.dense.any(1)
        often, self.cuts, self.dense = often[some], self.cuts[some], self.dense[some]
        self.row = np.full(len(sizes), -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.held = np.where(self.dense, np.diff(self.cuts), 0)
        most = np.array([[weight[a:b].max(initial=0) for a, b in zip(line, line[1:])] for line in self.cuts]).reshape(self.dense.shape)
        self.most = np.where(self.dense, most, 0)
        self.rows, self.matrices = [], []
        for b, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
            rows = np.flatnonzero(self.dense[:, b])
            matrix, number = np.zeros((len(rows), high - low), np.float32), np.full(len(often), -1, np.int32)
            for line, r in zip(matrix, rows):
                part = slice(self.cuts[r, b], self.cuts[r, b + 1])
                line[self.postings[part, 1] - low] = weight[part]
            number[rows] = np.arange(len(rows))
            self.rows.append(number)
            self.matrices.append(matrix)
        self.asked = np.zeros(len(sizes))
        # postings that cost as much as a text's part of a product; how far single precision may be off
        self.price = np.array([m.size / CELLS for m in self.matrices])
        self.off = (max((len(m) for m in self.matrices), default=0) + 8) * 2.0**-23

    def unit(self, terms, counts) -> np.ndarray:
        weights = (1 + np.log(np.asarray(counts, float))) * self.idf[terms]
        return weights / np.sqrt((weights * weights).sum())

    def nearest(self, terms, counts, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The answer for one text."""
        return next(self.search([(terms, counts, without)], k))

    def search(self, texts: list[tuple], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text (terms, counts, number of an example to leave out or -1): (example numbers, cosines) of the k nearest,
        ties to the smaller number; examples sharing no word are left out."""
        for low in range(0, len(texts), GROUP):
            group = [(np.asarray(t, np.int64), self.unit(t, c), w) for t, c, w in texts[low : low + GROUP]]
            rows = [self.row[terms] for terms, _, _ in group]
            # each text's first block, where it finds the most postings of common words
            gain = np.array([self.held[r[r >= 0]].sum(0) - self.price for r in rows]).reshape(len(group), len(self.price))
            dealt = (gain > 0) & (gain == gain.max(1, initial=0, keepdims=True))
            products: list[dict] = [{} for _ in group]
            for b, (number, matrix) in enumerate(zip(self.rows, self.matrices)):
                asking = np.flatnonzero(dealt[:, b])
                asked = np.zeros((len(asking), len(matrix)), np.float32)
                for line, i in zip(asked, asking):
                    place = np.where(rows[i] >= 0, number[rows[i]], -1)
                    line[place[place >= 0]] = group[i][1][place >= 0]
                for i, product in zip(asking, asked @ matrix):
                    products[i][b] = product
            for one, row, product, done in zip(group, rows, products, dealt):
                yield self._best(*one, row, product, done, k) if len(one[0]) and len(self.ids) else (np.empty(0, np.int64), np.empty(0))

    def _best(self, terms: np.ndarray, unit: np.ndarray, without: int, row: np.ndarray, product: dict, dealt: np.ndarray,
              k: int) -> tuple[np.ndarray, np.ndarray]:
        """One text's answer; ``product``: the sums over common words in the blocks that were dealt with by products."""
        often, single = row >= 0, unit.astype(np.float32)
        r, rare, usual = row[often], ~often, single[often]
        # lists of rare words, and of common ones in the blocks in which they are not common
        cuts, left = self.cuts[r], ~self.dense[r]
        sums = self.read(
            np.concatenate([self.starts[terms[rare]], cuts[:, :-1][left]]), np.concatenate([self.starts[terms[rare] + 1], cuts[:, 1:][left]]),
            np.concatenate([single[rare], np.broadcast_to(usual[:, None], left.shape)[left]]))
        for b, part in product.items():
            sums[self.bounds[b] : self.bounds[b + 1]] += part
        if without >= 0:
            sums[self.position[without]] = -np.inf
        least = reached(sums, k) - 2 * self.off
        # of the other blocks those whose bound reaches the neighbours found
        other = ~dealt & (np.maximum.reduceat(sums, self.bounds[:-1]) + usual @ self.most[r] >= least)
        if len(r) and other.any():
            more = ~left & other
            sums += self.read(cuts[:, :-1][more], cuts[:, 1:][more], np.broadcast_to(usual[:, None], more.shape)[more])
            least = reached(sums, k) - 2 * self.off
        # in double precision for those that may be among the nearest
        near = np.flatnonzero(sums >= max(least, 1e-30))
        if len(near) > k:
            some = sums[near]
            near = near[some >= np.partition(some, -k)[-k] - 2 * self.off]
        self.asked[terms] = unit * self.idf[terms]
        lows, highs = self.begins[near], self.begins[near + 1]
        at = spans(lows, highs)
        found = self.asked.take(self.terms.take(at)) * self.logs.take(self.term_counts.take(at))
        self.asked[terms] = 0
        cosines = np.add.reduceat(found, np.cumsum(highs - lows) - highs + lows) * self.scale[near] if len(near) else np.empty(0)
        numbers = self.number[near].astype(np.int64)
        best = np.lexsort((numbers, -cosines.round(12)))[:k]
        return numbers[best], cosines[best]

    def read(self, lows: np.ndarray, highs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """For each position the sum of its weights in some runs of postings, times what is asked."""
        at = spans(lows, highs)
        if not len(at):
            return np.zeros(len(self.ids))
        found = self.postings.view(np.int64)[:, 0].take(at).view(np.int32).reshape(-1, 2)
        return np.bincount(found[:, 1], found.view(np.float32)[:, 0] * np.repeat(asked, highs - lows), len(self.ids))

    def vote(self, found: tuple[np.ndarray, np.ndarray]) -> float:
        numbers, cosines = found
        weights = 1 / (SOFTENING + np.maximum(0, 1 - cosines))
        return float((weights * self.toxic[numbers]).sum() / weights.sum())


def like(examples: list[tuple], idf: np.ndarray, block: int) -> np.ndarray:
    """A group per example, so that blocks of a group's examples have few words in common with other texts: k-means on the
    words that most examples hold, which tell languages and kinds of text apart."""
    groups = -(-len(examples) // block)
    if groups < 2:
        return np.zeros(len(examples), np.int64)
    held = np.zeros(len(idf), np.int64)
    for _, _, terms, _ in examples:
        held[terms] += 1
    place = np.full(len(idf), SKETCH)
    usual = np.argsort(-held, kind="stable")[:SKETCH]
    place[usual] = np.arange(len(usual))
    sketch = np.zeros((len(examples), SKETCH + 1), np.float32)
    for line, (_, _, terms, counts) in zip(sketch, examples):
        line[place[terms]] = 1 + np.log(counts)
    sketch = sketch[:, :SKETCH]
    sketch /= np.maximum(1e-12, np.sqrt((sketch * sketch).sum(1, keepdims=True)))
    # first centres: each as far as can be from those before
    centres, far = sketch[:1], np.full(len(sketch), -1, np.float32)
    while len(centres) < groups:
        far = np.maximum(far, sketch @ centres[-1])
        centres = np.concatenate([centres, sketch[[far.argmin()]]])
    for _ in range(ROUNDS):
        group = (sketch @ centres.T).argmax(1)
        sums = np.stack([sketch[group == g].sum(0) for g in range(groups)])
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(size > 0, sums / np.maximum(1e-12, size), centres)
    return (sketch @ centres.T).argmax(1)


class Calibration:
    """Votes to probabilities: smoothed shares per tenth of the vote, made non-decreasing by pooling, straight lines between."""

    def __init__(self, votes: np.ndarray, toxic: np.ndarray, weights: np.ndarray, prior: float):
        tenth = np.minimum((votes * 10).astype(int), 9)
        mass = np.bincount(tenth, weights, 10)
        hits = np.bincount(tenth, weights * toxic, 10)
        self.centres = (np.arange(10) + 0.5) / 10
        pools = [[h + (c + prior) / 2, m + 1.0, 1] for h, m, c in zip(hits, mass, self.centres)]
        kept: list[list[float]] = []
        for pool in pools:
            kept.append(pool)
            while len(kept) > 1 and kept[-2][0] * kept[-1][1] > kept[-1][0] * kept[-2][1]:
                h, m, n = kept.pop()
                kept[-1] = [kept[-1][0] + h, kept[-1][1] + m, kept[-1][2] + n]
        self.shares = [h / m for h, m, n in kept for _ in range(int(n))]

    def __call__(self, vote: float) -> float:
        return float(min(1.0, np.interp(vote, self.centres, self.shares)))


def leads(term: np.ndarray, toxic: np.ndarray, terms: int, sizes: tuple[int, int]) -> np.ndarray:
    """(t - c) / (t + c) of each term's smoothed shares of toxic and other examples, at least LEAST_LEAD; term, toxic (boolean): a place per posting."""
    others, toxics = sizes
    part = toxics / max(1, others + toxics)
    held = np.bincount(term[toxic], minlength=terms)
    t = (held + SMOOTHING * part) / max(1, toxics)
    c = (np.bincount(term, minlength=terms) - held + SMOOTHING * (1 - part)) / max(1, others)
    return np.maximum(LEAST_LEAD, (t - c) / np.maximum(t + c, 1e-300))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, examples: int = EXAMPLES,
        neighbours: int = NEIGHBOURS) -> tuple[DataFrame, Broadcast, Calibration, float]:
    """(vectors of all docs, shared index, calibration, score without any word)."""
    chosen, sizes = drawn(docs, stored(labelled(docs, labels, learn), "toxic-labels"), examples)
    vocabulary = words_in(docs, chosen)
    found = stored(vectors(docs, vocabulary), "toxic-vectors")
    rows = found.join(F.broadcast(chosen), ["doc_id", "text_key"]).select("place", "doc_id", "toxic", "terms", "counts")
    rows = stored(rows.dropDuplicates(["place"]), "toxic-examples")
    known = rows.toArrow()
    place, toxic, ids = (known.column(c).to_numpy() for c in ("place", "toxic", "doc_id"))
    (offsets, term), (_, counts) = _lists(known.column("terms")), _lists(known.column("counts"))
    del known
    total = found.count()
    drawn_of = (int((toxic == 0).sum()), int((toxic == 1).sum()))
    idf = np.log((1 + total) / (1 + document_frequencies(found, len(vocabulary)))) + 1
    idf *= leads(term, np.repeat(toxic == 1, np.diff(offsets)), len(vocabulary), drawn_of)
    order = np.argsort(place)
    index = Index(idf, [(ids[i], toxic[i], term[offsets[i] : offsets[i + 1]], counts[offsets[i] : offsets[i + 1]]) for i in order])
    shared = docs.sparkSession.sparkContext.broadcast(index)
    prior = sizes.get(1, 0) / (sum(sizes.values()) + 1)
    number, votes = own_votes(rows, shared, place[order], neighbours)
    weights = np.array([sizes.get(t, 0) / max(1, drawn_of[t]) for t in (0, 1)])[index.toxic[number]]
    return found, shared, Calibration(votes, index.toxic[number], weights, prior), prior


def own_votes(rows: DataFrame, shared: Broadcast, place: np.ndarray, neighbours: int) -> tuple[np.ndarray, np.ndarray]:
    """(number, vote) of each example among the others, computed by the executors; examples without neighbours are left out."""
    places = rows.sparkSession.sparkContext.broadcast(place)

    def work(batches):
        for batch in batches:
            index, number = shared.value, np.searchsorted(places.value, batch.column("place").to_numpy())
            (begin, terms), (_, counts) = _lists(batch.column("terms")), _lists(batch.column("counts"))
            asked = [(terms[a:b], counts[a:b], int(n)) for a, b, n in zip(begin[:-1], begin[1:], number)]
            out = [(n, index.vote(near)) for n, near in zip(number, index.search(asked, neighbours)) if len(near[0])]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int64()), pa.array([v for _, v in out], pa.float64())],
                                             names=["number", "vote"])

    found = map_batches(rows.select("place", "terms", "counts"), work, "number long, vote double").toArrow().sort_by("number")
    return found.column("number").to_numpy(), found.column("vote").to_numpy()


def score(docs: DataFrame, labels: DataFrame, learn: Column | None = None, neighbours: int = NEIGHBOURS,
          threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, text_key, score, predicted and evidence (the three nearest examples) for each row of docs (doc_id, text)."""
    found, shared, calibration, silent = fit(
        docs, labels, F.lit(True) if learn is None else learn, neighbours=neighbours, **options)

    def work(batches):
        index = shared.value
        known: dict[bytes, tuple] = {}
        for batch in batches:
            (begin, terms), (_, counts) = _lists(batch.column("terms")), _lists(batch.column("counts"))
            keys = batch.column("text_key").to_pylist()
            if len(known) > REMEMBERED:
                known.clear()
            asked = {key: (terms[a:b], counts[a:b], -1) for key, a, b in zip(keys, begin[:-1], begin[1:]) if key not in known}
            for key, near in zip(asked, index.search(list(asked.values()), neighbours)):
                known[key] = (
                    calibration(index.vote(near)) if len(near[0]) else silent,
                    [{"doc_id": int(index.ids[n]), "cosine": float(c), "toxic": int(index.toxic[n])} for n, c in zip(near[0][:3], near[1])])
            scores, evidence = [known[key][0] for key in keys], [known[key][1] for key in keys]
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(scores, pa.float64()), pa.array(evidence, kind)],
                                             names=["doc_id", "text_key", "score", "evidence"])

    scored = map_batches(found, work, f"doc_id long, text_key binary, score double, evidence {EVIDENCE}")
    return scored.select("doc_id", "text_key", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")
