"""SentencePiece encoding and decoding as a relational lattice.

Spaces of a text become marks, one more stands in front, and the text falls into words: a
run of marks with what follows, or a line break. No piece spans two words, so each
different word is solved once: its substrings of at most the longest piece's length are
exploded and equi-joined to the piece table, the edges are grouped by word, and a Viterbi
pass, a fold over the edges by end position, finds the pieces with the largest sum of
scores; on ties the longest last piece wins. A character that is no piece is an edge of its
own, scored below every piece, and is spelled by byte pieces.

Words travel as one string per chunk of documents and bucket of words, so the shuffles
carry each chunk's different words, not every occurrence; texts travel once, compressed.

Words of more than 512 characters, for which the fold would copy long arrays, go through the
same pass as a loop where their text is assembled; their paths are the best over the whole word.

Defined results: a null or empty text has no pieces and decodes to an empty text; a mark that stands in a text itself is read as a
space, as the library does; every other text decodes to itself; repeated rows are each
encoded; null ids stay null; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, text_or_empty, tokenizer_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Longer words are solved by a loop instead of the fold.
LONGEST_WORD = 512
#: Bytes of text in a chunk of documents, which one task holds at once, and in a shuffle partition.
CHUNK_BYTES, PARTITION_BYTES, MOST_PARTITIONS = 2 << 20, 8 << 20, 20_000
#: Added to the lowest score for a character that is no piece.
UNKNOWN_SCORE = -10.0
_WORDS = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")


class Pieces:
    """The piece table of a model file."""

    def __init__(self, name: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
        self.rows, self.bytes, self.texts = [], {}, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.texts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.texts.append(b"")
            else:
                self.rows.append((piece, i, float(model.get_score(i))))
                self.texts.append(piece.replace(MARK, " ").encode())
        self.longest = max(len(p) for p, _, _ in self.rows)
        self.sizes = np.array([len(t) for t in self.texts])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.joined = np.frombuffer(b"".join(self.texts), np.uint8)
        self.known = {p: (i, s) for p, i, s in self.rows}
        self.unknown = min(s for _, _, s in self.rows) + UNKNOWN_SCORE
        spanning = [p for p, _, _ in self.rows if MARK in p.lstrip(MARK) or "\n" in p]
        if spanning or len(self.bytes) < 256:
            raise ValueError("the model needs byte pieces and none that spans two words")

    def best(self, word: str) -> list[int]:
        """What the fold gives, in time and memory that grow with the word's length."""
        scores, edges = [0.0], [(-1, 0)]
        for stop in range(1, len(word) + 1):
            most, edge = float("-inf"), None
            for start in range(max(0, stop - self.longest), stop):
                part = word[start:stop]
                found = self.known.get(part)
                if found is None and stop - start == 1:
                    found = (-1 - ord(part), self.unknown)
                if found is not None and scores[start] + found[1] > most:
                    most, edge = scores[start] + found[1], (start, found[0])
            scores.append(most)
            edges.append(edge)
        ids, at = [], len(word)
        while at:
            at, i = edges[at]
            ids.append(i)
        return self.spelled(ids[::-1])

    def spelled(self, ids: list[int]) -> list[int]:
        """Edges of unknown characters, below 0 by their code point, as byte pieces."""
        if min(ids) >= 0:
            return ids
        return [x for i in ids for x in ([i] if i >= 0 else [self.bytes[b] for b in chr(-1 - i).encode("utf-8", "surrogatepass")])]

    def decode(self, ids) -> bytes:
        """The UTF-8 text that ids stand for, without the mark in front."""
        ids = np.asarray(ids, np.int64)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ids) else 0) + np.repeat(self.starts[ids] - ends + sizes, sizes)
        return self.joined[at].tobytes()[1:]


_TABLES: dict[str, Pieces] = {}


def pieces(name: str = MODEL) -> Pieces:
    """The piece table of a file, kept per process."""
    if name not in _TABLES:
        _TABLES[name] = Pieces(name)
    return _TABLES[name]


def words(text: str) -> list[str]:
    if not text:
        return []
    return _WORDS.findall(MARK + text.replace(" ", MARK))


# --- the lattice ----------------------------------------------------------------------

def piece_table(spark: SparkSession, model: str = MODEL) -> DataFrame:
    return spark.createDataFrame(pieces(model).rows, "piece string, id int, score double")


def edges(rows: DataFrame, table: DataFrame, longest: int, unknown: float) -> DataFrame:
    """Columns of rows (word, ...) with start, stop, score, id of every piece within the word.

    The piece table has a fixed size, that of the model file, and is broadcast.
    """
    size = F.char_length("word")
    at = rows.withColumn("start", F.explode(F.sequence(F.lit(0), size - 1)))
    parts = at.withColumn("n", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), size - F.col("start")))))
    parts = parts.withColumn("piece", F.substring("word", F.col("start") + 1, F.col("n")))
    found = parts.join(F.broadcast(table), "piece", "left").where((F.col("n") == 1) | F.col("id").isNotNull())
    return found.select(
        *rows.columns, "start", (F.col("start") + F.col("n")).alias("stop"),
        F.coalesce("score", F.lit(unknown)).alias("score"), F.coalesce("id", -1 - F.ascii("piece")).alias("id"))


def best_path(lattice: Column, size: Column) -> Column:
    """Ids along the best path through edges (stop, start, score, id) sorted by stop, then start.

    The fold keeps, per position, the best score and the edge that reached it.
    """
    def step(state, edge):
        score = F.get(state, edge["start"])["score"] + edge["score"]
        better = F.coalesce(F.get(state, edge["stop"])["score"], F.lit(float("-inf"))) < score
        reached = F.struct(score.alias("score"), edge["start"].alias("start"), edge["id"].alias("id"))
        return F.when(better, F.concat(F.slice(state, 1, edge["stop"]), F.array(reached))).otherwise(state)

    begun = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("start"), F.lit(0).alias("id")))

    def back(path):
        def one(state, _):
            edge = F.get(path, state["at"])
            return F.when(state["at"] > 0, F.struct(edge["start"].alias("at"), F.concat(F.array(edge["id"]), state["ids"]).alias("ids"))).otherwise(state)

        none = F.array().cast("array<int>")
        return F.aggregate(F.sequence(F.lit(1), F.size(path) - 1), F.struct((F.size(path) - 1).alias("at"), none.alias("ids")), one)["ids"]

    return F.aggregate(lattice, begun, step, back)


def solved(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """rows (word, keys...) of different words, with ids of the best pieces."""
    known = pieces(model)
    lattice = edges(rows, piece_table(rows.sparkSession, model), known.longest, known.unknown)
    grouped = lattice.groupBy(*rows.columns).agg(F.sort_array(F.collect_list(F.struct("stop", "start", "score", "id"))).alias("edges"))
    return grouped.select(*rows.columns, best_path(F.col("edges"), F.char_length("word")).alias("ids"))


# --- documents ------------------------------------------------------------------------

def _by_bucket(split: list[list[str]], buckets: int) -> dict[int, list[str]]:
    """Different words of split texts but the longest, sorted, by bucket."""
    out: dict[int, list[str]] = {}
    for word in sorted(w for w in set().union(*split) if len(w) <= LONGEST_WORD):
        out.setdefault(zlib.crc32(word.encode("utf-8", "surrogatepass")) % buckets, []).append(word)
    return out


def _inflate(column) -> list[str]:
    read = zstandard.ZstdDecompressor()
    return [read.decompress(z).decode("utf-8", "surrogatepass") for z in column.to_pylist()]


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256 (of the text that the ids decode to) for each row of docs (doc_id, text)."""
    text = text_or_empty()
    # A chunk holds as much, and a bucket gathers as much, whatever the table holds.
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = buckets = max(1, -(-total // CHUNK_BYTES))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTITIONS, -(-total // PARTITION_BYTES)))
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", text), F.lit(chunks)).cast("int").alias("chunk"), "doc_id", text.alias("text"))

    def deflate(batches):
        write = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [write.compress(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("doc_id"), pa.array(z, pa.binary())], names=["chunk", "doc_id", "z"])

    texts = map_batches(dealt, deflate, "chunk int, doc_id long, z binary").repartition(parts, "chunk")

    def listed(key, table):
        found = _by_bucket([words(t) for t in _inflate(table.column("z"))], buckets)
        return pa.table({
            "chunk": pa.array([key[0].as_py()] * len(found), pa.int32()), "bucket": pa.array(found.keys(), pa.int32()),
            "words": pa.array([" ".join(w) for w in found.values()], pa.string())})

    lists = texts.groupBy("chunk").applyInArrow(listed, "chunk int, bucket int, words string").repartition(parts, "bucket")
    # the unused minimum keeps the column, and so the exchange, the same in both branches: it is made once
    different = lists.select("bucket", "chunk", F.explode(F.split("words", " ")).alias("word")).groupBy("bucket", "word").agg(F.min("chunk").alias("chunk"))
    answers = solved(different, model).where("chunk >= 0").select(F.col("bucket").alias("answer_bucket"), "word", "ids")

    def answered(key, left, right):
        table = pieces(model)
        known = {w: table.spelled(i) for w, i in zip(right.column("word").to_pylist(), right.column("ids").to_pylist())}
        write, out = zstandard.ZstdCompressor(level=3), []
        for line in left.column("words").to_pylist():
            found = [known[w] for w in line.split(" ")]
            sizes = np.array([len(f) for f in found], np.uint16)
            out.append(write.compress(np.array([len(found)], np.uint32).tobytes() + sizes.tobytes() + np.array([i for f in found for i in f], np.int32).tobytes()))
        return pa.table({"answer_chunk": left.column("chunk"), "bucket": left.column("bucket"), "answers": pa.array(out, pa.binary())})

    solutions = lists.groupBy("bucket").cogroup(answers.groupBy("answer_bucket")).applyInArrow(
        answered, "answer_chunk int, bucket int, answers binary")

    def assembled(key, left, right):
        table, split = pieces(model), [words(t) for t in _inflate(left.column("z"))]
        asked, read, known = _by_bucket(split, buckets), zstandard.ZstdDecompressor(), {}
        for bucket, z in zip(right.column("bucket").to_pylist(), right.column("answers").to_pylist()):
            data = read.decompress(z)
            n = int(np.frombuffer(data, np.uint32, 1)[0])
            ends = np.cumsum(np.frombuffer(data, np.uint16, n, 4)).tolist()
            ids = data[4 + 2 * n :]
            known.update((w, ids[4 * a : 4 * b]) for w, a, b in zip(asked[bucket], [0, *ends], ends))
        known.update((w, np.array(table.best(w), np.int32).tobytes()) for w in set().union(*split) if len(w) > LONGEST_WORD)
        found = [np.frombuffer(b"".join([known[w] for w in s]), np.int32) for s in split]
        digests = [hashlib.sha256(table.decode(f)).hexdigest() for f in found]
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        values = np.concatenate(found) if found else np.empty(0, np.int32)
        return pa.table({
            "doc_id": left.column("doc_id"), "n_tokens": pa.array(np.diff(offsets).astype(np.int64)),
            "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), "decoded_sha256": pa.array(digests, pa.string())})

    return texts.groupBy("chunk").cogroup(solutions.groupBy("answer_chunk")).applyInArrow(
        assembled, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, text for rows of encoded (doc_id, ids); null ids decode to null."""
    def work(batches):
        for batch in batches:
            texts = [None if i is None else pieces(model).decode(i).decode("utf-8", "surrogatepass") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), work, "doc_id long, text string", 500)
