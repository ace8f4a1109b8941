"""Token ids in a file format with random access.

Directly addressable codes: an id is split into chunks of 8 bits. Level 0 holds the lowest
chunk of every id, level 1 the next chunk of those ids that have one, and so on. A bitmap
per level marks the ids that go on, a rank directory counts its set bits before every block
of 512, so any id is found with one rank per level, without decoding others.

A file set is a Parquet folder, one row per segment of whole documents; segments follow
each other by (part, segment), documents by doc_id. Defined results: null texts are empty
and hold the end id alone; null ids come first; repeated rows are each stored, ties in text
order; empty tables give an empty file set; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, text_or_empty, tokenizer_path

BLOCK = 512
#: Ids after which a segment is closed; a longer document makes a longer segment.
SEGMENT_IDS = 1 << 20
#: Distinct words whose ids a Python worker remembers before it starts afresh.
REMEMBERED = 500_000
#: Marks that may follow the letters of a word; none starts a unit together with letters.
MARKS = ".,;:!?*#$%&)(|\"-"
#: Byte-level models show each byte as one character: visible ones as they are, others from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = dict(zip([b for b in range(256) if b not in _SHOWN], range(256, 512)))
LEVELS = "array<struct<codes: binary, more: binary, ranks: binary>>"
FILE_SCHEMA = f"part int, segment int, n_tokens long, doc_ids array<long>, lengths array<long>, levels {LEVELS}"


# --- the codes ------------------------------------------------------------------------

def pack(ids: np.ndarray) -> list[dict[str, bytes]]:
    """Levels of an array of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint32) if len(more) else np.empty(0, np.uint32)
        ranks = np.concatenate([np.zeros(1, np.uint32), np.cumsum(counts, dtype=np.uint32)])
        levels.append({"codes": (rest & 255).astype(np.uint8).tobytes(), "more": bits.tobytes(), "ranks": ranks.tobytes()})
        if not more.any():
            return levels
        rest = rest[more] >> 8


class Codes:
    """Reads packed levels."""

    def __init__(self, levels: list[dict[str, bytes]]):
        self.levels = [
            (np.frombuffer(x["codes"], np.uint8), np.frombuffer(x["more"], np.uint8), np.frombuffer(x["ranks"], np.uint32))
            for x in levels
        ]

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def rank(self, level: int, at: int) -> int:
        """Ids of the level before ``at`` that have a next chunk."""
        _, more, ranks = self.levels[level]
        block = at // BLOCK
        first, last = block * BLOCK // 8, at // 8
        count = int(ranks[block]) + int(np.bitwise_count(more[first:last]).sum())
        return count + (int(more[last]) & ((1 << at % 8) - 1)).bit_count() if at % 8 else count

    def __getitem__(self, at: int) -> int:
        if not 0 <= at < len(self):
            raise IndexError(at)
        value, shift = 0, 0
        for level, (codes, more, _) in enumerate(self.levels):
            value |= int(codes[at]) << shift
            if not int(more[at // 8]) >> at % 8 & 1:
                return value
            at, shift = self.rank(level, at), shift + 8
        raise ValueError("a chunk is missing")

    def slice(self, start: int, end: int) -> np.ndarray:
        """ids[start:end], read from their places alone."""
        out, places, shift = np.zeros(max(0, end - start), np.uint32), None, 0
        for level, (codes, more, _) in enumerate(self.levels):
            if start >= end:
                break
            chunk = codes[start:end].astype(np.uint32) << np.uint32(shift)
            if places is None:
                out |= chunk
                places = np.arange(end - start)
            else:
                out[places] |= chunk
            first = start // 8 * 8
            on = np.unpackbits(more[first // 8 : (end + 7) // 8], bitorder="little")[start - first : end - first].astype(bool)
            places = places[on]
            start = self.rank(level, start)
            end, shift = start + int(on.sum()), shift + 8
        return out


# --- encoding -------------------------------------------------------------------------

class WordEncoder:
    """Ids of whole texts from a byte-level tokenizers file.

    Its splitting pattern always starts a new unit at a space before a visible character,
    and between letters and following marks, so a text may be cut there; each distinct
    part is encoded once by the library. Texts with an added token's string, and models of
    another kind, are encoded whole. Parts are remembered without their leading space.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        probe = "ab cd,  ef\n gh é?! \n ij 12 l'an <"
        self.by_word = self.model.normalizer is None and self._by_parts(re.split(r" (?=\S)", probe)) == self._whole(probe)

    def _whole(self, text: str) -> bytes:
        return array("I", self.model.encode(text, add_special_tokens=False).ids).tobytes()

    def _by_parts(self, parts: list[str]) -> bytes:
        self._learn(set(parts[1:]))
        return (self._whole(parts[0]) if parts[0] else b"") + b"".join([self.known[w] for w in parts[1:]])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split: list[list[str] | None] = []
        for text in texts:
            if not self.by_word or any(a in text for a in self.added):
                split.append(None)
            elif re.search(r" (?:\s|$)", text):
                split.append(re.split(r" (?=\S)", text))
            else:
                split.append(text.split(" "))
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        self._learn({w for parts in split if parts for w in parts[1:]})
        return [np.frombuffer(self._by_parts_known(p) if p else self._whole(t), np.uint32) for t, p in zip(texts, split)]

    def _by_parts_known(self, parts: list[str]) -> bytes:
        known = self.known
        return (self._whole(parts[0]) if parts[0] else b"") + b"".join([known[w] for w in parts[1:]])

    def _learn(self, words: set[str]) -> None:
        known, older, marks = self.known, self.older, self.marks
        for word in words:
            if word in known:
                continue
            if word in older:
                known[word] = older[word]
                continue
            letters = word if word.isalpha() else word.rstrip(MARKS)
            if not letters.isalpha():
                known[word] = self._whole(" " + word)
                continue
            found = known.get(letters) or older.get(letters)
            if found is None:
                unit = "Ġ" + (letters if letters.isascii() else letters.encode().decode("latin-1").translate(BYTE_CHARS))
                found = array("I", [t.id for t in self.model.model.tokenize(unit)]).tobytes()
            known[letters] = found
            if len(letters) < len(word):
                rest = word[len(letters):]
                if rest not in marks:
                    marks[rest] = self._whole(rest)
                known[word] = found + marks[rest]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(name: str) -> WordEncoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = WordEncoder(tokenizer_path(name))
    return _ENCODERS[name]


# --- files ----------------------------------------------------------------------------

def write_tokens(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0) -> None:
    """Encode docs (doc_id, text) and store them in ascending doc_id order."""
    ordered = docs.select("doc_id", text_or_empty().alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches):
        part, segment = TaskContext.get().partitionId(), 0
        ids, doc_ids, held = [], [], 0

        def close():
            row = [part, segment, held, doc_ids, [len(x) for x in ids], pack(np.concatenate(ids))]
            names = [f.split()[0] for f in FILE_SCHEMA.split(", ", 5)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.list_(pa.struct([("codes", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())]))]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

        end = np.array([end_id], np.uint32)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for name, found in zip(names, encoder(tokenizer).encode(batch.column("text").to_pylist())):
                ids.append(np.concatenate([found, end]))
                doc_ids.append(name)
                held += len(ids[-1])
                if held >= SEGMENT_IDS:
                    yield close()
                    segment, ids, doc_ids, held = segment + 1, [], [], 0
        if ids:
            yield close()

    map_batches(ordered, encode, FILE_SCHEMA, 500).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def segment_starts(files: DataFrame) -> DataFrame:
    """part, segment, base: ids stored before each segment. One window row per part, then one window per part."""
    sizes = files.select("part", "segment", "n_tokens")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("all")).select(
        "part", F.coalesce(F.sum("all").over(before.orderBy("part")), F.lit(0)).alias("part_base"))
    inner = F.coalesce(F.sum("n_tokens").over(before.partitionBy("part").orderBy("segment")), F.lit(0))
    return sizes.withColumn("inner", inner).join(parts, "part").select(
        "part", "segment", (F.col("part_base") + F.col("inner")).alias("base"))


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each stored document, read from the files."""
    files = read_tokens(spark, path)

    def digest(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes, at = Codes(row["levels"]), 0
                starts, crcs = [], []
                for n in row["lengths"]:
                    starts.append(at)
                    crcs.append(zlib.crc32(codes.slice(at, at + n).astype("<u4").tobytes()))
                    at += n
                count = len(starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * count, pa.int32()), pa.array([row["segment"]] * count, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()),
                    pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64()),
                ], names=["part", "segment", "doc_id", "inner", "n_tokens", "ids_crc32"])

    rows = map_batches(files, digest, "part int, segment int, doc_id long, inner long, n_tokens long, ids_crc32 long", 4)
    return rows.join(segment_starts(files), ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
