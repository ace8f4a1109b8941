"""Token counts through a digest cache.

A text's digest and the tokenizer's digest form the key of a stored count. Only distinct
contents without a stored count are encoded; their counts are appended to the cache.

Defined results: a null text counts as empty (0 bytes, 0 tokens); empty tables give no
rows; repeated rows are each returned; null ids stay null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, text_or_empty, tokenizer_path

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"
#: Distinct words whose counts a Python worker remembers before it starts afresh.
REMEMBERED = 500_000


def tokenizer_digest(name: str) -> str:
    return hashlib.sha256(Path(tokenizer_path(name)).read_bytes()).hexdigest()


class PieceCounter:
    """Token counts of a SentencePiece model.

    In a model without pieces that hold a space mark after another character, no token
    spans the gap before a mark. A text with single spaces thus counts as the sum of its
    words, each encoded once by the library. Other texts are encoded whole.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces) and self._plain()
        self.known: dict[str, int] = {}

    def _plain(self) -> bool:
        """Whether the model leaves texts as they are, but for the mark put in front."""
        probe = "a  B\tc\nﬁ Å"
        return self.model.normalize(probe) == "▁" + probe.replace(" ", "▁")

    def counts(self, texts: list[str]) -> list[int]:
        split = [
            t.split(" ") if self.by_word and t and "  " not in t and "▁" not in t and t[0] != " " != t[-1] else None
            for t in texts
        ]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list({w for words in split if words for w in words if w not in known})
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            known.update(zip(part, map(len, self.model.encode(part, num_threads=1))))
        return [
            sum(map(known.__getitem__, words)) if words is not None else len(self.model.encode(text))
            for text, words in zip(texts, split)
        ]


class JsonCounter:
    """Token counts of a tokenizers file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.model.encode_batch(texts, add_special_tokens=False)]


_COUNTERS: dict[str, PieceCounter | JsonCounter] = {}


def counter(name: str) -> PieceCounter | JsonCounter:
    """The counter of a tokenizer file, kept per process."""
    if name not in _COUNTERS:
        path = tokenizer_path(name)
        _COUNTERS[name] = JsonCounter(path) if path.endswith(".json") else PieceCounter(path)
    return _COUNTERS[name]


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """One count per digest; an absent cache is empty, and a count stored twice counts once."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    return rows.where(F.col("tokenizer") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache_path: str, tokenizer: str = "piece_bpe_32k.model", limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs (doc_id, text).

    Copies are combined before the shuffle, so a content that fills a third of the table
    reaches the encoder once. ``cache_path`` is a Parquet folder that later calls share.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    keyed = docs.select("doc_id", text_or_empty().alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    contents = keyed.groupBy("digest").agg(F.first("text").alias("text"))
    misses = contents.join(read_cache(spark, cache_path, version), "digest", "left_anti")

    def encode(batches):
        for batch in batches:
            counts = counter(tokenizer).counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * len(counts), pa.string()), batch.column("digest"), pa.array(counts, pa.int64())],
                names=["tokenizer", "digest", "n_tokens"],
            )

    map_batches(misses, encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counts = read_cache(spark, cache_path, version)
    return keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")).join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
    )
