"""Helpers shared by the text and vector operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.session import shared_folder

#: Characters that separate words, everywhere in this package.
WORD = r"[^\x20\x09-\x0D]+"

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def unused(df: DataFrame, *stems: str) -> list[str]:
    """Names that df has no column of: the stems, with underscores where they are taken."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        out.append(stem)
    return out


def quoted(names: list[str]) -> list[Column]:
    """Columns by name, whatever characters that holds."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the value as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def map_batches(df: DataFrame, work: Callable[[Batches], Batches], schema: str, barrier_rows: int = 2000) -> DataFrame:
    """``work`` over Arrow batches of at most ``barrier_rows`` rows, wherever and whenever the plan runs, and 32 MB."""
    # Workers that start elsewhere find this package where the driver has it, unless it is installed or shipped.
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    # A task has one core: products on more threads only wait for each other, at the price of processor time.
    df.sparkSession.sparkContext.environment.setdefault("OPENBLAS_NUM_THREADS", "1")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))

    def limited(batches: Batches) -> Batches:
        return work(batch.slice(at, barrier_rows) for batch in batches for at in range(0, max(1, batch.num_rows), barrier_rows))

    return df.mapInArrow(limited, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder: later reads survive a lost executor."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def tokenizer_path(name: str) -> str:
    """A path as given, or the place of a file of the installed public tokenizers."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


# --- hashes over text, vectorised -------------------------------------------------

_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept per process."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
        with np.errstate(over="ignore"):
            for name, b in (("up", base), ("down", inverse)):
                steps = np.full(size, b, np.uint64)
                steps[0] = 1
                _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of codes[start:end]; equal spans have equal hashes wherever they stand."""
    up, _ = powers(len(codes) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=total[1:])
        raw = (total[ends] - total[starts]) * powers(len(codes) + 1)[1][starts]
        return mix64(raw + (ends - starts).astype(np.uint64) * _STEP)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_hashes(data: bytes) -> np.ndarray:
    """A hash for each word of a UTF-8 text, in order."""
    codes = np.frombuffer(data, np.uint8)
    if not len(codes):
        return np.empty(0, np.uint64)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = ~_IS_SPACE[codes]
    edges = np.flatnonzero(np.diff(inside))
    return span_hashes(codes, edges[::2], edges[1::2])


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of n consecutive words; a shorter text is one shingle, no words none."""
    if not len(words):
        return words
    if len(words) < n:
        n = len(words)
    with np.errstate(over="ignore"):
        out = words[: len(words) - n + 1].copy()
        for j in range(1, n):
            out = mix64(out * _STEP + np.uint64(j)) + words[j : len(words) - n + 1 + j]
    return np.unique(mix64(out + np.uint64(n)))
