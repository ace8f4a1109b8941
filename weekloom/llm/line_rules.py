"""Quality rules, line first.

Each line of a text is tried by rules on punctuation, navigation and boilerplate; lines that
fail are removed. A document is then rejected if its words fail the document rules, or if
the removed lines held more than a set share of its text. All rules look at one text alone,
so copies of a text get one verdict and no row is shuffled.

Line rules, the first that holds names the fault; words are runs of non-space characters:

- navigation: at least three separators (``| » · • >``), one per four words at least;
- punctuation: at least four marks (``! ? # * $ % & < > | ~ ^ _ = + \\``), one per word at least;
  or fewer than four words without a sign that ends a sentence, a quotation or a bracket;
- boilerplate: a phrase of legal notes, menus and scripts, or a line equal to an earlier one.

Defined results: a null or empty text, or one of spaces, has no words, fails the document
rules and keeps an empty text; lines without a word are neither judged nor counted as lost,
and stay; very long texts are read whole, words hashed in stretches; repeated rows are judged
each; null ids stay null; empty tables give no rows; other columns are ignored. Words are
compared by 64-bit hashes within one text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, mix64, text_or_empty, word_hashes

#: Share of a text's word characters that may be lost with its lines.
MOST_LOST = 0.5
FEWEST_WORDS, MOST_REPEATED = 50, 50

SPACES = " \t\n\v\f\r"
SEPARATORS = r"[|»·•>]"
MARKS = r"[!?#*$%&<>|~^_=+\\]"
SENTENCE_END = r"[.!?…:;\"'”’»)\]。！？][\x20\x09-\x0D]*$"
BOILERPLATE = (
    r"(?i)all rights reserved|copyright|terms of (use|service)|privacy policy|cookie|javascript|subscribe|sign (in|up)"
    r"|log ?in\b|click here|powered by|lorem ipsum|licensed under|released under the|©"
)

_WORD, _SEPARATOR, _MARK = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(SEPARATORS), re.compile(MARKS)
_END, _PHRASE = re.compile(SENTENCE_END), re.compile(BOILERPLATE)
_SPACE_BYTE, _SYMBOL_BYTE = (np.isin(np.arange(256), list(x)) for x in (SPACES.encode(), b"#*$%&|<>"))
_STRETCH = 1 << 20


def fault(line: str, words: list[str], earlier: bool) -> str | None:
    """The rule that a line with these words fails, if any."""
    separators = len(_SEPARATOR.findall(line))
    if separators >= 3 and 4 * separators >= len(words):
        return "navigation"
    marks = len(_MARK.findall(line))
    if marks >= 4 and marks >= len(words) or len(words) < 4 and not _END.search(line):
        return "punctuation"
    return "boilerplate" if earlier or _PHRASE.search(line) else None


def hashed_words(data: bytes) -> np.ndarray:
    """A hash for each word, computed in stretches that end at a space."""
    parts, start = [], 0
    while start < len(data):
        end = start + _STRETCH
        found = re.compile(rb"[\x20\x09-\x0D]").search(data, end) if end < len(data) else None
        end = found.start() if found else len(data)
        parts.append(word_hashes(data[start:end]))
        start = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def repeated_words(words: np.ndarray) -> int:
    """Words inside a window of three that occurs at least twice."""
    if len(words) < 4:
        return 0
    with np.errstate(over="ignore"):
        windows = mix64(mix64(words[:-2] + np.uint64(1)) + words[1:-1]) + words[2:]
    _, which, n = np.unique(windows, return_inverse=True, return_counts=True)
    twice = n[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : len(words) - 2 + shift] |= twice
    return int(covered.sum())


def judged(text: str) -> tuple[int, int, int, int, int, int, str, list[str]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars, kept text, faults of its lines."""
    data = text.encode()
    codes = np.frombuffer(data, np.uint8)
    words = hashed_words(data)
    word_chars = int(((codes & 0xC0 != 0x80) & ~_SPACE_BYTE[codes]).sum())
    seen: set[str] = set()
    kept, faults, duplicates, lost = [], [], 0, 0
    for line in text.split("\n"):
        own = _WORD.findall(line)
        failed = None
        if own:
            earlier = line in seen
            duplicates += earlier
            seen.add(line)
            failed = fault(line, own, earlier)
        if failed:
            faults.append(failed)
            lost += sum(map(len, own))
        else:
            kept.append(line)
    symbols = int(_SYMBOL_BYTE[codes].sum())
    return len(words), word_chars, symbols, duplicates, repeated_words(words), lost, "\n".join(kept), faults


def cleaned(docs: DataFrame, most_lost: float = MOST_LOST) -> DataFrame:
    """What the rules make of each row of docs (doc_id, text).

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars, clean_text,
    faults (of the removed lines, in order), base_failed, kept.
    """
    kinds = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.string())]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "clean_text", "faults"]

    def work(batches):
        for batch in batches:
            rows = list(zip(*map(judged, batch.column("text").to_pylist()))) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, rows, kinds)], names=["doc_id", *names])

    found = map_batches(
        docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")), work,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lost_chars long, "
        "clean_text string, faults array<string>", 1000)
    base_failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    enough_left = F.col("lost_chars") <= most_lost * F.col("word_chars")
    return found.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & enough_left)
