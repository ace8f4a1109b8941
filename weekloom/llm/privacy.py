"""Personal data: patterns, and terms that give it away.

Emails, IP addresses, card and phone numbers are found by pattern. Each distinct value is a
protected entity. The corpus then tells which words disclose an entity e: for a word t
anywhere in a document that holds e, the pointwise mutual information of t and e over
documents, divided by the information of e itself, is 1 when t never occurs without e and 0
when t says nothing about it. Where it reaches ``disclosure``, and t and e meet in at least
``support`` different texts, every occurrence of t is generalised to <term> in the documents
that hold e. Words are runs of letters, compared in lower case, outside the values
themselves; texts that differ in such values only count once.

Entities in fewer texts than that, and words in so many documents that they cannot reach
``disclosure`` for any entity left, are dropped before words and entities are paired.

Defined results: null texts are empty and hold nothing; empty tables give no rows; repeated
rows are each returned; null ids stay null; other columns are left as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, stored, text_or_empty, unused

KINDS = ("email", "ip", "card", "phone")
SUPPORT, DISCLOSURE = 3, 0.9
#: Different words that a Python worker counts before it passes the counts on.
HELD_WORDS = 300_000
#: The most words that are sent to every task, about 10 MB.
SENT_WORDS = 300_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits: what follows the run decides, whatever its start.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"[^0-9]+")


def _emails(text: str) -> list[tuple[int, int]]:
    """Starts are found backwards from each @, so a long run of letters is read once."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; a match that fails its test is dropped."""
    out = [("email", *x) for x in _emails(text)] if "@" in text else []
    if "." in text:
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for start, end in (m.span() for m in _CARD.finditer(text)):
        if end - start >= 13 and 13 <= len(digits := _DIGITS.sub("", text[start:end])) <= 19 and luhn(digits):
            out.append(("card", start, end))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.sub("", m[0])) <= 15]
    return out


def entity(kind: str, value: str) -> str:
    """Spellings of one value are one entity."""
    if kind == "email":
        return "email:" + value.lower()
    return f"{kind}:{value if kind == 'ip' else _DIGITS.sub('', value)}"


def outside(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(word in lower case, start, end) of each word that overlaps no span."""
    out, taken, at, done = [], sorted(s[1:] for s in spans), 0, 0
    for m in _WORD.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            done = max(done, taken[at][1])
            at += 1
        if done <= m.start():
            out.append((m[0].lower(), m.start(), m.end()))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span replaced by <kind>; of overlapping spans the earliest, then the longest, names the whole stretch."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


# --- corpus statistics ------------------------------------------------------------------

def holders(docs: DataFrame) -> DataFrame:
    """text_key, text, context (digest of the words outside values), entities, rows: each different text that holds a value."""
    def work(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                if spans := base_spans(text):
                    context = hashlib.md5(" ".join(w for w, _, _ in outside(text, spans)).encode()).digest()
                    out.append((hashlib.md5(text.encode()).digest(), text, context, sorted({entity(k, text[a:b]) for k, a, b in spans})))
            if out:
                kinds = [pa.binary(), pa.string(), pa.binary(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["text_key", "text", "context", "entities"])

    rows = map_batches(docs.select(text_or_empty().alias("text")), work, "text_key binary, text string, context binary, entities array<string>")
    return rows.groupBy("text_key").agg(*[F.first(c).alias(c) for c in ("text", "context", "entities")], F.count(F.lit(1)).alias("rows"))


def different_words(texts: DataFrame) -> DataFrame:
    """text_key, word: the different words of each text outside values."""
    def work(batches):
        for batch in batches:
            keys, words = [], []
            for key, text in zip(batch.column("text_key").to_pylist(), batch.column("text").to_pylist()):
                found = {w for w, _, _ in outside(text, base_spans(text))}
                keys += [key] * len(found)
                words += found
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(words, pa.string())], names=["text_key", "word"])

    return map_batches(texts.select("text_key", "text"), work, "text_key binary, word string")


def places(texts: DataFrame) -> DataFrame:
    """text_key, terms: every place of the given words in each text (text_key, text, words)."""
    def work(batches):
        for batch in batches:
            out = []
            for text, words in zip(batch.column("text").to_pylist(), batch.column("words").to_pylist()):
                told = set(words)
                out.append([{"start": a, "end": b} for w, a, b in outside(text, base_spans(text)) if w in told])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), pa.array(out, kind)], names=["text_key", "terms"])

    return map_batches(texts.select("text_key", "text", "words"), work, "text_key binary, terms array<struct<start: long, end: long>>")


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: rows of docs that hold the word outside values. Counted per task before the shuffle."""
    def work(batches):
        held: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                held.update({w for w, _, _ in outside(text, spans)} if spans else {w.lower() for w in set(_WORD.findall(text))})
            if len(held) > HELD_WORDS:
                yield counted(held)
                held.clear()
        if held:
            yield counted(held)

    def counted(held):
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    rows = map_batches(docs.select(text_or_empty().alias("text")), work, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def found(docs: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """text_key, terms: all places in a text of words that give away a value that the text holds."""
    total = docs.count()
    texts = stored(holders(docs), "pii-texts")
    held = texts.select("text_key", "context", "rows", F.explode("entities").alias("entity"))
    # entities that the same texts hold count alike: they are paired with words once, as the digest of that set of texts
    known = held.groupBy("entity").agg(
        F.sum("rows").alias("of_entity"), F.countDistinct("context").alias("contexts"),
        F.bit_xor(F.xxhash64("text_key")).alias("set"), F.bit_xor(F.xxhash64(F.lit(1), "text_key")).alias("set2"))
    known = known.where((F.col("contexts") >= support) & (F.col("of_entity") < total)).drop("contexts")
    # mutual information over information reaches disclosure only with n <= of_entity * (total / of_entity) ** (1 - disclosure)
    most = F.col("of_entity") * F.pow(total / F.col("of_entity"), F.lit(1 - disclosure)) * (1 + 1e-9)
    live = stored(held.join(known.withColumn("most", most), "entity").drop("entity").distinct(), "pii-live")
    limits = live.groupBy("text_key").agg(F.max("most").alias("limit"))
    highest = live.agg(F.max("most")).first()[0] or 0.0

    counts = stored(word_counts(docs).where(F.col("n") >= support), "pii-words")
    common = counts.where(F.col("n") > highest).select("word")
    cells = different_words(texts.join(limits.select("text_key"), "text_key"))
    if common.count() <= SENT_WORDS:  # else the next join drops them
        cells = cells.join(F.broadcast(common), "word", "left_anti")
    cells = cells.join(counts.where(F.col("n") <= highest), "word").join(limits, "text_key").where("n <= limit")
    cells = stored(cells.select("text_key", "word", "n"), "pii-cells")

    both = cells.join(live, "text_key").where("n <= most")
    entities = ["set", "set2", "of_entity"]
    pairs = both.groupBy(*entities, "word").agg(
        F.sum("rows").alias("both"), F.countDistinct("context").alias("contexts"), F.first("n").alias("n"))
    information = F.log2(total / F.col("of_entity"))
    mutual = F.log2(F.col("both") * total / F.col("of_entity") / F.col("n"))
    pairs = pairs.where((F.col("contexts") >= support) & (mutual >= disclosure * information)).select(*entities, "word")
    words = both.join(pairs, [*entities, "word"]).groupBy("text_key").agg(F.collect_set("word").alias("words"))
    return places(texts.join(words, "text_key"))


def spans_of(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for each row of docs (doc_id, text)."""
    def work(batches):
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                spans = base_spans(text)
                n = Counter(s[0] for s in spans)
                base = joined(spans)
                key = hashlib.md5(text.encode()).digest()
                out.append((doc, key, *(n[k] for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), base))
            kinds = [pa.int64(), pa.binary(), *[pa.int64()] * 4, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    schema = "doc_id long, text_key binary, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string"
    names = [c.split()[0] for c in schema.split(", ")]
    base = map_batches(docs.select("doc_id", text_or_empty().alias("text")), work, schema)
    terms = F.array_join(F.transform("terms", lambda t: F.concat_ws(":", F.lit("term"), t["start"], t["end"])), ",")
    added = found(docs, **options).select("text_key", terms.alias("added"))
    return base.join(added, "text_key", "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), "added").alias("spans"))


def sanitised(docs: DataFrame, **options) -> DataFrame:
    """docs with every span of its text generalised to its kind; n_chars, if there, follows."""
    added = found(docs, **options)
    text_key, told = unused(docs, "text_key", "told")
    rows = docs.withColumn(text_key, F.unhex(F.md5(text_or_empty()))).join(added.toDF(text_key, told), text_key, "left").drop(text_key)
    kinds, names = dict(docs.dtypes), [f"c{i}" for i in range(len(docs.columns))]
    place = docs.columns.index("text")

    def work(batches):
        for batch in batches:
            texts = []
            for text, terms in zip(batch.column(place).to_pylist(), batch.column("told").to_pylist()):
                spans = base_spans(text) if text else []
                texts.append(redacted(text, spans + [("term", t["start"], t["end"]) for t in terms or []]) if text else text)
            out = [pa.array(texts, pa.string()) if i == place else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(out, names=names)

    # plain names for the way through Arrow, as columns may be called anything
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema))
    out = map_batches(rows.toDF(*names, "told"), work, schema).toDF(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(kinds["n_chars"])) if "n_chars" in kinds else out
