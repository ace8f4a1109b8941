"""Mixing sources to target weights, with DataFrame functions only.

Each source's documents, laid end to end, are packed into blocks of a fixed number of
words. The counts of slots per output shard and source are a multinomial draw, conditional
on each source's total number of slots so that the totals meet the targets; shards hold
about, not exactly, a stated number of slots. Slots of a source, numbered through the
shards, are mapped through that source's pseudorandom index permutation and joined to
blocks by index. A source with more slots than blocks starts another round; its last slot
is cut to the words that are left.

Defined results: null or wordless texts have size 0 and nothing taken; a null source is a
source of its own, ordered last; a table without words has targets of 0; repeated rows are
documents of their own; documents of a source with equal ids follow in order of size, then
of a digest of all their columns. Every
draw depends on stated seeds and row contents alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.common import WORD, quoted, stored, text_or_empty, unused

BLOCK_WORDS = 1024
SHARD_SLOTS = 4096
#: Weights of the sources in order, repeated; the share of all words; the most rounds of a source.
WEIGHTS, SHARE, ROUNDS = (5, 2, 1), 1.5, 2
#: Groups of documents by id within a source, so that a large source is numbered by many tasks.
CHUNKS = 1024
#: Multipliers of the index permutations: primes, of which one divides no given number of blocks below their product.
PRIMES = (104729, 224737, 350377, 479909, 611953, 746773, 882377, 1020379)
SEED = 20240229


def row_key(docs: DataFrame) -> Column:
    """A digest of all columns: rows that share it are equal."""
    return F.unhex(F.md5(F.to_json(F.struct(*quoted(docs.columns)))))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words), row_key per row."""
    return docs.select("doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"), row_key(docs).alias("row_key"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = ROUNDS) -> DataFrame:
    """source, source_no, source_size, target: one row per source.

    Water-filling in closed form: in ascending order of size per weight, a source is full
    while giving all later ones the same share per weight needs more than is left.
    """
    listed = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    later = filling.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = totals.withColumn("source_no", F.row_number().over(listed).cast("long") - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = numbered.withColumns({"weight": weight, "cap": F.col("source_size") * most}).withColumns({
        "all": F.sum("source_size").over(whole) * F.lit(share),
        "filled": F.coalesce(F.sum("cap").over(earlier), F.lit(0)), "open": F.sum("weight").over(later),
    }).withColumn("level", (F.col("all") - F.col("filled")) / F.col("open"))
    full = F.col("cap") <= F.col("level") * F.col("weight")
    level = F.coalesce(F.max(F.when(~full, F.col("level"))).over(whole), F.lit(0.0))
    return rows.withColumn("target", F.when(full, F.col("cap").cast("double")).otherwise(level * F.col("weight"))).select(
        "source", "source_no", "source_size", "target")


def packed(sizes: DataFrame) -> DataFrame:
    """Each row's place in its source: adds chunk, row_no and offset, in order of (chunk, doc_id, size, row_key).

    Chunks are summed first, so no task numbers more than one chunk of a source.
    """
    rows = sizes.withColumn("chunk", F.coalesce(F.pmod("doc_id", F.lit(CHUNKS)), F.lit(CHUNKS)))
    inner = Window.partitionBy("source", "chunk").orderBy("doc_id", "size", "row_key").rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("source", "chunk").agg(F.sum("size").alias("n")).select(
        F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("base"))
    placed = rows.withColumns({"row_no": F.row_number().over(inner), "inner": F.sum("size").over(inner) - F.col("size")})
    return placed.join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c"))).select(
        "doc_id", "source", "size", "row_key", "chunk", "row_no", (F.col("base") + F.col("inner")).alias("offset"))


def multiplier(n_blocks: Column, source_no: Column) -> Column:
    """A prime that does not divide the number of blocks, chosen by source."""
    fit = F.filter(F.array(*[F.lit(p).cast("long") for p in PRIMES]), lambda p: n_blocks % p != 0)
    return F.element_at(fit, (source_no % F.size(fit) + 1).cast("int"))


def plan(goals: DataFrame, block_words: int) -> DataFrame:
    """Per source: blocks, permutation (position = (a * block + b) mod n) and slots that reach the target."""
    n, size = F.col("n_blocks"), F.col("source_size")
    rows = goals.where(size > 0).withColumn("n_blocks", F.ceil(size / block_words).cast("long"))
    rows = rows.withColumns({"a": multiplier(n, F.col("source_no")), "b": (F.col("source_no") + 1) * SEED % n,
                             "words": F.round("target").cast("long")})
    rows = rows.withColumns({"short": size - (n - 1) * block_words, "short_at": (F.col("a") * (n - 1) + F.col("b")) % n,
                             "rest": F.col("words") % size})
    before = F.col("short_at") * block_words
    part = F.when(F.col("rest") <= before, F.ceil(F.col("rest") / block_words)).otherwise(
        F.col("short_at") + 1 + F.ceil(F.greatest(F.col("rest") - before - F.col("short"), F.lit(0)) / block_words))
    return rows.withColumn("slots", F.floor(F.col("words") / size) * n + part.cast("long"))


def drawn(plans: DataFrame, shard_slots: int) -> DataFrame:
    """shard, source_no, lo, hi: which slots of each source a shard holds.

    Every slot draws its shard with equal chances, so a source's counts over the shards are
    multinomial with its number of slots as total. Slots of a large source are spread by
    ranges of 65,536 before they are listed.
    """
    wide = 1 << 16
    rows = plans.where("slots > 0").withColumn(
        "shards", F.ceil(F.sum("slots").over(Window.partitionBy()) / shard_slots).cast("long"))
    ranges = rows.select("source_no", "shards", "slots", F.explode(F.sequence(F.lit(0), ((F.col("slots") - 1) / wide).cast("long"))).alias("r"))
    last = F.least(F.col("slots"), (F.col("r") + 1) * wide) - 1
    slots = ranges.repartition("source_no", "r").select("source_no", "shards", F.explode(F.sequence(F.col("r") * wide, last)).alias("i"))
    shard = F.pmod(F.xxhash64(F.lit(SEED), "source_no", "i"), F.col("shards"))
    counts = slots.select("source_no", shard.alias("shard")).groupBy("shard", "source_no").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("hi", F.sum("n").over(upto)).select(
        "shard", "source_no", (F.col("hi") - F.col("n")).alias("lo"), "hi")


def takes(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, weights: tuple[int, ...] = WEIGHTS,
          share: float = SHARE, most: int = ROUNDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as (packed rows, goals, pieces).

    A piece is what one slot takes of one document: source_no, chunk, row_no, shard, slot,
    first (its first word in the document) and n (its words).
    """
    rows = stored(sized(docs), "mix-sizes")
    goals = targets(rows, weights, share, most)
    plans = stored(plan(goals, block_words), "mix-plan")
    slots = drawn(plans, shard_slots).select("shard", "source_no", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("slot"))
    known = plans.select("source_no", "source", "n_blocks", "a", "b", "short", "short_at", "source_size", "words")
    full = F.col("round") * F.col("source_size")
    begun = full + F.col("place") * block_words - F.when(F.col("place") > F.col("short_at"), block_words - F.col("short")).otherwise(0)
    slots = slots.join(known.drop("source"), "source_no").withColumns({
        "round": F.floor(F.col("slot") / F.col("n_blocks")), "place": F.col("slot") % F.col("n_blocks"),
    }).select("source_no", "place", "shard", "slot", F.least(F.col("words") - begun, F.lit(block_words)).alias("take"))

    placed = packed(rows).withColumnRenamed("source", "s")
    placed = placed.join(known, F.col("s").eqNullSafe(F.col("source"))).where("size > 0")
    block = (F.col("offset") / block_words).cast("long")
    until = ((F.col("offset") + F.col("size") - 1) / block_words).cast("long")
    parts = placed.select("source_no", "chunk", "row_no", "size", "offset", "n_blocks", "a", "b",
                          F.explode(F.sequence(block, until)).alias("block"))
    parts = parts.withColumns({"place": (F.col("a") * F.col("block") + F.col("b")) % F.col("n_blocks"),
                               "start": F.greatest(F.col("offset") - F.col("block") * block_words, F.lit(0)),
                               "first": F.greatest(F.col("block") * block_words - F.col("offset"), F.lit(0))})
    parts = parts.withColumn("here", F.least(block_words - F.col("start"), F.col("size") - F.col("first")))
    pieces = parts.join(slots, ["source_no", "place"]).withColumn("n", F.least(F.col("take") - F.col("start"), F.col("here")))
    return rows, goals, pieces.where("n > 0").select("source_no", "chunk", "row_no", "shard", "slot", "first", "n")


def taken(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row of docs (doc_id, text, source)."""
    rows, goals, pieces = takes(docs, **options)
    sums = pieces.groupBy("source_no", "chunk", "row_no").agg(F.sum("n").alias("taken"))
    placed = packed(rows).withColumnRenamed("source", "s")
    known = placed.join(goals, F.col("s").eqNullSafe(F.col("source")))
    return known.join(sums, ["source_no", "chunk", "row_no"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row per piece with docs' columns; text holds the piece's words with the white space after each.

    Rows equal in all columns count as copies of one.
    """
    rows, goals, pieces = takes(docs, **options)
    placed = packed(rows).withColumnRenamed("source", "s").join(goals, F.col("s").eqNullSafe(F.col("source")))
    row, cuts, words, cut = unused(docs, "row", "cuts", "words", "cut")
    taken = placed.join(pieces, ["source_no", "chunk", "row_no"]).groupBy(F.col("row_key").alias(row)).agg(
        F.sort_array(F.collect_list(F.struct("shard", "slot", "first", "n"))).alias(cuts))
    full = docs.withColumn(row, row_key(docs)).groupBy(row).agg(*[F.first(c).alias(n) for c, n in zip(quoted(docs.columns), docs.columns)])
    split = F.regexp_extract_all(F.col("text"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    out = full.join(taken, row).withColumn(words, split).withColumn(cut, F.explode(cuts))
    text = F.array_join(F.slice(words, (F.col(cut)["first"] + 1).cast("int"), F.col(cut)["n"].cast("int")), "")
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*quoted(docs.columns))
