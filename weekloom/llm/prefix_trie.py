"""A weighted prefix trie of conversations, by collapsing whole sequences.

Conversations are ordered by turn and rebuilt: a conversation may open with the first turns
of the one that its group shares. Identical rebuilt conversations become one weighted
sequence with a list of its ends. Only one conversation of each sequence goes on: its
prefixes, weighted, are grouped to nodes. A sequence that is a proper prefix of another one
is dropped by an anti-join; those left are the leaves.

A turn is a pair of 60-bit values of its SHA-256, a sequence the pair of polynomials of its
turns modulo 2**61 - 1 with its length, so prefixes are joined and moved by arithmetic and
texts are read once. Prefix hashes, ranks and sums over subtrees run along conversations in
sorted parts (scans), so one conversation, turn or node may hold any share of the rows.

The smallest member's sequence carries a node. The nodes that a sequence carries are the
lower end of its path: what they sum up to is added to the upper ones.

Defined results: rows with a null conv_id belong to no conversation and are left out; a null
turn comes first; equal turns are ordered by the digest of role and text, so repeated rows
are turns of their own; null role and text are empty; a conversation that is rebuilt
without turns ends at the root; an empty table has no nodes, not even a root; other columns
are ignored. Turns are compared by 120 bits of their digest.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import crc_mod, map_batches, stored
from weekloom.llm.scans import carried, scanned

PRIME = (1 << 61) - 1
BASES = (1_181_783_497_276_652_981, 1_865_811_235_122_147_685)
#: conv_ids in one chunk of an end list.
CHUNK = 4096
KEY = ["depth", "k1", "k2"]


def modular(a: Column, b: Column, c: Column) -> Column:
    """(a * b + c) modulo PRIME."""
    wide = "decimal(19,0)"
    return F.pmod(a.cast(wide) * b.cast(wide) + c.cast(wide), F.lit(PRIME).cast(wide)).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest, size (code points of the text) of each row of conversations (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), digest.alias("digest"), F.char_length(text).cast("long").alias("size"))


def ranked(ordered: DataFrame) -> DataFrame:
    """conv_id, part, rank (from 0), p1, p2 (hashes of the turns up to this one), size."""
    lane = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    rows = ordered.select("conv_id", "turn", "digest", lane(1).alias("v1"), lane(16).alias("v2"), "size")

    def scan(batches):
        now, n, p1, p2, up1, up2 = None, 0, 0, 0, 1, 1
        for batch in batches:
            ranks, first, second = [], [], []
            for conv, v1, v2 in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "v1", "v2"))):
                if conv != now:
                    now, n, p1, p2, up1, up2 = conv, 0, 0, 0, 1, 1
                p1, p2 = (p1 + (v1 + 1) * up1) % PRIME, (p2 + (v2 + 1) * up2) % PRIME
                up1, up2, n = up1 * BASES[0] % PRIME, up2 * BASES[1] % PRIME, n + 1
                ranks.append(n), first.append(p1), second.append(p2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(x, pa.int64()) for x in (ranks, first, second)), batch.column("size")],
                names=["conv_id", "n", "p1", "p2", "size"])

    local = scanned(rows, ["conv_id", F.col("turn").asc_nulls_first(), "digest"], scan,
                    "conv_id long, n long, p1 long, p2 long, size long", "trie-turns")

    def follow(a, b):
        return a[0] + b[0], *((a[i] + pow(base, a[0], PRIME) * b[i]) % PRIME for i, base in ((1, BASES[0]), (2, BASES[1])))

    before = carried(local, ["conv_id"], ["n", "p1", "p2"], follow)
    scale = before.sparkSession.createDataFrame(
        [(r.part, r.conv_id, r.n, r.p1, r.p2, *(pow(b, r.n, PRIME) for b in BASES)) for r in before.collect()],
        "part int, conv_id long, n0 long, c1 long, c2 long, s1 long, s2 long")
    joined = local.join(F.broadcast(scale), ["part", "conv_id"], "left")  # one row per part at most
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return joined.select(
        "conv_id", "part", (F.coalesce("n0", zero) + F.col("n") - 1).alias("rank"),
        *(modular(F.col(f"p{i}"), F.coalesce(f"s{i}", one), F.coalesce(f"c{i}", zero)).alias(f"p{i}") for i in (1, 2)), "size")


def rebuilt(turn_rows: DataFrame, heads: int, stride: int) -> DataFrame:
    """One row per conversation: what it opens with, where its own turns go on, and the hash of the whole.

    conv_id, depth, k1, k2 (of the whole), head (the m turns it opens with: rank, p1, p2, size), base_id, m,
    h (own turns replaced), moves (factors and summands that turn the hash of an own prefix into that of the rebuilt one).
    """
    most = max(0, heads - 1)
    opening = F.sort_array(F.collect_list(F.when(F.col("rank") < most, F.struct("rank", "p1", "p2", "size"))))
    convs = turn_rows.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.max_by(F.struct("p1", "p2"), "rank").alias("all"), opening.alias("opening"))
    base = convs.where(F.col("conv_id") % stride == 0).select(F.col("conv_id").alias("base_id"), F.col("opening").alias("lent"))
    convs = convs.select("*", (F.col("conv_id") - F.col("conv_id") % stride).alias("base_id"), crc_mod("conv_id", heads).cast("int").alias("h"))
    rows = convs.join(base, "base_id", "left").withColumn("m", F.least("h", F.coalesce(F.size("lent"), F.lit(0))))
    rows = rows.withColumn("head", F.when(F.col("m") > 0, F.slice("lent", F.lit(1), F.greatest("m", F.lit(1)))))
    rows = rows.withColumn("tail", F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    zero = F.lit(0).cast("long")
    out = []
    for i, base_value in ((1, BASES[0]), (2, BASES[1])):
        inverse = pow(base_value, -1, PRIME)
        steps = F.array(*(F.lit(pow(base_value, d, PRIME) if d >= 0 else pow(inverse, -d, PRIME)).cast("long") for d in range(-most, most + 1)))
        factor = F.element_at(steps, F.col("m") - F.col("h") + most + 1)
        opened = F.when(F.col("m") > 0, F.element_at(F.col("head"), F.greatest("m", F.lit(1)))[f"p{i}"]).otherwise(zero)
        replaced = F.when((F.col("h") > 0) & (F.col("tail") > 0), F.element_at(F.col("opening"), F.greatest("h", F.lit(1)))[f"p{i}"]).otherwise(zero)
        # opened + factor * (p - replaced), as factor * p + summand
        summand = modular(factor, F.pmod(-replaced, F.lit(PRIME)), opened)
        out += [factor.alias(f"f{i}"), summand.alias(f"g{i}"), opened.alias(f"o{i}")]
    rows = rows.select("conv_id", "base_id", "head", "m", "h", "tail", "all", *out)
    whole = [F.when(F.col("tail") > 0, modular(F.col(f"all.p{i}"), F.col(f"f{i}"), F.col(f"g{i}"))).otherwise(F.col(f"o{i}")).alias(f"k{i}") for i in (1, 2)]
    return rows.select("conv_id", (F.col("m") + F.col("tail")).alias("depth"), *whole, "base_id", "head", "m", "h", "f1", "f2", "g1", "g2")


def paths(turn_rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Every prefix of the chosen conversations: conv_id, weight, key, inner (a proper prefix), size and place of its last turn."""
    whole = F.col("depth").alias("whole")
    root = chosen.select("conv_id", "weight", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), whole,
                         F.lit(0).cast("long").alias("size"), F.lit(None).cast("long").alias("turn_conv_id"), F.lit(None).cast("long").alias("turn_rank"))
    heads = chosen.select("conv_id", "weight", whole, "base_id", F.explode("head").alias("t")).select(
        "conv_id", "weight", (F.col("t.rank") + 1).alias("depth"), F.col("t.p1").alias("k1"), F.col("t.p2").alias("k2"), "whole", F.col("t.size").alias("size"),
        F.col("base_id").alias("turn_conv_id"), F.col("t.rank").alias("turn_rank"))
    # A long conversation lies in many parts: it meets its own row once in each.
    places = turn_rows.select("conv_id", "part").distinct().join(chosen.select("conv_id", "weight", whole, "m", "h", "f1", "f2", "g1", "g2"), "conv_id")
    tails = turn_rows.join(places, ["conv_id", "part"]).where("rank >= h").select(
        "conv_id", "weight", (F.col("rank") - F.col("h") + F.col("m") + 1).alias("depth"),
        *(modular(F.col(f"p{i}"), F.col(f"f{i}"), F.col(f"g{i}")).alias(f"k{i}") for i in (1, 2)), "whole", "size",
        F.col("conv_id").alias("turn_conv_id"), F.col("rank").alias("turn_rank"))
    rows = root.unionByName(heads).unionByName(tails)
    return rows.withColumn("inner", F.col("depth") < F.col("whole")).drop("whole")


def sums_below(rows: DataFrame) -> DataFrame:
    """key, saved_tokens, n_leaves: each row's own values and those of all deeper rows of its path, summed by node."""
    def scan(batches):
        now, saved, leaves = None, 0, 0
        for batch in batches:
            first, second = [], []
            for conv, own, leaf in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "saved", "leaf"))):
                if conv != now:
                    now, saved, leaves = conv, 0, 0
                saved, leaves = saved + own, leaves + leaf
                first.append(saved), second.append(leaves)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", *KEY)), pa.array(first, pa.int64()), pa.array(second, pa.int64())],
                names=["conv_id", *KEY, "saved", "leaves"])

    local = scanned(rows.select("conv_id", *KEY, "saved", "leaf"), ["conv_id", F.desc("depth")], scan,
                    "conv_id long, depth long, k1 long, k2 long, saved long, leaves long", "trie-sums")
    before = carried(local, ["conv_id"], ["saved", "leaves"], lambda a, b: (a[0] + b[0], a[1] + b[1]))
    before = before.withColumnsRenamed({"saved": "saved0", "leaves": "leaves0"})
    full = local.join(F.broadcast(before), ["part", "conv_id"], "left")  # one row per part at most
    zero = F.lit(0)
    return full.groupBy(*KEY).agg(
        F.sum(F.col("saved") + F.coalesce("saved0", zero)).alias("saved_tokens"), F.sum(F.col("leaves") + F.coalesce("leaves0", zero)).alias("n_leaves"))


def looked_up(nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """conv_id, parent_conv_id for asked (conv_id, key of the parent), along the sorted keys: a parent may have any number of children."""
    rows = nodes.select(*KEY, F.lit(0).alias("kind"), "conv_id").unionByName(asked.select(*KEY, F.lit(1).alias("kind"), "conv_id"))

    def scan(batches):
        known = None
        for batch in batches:
            out = []
            for kind, conv in zip(batch.column("kind").to_pylist(), batch.column("conv_id").to_pylist()):
                known = conv if kind == 0 else known
                out.append(known)
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("conv_id"), pa.array(out, pa.int64())], names=["kind", "conv_id", "parent"])

    local = scanned(rows, [*KEY, "kind", "conv_id"], scan, "kind int, conv_id long, parent long", "trie-parents")
    # Children whose node stands in an earlier part: the last node before their part.
    before = carried(local.withColumn("one", F.lit(1)), ["one"], ["parent"], lambda a, b: (b[0] if b[0] is not None else a[0],))
    full = local.where("kind = 1").join(F.broadcast(before.select("part", F.col("parent").alias("earlier"))), "part", "left")
    return full.select("conv_id", F.coalesce("parent", "earlier").alias("parent_conv_id"))


def end_lists(convs: DataFrame) -> DataFrame:
    """The conversations that end at each node, ascending, in chunks: key, first_id, ids array<long>."""
    order = [*KEY, "conv_id"]
    parts = 2 * int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = convs.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def work(batches):
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in KEY))
            out = []
            for key, group in groupby(zip(keys, batch.column("conv_id").to_pylist()), lambda x: x[0]):
                ids = [i for _, i in group]
                out += [(*key, ids[at], ids[at : at + CHUNK]) for at in range(0, len(ids), CHUNK)]
            if out:
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[*KEY, "first_id", "ids"])

    return map_batches(rows, work, "depth long, k1 long, k2 long, first_id long, ids array<long>", 10_000)


def end_digests(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: SHA-256 of each end list as text, streamed chunk by chunk."""
    rows = ends.repartition(*KEY).sortWithinPartitions(*KEY, "first_id")

    def work(batches):
        now, digest = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if key != now:
                    out += [(*now, digest.hexdigest())] if now else []
                    now, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(map(str, ids)).encode())
            yield rows_of(out)
        if now:
            yield rows_of([(*now, digest.hexdigest())])

    def rows_of(out):
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])], names=[*KEY, "ends_sha256"])

    return map_batches(rows, work, "depth long, k1 long, k2 long, ends_sha256 string", 500)


def trie(conversations: DataFrame, heads: int = 1, stride: int = 100) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of conversations (conv_id, turn, role, text).

    A conversation opens with the first crc32(conv_id as text) mod ``heads`` turns of the conversation
    conv_id - conv_id mod ``stride`` in place of its own first ones; with heads = 1 it stays as it is.

    nodes: key (depth, k1, k2), conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, and
    turn_conv_id, turn_rank: which original turn is the node's last one. ends: end_lists().
    """
    turn_rows = ranked(turns(conversations))
    convs = stored(rebuilt(turn_rows, heads, stride), "trie-convs")
    sequences = stored(convs.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight")), "trie-sequences")
    prefixes = stored(paths(turn_rows, convs.join(sequences.select("conv_id", "weight"), "conv_id")), "trie-paths")
    proper = prefixes.where("inner").select(*KEY).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").select(*KEY, F.lit(1).alias("leaf"))
    first = F.min(F.struct("conv_id", "turn_conv_id", "turn_rank", "size")).alias("first")
    nodes = prefixes.groupBy(*KEY).agg(F.sum("weight").alias("n_convs"), first).select(*KEY, "n_convs", "first.*")
    saved = ((F.col("n_convs") - 1) * F.col("size")).alias("saved")
    nodes = stored(nodes.join(leaves, KEY, "left").select(*KEY, "conv_id", "n_convs", "turn_conv_id", "turn_rank", saved,
                                                          F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf")), "trie-nodes")
    own = prefixes.join(nodes.select("conv_id", "depth", "saved", "leaf"), ["conv_id", "depth"], "left")
    below = sums_below(own.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("saved", "leaf")}))
    # The topmost node that a sequence carries hangs on a node of another one.
    tops = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"))
    hung = stored(prefixes.join(tops.select("conv_id", (F.col("top") - 1).alias("depth")), ["conv_id", "depth"]).select("conv_id", *KEY), "trie-tops")
    parents = looked_up(nodes, hung).join(tops, "conv_id").select("conv_id", F.col("top").alias("depth"), "parent_conv_id")
    others = hung.groupBy(*KEY).agg(F.count(F.lit(1)).alias("others"))
    lowest = nodes.groupBy("conv_id").agg(F.max("depth").alias("depth")).withColumn("ends", F.lit(True))
    full = nodes.join(below, KEY).join(others, KEY, "left").join(parents, ["conv_id", "depth"], "left").join(lowest, ["conv_id", "depth"], "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    children = F.coalesce("others", F.lit(0)) + F.when(F.col("ends"), 0).otherwise(1)
    out = full.select(*KEY, "conv_id", parent.alias("parent_conv_id"), "n_convs", children.cast("long").alias("n_children"), "n_leaves", "saved_tokens",
                      "turn_conv_id", "turn_rank")
    return out, stored(end_lists(convs), "trie-ends")
