"""The prefix trie against a plain one, and the cases its docstring states."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from weekloom.llm import prefix_trie, scans

SCHEMA = "conv_id long, turn int, role string, text string"


def plain(rows, heads=1, stride=100):
    """(conv_id, depth) -> parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends, by walking all prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv, mine in turns.items():
        h = zlib.crc32(str(conv).encode()) % heads
        first = turns.get(conv - int(abs(conv) % stride * (1 if conv > 0 else -1)), [])[:h]
        whole = tuple(first + mine[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(conv)
        ends[whole].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:d]] += node not in children
    return {
        (min(c), len(n)): (min(members[n[:-1]]) if n else None, len(c), len(children.get(n, [])), leaves[n], saved[n], sorted(ends.get(n, [])))
        for n, c in members.items()
    }


def built(spark, rows, extra=(), **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in extra:
        frame = frame.withColumn(name, F.lit("extra"))
    nodes, ends = prefix_trie.trie(frame, **options)
    lists = defaultdict(list)
    for r in ends.orderBy("first_id").collect():
        lists[r.depth, r.k1, r.k2] += r.ids
    digests = {(r.depth, r.k1, r.k2): r.ends_sha256 for r in prefix_trie.end_digests(ends).collect()}
    assert digests == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in lists.items()}
    found = nodes.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, lists.get((r.depth, r.k1, r.k2), [])) for r in found}
    assert len(out) == len(found)
    return out


def random_rows(seed, n, words=6):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-150, 450), n):
        for turn in range(draw.randint(1, 9)):
            rows.append((conv, turn if draw.random() < 0.95 else None, draw.choice(["user", "bot", None]), draw.choice(["a", "b🙂", None, "long text"][:words])))
    draw.shuffle(rows)
    return rows


def test_trie_equals_a_plain_one(spark):
    rows = random_rows(1, 160, 2)
    assert built(spark, rows, heads=6) == plain(rows, 6)


def test_hot_turn_conversation_and_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c, t, "user", x) for c in range(300) for t, x in enumerate(["hello", f"t{c % 3}"][: 1 + c % 2])]
    rows += [(1000, t, "user", f"turn {t % 11}") for t in range(3000)]
    rows += [(2000 + c, 0, "user", f"alone {c}") for c in range(200)]
    assert built(spark, rows, heads=6) == plain(rows, 6)


def test_turns_of_nodes_are_named(spark):
    rows = [(100, 0, "user", "shared"), (100, 1, "bot", "x"), (101, 0, "user", "own"), (101, 1, "bot", "y")]
    nodes, _ = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), heads=2)
    named = {(r.conv_id, r.depth): (r.turn_conv_id, r.turn_rank) for r in nodes.collect()}
    borrowed = zlib.crc32(b"101") % 2
    assert named[100, 0] == (None, None) and named[100, 1] == (100, 0) and named[100, 2] == (100, 1)
    assert named[101, 2] == (101, 1) and ((101, 1) in named) == (not borrowed)


def test_awkward_and_empty_tables(spark):
    rows = [(None, 0, "user", "of nobody"), (5, None, None, None), (5, 0, "user", None), (5, 0, "user", None), (6, 1, None, "x" * 50_000),
            (7, 0, "", ""), (-3, 2, "bot", "late"), (-3, 1, "bot", "early")]
    assert built(spark, rows, ("depth", "k1", "size", "part", "last", "weight", "a.b")) == plain(rows)
    assert built(spark, [(None, 0, "user", "x")]) == {}


def test_sums_are_carried_over_parts(spark):
    rows = spark.range(1000).selectExpr("id % 2 as k", "id as n")

    def scan(batches):
        import pyarrow as pa

        now, total = None, 0
        for batch in batches:
            out = []
            for k, n in zip(batch.column("k").to_pylist(), batch.column("n").to_pylist()):
                now, total = (k, n) if k != now else (now, total + n)
                out.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("n"), pa.array(out, pa.int64())], names=["k", "n", "total"])

    local = scans.scanned(rows, ["k", "n"], scan, "k long, n long, total long", "sums")
    before = scans.carried(local, ["k"], ["total"], lambda a, b: (a[0] + b[0],))
    full = local.join(before.withColumnRenamed("total", "more"), ["part", "k"], "left").selectExpr("k", "n", "total + coalesce(more, 0) as total")
    assert {(r.k, r.n): r.total for r in full.collect()} == {(n % 2, n): sum(range(n % 2, n + 1, 2)) for n in range(1000)}
    assert local.select("part").distinct().count() > 4 and local.where("last").count() == local.select("part").distinct().count()
