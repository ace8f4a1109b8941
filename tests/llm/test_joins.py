import math
import random

import duckdb
import numpy as np
import pytest

from weekloom.llm import near_text, near_vectors, oracle
from weekloom.llm.components import components, spanning

from .helpers_llm import awkward, documents, empty, random_texts


def groups_of(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == groups_of(linked, [(a, b) for a, b in links if a != b])
    assert len(spanning(5, [(0, 1), (1, 2), (0, 2), (3, 4)])) == 3
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- texts ------------------------------------------------------------------------------

def near_copies(seed):
    draw, texts = random.Random(seed), random_texts(seed, 60, (0, 80))
    for text in list(texts):
        words = text.split()
        for _ in range(draw.choice([0, 0, 1, 3])):
            changed = list(words)
            for _ in range(draw.choice([0, 1, 1, 2])):
                if changed:
                    changed[draw.randrange(len(changed))] = "changed"
            texts.append(" ".join(changed))
    base = random_texts(seed + 1, 1, (300, 300))[0].split()  # a large group of near copies
    for i in range(90):
        texts.append(" ".join([*base[: 3 * (i % 30)], f"v{i}", *base[3 * (i % 30) :]]))
    return texts + ["a b c", "a b c", "a  b\nc", ""]


def plain_join(texts):
    def grams(t):
        w = t.split()
        n = min(5, len(w))
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()

    sets = [grams(t or "") for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    count = [0] * len(sets)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    return count, groups_of(range(len(sets)), links), sets


@pytest.mark.parametrize("hot, block", [(64, 256), (4, 8)])
def test_join_equals_all_pairs(spark, hot, block):
    texts = near_copies(11)
    count, group, sets = plain_join(texts)
    for row in near_text.joined(documents(spark, texts), hot=hot, block=block).collect():
        i = row.doc_id
        least = min((j for j in range(len(sets)) if sets[j] == sets[i]), default=i) if sets[i] else i
        assert (row.class_id, row.n_links, row.component_id, row.kept) == (least, count[i], group[i], group[i] == i)


def test_sql_of_the_join_agrees(spark):
    texts = near_copies(12)
    documents(spark, texts).toPandas().to_parquet(path := "/tmp/near-copies-llm-test.parquet")
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    rows = {tuple(r) for r in sql.execute(oracle.NEAR_TEXT).fetchall()}
    assert rows == {tuple(r) for r in near_text.joined(documents(spark, texts)).collect()}


def test_awkward_and_empty_texts(spark):
    got = near_text.joined(awkward(spark)).collect()
    assert len(got) == 10
    by_id = {r.doc_id: r for r in got}
    assert by_id[4].n_links == 2 and by_id[5].component_id == 4 and by_id[1].n_links == by_id[2].n_links == 0
    assert near_text.joined(empty(spark)).count() == 0


def test_pruning_keeps_what_reaches_the_threshold():
    draw = np.random.default_rng(3)
    lost = 0
    for _ in range(200):
        common = draw.integers(0, 1 << 63, 160, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, draw.integers(0, 1 << 63, 20, dtype=np.uint64)])) for _ in "ab")
        x, y = near_text.signature(a)[None], near_text.signature(b)[None]
        lost += not len(near_text.pruned(x, y, np.array([0]), np.array([0])))
    assert lost == 0
    far = near_text.signature(draw.integers(0, 1 << 63, 200, dtype=np.uint64))[None]
    assert not len(near_text.pruned(x, far, np.array([0]), np.array([0])))


def test_least_agreements_are_beta_tails():
    draw = np.random.default_rng(4)
    for step, least in enumerate(near_text.least_agreements(0.8, 0.01)):
        n = (step + 1) * near_text.STEP
        tail = lambda m: (draw.beta(m + 1, n - m + 1, 200_000) >= 0.8).mean()
        assert tail(least) >= 0.008 and (least == 0 or tail(least - 1) <= 0.012)


# --- vectors ----------------------------------------------------------------------------

def vector_rows(seed, n=120, dim=16):
    draw = np.random.default_rng(seed)
    rows = [(i, draw.normal(size=dim).astype("f4").tolist(), int(draw.integers(3))) for i in range(n)]
    for i in range(60):  # near copies of a few, some just beyond the threshold
        base = np.array(rows[i % 12][1])
        rows.append((n + i, (base + draw.normal(size=dim) * 0.04 * (i % 6)).astype("f4").tolist(), rows[i % 12][2]))
    rows += [(n + 60 + i, rows[0][1], rows[0][2]) for i in range(5)]
    rows += [(n + 70, [2 * x for x in rows[0][1]], rows[0][2]), (n + 71, [0.0] * dim, 0), (n + 72, None, 0), (n + 73, [], 0),
             (n + 74, [math.nan] + rows[0][1][1:], 0), (n + 75, [math.inf] + rows[0][1][1:], 0), (n + 76, [None] + rows[0][1][1:], 0),
             (n + 77, rows[0][1], None), (n + 78, rows[0][1][:5], rows[0][2])]
    return rows


def plain_vector_links(rows):
    def good(v):
        return v and None not in v and all(map(math.isfinite, v)) and any(v)

    vectors = {i: np.array(v, float) for i, v, label in rows if label is not None and good(v)}
    labels = {i: label for i, _, label in rows}
    out = []
    for i in vectors:
        for j in vectors:
            if i < j and labels[i] == labels[j] and len(vectors[i]) == len(vectors[j]):
                if vectors[i] @ vectors[j] / np.linalg.norm(vectors[i]) / np.linalg.norm(vectors[j]) >= 0.98:
                    out.append((i, j))
    return out


@pytest.mark.parametrize("options", [{}, {"per_list": 8, "block": 4, "sample": 64}])
def test_vector_links_equal_all_pairs(spark, options):
    rows = vector_rows(5)
    links = plain_vector_links(rows)
    group = groups_of([r[0] for r in rows], links)
    got = near_vectors.linked(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), **options).collect()
    assert len(got) == len(rows)
    for row in got:
        n = sum(row.vec_id in link for link in links)
        assert (row.n_links, row.component_id, row.kept) == (n, group[row.vec_id], group[row.vec_id] == row.vec_id)


def test_vector_edge_cases(spark):
    schema = "vec_id long, embedding array<double>, label int, weight string, list string, vector string"
    rows = [(None, [1.0, 0.0], 1, "x", "x", "x"), (1, [1e200, 0.0], 1, "x", "x", "x"), (2, [1e-200, 1e-203], 1, "x", "x", "x")]
    got = {r.vec_id: r for r in near_vectors.linked(spark.createDataFrame(rows, schema)).collect()}
    assert got[1].n_links == 1 and got[2].component_id == 1 and len(got) == 3
    assert near_vectors.linked(spark.createDataFrame([], schema)).count() == 0
