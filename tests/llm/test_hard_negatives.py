"""Hard negatives against comparing everything, and the cases their docstring states."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from weekloom.llm import hard_negatives
from weekloom.llm.hard_negatives import Halves, mine, scores, visited

SCHEMA = "vec_id long, label long, embedding array<float>"


def plain(rows, positives=5, negatives=10, low=30, high=90, every=10):
    good = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and None not in v and all(map(math.isfinite, v)):
            good[i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)] = None
    out = []
    for i, label, v in good:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in good if j != i and len(w) == len(v)]
        for down, p, m in [s for s in sorted(scored) if s[2] == label][:positives]:
            fits = [s for s in sorted(scored) if s[2] != label and low * -down <= 100 * -s[0] <= high * -down][:negatives]
            out += [(i, p, k, j, -down, -d) for k, (d, j, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    found = mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, **options)
    return sorted(tuple(r) for r in found.collect())


def vectors(seed, n, dim=8, labels=4, centres=6):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centres, dim)) / 3
    return [(i, int(draw.integers(labels)), (middle[draw.integers(centres)] + draw.normal(size=dim) / 20).tolist()) for i in range(n)]


def test_mining_equals_comparing_everything_in_any_number_of_rounds(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "PER_CELL", 8)
    monkeypatch.setattr(hard_negatives, "GROWTH", 3)
    rows = vectors(1, 250)
    rows += [(300 + i, 1, rows[7][2]) for i in range(60)]  # one vector many times, as anchors too
    assert mined(spark, rows, first=20) == plain(rows)


def test_blocks_of_a_large_cell_hold_all_of_it(spark):
    rows = [(i, i % 3, [0.5, 0.25, 0.5, 0.125]) for i in range(70)] + [(100 + i, i % 3, [0.25, 0.25, 0.25, i / 64]) for i in range(40)]
    frame = hard_negatives.members(spark.createDataFrame(rows, SCHEMA), 256.0)
    index = hard_negatives.Index(frame, block=16)
    sizes = [len(r.held) for r in index.blocks.collect()]
    assert sum(sizes) == 110 and max(sizes) < 40 and len(sizes) > 4
    assert mined(spark, rows, positives=2, negatives=3, low=50, high=70) == plain(rows, 2, 3, 50, 70)


def test_cells_come_by_falling_bound_and_bounds_hold():
    draw = np.random.default_rng(2)
    data, query = draw.normal(size=(400, 6)).round(2) * 100, draw.normal(size=6) * 100
    halves = Halves(data, 7)
    (w1, d1), (w2, d2) = halves.encode(data)
    for a, b, x, y in zip(w1, w2, d1, d2):
        halves.counts[a, b] += 1
        halves.radii[0][a], halves.radii[1][b] = max(halves.radii[0][a], x), max(halves.radii[1][b], y)
    cells = list(visited(halves, query, None))
    bounds = [c[0] for c in cells]
    assert bounds == sorted(bounds, reverse=True) and len({c[3:] for c in cells}) == len(cells) == 49
    upper = {c[3:]: c[0] for c in cells}
    lower = [low for low, _ in halves.bounds(query)]
    for row, a, b in zip(data, w1, w2):
        assert lower[0][a] + lower[1][b] <= row @ query <= upper[a, b]
    for at in (0, 10, 47, 48):
        assert list(visited(halves, query, cells[at][:3])) == cells[at + 1 :]


def test_large_components_are_scored_exactly(spark):
    a = np.array([[2.0**40, 3.0]])
    assert scores(a, np.array([[2.0**21, 5.0]])).tolist() == [[2**61 + 15]]
    assert scores(a, np.array([[2.0**40, 1.0], [-(2.0**40), 1.0]])).tolist() == [[1 << 62, -(1 << 62)]]
    rows = [(0, 1, [2.0**30, 1.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 0.5]), (3, 2, [0.5, -4.0])]
    assert mined(spark, rows) == plain(rows) != []


def test_awkward_and_empty_tables(spark):
    draw = random.Random(4)
    rows = [(i, draw.choice([0, 1, None]), [draw.random() for _ in range(4)]) for i in range(60)]
    rows += [(None, 0, [1.0] * 4), (60, 1, None), (70, 0, [1.0, None, 0.0, 0.0]), (71, 0, [float("nan")] * 4), (72, 1, [float("inf")] * 4),
             (80, 0, [1.0, 0.5]), (81, 0, [0.5, 0.5]), (82, 1, [0.5, 0.25]), (90, 0, []), (91, 0, []), (92, 1, []),
             (100, 2, [-1.0, 0.0, 0.0, 0.0]), (101, 2, [1.0, 0.0, 0.0, 0.0]), rows[20], rows[20], (20, 1, [0.9] * 4), (20, 0, [0.1] * 4)]
    extra = spark.createDataFrame(rows, SCHEMA)
    for name in ("score", "dim", "key", "cells", "block", "rank", "a.b"):
        extra = extra.withColumn(name, F.lit("extra"))
    assert sorted(tuple(r) for r in mine(extra, F.col("vec_id") % 10 == 0).collect()) == plain(rows)
    assert mine(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0).count() == 0
