"""Trees grown by several tasks against one task, and against plain sums."""

import itertools

import numpy as np
import pytest

from weekloom.operators import boosting

COLUMNS = ["A", "B", "C"]


def data(n=400):
    draw = np.random.default_rng(1)
    x = np.stack([draw.integers(-1, 30, n), draw.integers(0, 4, n), draw.integers(-1, 3, n)])
    return x, np.where(x[0] > 12, 3.0, 1.0) + x[1] + np.where(x[2] < 0, 5.0, 0.0) + draw.normal(size=n)


def fitted(spark, monkeypatch, least, **size):
    monkeypatch.setattr(boosting, "LEAST_ROWS", least)
    monkeypatch.setattr(boosting, "BLOCK", 16)
    x, y = data()
    frame = spark.createDataFrame([(float(v), *map(int, row)) for v, row in zip(y, x.T)], "Y double, A int, B int, C int").repartition(5)
    given = {"trees": 5, "depth": 3, "rate": 0.2, "rows": 1.0, "share": 1.0, "bins": 64, "seed": 7} | size
    return boosting.fit(frame, "Y", COLUMNS, [0, 2], **given), frame


@pytest.mark.parametrize("files", [True, False])
def test_several_tasks_grow_the_trees_of_one(spark, monkeypatch, files):
    alone = fitted(spark, monkeypatch, 1000, trees=2 if not files else 5)[0].table.to_pylist()
    if not files:
        monkeypatch.setattr(boosting, "_folder", lambda _: None)  # only Spark reaches the shared folder
    together, frame = fitted(spark, monkeypatch, 50, trees=2 if not files else 5)
    assert len(alone) == together.table.num_rows
    for a, b in zip(alone, together.table.to_pylist()):
        assert {k: v for k, v in a.items() if k not in ("VALUE", "GAIN")} == {k: v for k, v in b.items() if k not in ("VALUE", "GAIN")}
        assert a["VALUE"] == pytest.approx(b["VALUE"], abs=1e-9)
    again = fitted(spark, monkeypatch, 50, trees=2 if not files else 5)[0]
    assert again.table.equals(together.table)


def test_trees_follow_the_rest_and_are_kept(spark, monkeypatch, tmp_path):
    model, frame = fitted(spark, monkeypatch, 50, trees=30, rows=0.8, share=0.8)
    model.save(spark, str(tmp_path / "model"))
    loaded = boosting.Model.load(spark, str(tmp_path / "model"), 3)
    rows = frame.withColumn("P", loaded.predicted(COLUMNS)).collect()
    errors = np.array([r.Y - r.P for r in rows])
    _, y = data()
    assert (errors**2).mean() < 0.5 * y.var()
    shares = loaded.gains([0, 2])
    assert len(shares) == 5 and shares.sum() == pytest.approx(1) and (shares >= 0).all()
    assert len(set(loaded.table.column("TREE").to_pylist())) == 30


def test_first_split_is_the_best_of_all(spark, monkeypatch):
    model, _ = fitted(spark, monkeypatch, 50, trees=1, depth=1)
    x, y = data()
    best = 0.0
    for column, cut, low in itertools.product(range(3), range(-1, 30), (True, False)):
        if not low and column == 1:
            continue
        left = np.where(x[column] < 0, low, x[column] <= cut)
        if 0 < left.sum() < len(y):
            best = max(best, sum(y[s].sum() ** 2 / s.sum() for s in (left, ~left)) - y.sum() ** 2 / len(y))
    assert model.table.column("GAIN").to_pylist()[0] == pytest.approx(best, rel=1e-4)


def test_too_many_bins_are_grouped_and_bad_tables_told(spark, monkeypatch):
    model, _ = fitted(spark, monkeypatch, 50, bins=4)
    cuts = {(r["INPUT"], r["LAST_LEFT"]) for r in model.table.to_pylist() if r["INPUT"] == 0}
    assert cuts and len(cuts) <= 5
    empty = spark.createDataFrame([], "Y double, A int, B int, C int")
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit(empty, "Y", COLUMNS, [], 1, 1, 1.0, 1.0, 1.0, 4, 7)
    lost = boosting.fit(spark.createDataFrame([(float("nan"), 1, 1, 1)], "Y double, A int, B int, C int"), "Y", COLUMNS, [], 3, 2, 1.0, 1.0, 1.0, 4, 7)
    assert lost.table.num_rows == 1 and np.isnan(lost.table.column("VALUE").to_pylist()[0])
