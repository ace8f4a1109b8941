import datetime as dt
import pathlib
import random
import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import by, day, plan, rows
from weekloom import schemas, session
from weekloom.operators import features

MONDAY = day("2024-01-01")


def week(i):
    return MONDAY + dt.timedelta(weeks=i)


def weekly_frame(spark, series):
    """series: {(store, family): {week number: sales}}"""
    data = [
        (store, family, week(i), "Quito", "P", f"T{store}", store, sales, i % 3, 1 if i % 4 == 0 else 0, 50.0 + i, 100 + i, 7)
        for (store, family), points in series.items() for i, sales in points.items()
    ]
    return spark.createDataFrame(data, schemas.SALES_WEEKLY)


@pytest.fixture(scope="module")
def sparse(spark):
    rnd = random.Random(1)
    full = {i: round(rnd.uniform(0, 100), 2) for i in range(70)}
    gaps = {i: round(rnd.uniform(-10, 100), 2) for i in range(70) if rnd.random() < 0.3}
    early = {i: 5.0 for i in range(3, 20)}
    return {(1, "A"): full, (1, "B"): gaps, (2, "A"): early, (3, "A"): {0: 9.0}}


HOLIDAYS = [(1, week(69), 1), (1, week(69) + dt.timedelta(days=6), 1), (2, week(70), 1)]


@pytest.fixture(scope="module")
def built(spark, sparse):
    holidays = spark.createDataFrame(HOLIDAYS, schemas.STORE_HOLIDAYS)
    return features.build_features(weekly_frame(spark, sparse), holidays)


def test_edge_weeks_are_dropped_and_gaps_filled(built, sparse):
    got = by(built.where("IS_FUTURE = 0"), "STORE_NBR", "FAMILY", "WEEK_START")
    assert {k[:2] for k in got} == {(1, "A"), (1, "B"), (2, "A")}  # (3, A) had the first week only
    for store, family in [(1, "A"), (1, "B"), (2, "A")]:
        for i in range(1, 69):
            assert got[(store, family, week(i))]["SALES"] == sparse[(store, family)].get(i, 0.0)
    assert len(got) == 3 * 68


def test_features_equal_a_direct_computation(built, sparse):
    got = by(built, "STORE_NBR", "FAMILY", "WEEK_START")
    for store, family in [(1, "A"), (1, "B"), (2, "A")]:
        values = [sparse[(store, family)].get(i, 0.0) for i in range(1, 69)] + [None]
        for t in range(69):
            row = got[(store, family, week(t + 1))]
            for k in (1, 2, 4, 52):
                assert row[f"SALES_LAG_{k}"] == (values[t - k] if t >= k else None)
            for n in (4, 12):
                past = values[max(0, t - n):t]
                assert row[f"SALES_ROLL_MEAN_{n}"] == (pytest.approx(statistics.fmean(past)) if past else None)
            past = values[max(0, t - 12):t]
            std = statistics.stdev(past) if len(past) > 1 else None
            assert row["SALES_ROLL_STD_12"] == (pytest.approx(std, abs=1e-9) if std is not None else None)
            assert (row["WEEK_OF_YEAR"], row["MONTH"], row["YEAR"]) == (
                row["WEEK_START"].isocalendar()[1], row["WEEK_START"].month, row["WEEK_START"].year)


def test_future_row_repeats_the_last_row(built):
    future = by(built.where("IS_FUTURE = 1"), "STORE_NBR", "FAMILY")
    assert set(future) == {(1, "A"), (1, "B"), (2, "A")}
    row = future[(1, "A")]
    assert row["WEEK_START"] == week(69)
    assert row["SALES"] is None and row["STORE_TRANSACTIONS"] is None
    assert (row["PROMO_ITEMS"], row["AVG_OIL_PRICE"]) == (68 % 3, 118.0)
    assert row["HOLIDAY_DAYS"] == 2 and future[(2, "A")]["HOLIDAY_DAYS"] == 0


def test_sparse_future_row_of_a_series_that_ended(spark, sparse):
    holidays = spark.createDataFrame(HOLIDAYS, schemas.STORE_HOLIDAYS)
    sparse_features = features.build_features(weekly_frame(spark, sparse), holidays, dense=False)
    row = by(sparse_features.where("IS_FUTURE = 1"), "STORE_NBR", "FAMILY")[(2, "A")]
    assert row["WEEK_START"] == week(69)
    assert row["SALES_LAG_1"] == 5.0 and row["PROMO_ITEMS"] == 19 % 3  # its own last row, not last week


def test_changing_a_week_leaves_earlier_features_alone(spark, sparse, built):
    changed = {**sparse, (1, "A"): {**sparse[(1, "A")], 40: 1e6}}
    holidays = spark.createDataFrame(HOLIDAYS, schemas.STORE_HOLIDAYS)
    other = features.build_features(weekly_frame(spark, changed), holidays)
    columns = [c for c in built.columns if c.startswith("SALES_")]
    before = F.col("WEEK_START") <= F.lit(week(40))
    order = ["STORE_NBR", "FAMILY", "WEEK_START"]
    assert rows(built.where(before).select(*order, *columns), *order) == rows(other.where(before).select(*order, *columns), *order)
    after = by(other, *order)[(1, "A", week(41))]
    assert after["SALES_LAG_1"] == 1e6


def test_one_stray_date_does_not_stretch_the_grid(spark, sparse):
    stray = {**sparse, (9, "Z"): {20000: 1.0}}  # some four centuries ahead
    holidays = spark.createDataFrame(HOLIDAYS, schemas.STORE_HOLIDAYS)
    built = features.build_features(weekly_frame(spark, stray), holidays)
    assert rows(built.agg(F.min("WEEK_START"), F.max("WEEK_START")))[0] == (week(1), week(70))
    assert built.count() == 3 * 70


def test_complete_weeks_option(spark):
    df = weekly_frame(spark, {(1, "A"): {i: 1.0 for i in range(5)}})
    df = df.withColumn("DAYS_IN_WEEK", F.when(F.col("WEEK_START") == F.lit(week(2)), 6).otherwise(F.col("DAYS_IN_WEEK")).cast("bigint"))
    assert features.trim_edge_weeks(df).count() == 3
    assert features.trim_edge_weeks(df, complete_weeks_only=True).count() == 2


def test_windows_share_one_shuffle_by_series(spark, tmp_path, sparse):
    path = str(tmp_path / "weekly")
    weekly_frame(spark, sparse).write.parquet(path)
    stored = spark.read.schema(schemas.SALES_WEEKLY).parquet(path)
    text = plan(features.build_features(stored, spark.createDataFrame(HOLIDAYS, schemas.STORE_HOLIDAYS)))
    exchanges = [line for line in text.split("\n") if "Exchange hashpartitioning(STORE_NBR" in line]
    assert len([line for line in exchanges if "FAMILY" in line]) == 1
    assert text.index("Window [lag(SALES") < text.index("REPARTITION_BY_COL")  # below every window
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_category_codes_are_text_positions(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("C",)], "FAMILY string")
    codes = features.category_codes(df, "FAMILY")
    assert rows(codes, "CODE") == [("C", 0), ("a", 1), ("b", 2)]
    coded = features.attach_codes(df, "FAMILY", codes, "FAMILY_CODE")
    assert sorted(r["FAMILY_CODE"] for r in coded.collect()) == [-1, 0, 1, 2, 2]


def test_series_position_and_tail(spark):
    df = weekly_frame(spark, {(1, "A"): {i: float(i) for i in range(6)}, (2, "A"): {3: 1.0}})
    placed = by(features.series_position(df), "STORE_NBR", "WEEK_START")
    assert placed[(1, week(4))]["T"] == 4 and placed[(2, week(3))]["T"] == 0
    assert {(r["STORE_NBR"], r["WEEK_START"]) for r in features.series_tail(df, 2).collect()} == {
        (1, week(4)), (1, week(5)), (2, week(3))}


def test_category_codes_span_several_ranges(spark):
    names = [f"n{i:03d}" for i in range(300)]
    df = spark.createDataFrame([(n,) for n in names[::-1] + [None]], "FAMILY string")
    codes = features.category_codes(df, "FAMILY")
    assert [tuple(r) for r in codes.orderBy("FAMILY").collect()] == [(n, i) for i, n in enumerate(names)]
    assert features.category_codes(df.limit(0), "FAMILY").count() == 0


def test_rolling_statistics_keep_their_digits_after_large_amounts(spark):
    """Sums are exact: what a series sold before the window leaves no trace, of cents beside hundreds of millions."""
    from decimal import Decimal

    amounts = [2e8, 3e8 + 0.01, 0.03, 0.01, 0.02, 0.05, 0.01, 0.04, 0.02, 0.01, 0.03, 0.02, 0.01, 0.02, None, 0.07, float("nan"), 0.01]
    weekly = [(1, "A", day("2019-01-07") + dt.timedelta(weeks=i), x) for i, x in enumerate(amounts)]
    frame = spark.createDataFrame(weekly, "STORE_NBR bigint, FAMILY string, WEEK_START date, SALES double")
    got = by(features.add_features(frame), "WEEK_START")
    for i in range(len(amounts)):
        row = got[day("2019-01-07") + dt.timedelta(weeks=i)]
        past = [Decimal(str(x)) for x in amounts[max(0, i - 12) : i] if x is not None and x == x]
        mean = float(sum(past) / len(past)) if past else None
        assert row["SALES_ROLL_MEAN_12"] == (pytest.approx(mean, rel=1e-15) if past else None)
        if len(past) > 1:
            exact = (sum(x * x for x in past) - sum(past) ** 2 / len(past)) / (len(past) - 1)
            assert row["SALES_ROLL_STD_12"] == pytest.approx(float(exact.sqrt()), rel=1e-14)
        else:
            assert row["SALES_ROLL_STD_12"] is None


def test_partitions_follow_the_input(spark, tmp_path, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    sparse = weekly_frame(spark, {(s, f): {i: float(i) for i in range(30)} for s in range(40) for f in "AB"})
    assert session.partitions_for(sparse) == cores  # no files
    path = str(tmp_path / "a b%3A=1")
    sparse.repartition(3).write.parquet(path)
    stored = spark.read.schema(sparse.schema).parquet(path)
    size = sum(f.stat().st_size for f in pathlib.Path(path).glob("part-*"))
    assert session.partitions_for(stored.where("STORE_NBR > 3")) == cores
    monkeypatch.setattr(session, "PARTITION_BYTES", size // 50)
    assert session.partitions_for(stored) in (50, 51, 52)
    monkeypatch.setattr(session, "MOST_PARTITIONS", 20)
    assert session.partitions_for(stored) == 20
    built = features.build_features(stored, spark.createDataFrame(HOLIDAYS, schemas.STORE_HOLIDAYS))
    assert "REPARTITION_BY_NUM" in plan(built)
    expected = features.build_features(sparse, spark.createDataFrame(HOLIDAYS, schemas.STORE_HOLIDAYS))
    assert sorted(rows(built), key=str) == sorted(rows(expected), key=str)


def test_rows_from_a_week_on_equal_those_of_the_whole_history(spark, sparse):
    late = sparse | {(4, "B"): {2: 7.0, 5: 3.0}, (5, "A"): {66: 1.5, 68: 2.5}}
    holidays = spark.createDataFrame(HOLIDAYS, schemas.STORE_HOLIDAYS)
    weekly = weekly_frame(spark, late)
    whole = features.build_features(weekly, holidays)
    for i in (1, 30, 61, 68, 69):
        oldest = F.lit(week(i))
        got = features.build_features(weekly, holidays, oldest=oldest)
        assert sorted(rows(got), key=str) == sorted(rows(whole.where(F.col("WEEK_START") >= oldest)), key=str)
        assert got.count() == 5 * (70 - i)
    # weeks that nothing looks back to are not laid out
    assert rows(features.densify(weekly, F.lit(week(0)), F.lit(week(69)), F.lit(week(60))).agg(F.min("WEEK_START"), F.count("*"))) == [(week(60), 6 * 10)]
    with pytest.raises(PySparkException, match="sequence boundaries"):
        features.build_features(weekly.union(weekly.where("SALES = 3")), holidays, oldest=F.lit(week(68))).collect()
    with pytest.raises(ValueError, match="dense"):
        features.build_features(weekly, holidays, dense=False, oldest=F.lit(week(1)))
