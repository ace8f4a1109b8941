import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import by, day, plan, rows
from weekloom import schemas
from weekloom.catalog.queries import all_queries
from weekloom.operators import quality, staging
from weekloom.sources import tables

RAW_HOLIDAYS = "DATE string, TYPE string, LOCALE string, LOCALE_NAME string, TRANSFERRED string"


@pytest.fixture(scope="module")
def side(spark):
    """Daily rows with repeats, gaps and NULL keys, plus the four side tables."""
    rnd = random.Random(3)
    start = day("2024-01-03")
    dates = [start + dt.timedelta(days=i) for i in range(25)]
    daily = []
    for _ in range(900):
        store = 1 if rnd.random() < 0.5 else rnd.choice([2, 3, 4, None])
        daily.append((
            rnd.choice(dates + [None]), store, rnd.choice(["A", "B", None]),
            rnd.choice([None, round(rnd.uniform(-5, 50), 2)]), rnd.choice([None, 0, 2]),
        ))
    stores = [(1, "Quito", "Pichincha", "A", 3), (2, "Loja", "Loja", "B", 4), (3, None, None, None, None)]
    oil = [(d, None if d.day % 5 == 0 or d < day("2024-01-05") else float(d.day)) for d in dates]
    holidays = [(s, d, 1) for s in (1, 2) for d in dates if d.day % 4 == 0]
    traffic = [(d, s, rnd.choice([None, 10 * s + d.day])) for s in (1, 3) for d in dates if d.day % 3]
    return (
        spark.createDataFrame(daily, schemas.SALES_DAILY), spark.createDataFrame(stores, schemas.STORES),
        spark.createDataFrame(oil, schemas.OIL_DAILY), spark.createDataFrame(holidays, schemas.STORE_HOLIDAYS),
        spark.createDataFrame(traffic, schemas.TRANSACTIONS_DAILY),
    )


def test_weekly_sales_equals_rollup_of_the_joined_daily_table(side):
    direct = staging.weekly_sales(*side)
    joined = staging.rollup_weekly(staging.enrich(*side)).select(direct.columns)

    def digest(df):
        return sorted(rows(df.withColumn("SALES", F.round("SALES", 6)).withColumn("AVG_OIL_PRICE", F.round("AVG_OIL_PRICE", 6))), key=str)

    assert digest(direct) == digest(joined)
    assert direct.schema.simpleString() == joined.schema.simpleString()


def test_enrich_keeps_every_daily_row(side):
    daily = side[0]
    enriched = staging.enrich(*side)
    assert enriched.count() == daily.count()
    assert enriched.where("IS_HOLIDAY is null").count() == 0


def test_salting_hot_stores_changes_nothing(side):
    daily, *others = side
    copies = daily.where("STORE_NBR = 1 or STORE_NBR is null").limit(40)
    for _ in range(4):
        copies = copies.union(copies)
    skewed = daily.union(copies).repartition(6)
    plain, salted = staging.enrich(skewed, *others), staging.enrich(skewed, *others, hot_rows=300)
    assert sorted(rows(plain), key=str) == sorted(rows(salted), key=str)
    hot = staging.hot_values(skewed, "STORE_NBR", 300)
    assert 1 in {r[0] for r in hot.collect()}
    spread = staging.salt_rows(skewed, "STORE_NBR", hot).where("STORE_NBR = 1")
    assert spread.select("SALT").distinct().count() == 6


def test_frequent_stores_are_noted_by_the_write_itself(spark, side, tmp_path):
    daily, *others = side
    path = str(tmp_path / "daily")
    assert tables.overwrite_tracked(daily.where("STORE_NBR is null or STORE_NBR < 3"), path, "STORE_NBR") + tables.append_tracked(
        daily.where("STORE_NBR >= 3"), path, "STORE_NBR") == 900
    exact = {r[0]: r[1] for r in daily.groupBy("STORE_NBR").count().collect()}
    limit = sorted(exact.values())[-3]
    hot = tables.frequent_values(spark, path, limit)
    assert {r["_HOT"] for r in hot.collect()} == {k for k, n in exact.items() if n > limit}
    with_null = tables.frequent_values(spark, path, min(exact.values()) - 1)
    assert {r["_HOT"] for r in with_null.collect()} == set(exact) and None in exact
    stored = spark.read.schema(schemas.SALES_DAILY).parquet(path)
    told = staging.enrich(stored, *others, hot=with_null)
    assert sorted(rows(told), key=str) == sorted(rows(staging.enrich(daily, *others)), key=str)
    # the frequent stores come from the sketch: the joins read the daily table once
    assert plan(staging.enrich(stored, *others, hot=with_null)).count(f"{path}]") == 1
    spread = staging.salt_rows(stored.repartition(6), "STORE_NBR", with_null).where("STORE_NBR is null")
    assert spread.select("SALT").distinct().count() > 1


def test_enriched_query_reads_its_lines_twice(spark, sf_dir):
    """Once to store the daily table, once for the transactions."""
    assert plan(all_queries()["sales_enriched"](spark, sf_dir)).count("lineitem.parquet") == 1


def test_enriched_columns_match_a_lookup(side):
    daily, stores, oil, holidays, traffic = side
    prices, days, visits = by(oil, "DATE"), by(holidays, "STORE_NBR", "DATE"), by(traffic, "STORE_NBR", "DATE")
    for r in staging.enrich(*side).collect():
        key = (r.STORE_NBR, r.DATE)
        assert r.IS_HOLIDAY == (1 if key in days else 0)
        assert r.TRANSACTIONS == visits.get(key, {}).get("TRANSACTIONS")
        assert r.OIL_PRICE == prices.get(r.DATE, {}).get("OIL_PRICE")


def test_holidays_match_the_three_way_rule(spark):
    stores = [(1, "Quito", "Pichincha", "A", 1), (2, "Loja", "Loja", "B", 1), (3, None, "Loja", "C", 1), (4, "National", None, "D", 1)]
    events = [
        ("2024-01-01", "Holiday", "National", "Ecuador", "False"), ("2024-01-01", "Holiday", "Local", "Quito", "False"),
        ("2024-01-02", "Holiday", "Regional", "Loja", "False"), ("2024-01-03", "Holiday", "Local", "Loja", "False"),
        ("2024-01-04", "Holiday", "National", "Ecuador", "True"), ("2024-01-05", "Work Day", "National", "Ecuador", "False"),
        ("2024-01-06", "Holiday", "National", None, "False"), ("2024-01-07", "Holiday", "National", "Ecuador", None),
        ("2024-01-08", "Holiday", "Local", None, "False"), ("2024-01-09", None, "National", "Ecuador", "False"),
        ("2024-01-10", "Holiday", "Local", "National", "False"), ("2024-01-01", "Holiday", "National", "Ecuador", "False"),
    ]
    expected = set()
    for date, kind, locale, name, moved in events:
        if kind is None or moved is None or moved.upper() == "TRUE" or kind == "Work Day":
            continue
        for nbr, city, state, _, _ in stores:
            hit = locale == "National" or (name is not None and (
                (locale == "Regional" and name == state) or (locale == "Local" and name == city)))
            if hit:
                expected.add((nbr, day(date), 1))
    active = staging.active_holidays(spark.createDataFrame(events, RAW_HOLIDAYS))
    result = staging.store_holidays(active, spark.createDataFrame(stores, schemas.STORES))
    got = rows(result)
    assert len(got) == len(set(got)) and set(got) == expected
    assert "CartesianProduct" not in plan(result) and "NestedLoop" not in plan(result)


@pytest.mark.parametrize("bucket", ["week", "month", "year"])
def test_fill_forward_equals_a_running_scan(spark, bucket):
    rnd = random.Random(5)
    start = day("2023-11-20")
    values = [(start + dt.timedelta(days=i), None if rnd.random() < 0.6 or i < 9 or 60 < i < 150 else float(i)) for i in range(200)]
    df = spark.createDataFrame(values, "DATE date, PRICE double").repartition(5)
    last, expected = None, []
    for date, price in values:
        last = price if price is not None else last
        expected.append((date, last))
    assert rows(staging.fill_forward(df, "DATE", "PRICE", bucket=bucket), "DATE") == expected


def test_fill_forward_per_key(spark):
    data = [(k, day("2024-01-30") + dt.timedelta(days=i), float(k * 10) if i == k else None) for k in (0, 1, 2) for i in range(5)]
    df = spark.createDataFrame(data, "K int, DATE date, V double")
    got = rows(staging.fill_forward(df, "DATE", "V", keys=("K",)).select("K", "DATE", "V"), "K", "DATE")
    assert got == [(k, d, float(k * 10) if (d - day("2024-01-30")).days >= k else None) for k, d, _ in data]


def test_oil_has_one_row_per_day_past_2000_days(spark):
    daily = spark.createDataFrame([(day("2010-01-01"),), (day("2018-12-31"),)], "DATE date")
    prices = spark.createDataFrame([(day("2010-01-03"), 5.0), (day("2010-01-03"), None), (day("2012-01-01"), 7.0)], schemas.OIL_DAILY)
    filled = staging.oil_daily(prices, daily)
    assert filled.count() == 3287
    assert rows(filled.groupBy("OIL_PRICE").count(), "OIL_PRICE") == [(None, 2), (5.0, 728), (7.0, 2557)]


def test_quality_reports(spark, side):
    daily, stores, oil, holidays, traffic = side
    weekly = staging.weekly_sales(*side)
    total = rows(quality.reconcile(daily, weekly))[0]
    assert total[0] == total[1]
    assert rows(quality.unparsed_dates(daily))[0][0] == daily.where("DATE is null").count()
    assert rows(quality.oil_gaps(oil))[0][0] == oil.where("OIL_PRICE is null").count()
    assert quality.duplicate_keys(stores, ["STORE_NBR"]).isEmpty()
    quality.assert_unique(stores, ["STORE_NBR"], "STORES")
    with pytest.raises(ValueError, match="duplicate keys"):
        quality.assert_unique(stores.union(stores), ["STORE_NBR"], "STORES")
    assert quality.conflicting_store_columns(staging.enrich(*side), staging.STORE_COLUMNS).isEmpty()
    mixed = spark.createDataFrame([(1, "A"), (1, None), (2, "B"), (2, "B"), (3, None)], "STORE_NBR bigint, CITY string")
    assert rows(quality.conflicting_store_columns(mixed, ["CITY"])) == [(1,)]


def test_build_staging_names_seven_tables(spark, sf_dir):
    from weekloom.catalog.frames import Frames
    from weekloom.sources import star
    built = staging.build_staging(star.raw_tables(Frames(spark, sf_dir).table))
    assert list(built) == [
        "SALES_DAILY", "STORES", "OIL_DAILY", "STORE_HOLIDAYS", "TRANSACTIONS_DAILY", "SALES_DAILY_ENRICHED", "SALES_WEEKLY",
    ]
    assert built["SALES_WEEKLY"].count() == 5215


def test_totals_are_rounded_once(spark):
    from weekloom.operators import quality

    daily = spark.createDataFrame([(1234.4951,)], "SALES double")
    assert tuple(quality.reconcile(daily, daily).first()) == (1234.0, 1234.0)


def test_spread_join_keeps_null_and_frequent_keys(spark):
    from weekloom.operators.skew import spread_join

    left = spark.createDataFrame([(1 if i % 3 else None, f"f{i % 7}", i) for i in range(200)] + [(2, "f", 0)], "STORE_NBR bigint, FAMILY string, W int")
    right = spark.createDataFrame([(1, "A"), (3, "C"), (None, "N")], "STORE_NBR bigint, CITY string")
    expected = sorted(map(str, left.join(right, "STORE_NBR", "left").collect()))
    assert sorted(map(str, spread_join(left, right, "STORE_NBR", ["FAMILY", "W"]).collect())) == expected
