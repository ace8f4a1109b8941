import pytest
from pyspark.sql import functions as F

from helpers import by, day, rows
from weekloom import schemas
from weekloom.functions.text import direction, percent_change, ratio_percent_change, thousands
from weekloom.operators import narrative, reports

WEEK = day("2024-01-08")
OLD, NEW = "2024-01-01 06:00:00", "2024-01-08 06:00:00"
FEATURES = (
    "STORE_NBR bigint, FAMILY string, WEEK_START date, SALES_LAG_1 double, SALES_LAG_52 double, "
    "SALES_ROLL_MEAN_4 double, PROMO_ITEMS bigint, HOLIDAY_DAYS bigint"
)


@pytest.fixture(scope="module")
def tables(spark):
    values = [  # store, family, forecast, last week, last year, mean of 4 weeks, promo, holidays
        (1, "BEVERAGES", 1200.5, 1000.0, None, 1100.0, 3, 2), (1, "DAIRY", 300.0, 400.0, 250.0, 300.0, 0, 2),
        (1, "BREAD", 90.0, 0.0, 0.0, 100.0, None, None), (1, "EGGS", 50.0, 50.0, 50.0, None, 1, 0),
        (2, "BREAD", 10.0, None, None, 0.0, 0, 0), (3, "DAIRY", 75.0, 100.0, 100.0, 60.0, 1, 0),
    ]
    features = spark.createDataFrame([(s, f, WEEK, lw, ly, a4, p, h) for s, f, _, lw, ly, a4, p, h in values], FEATURES)
    log = [(s, f, WEEK, fc, "m", NEW) for s, f, fc, *_ in values] + [(1, "DAIRY", WEEK, 9999.0, "m", OLD)]
    stores = [(1, "Quito", "Pichincha", "A", 1), (2, None, "Loja", "B", 2), (3, "Quito", "Pichincha", "C", 3)]
    return (
        spark.createDataFrame(log, schemas.FORECASTS), features, spark.createDataFrame(stores, schemas.STORES)
    )


def test_text_formats(spark):
    inf = float("inf")
    values = [0.5, 1.5, 1234567.5, 0.25, 0.15, -0.3, inf, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = rows(df.select("i", thousands(F.col("x")), direction(F.col("x"))), "i")
    assert [g[1] for g in got] == ["0", "2", "1,234,568", "0", "0", "-0", "inf", "nan"]
    assert [g[2] for g in got] == ["up 0.5%", "up 1.5%", "up 1234567.5%", "up 0.2%", "up 0.1%", "down 0.3%", "up inf%", "n/a"]


def test_percent_changes_of_a_zero_base(spark):
    df = spark.createDataFrame([(5.0, 0.0), (-5.0, 0.0), (0.0, 0.0), (5.0, None), (50.0, 40.0)], "n double, o double")
    inf = float("inf")
    guarded = [r[0] for r in rows(df.select(percent_change(F.col("n"), F.col("o"))))]
    unguarded = [r[0] for r in rows(df.select(ratio_percent_change(F.col("n"), F.col("o"))))]
    assert guarded == [None, None, None, None, 25.0]
    assert unguarded == [inf, -inf, None, None, 25.0]


def test_store_documents(tables):
    documents = by(narrative.store_documents(narrative.fact_frame(*tables)), "STORE_NBR")
    assert documents[1]["SUMMARY"] == (
        "Store 1 (Quito, Pichincha; store type A) - forecast for the week of 2024-01-08. "
        "Total forecast sales: 1,640, up 13.1% vs last week (1,450), up 9.4% vs its 4-week average (1,500), "
        "and up 446.8% vs the same week last year (300). "
        "Largest expected increases vs the 4-week average: BEVERAGES (1,200 vs 1,100, up 9.1%); "
        "DAIRY (300 vs 300, up 0.0%); BREAD (90 vs 100, down 10.0%). "
        "Largest expected decreases: BREAD (90 vs 100, down 10.0%); DAIRY (300 vs 300, up 0.0%); "
        "BEVERAGES (1,200 vs 1,100, up 9.1%). "
        "Product families with items on promotion last week: 2 of 4. "
        "Holiday days at this store during the forecast week: 2."
    )
    assert documents[2]["SUMMARY"] == (
        "Store 2 (None, Loja; store type B) - forecast for the week of 2024-01-08. "
        "Total forecast sales: 10, n/a vs last week (0), n/a vs its 4-week average (0), "
        "and n/a vs the same week last year (0). "
        "Largest expected increases vs the 4-week average: BREAD (10 vs 0, n/a). "
        "Largest expected decreases: BREAD (10 vs 0, n/a). "
        "Product families with items on promotion last week: 0 of 1. "
        "Holiday days at this store during the forecast week: 0."
    )
    assert documents[1]["WEEK_START"] == "2024-01-08"


def test_chain_document(tables):
    document = rows(narrative.chain_document(narrative.fact_frame(*tables)))
    assert document == [(0, "2024-01-08", (
        "Chain-wide forecast for the week of 2024-01-08: total forecast sales 1,726 across 3 stores and 4 product families, "
        "up 11.3% vs last week (1,550). "
        "Stores with the largest expected increase vs last week: store 2 (up inf%), store 1 (up 13.1%), store 3 (down 25.0%). "
        "Stores with the largest expected decrease vs last week: store 3 (down 25.0%), store 1 (up 13.1%), store 2 (up inf%)."
    ))]


def test_summaries_hold_stores_and_chain(tables):
    assert {r["STORE_NBR"] for r in narrative.summaries(narrative.fact_frame(*tables)).collect()} == {0, 1, 2, 3}


def test_business_questions(tables, spark):
    forecasts, features, stores = tables
    assert rows(reports.top_stores(forecasts, 2)) == [(1, 1640.5), (3, 75.0)]
    assert rows(reports.top_family(forecasts)) == [("BEVERAGES", 1200.5)]
    assert rows(reports.forecast_count(forecasts)) == [(6,)]
    assert rows(reports.forecast_total(forecasts)) == [(1725.5,)]
    assert rows(reports.city_with_most_stores(stores)) == [("Quito", 2)]
    declines = rows(reports.store_declines(forecasts, features))
    assert [(r[0], r[3]) for r in declines] == [(3, -0.25), (1, pytest.approx(0.131379, abs=1e-6)), (2, None)]
    assert rows(reports.family_change(forecasts, features)) == [("BEVERAGES", 1200.5, 1000.0, pytest.approx(20.05))]
    log = spark.createDataFrame(
        [("m", "2024-01-01", 0.10, 5, 0.12, True, OLD), ("m", "2024-01-08", 0.20, 5, 0.12, False, NEW)], schemas.ACCURACY_LOG)
    assert rows(reports.newest_check(log).select("WAPE", "PASSED")) == [(0.20, False)]
    results = spark.createDataFrame([("a", "top10", 1, 0.3, 1.0), ("b", "top10", 1, 0.1, 1.0), ("c", "all", 1, 0.01, 1.0), ("d", "top10", 0, None, None)], schemas.MODEL_RESULTS)
    assert rows(reports.best_model(results)) == [("b", 0.1)]


def test_exploratory_reports(spark):
    data = [
        (1, "A", day("2024-01-01"), 10.0, 1, 0), (1, "A", day("2024-01-08"), 20.0, 0, 2), (2, "A", day("2024-01-01"), 30.0, None, None),
        (2, "B", day("2023-01-02"), 60.0, 2, 0),
    ]
    weekly = spark.createDataFrame(data, "STORE_NBR bigint, FAMILY string, WEEK_START date, SALES double, PROMO_ITEMS bigint, HOLIDAY_DAYS bigint")
    assert rows(reports.weekly_total(weekly), "WEEK_START")[1] == (day("2024-01-01"), 40.0)
    assert rows(reports.top_families(weekly)) == [("B", 60.0), ("A", 60.0)]
    assert rows(reports.seasonality(weekly), "WEEK_OF_YEAR") == [(1, pytest.approx(100 / 3)), (2, 20.0)]
    assert rows(reports.sales_by_flag(weekly, "PROMO_ITEMS", "P"), "P") == [(False, 25.0), (True, 35.0)]
    top = spark.createDataFrame([(1, "A", 30.0), (2, "B", 60.0)], "STORE_NBR bigint, FAMILY string, TOTAL_SALES double")
    assert rows(reports.biggest_series_history(weekly, top)) == [(2, "B", day("2023-01-02"), 60.0)]
