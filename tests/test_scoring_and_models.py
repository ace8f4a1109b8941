import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from helpers import by, day, rows
from weekloom import schemas
from weekloom.functions.scores import from_log_scale, rmse, to_log_scale, wape
from weekloom.operators import features, global_model, scoring, series_models
from weekloom.operators.global_model import Boosting
from weekloom.plans import backtest_run, weekly_run

MONDAY = day("2019-01-07")
SMALL = Boosting(trees=12, depth=5, rate=0.3, bins=32)


def week(i):
    return MONDAY + dt.timedelta(weeks=i)


@pytest.fixture(scope="module")
def seasonal(spark, tmp_path_factory):
    """Stored features of growing, seasonal series in which last year's value
    alone is a poor guess."""
    data = []
    for store in range(1, 7):
        for f, family in enumerate(["A", "B"]):
            for i in range(170):
                level = 100 * store + 80 * f + 2.0 * i * store
                sales = round(level * (1 + 0.3 * math.sin(2 * math.pi * i / 52)), 2)
                data.append((store, family, week(i), "Q", "P", "T", store, sales, i % 3, 0, 50.0, 100, 7))
    weekly = spark.createDataFrame(data, schemas.SALES_WEEKLY)
    path = str(tmp_path_factory.mktemp("features") / "t")
    features.build_features(weekly, spark.createDataFrame([], schemas.STORE_HOLIDAYS)).write.parquet(path)
    return spark.read.parquet(path)


def test_wape_and_rmse(spark):
    df = spark.createDataFrame([(10.0, 8.0), (0.0, 1.0), (-5.0, -5.0)], "a double, f double")
    got = rows(df.agg(wape(F.col("a"), F.col("f")), rmse(F.col("a"), F.col("f"))))[0]
    assert got[0] == pytest.approx(3 / 15) and got[1] == pytest.approx(math.sqrt(5 / 3))
    assert rows(df.where("a = 0").agg(wape(F.col("a"), F.col("f"))))[0][0] is None


def test_log_scale_clips_at_zero(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (7.0,)], "x double")
    got = rows(df.select(to_log_scale(F.col("x")), from_log_scale(F.col("x"))))
    assert got[0] == (0.0, 0.0) and got[1] == (0.0, 0.0)
    assert got[2] == (pytest.approx(math.log(8)), pytest.approx(math.exp(7) - 1))


def test_incomplete_model_has_no_all_row(spark):
    tested = spark.createDataFrame(
        [(10.0, True, 9.0, 8.0), (20.0, True, 20.0, None), (5.0, False, 0.0, None)],
        "SALES double, IS_TOP boolean, P1 double, P2 double",
    )
    results = scoring.score_models(tested, {"naive_52": "P1", "other": "P2"})
    got = by(results, "MODEL", "SCOPE")
    assert set(got) == {("naive_52", "all"), ("naive_52", "top10"), ("other", "top10")}
    assert got[("naive_52", "all")]["WAPE"] == pytest.approx(6 / 35)
    assert got[("other", "top10")]["N"] == 1 and got[("other", "top10")]["WAPE"] == pytest.approx(0.2)
    table = by(scoring.compare_models(results), "MODEL")
    assert table["naive_52"]["IMPROVEMENT_VS_NAIVE_TOP10"] == "0.0%"
    assert table["other"]["ALL_SERIES"] is None
    assert table["other"]["IMPROVEMENT_VS_NAIVE_TOP10"] == f"{(0.0333 - 0.2) / 0.0333 * 100:.1f}%"
    assert [r[0] for r in rows(scoring.rank_models(results))] == ["naive_52", "other"]


def test_predictions_replace_an_earlier_column(spark):
    base = spark.createDataFrame([(1, "A", week(0), 5.0), (1, "B", week(0), 6.0)], "STORE_NBR bigint, FAMILY string, WEEK_START date, P double")
    new = spark.createDataFrame([(1, "A", week(0), 9.0)], "STORE_NBR bigint, FAMILY string, WEEK_START date, P double")
    assert rows(scoring.attach_predictions(base, new, "P").select("FAMILY", "P"), "FAMILY") == [("A", 9.0), ("B", None)]


def test_top_series_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(s, f, 10.0) for s in (2, 1) for f in ("B", "A")], "STORE_NBR bigint, FAMILY string, SALES double")
    assert rows(scoring.top_series(df, 3)) == [(1, "A", 10.0), (1, "B", 10.0), (2, "A", 10.0)]


def test_backtest_rows_are_the_last_weeks(seasonal):
    tested = scoring.backtest_rows(scoring.actual_rows(seasonal))
    assert {r[0] for r in tested.select("WEEK_START").distinct().collect()} == {week(i) for i in range(161, 169)}
    assert tested.where("IS_TOP").count() == 80


def test_gate_log_and_both_outcomes(spark):
    df = spark.createDataFrame([(week(0), 10.0, 9.0), (week(0), 10.0, 10.5)], "WEEK_START date, SALES double, P double")
    row = by(scoring.gate_log(df, "P", "m", "2024-01-01 00:00:00", 0.075), "MODEL")["m"]
    assert (row["WAPE"], row["N_SERIES"], row["EVAL_WEEK"], row["PASSED"]) == (0.075, 2, "2019-01-07", True)
    assert by(scoring.gate_log(df, "P", "m", "t", 0.07), "MODEL")["m"]["PASSED"] is False


def test_model_rows_have_no_missing_input(seasonal):
    vectors = global_model.model_rows(seasonal)
    first = vectors.where(F.col("SALES_LAG_52").isNull()).first()
    values = first["INPUTS"].toArray()
    assert len(values) == 15 + 10 and not any(math.isnan(v) for v in values)
    assert values[3] == -1.0 and values[15 + 3] == 1.0


def test_boosted_model_beats_naive_on_growing_series(seasonal):
    predictions = global_model.backtest(global_model.model_rows(seasonal), SMALL, n_weeks=2)
    assert predictions.count() == 24
    tested = scoring.attach_predictions(
        scoring.backtest_rows(scoring.actual_rows(seasonal), scoring.test_weeks(scoring.actual_rows(seasonal), 2))
        .withColumn("PRED_NAIVE52", scoring.naive_prediction()),
        predictions, "PRED_GBT",
    )
    got = by(scoring.score_models(tested, {"naive_52": "PRED_NAIVE52", "gbt_global": "PRED_GBT"}), "MODEL", "SCOPE")
    assert got[("gbt_global", "all")]["WAPE"] < got[("naive_52", "all")]["WAPE"]


def test_importance_covers_every_input(spark, seasonal):
    model = global_model.fit(global_model.trainable(global_model.model_rows(seasonal)), SMALL)
    table = global_model.importance(spark, model).collect()
    assert len(table) == 15 and sum(r["IMPORTANCE"] for r in table) == pytest.approx(1.0)
    assert [r["IMPORTANCE"] for r in table] == sorted(r["IMPORTANCE"] for r in table)


def test_forecast_fails_without_future_rows(seasonal):
    with pytest.raises(ValueError, match="no future rows"):
        global_model.forecast(global_model.model_rows(seasonal).where("IS_FUTURE = 0"), "t", SMALL)


@pytest.mark.parametrize("backtest, limit", [(series_models.backtest_arima, 0.03), (series_models.backtest_trend_season, 0.2)])
def test_series_models_follow_trend_and_season(seasonal, backtest, limit):
    actuals = scoring.actual_rows(seasonal)
    predictions = backtest(actuals).withColumnRenamed("PRED", "P")
    assert predictions.count() == 96 and predictions.where("ERROR is not null").count() == 0
    tested = scoring.attach_predictions(scoring.backtest_rows(actuals), predictions, "P")
    assert by(scoring.score_models(tested, {"m": "P"}), "SCOPE")["all"]["WAPE"] < limit


def test_series_models_never_see_the_predicted_week(seasonal):
    actuals = scoring.actual_rows(seasonal)
    weeks = scoring.test_weeks(actuals, 1)
    spiked = actuals.withColumn("SALES", F.when(F.col("WEEK_START") == F.lit(week(168)), 1e9).otherwise(F.col("SALES")))
    for backtest in (series_models.backtest_arima, series_models.backtest_trend_season):
        assert rows(backtest(actuals, weeks), "STORE_NBR", "FAMILY") == rows(backtest(spiked, weeks), "STORE_NBR", "FAMILY")


def test_short_series_report_a_failed_fit(spark):
    df = spark.createDataFrame(
        [(1, "A", week(i), 5.0, 0, 0) for i in range(6)],
        "STORE_NBR bigint, FAMILY string, WEEK_START date, SALES double, PROMO_ITEMS bigint, HOLIDAY_DAYS bigint",
    )
    failed = series_models.backtest_arima(df, scoring.test_weeks(df, 2)).collect()
    assert [(r["PRED"], r["ERROR"]) for r in failed] == [(None, "too few weeks")] * 2


RAW = {
    "TRAIN": "DATE string, STORE_NBR string, FAMILY string, SALES string, ONPROMOTION string",
    "STORES": "STORE_NBR string, CITY string, STATE string, TYPE string, CLUSTER string",
    "OIL": "DATE string, DCOILWTICO string",
    "HOLIDAYS_EVENTS": "DATE string, TYPE string, LOCALE string, LOCALE_NAME string, TRANSFERRED string",
    "TRANSACTIONS": "DATE string, STORE_NBR string, TRANSACTIONS string",
}


@pytest.fixture(scope="module")
def raw(spark):
    days = [MONDAY + dt.timedelta(days=i) for i in range(0, 70 * 7)]
    data = {
        "TRAIN": [(str(d), str(s), f, str(50 * s + 10 * d.weekday()), "1") for d in days for s in (1, 2, 3) for f in ("A", "B")],
        "STORES": [(str(s), "Quito", "Pichincha", "A", "1") for s in (1, 2, 3)],
        "OIL": [(str(d), "50.5") for d in days[::2]],
        "HOLIDAYS_EVENTS": [(str(days[10]), "Holiday", "National", "Ecuador", "False")],
        "TRANSACTIONS": [(str(d), str(s), "100") for d in days for s in (1, 2, 3)],
    }
    return {name: spark.createDataFrame(rows_, RAW[name]) for name, rows_ in data.items()}


def test_weekly_run_end_to_end(spark, raw, tmp_path):
    out = str(tmp_path / "run")

    def embed(documents):
        return documents.withColumn("VECTOR", F.array(F.length("SUMMARY").cast("float"), F.col("STORE_NBR").cast("float")))

    tables = weekly_run.run(spark, raw, out, "2024-01-01 00:00:00", threshold=0.5, size=SMALL, embed=embed)
    assert tables["SALES_WEEKLY"].count() == 420
    assert rows(tables["SALES_WEEKLY"].agg(F.min("DAYS_IN_WEEK"), F.max("DAYS_IN_WEEK"), F.sum("HOLIDAY_DAYS")))[0] == (7, 7, 6)
    assert tables["FORECASTS"].count() == 6 and tables["FORECASTS"].where("FORECAST > 0").count() == 6
    assert tables["STORE_SUMMARIES"].count() == 4 and tables["INDEX"].count() == 4

    second = weekly_run.run(spark, raw, out, "2024-01-08 00:00:00", threshold=0.5, size=SMALL)
    assert second["FORECASTS"].count() == 12 and second["ACCURACY_LOG"].count() == 2

    with pytest.raises(weekly_run.GateFailed):
        weekly_run.run(spark, raw, out, "2024-01-15 00:00:00", threshold=-1.0, size=SMALL)
    log = spark.read.schema(schemas.ACCURACY_LOG).parquet(f"{out}/ANALYTICS/ACCURACY_LOG")
    assert rows(log.select("RUN_TS", "PASSED"), "RUN_TS")[-1] == ("2024-01-15 00:00:00", False)
    assert spark.read.schema(schemas.FORECASTS).parquet(f"{out}/ANALYTICS/FORECASTS").count() == 12


def test_enriched_table_is_kept_on_request(spark, raw, tmp_path):
    tables = weekly_run.stage(spark, raw, str(tmp_path / "run"), keep_enriched=True)
    assert tables["SALES_DAILY_ENRICHED"].count() == 2940


def test_weekly_run_reads_other_date_formats_and_refuses_unreadable_dates(spark, raw, tmp_path):
    from pyspark.sql import functions as F

    other = {t: df.withColumn("DATE", F.date_format(F.to_date("DATE"), "dd.MM.yyyy")) if "DATE" in df.columns else df for t, df in raw.items()}
    with pytest.raises(ValueError, match="no readable date"):
        weekly_run.stage(spark, other, str(tmp_path / "refused"))
    read = weekly_run.stage(spark, other, str(tmp_path / "read"), date_formats=("dd.MM.yyyy",))
    plain = weekly_run.stage(spark, raw, str(tmp_path / "plain"))
    assert sorted(read["SALES_WEEKLY"].collect()) == sorted(plain["SALES_WEEKLY"].collect())
    assert set(read["STAGING_CHECKS"].columns) == {"DAILY_TOTAL", "WEEKLY_TOTAL", "OIL_GAPS"}


def test_weekly_run_refuses_duplicate_stores(spark, raw, tmp_path):
    doubled = {**raw, "STORES": raw["STORES"].union(raw["STORES"])}
    with pytest.raises(ValueError, match="STORES has duplicate keys"):
        weekly_run.stage(spark, doubled, str(tmp_path / "run"))


def test_backtest_run_stores_both_tables(spark, seasonal, tmp_path):
    results, predictions = backtest_run.run_backtest(spark, seasonal, str(tmp_path), SMALL, n_weeks=2)
    assert predictions.count() == 24
    assert set(predictions.columns) == {
        "STORE_NBR", "FAMILY", "WEEK_START", "SALES", "IS_TOP", "PRED_NAIVE52", "PRED_ARIMA", "PRED_TREND", "PRED_GBT"}
    assert {r["MODEL"] for r in results.collect()} == {"naive_52", "arima_fourier", "trend_season", "gbt_global"}


def test_a_split_sends_missing_values_where_they_fit_best(spark):
    """One tree of depth 1 equals the best split over all inputs, thresholds and sides for missing values."""
    import itertools
    import random

    from weekloom.fixed_values import MODEL_INPUTS

    draw = random.Random(3)
    for good_side in (-1, 1):  # missing values behave like small, then like large ones
        data = []
        for i in range(90):
            lag = None if i % 4 == 0 else float(draw.randint(1, 12))
            level = (9.0 if good_side > 0 else 1.0) if lag is None else lag
            data.append((1 + i % 3, "AB"[i % 2], week(i), 100.0 * (level > 6) + draw.random(), lag, 5.0, draw.choice([None, 1.0, 2.0])))
        frame = spark.createDataFrame(data, "STORE_NBR bigint, FAMILY string, WEEK_START date, SALES double, SALES_LAG_1 double, SALES_LAG_52 double, SALES_LAG_2 double")
        filled = frame.withColumns({c: F.lit(1.0) for c in MODEL_INPUTS if c not in frame.columns and not c.endswith("_CODE")})
        vectors = global_model.model_rows(filled.withColumn("STORE_TYPE", F.lit("T")).withColumn("IS_FUTURE", F.lit(0)), n_weeks=1)
        size = Boosting(trees=1, depth=1, rate=1.0, rows=1.0, columns="all")
        found = by(global_model.predict(global_model.fit(global_model.trainable(vectors), size), vectors), "WEEK_START")
        label = [math.log1p(r[3]) for r in data]
        best = None
        inputs = {"lag": [r[4] for r in data], "other": [r[6] for r in data], "store": [float(r[0]) for r in data], "family": [float(r[1] == "B") for r in data]}
        for values, missing_left in itertools.product(inputs.values(), (True, False)):
            for cut in sorted({v for v in values if v is not None}) + [math.inf]:
                left = [missing_left if v is None else v < cut for v in values]
                sides = [[y for y, at in zip(label, left) if at == side] for side in (True, False)]
                if all(sides):
                    means = [sum(s) / len(s) for s in sides]
                    error = sum((y - means[not at]) ** 2 for y, at in zip(label, left))
                    best = min(best or (math.inf,), (error, [means[not at] for at in left]))
        predicted = [math.log1p(found[week(i)]["PRED_GBT"]) for i in range(90)]
        assert predicted == pytest.approx(best[1], abs=1e-9)


def test_a_sweep_goes_on_from_finished_origins(spark, seasonal, tmp_path, monkeypatch):
    vectors, folder = global_model.model_rows(seasonal), str(tmp_path / "sweep")
    small = Boosting(trees=2, depth=2, bins=16)
    first = sorted(global_model.backtest(vectors, small, n_weeks=3, folder=folder).collect())
    fits = []
    plain = global_model.fit
    monkeypatch.setattr(global_model, "fit", lambda train, size: fits.append(size) or plain(train, size))
    again = global_model.backtest(vectors, small, n_weeks=3, folder=folder)
    assert not fits and sorted(again.collect()) == first and len(first) == 36
    base = next((tmp_path / "sweep").iterdir()) / "predictions"
    (base / str(week(167)) / "_SUCCESS").unlink()  # as if cut off there
    assert sorted(global_model.backtest(vectors, small, n_weeks=3, folder=folder).collect()) == first
    assert len(fits) == 1 and len(list(base.iterdir())) == 3
    global_model.backtest(vectors, Boosting(trees=1, depth=2, bins=16), n_weeks=1, folder=folder)
    assert len(fits) == 2  # another size has a folder of its own
