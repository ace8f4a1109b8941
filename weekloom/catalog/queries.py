"""Every named query: (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom import schemas
from weekloom.catalog.frames import CHECK_THRESHOLD, NEW_RUN, OLD_RUN, Frames, money, rounded
from weekloom.fixed_values import KEYS, NAIVE_MODEL, RAW_FILES, SERIES
from weekloom.functions import casts
from weekloom.operators import (
    answers, audit, clustered_search, features, global_model, narrative, quality, reports, retrieval, scoring, series_models, staging,
)
from weekloom.plans import refresh
from weekloom.session import scratch_path
from weekloom.sources import raw, star, tables, vector_index

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Frames(spark, sf_dir))

    call.__name__, call.__doc__ = fn.__name__, fn.__doc__
    _QUERIES[fn.__name__] = call
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


WEEKLY_DIGITS = {"SALES": 2, "AVG_OIL_PRICE": 6}
FEATURE_DIGITS = {
    "SALES": 2, "AVG_OIL_PRICE": 6, "SALES_LAG_1": 2, "SALES_LAG_2": 2, "SALES_LAG_4": 2, "SALES_LAG_52": 2,
    "SALES_ROLL_MEAN_4": 6, "SALES_ROLL_MEAN_12": 6, "SALES_ROLL_STD_12": 6,
}


# --- sources and sinks --------------------------------------------------------

@query
def csv_scan(f: Frames) -> DataFrame:
    """Prices written as CSV and read back as text: upper-case names, NULL tokens."""
    path = scratch_path(f.spark, "oil-csv")
    prices = star.oil(f.table).select(
        F.col("DATE").alias("date"), F.coalesce("DCOILWTICO", F.lit("N/A")).alias("dcoilwtico")
    )
    prices.write.option("header", True).csv(path)
    return raw.read_csv_text(f.spark, path)


@query
def raw_load_counts(f: Frames) -> DataFrame:
    """Multi-file CSV load: rows per raw table."""
    folder, out = scratch_path(f.spark, "csv"), scratch_path(f.spark, "raw")
    derived = star.raw_tables(f.table)
    derived["TRAIN"] = f.stored(derived["TRAIN"], "train")  # two files come of it
    derived["TEST"] = derived["TRAIN"].drop("SALES")
    files = {name: table for name, table in RAW_FILES.items() if table in derived}
    for name, table in files.items():
        derived[table].write.option("header", True).csv(f"{folder}/{name}")
    loaded = raw.load_raw(f.spark, folder, out, files)
    counts = [
        frame.agg(F.lit(table).alias("TABLE_NAME"), F.count(F.lit(1)).alias("N_ROWS"), F.lit(loaded[table]).cast("bigint").alias("N_REPORTED"))
        for table, frame in raw.read_raw(f.spark, out, files).items()
    ]
    out_rows = counts[0]
    for part in counts[1:]:
        out_rows = out_rows.unionByName(part)
    return out_rows


@query
def overwrite_sink(f: Frames) -> DataFrame:
    """A table replaced by a second write holds only the second content."""
    path = scratch_path(f.spark, "stores")
    tables.overwrite_table(f.stores, path)
    tables.overwrite_table(f.stores.where(F.col("STORE_TYPE") != "A"), path)
    return tables.read_table(f.spark, path, schemas.STORES)


@query
def append_log(f: Frames) -> DataFrame:
    """Rows and total per run of an append-only forecast log."""
    rows = f.forecasts.groupBy("RUN_TS", "MODEL").agg(
        F.count(F.lit(1)).alias("N_ROWS"), F.sum("FORECAST").alias("TOTAL_FORECAST")
    )
    return rounded(rows, TOTAL_FORECAST=6)


@query
def append_replay(f: Frames) -> DataFrame:
    """A log whose newer run was cut short and written again: each row once, and every run as its note says."""
    path = scratch_path(f.spark, "replayed")
    schema = schemas.FORECASTS
    tables.append_run(f.forecasts.where((F.col("RUN_TS") == OLD_RUN) | (F.col("STORE_NBR") % 2 == 0)), path)
    tables.append_run(f.forecasts.where(F.col("RUN_TS") == NEW_RUN), path)
    log = tables.read_table(f.spark, path, schema)
    found = log.groupBy("RUN_TS", "MODEL").agg(
        F.count(F.lit(1)).alias("N_ROWS"), F.count_distinct(*KEYS).alias("N_DIFFERENT"), F.sum("FORECAST").alias("TOTAL_FORECAST"))
    status = tables.run_status(f.spark, path, schema).select("RUN_TS", "N_NOTED", "SETTLED")
    return rounded(found.join(status, "RUN_TS"), TOTAL_FORECAST=6)


@query
def latest_run(f: Frames) -> DataFrame:
    return rounded(tables.latest_run(f.forecasts), FORECAST=2)


@query
def rows_json(f: Frames) -> DataFrame:
    """The newest 100 weekly rows as JSON records, with a sum that isn't exact in binary."""
    week = rounded(f.weekly, SALES=2, AVG_OIL_PRICE=6).withColumn("TENTHS", F.lit(0.1) + F.lit(0.2)).select(
        "WEEK_START", "STORE_NBR", "FAMILY", "PROMO_ITEMS", "STORE_TRANSACTIONS", "SALES", "AVG_OIL_PRICE", "TENTHS", "CITY")
    return tables.rows_as_json(week, F.desc("WEEK_START"), F.col("STORE_NBR"), F.col("FAMILY"))


@query
def vector_index_roundtrip(f: Frames) -> DataFrame:
    """The index written and read back: one row per document."""
    documents = f.table("embeddings").select(
        F.col("vec_id").alias("STORE_NBR"), F.lit("2001-10-29").alias("WEEK_START"),
        F.concat(F.lit("document "), F.col("vec_id").cast("string")).alias("SUMMARY"), F.col("embedding").alias("VECTOR"),
    )
    path = scratch_path(f.spark, "index")
    vector_index.write_index(documents, path)
    stored = vector_index.read_index(f.spark, path)
    return stored.select(
        "store_nbr", "week_start", "text", F.size("vector").cast("bigint").alias("dims"),
        F.round(F.get("vector", F.lit(0)).cast("double"), 5).alias("first_value"),
    )


# --- staging ------------------------------------------------------------------

@query
def typed_sales(f: Frames) -> DataFrame:
    return f.daily


@query
def typed_stores(f: Frames) -> DataFrame:
    return f.stores


@query
def typed_transactions(f: Frames) -> DataFrame:
    return f.traffic


@query
def tolerant_casts(f: Frames) -> DataFrame:
    """Casts of good and bad text made from every order."""
    key = F.col("o_orderkey").cast("string")
    day = F.col("o_orderdate").cast("date").cast("string")
    dates = F.array(
        day, F.substring(day, 1, 4), F.lit("01/02/2013"), F.lit("2013-13-01"), F.lit(""), F.lit(None).cast("string"),
        F.concat(day, F.lit("x")), F.substring(day, 1, 7),
    )
    numbers = F.array(
        key, F.concat(key, F.lit(".5")), F.concat(key, F.lit(".4")), F.concat(F.lit("  "), key, F.lit(" ")),
        F.lit("x"), F.lit("NaN"), F.lit("n/a"), F.concat(F.lit("-"), key, F.lit(".7")),
    )
    choice = (F.col("o_orderkey") % 8).cast("int")
    texts = f.table("orders").select(
        F.col("o_orderkey").alias("ORDER_KEY"), F.get(dates, choice).alias("D"), F.get(numbers, choice).alias("N")
    )
    cleaned = raw.blank_missing(texts)
    return cleaned.select(
        "ORDER_KEY", casts.to_date(F.col("D")).alias("DAY"), casts.to_long(F.col("N")).alias("WHOLE"),
        casts.to_double(F.col("N")).alias("REAL"), F.col("N").alias("TEXT"),
    )


@query
def calendar_oil_fill(f: Frames) -> DataFrame:
    return f.oil


@query
def oil_fill_bucketed(f: Frames) -> DataFrame:
    """The same fill with yearly instead of monthly buckets."""
    return staging.oil_daily(f.prices, star.sales_dates(f.table), bucket="year")


@query
def store_holidays(f: Frames) -> DataFrame:
    return f.holidays


@query
def sales_enriched(f: Frames) -> DataFrame:
    return f.enriched


@query
def weekly_rollup(f: Frames) -> DataFrame:
    return rounded(f.weekly, **WEEKLY_DIGITS)


@query
def weekly_from_enriched(f: Frames) -> DataFrame:
    """The rollup of the joined daily table; equals ``weekly_rollup``."""
    return rounded(staging.rollup_weekly(f.enriched).select(f.weekly.columns), **WEEKLY_DIGITS)


@query
def weekly_preview(f: Frames) -> DataFrame:
    return rounded(quality.weekly_preview(f.weekly), **WEEKLY_DIGITS)


# --- data quality -------------------------------------------------------------

@query
def dq_reconcile(f: Frames) -> DataFrame:
    return quality.reconcile(f.daily, f.weekly)


@query
def dq_unparsed_dates(f: Frames) -> DataFrame:
    return quality.unparsed_dates(f.daily)


@query
def dq_oil_gaps(f: Frames) -> DataFrame:
    return quality.oil_gaps(f.oil)


@query
def dq_partial_weeks(f: Frames) -> DataFrame:
    return quality.partial_weeks(f.weekly)


@query
def dq_duplicate_keys(f: Frames) -> DataFrame:
    """Store-days with several line items (duplicate keys of the untyped lines)."""
    lines = f.table("lineitem").select((F.col("l_suppkey") + 1).alias("STORE_NBR"), F.col("l_shipdate").cast("date").alias("DATE"))
    return quality.duplicate_keys(lines, ["STORE_NBR", "DATE"])


@query
def dq_store_columns(f: Frames) -> DataFrame:
    """Stores with conflicting attributes in the enriched table (none expected)."""
    return quality.conflicting_store_columns(f.enriched, staging.STORE_COLUMNS)


# --- features -----------------------------------------------------------------

@query
def weekly_trimmed(f: Frames) -> DataFrame:
    return rounded(f.kept, **WEEKLY_DIGITS)


@query
def weekly_dense(f: Frames) -> DataFrame:
    return rounded(f.dense, **WEEKLY_DIGITS)


@query
def feature_lags(f: Frames) -> DataFrame:
    return rounded(f.features.select(*KEYS, "IS_FUTURE", "SALES_LAG_1", "SALES_LAG_2", "SALES_LAG_4", "SALES_LAG_52"),
                   SALES_LAG_1=2, SALES_LAG_2=2, SALES_LAG_4=2, SALES_LAG_52=2)


@query
def feature_rolling(f: Frames) -> DataFrame:
    return rounded(f.features.select(*KEYS, "IS_FUTURE", "SALES_ROLL_MEAN_4", "SALES_ROLL_MEAN_12", "SALES_ROLL_STD_12"),
                   SALES_ROLL_MEAN_4=6, SALES_ROLL_MEAN_12=6, SALES_ROLL_STD_12=6)


@query
def feature_calendar(f: Frames) -> DataFrame:
    return f.features.select(*KEYS, "IS_FUTURE", "WEEK_OF_YEAR", "MONTH", "YEAR")


@query
def feature_table(f: Frames) -> DataFrame:
    """The whole FEATURES table."""
    return rounded(f.features, **FEATURE_DIGITS)


@query
def features_sparse(f: Frames) -> DataFrame:
    """Row-offset lags on the weeks as they are, without filling."""
    sparse = features.build_features(f.stored_weekly, f.holidays, f.stored_edges, dense=False)
    return rounded(sparse, **FEATURE_DIGITS)


@query
def future_rows(f: Frames) -> DataFrame:
    """History and forecast rows of the unfilled weekly table."""
    next_week = f.forecast_week
    rows = features.add_next_week(features.with_next_holidays(f.kept, f.holidays, next_week), next_week)
    return rounded(rows, **WEEKLY_DIGITS)


@query
def category_codes(f: Frames) -> DataFrame:
    """Codes of family and store type for every series."""
    series = f.stored(f.weekly.select(*SERIES, "STORE_TYPE").distinct(), "series")
    coded = series
    for column, name in [("FAMILY", "FAMILY_CODE"), ("STORE_TYPE", "STORE_TYPE_CODE")]:
        coded = features.attach_codes(coded, column, features.category_codes(series, column), name)
    return coded.select(*SERIES, "STORE_TYPE", "FAMILY_CODE", "STORE_TYPE_CODE")


@query
def fourier_terms(f: Frames) -> DataFrame:
    placed = features.series_position(f.dense.select(*KEYS))
    waves = placed.select(*KEYS, "T", *features.fourier_columns(F.col("T")))
    return rounded(waves, **{f"{w}_{k}": 6 for k in (1, 2, 3) for w in ("SIN", "COS")})


@query
def top_series(f: Frames) -> DataFrame:
    return scoring.top_series(f.kept)


@query
def test_weeks(f: Frames) -> DataFrame:
    return scoring.test_weeks(f.kept)


@query
def series_tail(f: Frames) -> DataFrame:
    """Last 30 weeks of the biggest series with its test-week predictions."""
    history = reports.biggest_series_history(f.actuals, scoring.top_series(f.stored_kept))
    predictions = f.tested.select(*KEYS, "PRED_NAIVE52", "PRED_MEAN4")
    return rounded(history.join(predictions, KEYS, "left"), SALES=2, PRED_NAIVE52=2, PRED_MEAN4=6)


# --- models and scores --------------------------------------------------------

@query
def naive_backtest(f: Frames) -> DataFrame:
    return rounded(f.tested.select(*KEYS, "SALES", "IS_TOP", "PRED_NAIVE52"), SALES=2, PRED_NAIVE52=2)


@query
def ma4_backtest(f: Frames) -> DataFrame:
    """The 4-week mean attached by key, for the biggest series only."""
    rows = f.tested.select(*KEYS, "SALES", "IS_TOP")
    means = f.tested.where("IS_TOP").select(*KEYS, "PRED_MEAN4")
    return rounded(scoring.attach_predictions(rows, means, "PRED_MEAN4"), SALES=2, PRED_MEAN4=6)


@query
def model_results(f: Frames) -> DataFrame:
    return rounded(f.results, WAPE=6, RMSE=4)


@query
def model_comparison(f: Frames) -> DataFrame:
    return scoring.compare_models(f.stored(f.results, "model-results"))


@query
def model_ranking(f: Frames) -> DataFrame:
    return rounded(scoring.rank_models(f.results), WAPE=6)


@query
def gate_log(f: Frames) -> DataFrame:
    held_out = f.held_out.withColumn("PRED", scoring.naive_prediction())
    return rounded(scoring.gate_log(held_out, "PRED", NAIVE_MODEL, NEW_RUN, CHECK_THRESHOLD), WAPE=6)


@query
def forecast_naive(f: Frames) -> DataFrame:
    future = f.future.withColumn("PRED", scoring.naive_prediction())
    return rounded(scoring.forecast_rows(future, "PRED", NAIVE_MODEL, NEW_RUN), FORECAST=2)


@query
def gbt_forecast(f: Frames) -> DataFrame:
    """Trained at the stated size: 400 trees of depth 8."""
    return global_model.forecast(f.model_rows, NEW_RUN, model=f.full_model)


@query
def gbt_gate(f: Frames) -> DataFrame:
    return global_model.gate(f.model_rows, NEW_RUN, CHECK_THRESHOLD)


@query
def gbt_importance(f: Frames) -> DataFrame:
    return global_model.importance(f.spark, f.full_model)


@query
def arima_fourier_backtest(f: Frames) -> DataFrame:
    return series_models.backtest_arima(f.actuals, scoring.test_weeks(f.stored_kept))


@query
def trend_season_backtest(f: Frames) -> DataFrame:
    return series_models.backtest_trend_season(f.actuals, scoring.test_weeks(f.stored_kept))


def _valid(rows: DataFrame) -> DataFrame:
    """Keys and sales of predicted rows, and whether each prediction is a finite number of 0 or more."""
    good = F.col("PRED").isNotNull() & ~F.isnan("PRED") & F.col("PRED").between(0, 1e15)
    return rounded(rows.select(*KEYS, "SALES", F.coalesce(good, F.lit(False)).alias("VALID")), SALES=2)


@query
def arima_fourier_checked(f: Frames) -> DataFrame:
    return _valid(series_models.backtest_arima(f.actuals, scoring.test_weeks(f.stored_kept)).join(f.tested.select(*KEYS, "SALES"), KEYS))


@query
def trend_season_checked(f: Frames) -> DataFrame:
    return _valid(series_models.backtest_trend_season(f.actuals, scoring.test_weeks(f.stored_kept)).join(f.tested.select(*KEYS, "SALES"), KEYS))


@query
def series_fits_checked(f: Frames) -> DataFrame:
    """What both per-series fits must hold to, for every series."""
    return series_models.check_fits(f.actuals, scoring.test_weeks(f.stored_kept))


def _valid_number(column: str) -> Column:
    good = F.col(column).isNotNull() & ~F.isnan(column) & F.col(column).between(0, 1e15)
    return F.coalesce(good, F.lit(False)).alias(column.replace("PRED_", "VALID_"))


@query
def backtest_predictions(f: Frames) -> DataFrame:
    """The stored table of a backtest run over all series and eight origins; the boosted model at a small size."""
    models = [_valid_number(c) for c in ("PRED_ARIMA", "PRED_TREND", "PRED_GBT")]
    return rounded(f.backtest.select(*KEYS, "SALES", "IS_TOP", "PRED_NAIVE52", *models), SALES=2, PRED_NAIVE52=2)


@query
def forecast_example(f: Frames) -> DataFrame:
    """The biggest series' last 30 weeks with the test-week predictions of all models, the boosted one at a small size."""
    models = ["PRED_NAIVE52", "PRED_ARIMA", "PRED_TREND", "PRED_GBT"]
    predictions = f.backtest
    history = reports.biggest_series_history(f.actuals, scoring.top_series(f.stored_kept))
    both = reports.forecast_example(history, predictions, models)
    return rounded(both.select(*KEYS, "SALES", "PRED_NAIVE52", *map(_valid_number, models[1:])), SALES=2, PRED_NAIVE52=2)


# --- reports ------------------------------------------------------------------

@query
def eda_weekly_total(f: Frames) -> DataFrame:
    return reports.weekly_total(money(f.kept)).withColumn("SALES", F.col("SALES").cast("double"))


@query
def eda_top_families(f: Frames) -> DataFrame:
    return reports.top_families(money(f.kept)).withColumn("SALES", F.col("SALES").cast("double"))


@query
def eda_seasonality(f: Frames) -> DataFrame:
    return rounded(_real(reports.seasonality(money(f.kept))), AVG_SALES=6)


@query
def eda_promo(f: Frames) -> DataFrame:
    return rounded(_real(reports.sales_by_flag(money(f.kept), "PROMO_ITEMS", "HAS_PROMO")), AVG_SALES=6)


@query
def eda_holiday(f: Frames) -> DataFrame:
    return rounded(_real(reports.sales_by_flag(money(f.kept), "HOLIDAY_DAYS", "HAS_HOLIDAY")), AVG_SALES=6)


def _real(df: DataFrame) -> DataFrame:
    return df.withColumn("AVG_SALES", F.col("AVG_SALES").cast("double"))


@query
def q_top_stores(f: Frames) -> DataFrame:
    return rounded(reports.top_stores(f.forecasts), TOTAL_FORECAST=2)


@query
def q_top_family(f: Frames) -> DataFrame:
    return rounded(reports.top_family(f.forecasts), TOTAL_FORECAST=2)


@query
def q_latest_wape(f: Frames) -> DataFrame:
    return rounded(reports.newest_check(f.accuracy_log).select("WAPE"), WAPE=6)


@query
def q_best_model(f: Frames) -> DataFrame:
    return rounded(reports.best_model(f.results), WAPE=6)


@query
def q_series_count(f: Frames) -> DataFrame:
    return reports.forecast_count(f.forecasts)


@query
def q_top_city(f: Frames) -> DataFrame:
    return reports.city_with_most_stores(f.stores)


@query
def q_total_forecast(f: Frames) -> DataFrame:
    return rounded(reports.forecast_total(f.forecasts), TOTAL_FORECAST=2)


@query
def q_store_declines(f: Frames) -> DataFrame:
    declines = reports.store_declines(f.run_log(f.future_sales), f.future_sales)
    return rounded(declines, TOTAL_FORECAST=2, LAST_WEEK=2, CHANGE_RATIO=6)


@query
def q_gate_passed(f: Frames) -> DataFrame:
    return reports.newest_check(f.accuracy_log).select("MODEL", "PASSED")


@query
def q_family_change(f: Frames) -> DataFrame:
    change = reports.family_change(f.run_log(f.future_sales), f.future_sales)
    return rounded(change, TOTAL_FORECAST=2, LAST_WEEK=2, PCT_CHANGE=6)


# --- documents and retrieval --------------------------------------------------

@query
def fact_frame(f: Frames) -> DataFrame:
    return rounded(f.facts, FORECAST=2, LAST_WEEK=2, SAME_WEEK_LAST_YEAR=2, AVG_4WK=6)


@query
def family_moves(f: Frames) -> DataFrame:
    return narrative.family_moves(f.facts)


@query
def store_documents(f: Frames) -> DataFrame:
    return narrative.store_documents(f.facts)


@query
def chain_document(f: Frames) -> DataFrame:
    return narrative.chain_document(f.facts)


@query
def store_summaries(f: Frames) -> DataFrame:
    """All documents: the stores' and the chain's."""
    return narrative.summaries(f.facts)


@query
def document_refresh(f: Frames) -> DataFrame:
    """Two refreshes: a fifth of the stores is new in the second, a fifth changed, a fifth vanished."""
    out, kind = scratch_path(f.spark, "refreshed"), F.col("STORE_NBR") % 5
    before = f.facts.where(kind != 0).withColumn("FORECAST", F.col("FORECAST") + F.when(kind == 1, 1000.0).otherwise(0.0))
    refresh.refresh_changed(f.spark, f.stored(before, "facts-before"), out, OLD_RUN)
    states = refresh.refresh_changed(f.spark, f.stored(f.facts.where(kind != 2), "facts-now"), out, NEW_RUN)
    log = refresh.document_log(f.spark, out)
    logged = log.groupBy("STORE_NBR").agg(F.count(F.lit(1)).alias("N_LOGGED"))
    current = refresh.current_documents(log).select("STORE_NBR", "WEEK_START", "SUMMARY")
    return states.drop("DIGEST").join(logged, "STORE_NBR").join(current, "STORE_NBR", "left")


@query
def vector_normalise(f: Frames) -> DataFrame:
    values = f.index.select("vec_id", F.posexplode("vector").alias("POS", "VALUE"))
    return rounded(values.withColumn("POS", F.col("POS").cast("bigint")), VALUE=6)


@query
def cosine_topk(f: Frames) -> DataFrame:
    return retrieval.semantic_search(f.index, f.question_vector, "vec_id", k=10)


@query
def hybrid_search(f: Frames) -> DataFrame:
    question = F.lit("Why is store 3's forecast lower than usual, unlike stores #7?")
    return retrieval.hybrid_search(f.index, question, f.question_vector, "vec_id", k=150)


@query
def batch_topk(f: Frames) -> DataFrame:
    ranked = retrieval.batch_search(f.index, f.questions, "vec_id", k=5)
    return ranked.withColumn("RANK", F.col("RANK").cast("bigint"))


@query
def clustered_topk(f: Frames) -> DataFrame:
    """The same questions, asked of clusters."""
    ranked = clustered_search.clustered_search(clustered_search.ClusteredIndex(f.index, "vec_id"), f.questions, "vec_id", k=5)
    return ranked.withColumn("RANK", F.col("RANK").cast("bigint"))


# --- query log and answers ----------------------------------------------------

@query
def sql_audit(f: Frames) -> DataFrame:
    return audit.audit_queries(f.query_log)


@query
def audit_summary(f: Frames) -> DataFrame:
    """Queries per verdict."""
    return audit.audit_queries(f.query_log).groupBy("VERDICT").agg(
        F.count(F.lit(1)).alias("N_QUERIES"), F.count_if("COMMA_JOIN").alias("N_COMMA_JOINS")
    )


@query
def document_numbers(f: Frames) -> DataFrame:
    """Numbers in every document's whole text."""
    found = f.table("documents").select("doc_id", answers.numbers_in(F.col("text")).alias("n"))
    return found.select(
        "doc_id", F.size("n").cast("bigint").alias("N_NUMBERS"),
        F.size(answers.whole(F.col("n"))).cast("bigint").alias("N_WHOLE"), F.array_max("n").alias("MAX_NUMBER"),
    )


@query
def answer_scoring(f: Frames) -> DataFrame:
    return answers.score_answers(f.answer_cases).select("CASE_ID", "KIND", "ANSWER", "PASSED")


@query
def answer_report(f: Frames) -> DataFrame:
    return answers.score_report(answers.score_answers(f.answer_cases)).drop("TRUTH")


@query
def answer_accuracy(f: Frames) -> DataFrame:
    scored = answers.score_answers(f.answer_cases)
    return rounded(answers.accuracy(scored, "KIND"), ACCURACY=6)
