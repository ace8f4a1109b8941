"""The weekly batch: stage, features, accuracy gate, forecast, documents, index."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from weekloom import schemas
from weekloom.fixed_values import GATE_THRESHOLD
from weekloom.operators import global_model, narrative, quality, staging
from weekloom.operators.features import build_features
from weekloom.operators.global_model import Boosting
from weekloom.session import scratch_path
from weekloom.sources.tables import append_run, frequent_values, overwrite_table, overwrite_tracked, read_table
from weekloom.sources.vector_index import write_index

UNIQUE_KEYS = {
    "STORES": ["STORE_NBR"], "TRANSACTIONS_DAILY": ["STORE_NBR", "DATE"],
}
FORECAST_TABLE, LOG_TABLE = "ANALYTICS/FORECASTS", "ANALYTICS/ACCURACY_LOG"


class GateFailed(ValueError):
    """The newest week was predicted worse than the threshold allows."""


def _stored(
    spark: SparkSession, df: DataFrame, path: str, schema: str | None = None, partition: str | None = None
) -> DataFrame:
    overwrite_table(df, path, partition)
    return read_table(spark, path, schema)


def stage(
    spark: SparkSession, raw: Mapping[str, DataFrame], out: str, keep_enriched: bool = False,
    date_formats: tuple[str, ...] = (),
) -> dict[str, DataFrame]:
    """Write the staging tables. Each later table reads the stored earlier ones.

    Dates are ISO text or of one of ``date_formats``; a sale without a readable date stops
    the run before any later table is written.

    The weekly table does not need the enriched daily one, which is the largest
    of all; it is written only on request.
    """
    def keep(name: str, df: DataFrame, schema: str) -> DataFrame:
        return _stored(spark, df, f"{out}/STAGING/{name}", schema)

    daily_path = f"{out}/STAGING/SALES_DAILY"
    overwrite_tracked(staging.type_sales(raw["TRAIN"], date_formats), daily_path, "STORE_NBR")
    daily = read_table(spark, daily_path, schemas.SALES_DAILY)
    unread = quality.unparsed_dates(daily).first()[0]
    if unread:
        raise ValueError(f"{unread} rows of TRAIN have no readable date")
    stores = keep("STORES", staging.type_stores(raw["STORES"]), schemas.STORES)
    oil = keep("OIL_DAILY", staging.oil_daily(staging.type_oil(raw["OIL"], date_formats), daily), schemas.OIL_DAILY)
    events = staging.active_holidays(raw["HOLIDAYS_EVENTS"], date_formats)
    holidays = keep("STORE_HOLIDAYS", staging.store_holidays(events, stores), schemas.STORE_HOLIDAYS)
    traffic = keep("TRANSACTIONS_DAILY", staging.type_transactions(raw["TRANSACTIONS"], date_formats), schemas.TRANSACTIONS_DAILY)
    tables = {
        "SALES_DAILY": daily, "STORES": stores, "OIL_DAILY": oil, "STORE_HOLIDAYS": holidays,
        "TRANSACTIONS_DAILY": traffic,
    }
    for name, keys in UNIQUE_KEYS.items():
        quality.assert_unique(tables[name].dropna(subset=keys), keys, name)
    weekly = staging.weekly_sales(daily, stores, oil, holidays, traffic)
    if keep_enriched:
        enriched = staging.enrich(daily, stores, oil, holidays, traffic, hot=frequent_values(spark, daily_path))
        tables["SALES_DAILY_ENRICHED"] = keep("SALES_DAILY_ENRICHED", enriched, schemas.SALES_DAILY_ENRICHED)
    tables["SALES_WEEKLY"] = keep("SALES_WEEKLY", weekly, schemas.SALES_WEEKLY)
    totals = quality.reconcile(daily, tables["SALES_WEEKLY"])
    checks = totals.withColumn("OIL_GAPS", quality.oil_gaps(oil).scalar())
    tables["STAGING_CHECKS"] = _stored(spark, checks, f"{out}/STAGING/STAGING_CHECKS")
    return tables


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out: str,
    run_ts: str,
    threshold: float = GATE_THRESHOLD,
    size: Boosting = Boosting(),
    dense: bool = True,
    embed: Callable[[DataFrame], DataFrame] | None = None,
    date_formats: tuple[str, ...] = (),
) -> dict[str, DataFrame]:
    """Run all steps, writing every table below ``out``.

    The gate logs its result first and then raises ``GateFailed``; nothing is
    forecast in that case. Only the check of this very run decides, whatever the log
    has under the same ``run_ts``. ``embed`` adds a VECTOR column to the documents; the
    index is built only when it is given.
    """
    tables = stage(spark, raw, out, date_formats=date_formats)
    features = build_features(tables["SALES_WEEKLY"], tables["STORE_HOLIDAYS"], dense=dense)
    tables["FEATURES"] = _stored(
        spark, features, f"{out}/ANALYTICS/FEATURES", schemas.FEATURES, partition="IS_FUTURE"
    )

    rows = global_model.model_rows(tables["FEATURES"])
    this_check = _stored(spark, global_model.gate(rows, run_ts, threshold, size), scratch_path(spark, "gate"))
    append_run(this_check, f"{out}/{LOG_TABLE}")
    tables["ACCURACY_LOG"] = read_table(spark, f"{out}/{LOG_TABLE}", schemas.ACCURACY_LOG)
    if not this_check.where("NOT PASSED").isEmpty():
        raise GateFailed(f"quality gate failed: WAPE above {threshold}")

    append_run(global_model.forecast(rows, run_ts, size), f"{out}/{FORECAST_TABLE}")
    tables["FORECASTS"] = read_table(spark, f"{out}/{FORECAST_TABLE}", schemas.FORECASTS)
    return refresh_documents(spark, tables, out, embed)


def refresh_documents(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    out: str,
    embed: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Rebuild the summaries of the latest forecast, then the index."""
    facts = narrative.fact_frame(tables["FORECASTS"], tables["FEATURES"], tables["STORES"])
    facts = _stored(spark, facts, scratch_path(spark, "facts"))  # read by each part of the documents
    documents = _stored(
        spark, narrative.summaries(facts), f"{out}/ANALYTICS/STORE_SUMMARIES", schemas.STORE_SUMMARIES
    )
    tables["STORE_SUMMARIES"] = documents
    if embed is not None:
        write_index(embed(documents), f"{out}/ANALYTICS/INDEX")
        tables["INDEX"] = read_table(spark, f"{out}/ANALYTICS/INDEX", schemas.VECTOR_INDEX)
    return tables
