"""English summaries of the latest forecast, one per store and one for the chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.fixed_values import (
    CHAIN_TEMPLATE, FAMILY_LINE_TEMPLATE, KEYS, MOVES_PER_STORE, STORE_LINE_TEMPLATE, STORE_TEMPLATE,
    STORES_PER_CHAIN_LIST,
)
from weekloom.functions.casts import to_double
from weekloom.functions.dates import iso_text
from weekloom.functions.text import direction, percent_change, ratio_percent_change, thousands
from weekloom.sources.tables import latest_run, weeks_of


def fact_frame(forecasts: DataFrame, features: DataFrame, stores: DataFrame) -> DataFrame:
    """Latest forecasts with the features and store of the same series and week."""
    numbers = {
        "SALES_LAG_1": "LAST_WEEK", "SALES_LAG_52": "SAME_WEEK_LAST_YEAR", "SALES_ROLL_MEAN_4": "AVG_4WK",
        "PROMO_ITEMS": "PROMO_ITEMS", "HOLIDAY_DAYS": "HOLIDAY_DAYS",
    }
    latest = latest_run(forecasts)
    facts = weeks_of(features, latest).select(*KEYS, *[to_double(F.col(c)).alias(n) for c, n in numbers.items()])
    places = stores.select("STORE_NBR", "CITY", "STATE", "STORE_TYPE")
    return (
        latest.select(*KEYS, to_double(F.col("FORECAST")).alias("FORECAST"))
        .join(facts, KEYS).join(places, "STORE_NBR")
        .withColumn("HOLIDAY_DAYS", F.coalesce("HOLIDAY_DAYS", F.lit(0.0)))
    )


def total(column: str) -> Column:
    """Sum with missing as 0, free of summation-order noise."""
    return F.round(F.coalesce(F.sum(column), F.lit(0.0)), 6)


def family_moves(facts: DataFrame, n: int = MOVES_PER_STORE) -> DataFrame:
    """Per store: the n largest rises and falls against the 4-week mean, as text.

    Ranks are cut per task before the shuffle, so a store never gathers more than
    n candidates per task and direction.
    """
    lines = facts.select(
        "STORE_NBR", "FAMILY", F.round(F.col("FORECAST") - F.col("AVG_4WK"), 6).alias("CHANGE"),
        F.format_string(
            FAMILY_LINE_TEMPLATE, F.col("FAMILY"), thousands(F.col("FORECAST")), thousands(F.col("AVG_4WK")),
            direction(percent_change(F.col("FORECAST"), F.col("AVG_4WK"))),
        ).alias("LINE"),
    ).where(F.col("CHANGE").isNotNull())

    def side(order: Column, name: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("STORE_NBR").orderBy(order, "FAMILY"))
        top = lines.withColumn("RN", rank).where(F.col("RN") <= n)
        ordered = F.sort_array(F.collect_list(F.struct("RN", "LINE")))
        return top.groupBy("STORE_NBR").agg(F.array_join(F.transform(ordered, lambda r: r["LINE"]), "; ").alias(name))

    return side(F.desc("CHANGE"), "MOVES_UP").join(side(F.asc("CHANGE"), "MOVES_DOWN"), "STORE_NBR", "full")


def store_totals(facts: DataFrame) -> DataFrame:
    """Per store: totals and counts behind its document."""
    return facts.groupBy("STORE_NBR").agg(
        F.any_value("CITY").alias("CITY"), F.any_value("STATE").alias("STATE"),
        F.any_value("STORE_TYPE").alias("STORE_TYPE"),
        total("FORECAST").alias("FC"), total("LAST_WEEK").alias("LW"),
        total("SAME_WEEK_LAST_YEAR").alias("LY"), total("AVG_4WK").alias("A4"),
        F.count_if(F.col("PROMO_ITEMS") > 0).alias("PROMO_FAMILIES"), F.count(F.lit(1)).alias("FAMILIES"),
        F.max("HOLIDAY_DAYS").cast("bigint").alias("HOLIDAYS"),
    )


def _week(facts: DataFrame) -> Column:
    return iso_text(facts.agg(F.max("WEEK_START")).scalar())


def store_documents(facts: DataFrame, week: Column | None = None) -> DataFrame:
    """STORE_NBR, WEEK_START, SUMMARY: one document per store; ``week`` if it isn't the newest one of these facts."""
    week = _week(facts) if week is None else week
    rows = store_totals(facts).join(family_moves(facts), "STORE_NBR", "left").withColumn("WEEK", week)
    fc = F.col("FC")

    def versus(old: str) -> list[Column]:
        return [direction(percent_change(fc, F.col(old))), thousands(F.col(old))]

    summary = F.format_string(
        STORE_TEMPLATE, F.col("STORE_NBR"), *[F.coalesce(c, F.lit("None")) for c in ("CITY", "STATE", "STORE_TYPE")],
        F.col("WEEK"), thousands(fc), *versus("LW"), *versus("A4"), *versus("LY"),
        F.coalesce("MOVES_UP", F.lit("")), F.coalesce("MOVES_DOWN", F.lit("")),
        F.col("PROMO_FAMILIES"), F.col("FAMILIES"), F.col("HOLIDAYS"),
    )
    return rows.select(F.col("STORE_NBR").cast("bigint").alias("STORE_NBR"), F.col("WEEK").alias("WEEK_START"), summary.alias("SUMMARY"))


def store_changes(facts: DataFrame) -> DataFrame:
    """Per store: forecast and last-week totals and their unguarded change."""
    sums = facts.groupBy("STORE_NBR").agg(total("FORECAST").alias("FC"), total("LAST_WEEK").alias("LW"))
    return sums.withColumn("PCT", ratio_percent_change(F.col("FC"), F.col("LW")))


def chain_document(facts: DataFrame, n: int = STORES_PER_CHAIN_LIST) -> DataFrame:
    """The chain-wide document, as store 0."""
    line = F.format_string(STORE_LINE_TEMPLATE, F.col("STORE_NBR"), direction(F.col("PCT"))).alias("LINE")
    changes = store_changes(facts).where(F.col("PCT").isNotNull()).select("STORE_NBR", "PCT", line)

    def listing(best_first: Column, sort_key: Column) -> Column:
        chosen = changes.orderBy(best_first, "STORE_NBR").limit(n)
        ordered = F.sort_array(F.collect_list(F.struct(sort_key.alias("K"), "STORE_NBR", "LINE")))
        return chosen.agg(F.array_join(F.transform(ordered, lambda r: r["LINE"]), ", ")).scalar()

    chain = facts.agg(
        total("FORECAST").alias("FC"), total("LAST_WEEK").alias("LW"), iso_text(F.max("WEEK_START")).alias("WEEK"),
        F.count_distinct("STORE_NBR").alias("STORES"), F.count_distinct("FAMILY").alias("FAMILIES"),
    ).where(F.col("WEEK").isNotNull())
    summary = F.format_string(
        CHAIN_TEMPLATE, F.col("WEEK"), thousands(F.col("FC")), F.col("STORES"), F.col("FAMILIES"),
        direction(percent_change(F.col("FC"), F.col("LW"))), thousands(F.col("LW")),
        listing(F.desc("PCT"), -F.col("PCT")), listing(F.asc("PCT"), F.col("PCT")),
    )
    return chain.select(F.lit(0).cast("bigint").alias("STORE_NBR"), F.col("WEEK").alias("WEEK_START"), summary.alias("SUMMARY"))


def summaries(facts: DataFrame) -> DataFrame:
    """All documents: the stores' and the chain's."""
    return store_documents(facts).unionByName(chain_document(facts))
