"""Raw text tables to typed daily tables and the weekly sales table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.fixed_values import KEYS
from weekloom.functions.casts import to_date, to_double, to_long
from weekloom.functions.dates import week_start
from weekloom.operators.skew import HOT_ROWS, hot_values, repeat_rows, salt_rows, spread_join
from weekloom.session import partitions_for

WEEKDAYS = range(7)
STORE_COLUMNS = ["CITY", "STATE", "STORE_TYPE", "STORE_CLUSTER"]


# --- typed projections -------------------------------------------------------

def type_sales(raw: DataFrame, date_formats: tuple[str, ...] = ()) -> DataFrame:
    return raw.select(
        to_date(F.col("DATE"), date_formats).alias("DATE"),
        to_long(F.col("STORE_NBR")).alias("STORE_NBR"),
        F.col("FAMILY"),
        to_double(F.col("SALES")).alias("SALES"),
        to_long(F.col("ONPROMOTION")).alias("ONPROMOTION"),
    )


def type_stores(raw: DataFrame) -> DataFrame:
    return raw.select(
        to_long(F.col("STORE_NBR")).alias("STORE_NBR"),
        F.col("CITY"),
        F.col("STATE"),
        F.col("TYPE").alias("STORE_TYPE"),
        to_long(F.col("CLUSTER")).alias("STORE_CLUSTER"),
    )


def type_oil(raw: DataFrame, date_formats: tuple[str, ...] = ()) -> DataFrame:
    return raw.select(
        to_date(F.col("DATE"), date_formats).alias("DATE"),
        to_double(F.col("DCOILWTICO")).alias("OIL_PRICE"),
    )


def type_transactions(raw: DataFrame, date_formats: tuple[str, ...] = ()) -> DataFrame:
    return raw.select(
        to_date(F.col("DATE"), date_formats).alias("DATE"),
        to_long(F.col("STORE_NBR")).alias("STORE_NBR"),
        to_long(F.col("TRANSACTIONS")).alias("TRANSACTIONS"),
    )


# --- price calendar ----------------------------------------------------------

def calendar(daily: DataFrame) -> DataFrame:
    """One row per day from the first to the last sales date."""
    span = daily.agg(F.min("DATE").alias("lo"), F.max("DATE").alias("hi")).where(F.col("lo").isNotNull())
    return span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("DATE"))


def fill_forward(
    df: DataFrame, day: str, value: str, keys: tuple[str, ...] = (), bucket: str = "month"
) -> DataFrame:
    """Replace NULLs of ``value`` by the last earlier non-NULL one (per ``keys``).

    Two levels, so no task ever holds a whole history: each calendar bucket is
    filled on its own, and the closing value of the buckets before it is carried
    in. Only the one-row-per-bucket closing table is ordered as a whole.
    """
    rows = df.withColumn("_BUCKET", F.trunc(F.col(day), bucket))
    known = F.struct(F.col(day), F.col(value))
    closing = rows.groupBy(*keys, "_BUCKET").agg(
        F.max(F.when(F.col(value).isNotNull(), known))[value].alias("_CLOSE")
    )
    earlier = Window.partitionBy(*keys).orderBy("_BUCKET").rowsBetween(Window.unboundedPreceding, -1)
    opening = closing.select(
        *keys, "_BUCKET", F.last("_CLOSE", ignorenulls=True).over(earlier).alias("_OPEN")
    )
    if not keys:  # one row per calendar bucket: a few hundred rows
        opening = F.broadcast(opening)
    inside = Window.partitionBy(*keys, "_BUCKET").orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("_OPEN"))
    return rows.join(opening, [*keys, "_BUCKET"], "left").withColumn(value, filled).drop("_BUCKET", "_OPEN")


def oil_daily(oil: DataFrame, daily: DataFrame, bucket: str = "month") -> DataFrame:
    """Every calendar day with the most recent known price.

    Prices are reduced to one per day first, so the result has exactly one row
    per calendar day and may be broadcast wherever it is joined.
    """
    one_per_day = oil.groupBy("DATE").agg(F.max("OIL_PRICE").alias("OIL_PRICE"))
    days = calendar(daily).join(one_per_day, "DATE", "left")
    return fill_forward(days, "DATE", "OIL_PRICE", bucket=bucket).select("DATE", "OIL_PRICE")


# --- store holidays ----------------------------------------------------------

def active_holidays(raw: DataFrame, date_formats: tuple[str, ...] = ()) -> DataFrame:
    """Holidays that were celebrated: neither transferred nor extra work days."""
    celebrated = (F.upper("TRANSFERRED") != "TRUE") & (F.col("TYPE") != "Work Day")
    return raw.where(celebrated).select(
        to_date(F.col("DATE"), date_formats).alias("DATE"), F.col("LOCALE"), F.col("LOCALE_NAME")
    )


def store_holidays(holidays: DataFrame, stores: DataFrame, salts: int = 16) -> DataFrame:
    """Store x date for national, regional (state) and local (city) holidays.

    The three-way match is one equi join: a store carries one key per locale.
    Every store shares the national key, so stores are spread over ``salts`` and
    the (small, de-duplicated) holiday list is repeated once per salt.
    """
    place = F.when(F.col("LOCALE") == "National", F.lit("")).otherwise(F.col("LOCALE_NAME"))
    events = holidays.select("DATE", "LOCALE", place.alias("PLACE")).distinct().withColumn(
        "SALT", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    store_keys = stores.select(
        "STORE_NBR",
        F.pmod(F.xxhash64("STORE_NBR"), F.lit(salts)).cast("int").alias("SALT"),
        F.explode(F.array(
            F.struct(F.lit("National").alias("LOCALE"), F.lit("").alias("PLACE")),
            F.struct(F.lit("Regional").alias("LOCALE"), F.col("STATE").alias("PLACE")),
            F.struct(F.lit("Local").alias("LOCALE"), F.col("CITY").alias("PLACE")),
        )).alias("KEY"),
    ).select("STORE_NBR", "SALT", "KEY.*")
    matched = events.join(store_keys, ["LOCALE", "PLACE", "SALT"])
    return matched.select("STORE_NBR", "DATE").distinct().withColumn("IS_HOLIDAY", F.lit(1))


# --- enriched daily and weekly sales -----------------------------------------

def enrich(
    daily: DataFrame, stores: DataFrame, oil: DataFrame, holidays: DataFrame, transactions: DataFrame,
    hot_rows: int = HOT_ROWS, hot: DataFrame | None = None,
) -> DataFrame:
    """Daily sales with store, price, holiday and traffic columns (all left joins).

    Holidays and traffic share the (store, date) key, so they meet first and the
    daily rows join once on it. ``oil`` has one row per calendar day, small enough to be
    broadcast unless a stray date stretches the calendar; Spark decides.
    Rows of a store with more than ``hot_rows`` rows are salted. ``hot`` names these stores when the daily
    table is stored with a sketch of them (``frequent_values``); else its rows are counted.
    """
    hot = hot_values(daily, "STORE_NBR", hot_rows) if hot is None else hot
    store_days = holidays.join(transactions, ["STORE_NBR", "DATE"], "full")
    return (
        salt_rows(daily, "STORE_NBR", hot)
        .join(repeat_rows(stores, "STORE_NBR", hot), ["STORE_NBR", "SALT"], "left")
        .join(oil, "DATE", "left")
        .join(repeat_rows(store_days, "STORE_NBR", hot), ["STORE_NBR", "DATE", "SALT"], "left")
        .select(
            "DATE", "STORE_NBR", "FAMILY", "SALES", "ONPROMOTION", *STORE_COLUMNS, "OIL_PRICE",
            F.coalesce("IS_HOLIDAY", F.lit(0)).alias("IS_HOLIDAY"), "TRANSACTIONS",
        )
    )


def rollup_weekly(enriched: DataFrame) -> DataFrame:
    """Store x family x week totals of an enriched daily table."""
    return enriched.groupBy("STORE_NBR", "FAMILY", week_start(F.col("DATE")).alias("WEEK_START")).agg(
        *[F.any_value(c).alias(c) for c in STORE_COLUMNS],
        F.sum("SALES").alias("SALES"),
        F.sum("ONPROMOTION").alias("PROMO_ITEMS"),
        F.sum("IS_HOLIDAY").alias("HOLIDAY_DAYS"),
        F.avg("OIL_PRICE").alias("AVG_OIL_PRICE"),
        F.sum("TRANSACTIONS").alias("STORE_TRANSACTIONS"),
        F.count(F.lit(1)).alias("DAYS_IN_WEEK"),
    )


def weekly_sales(
    daily: DataFrame, stores: DataFrame, oil: DataFrame, holidays: DataFrame, transactions: DataFrame
) -> DataFrame:
    """``rollup_weekly(enrich(...))`` without joining at the daily grain.

    Daily rows shuffle once, combined on the map side, to one row per series-week
    that keeps its row count per weekday (N0..N6). Calendar facts are laid out per
    weekday the same way (0 where absent, plus a bit mask of the days present), so
    the joins run at the weekly grain. Needs unique keys in the four side tables
    (see ``quality.duplicate_keys``). Rows meet in as many partitions as the size of the
    daily input asks for.
    """
    week = week_start(F.col("DATE")).alias("WEEK_START")
    parts = partitions_for(daily)

    def mask(name: str, present: str = "true") -> Column:
        """Bit per weekday that has a row with ``present``."""
        return F.expr(f"coalesce(bit_or(if({present}, shiftleft(1, weekday(DATE)), null)), 0) AS {name}")

    def per_day(prefix: str, column: str) -> list[Column]:
        """The value of each weekday (0 if absent) and the mask of days that have one."""
        values = [f"coalesce(sum(if(weekday(DATE) = {i}, {column}, null)), 0) AS {prefix}{i}" for i in WEEKDAYS]
        return [*map(F.expr, values), mask(f"{prefix}_DAYS", f"{column} is not null")]

    sales = daily.groupBy("STORE_NBR", "FAMILY", week).agg(
        F.sum("SALES").alias("SALES"),
        F.sum("ONPROMOTION").alias("PROMO_ITEMS"),
        F.count(F.lit(1)).alias("DAYS_IN_WEEK"),
        *[F.expr(f"count_if(weekday(DATE) = {i}) AS N{i}") for i in WEEKDAYS],
    )
    store_days = holidays.select("STORE_NBR", "DATE", "IS_HOLIDAY").unionByName(
        transactions, allowMissingColumns=True
    )
    spread_days = store_days.withColumn("WEEK_START", week).repartition(parts, "STORE_NBR", "WEEK_START")
    store_weeks = spread_days.groupBy("STORE_NBR", "WEEK_START").agg(
        mask("H_DAYS", "IS_HOLIDAY = 1"), *per_day("T", "TRANSACTIONS")
    )
    oil_weeks = oil.groupBy(week).agg(*per_day("P", "OIL_PRICE"))

    def rows_on(days: str) -> str:
        """Daily rows on the weekdays of a mask."""
        return "(" + " + ".join(f"N{i} * (shiftright({days}, {i}) & 1)" for i in WEEKDAYS) + ")"

    def weighted(prefix: str) -> str:
        """Sum of a fact over the daily rows; NULL when no row's day has it."""
        total = " + ".join(f"N{i} * {prefix}{i}" for i in WEEKDAYS)
        return f"if({rows_on(f'{prefix}_DAYS')} > 0, {total}, null)"

    with_days = sales.repartition(parts, "STORE_NBR", "WEEK_START").join(store_weeks, ["STORE_NBR", "WEEK_START"], "left").join(oil_weeks, "WEEK_START", "left")
    # Before the rows shuffle again: the facts alone, not what they are made of.
    facts = with_days.selectExpr(
        *KEYS, "SALES", "PROMO_ITEMS",
        f"coalesce({rows_on('H_DAYS')}, 0L) AS HOLIDAY_DAYS",
        f"try_divide({weighted('P')}, {rows_on('P_DAYS')}) AS AVG_OIL_PRICE",
        f"{weighted('T')} AS STORE_TRANSACTIONS",
        "DAYS_IN_WEEK",
    )
    joined = spread_join(facts, stores, "STORE_NBR", ["FAMILY", "WEEK_START"])
    return joined.select(
        *KEYS, *STORE_COLUMNS, "SALES", "PROMO_ITEMS", "HOLIDAY_DAYS", "AVG_OIL_PRICE", "STORE_TRANSACTIONS", "DAYS_IN_WEEK")


def edge_weeks(daily: DataFrame) -> DataFrame:
    """First and last sales week: one row, from the DATE column alone."""
    return daily.agg(
        week_start(F.min("DATE")).alias("FIRST_WEEK"), week_start(F.max("DATE")).alias("LAST_WEEK")
    )


def build_staging(raw: Mapping[str, DataFrame], date_formats: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """All seven staging tables, lazily, in dependency order."""
    daily = type_sales(raw["TRAIN"], date_formats)
    stores = type_stores(raw["STORES"])
    oil = oil_daily(type_oil(raw["OIL"], date_formats), daily)
    holidays = store_holidays(active_holidays(raw["HOLIDAYS_EVENTS"], date_formats), stores)
    traffic = type_transactions(raw["TRANSACTIONS"], date_formats)
    return {
        "SALES_DAILY": daily,
        "STORES": stores,
        "OIL_DAILY": oil,
        "STORE_HOLIDAYS": holidays,
        "TRANSACTIONS_DAILY": traffic,
        "SALES_DAILY_ENRICHED": enrich(daily, stores, oil, holidays, traffic),
        "SALES_WEEKLY": weekly_sales(daily, stores, oil, holidays, traffic),
    }
