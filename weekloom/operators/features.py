"""Weekly sales to model-ready features, without looking ahead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from weekloom.fixed_values import (
    FEATURE_INPUTS, FOURIER_ORDER, LAG_WEEKS, ROLLING_MEAN_WEEKS, ROLLING_STD_WEEKS, SEASON_WEEKS, SERIES,
)
from weekloom.operators.skew import spread_join
from weekloom.session import partitions_for, scratch_path

#: Weeks before its own that a row of the features depends on.
LOOK_BACK = max(*LAG_WEEKS, *ROLLING_MEAN_WEEKS, ROLLING_STD_WEEKS) + 1


def _series_order() -> WindowSpec:
    return Window.partitionBy(*SERIES).orderBy("WEEK_START")


def _by_series(weekly: DataFrame) -> DataFrame:
    """Spread rows by series (at most one row per week each).

    Stated because a join on the store would leave rows partitioned by store,
    which also satisfies the windows but puts a large store into one task. For more input
    than a partition per core their number follows its size, as filling gaps makes several rows of one.
    """
    parts = partitions_for(weekly)
    if parts <= weekly.sparkSession.sparkContext.defaultParallelism:
        return weekly.repartition(*SERIES)
    return weekly.repartition(parts, *SERIES)


def weekly_edges(weekly: DataFrame) -> DataFrame:
    return weekly.agg(F.min("WEEK_START").alias("FIRST_WEEK"), F.max("WEEK_START").alias("LAST_WEEK"))


def trim_edge_weeks(
    weekly: DataFrame, edges: DataFrame | None = None, complete_weeks_only: bool = False
) -> DataFrame:
    """Drop the globally first and last week, which are usually partial.

    ``edges`` (one row FIRST_WEEK, LAST_WEEK) saves a second pass over a weekly
    table that is not stored; Spark pushes both scalars below the rollup.
    """
    edges = weekly_edges(weekly) if edges is None else edges
    week = F.col("WEEK_START")
    kept = weekly.where((week > edges.select("FIRST_WEEK").scalar()) & (week < edges.select("LAST_WEEK").scalar()))
    return kept.where(F.col("DAYS_IN_WEEK") >= 7) if complete_weeks_only else kept


def next_week_of(kept: DataFrame) -> Column:
    """Scalar: the week after the newest kept one."""
    return F.date_add(kept.agg(F.max("WEEK_START")).scalar(), 7)


def with_next_holidays(kept: DataFrame, holidays: DataFrame, next_week: Column) -> DataFrame:
    """Add the store's holiday count in the forecast week (0 when none)."""
    in_week = (F.col("DATE") >= next_week) & (F.col("DATE") < F.date_add(next_week, 7))
    counts = holidays.where(in_week).groupBy("STORE_NBR").agg(F.count(F.lit(1)).alias("NEXT_HOLIDAY_DAYS"))
    joined = spread_join(kept, counts, "STORE_NBR", ["FAMILY", "WEEK_START"])
    return joined.withColumn("NEXT_HOLIDAY_DAYS", F.coalesce("NEXT_HOLIDAY_DAYS", F.lit(0).cast("bigint")))


def densify(kept: DataFrame, first_week: Column, last_week: Column, since: Column | None = None) -> DataFrame:
    """One row per series for every week of [first_week, last_week]; with ``since``, of those from it on.

    Each row also produces the empty weeks up to the next one (the first row also
    those before it), so no grid is joined and the shuffle by series is shared
    with the windows that follow. Store columns are copied; amounts are 0 and
    price and traffic unknown in the added weeks.
    """
    before = F.lag("WEEK_START").over(_series_order())
    after = F.lead("WEEK_START").over(_series_order())
    spans = _by_series(kept).withColumn("_FROM", F.when(before.isNull(), first_week).otherwise(F.col("WEEK_START"))).withColumn(
        "_TO", F.coalesce(F.date_sub(after, 7), last_week)
    )
    if since is not None:
        repeated = F.col("_FROM") > F.col("_TO")  # two rows of one week: still refused below
        spans = spans.where((F.col("_TO") >= since) | repeated).withColumn(
            "_FROM", F.when(repeated, F.col("_FROM")).otherwise(F.greatest("_FROM", since)))
    weeks = spans.withColumn("_WEEK", F.explode(F.sequence("_FROM", "_TO", F.expr("interval 7 days"))))
    real = F.col("_WEEK") == F.col("WEEK_START")
    empty_value = {
        "SALES": F.lit(0.0), "PROMO_ITEMS": F.lit(0).cast("bigint"), "HOLIDAY_DAYS": F.lit(0).cast("bigint"),
        "DAYS_IN_WEEK": F.lit(0).cast("bigint"), "AVG_OIL_PRICE": F.lit(None), "STORE_TRANSACTIONS": F.lit(None),
    }
    return weeks.select(*[
        F.col("_WEEK").alias(c) if c == "WEEK_START"
        else F.when(real, F.col(c)).otherwise(empty_value[c]).alias(c) if c in empty_value
        else F.col(c)
        for c in kept.columns
    ])


def add_next_week(kept: DataFrame, next_week: Column, last_week: Column | None = None) -> DataFrame:
    """History (IS_FUTURE 0) plus one forecast row per series (IS_FUTURE 1).

    The forecast row repeats the series' last row: promotions and price carry
    over, sales and traffic are unknown, holidays come from NEXT_HOLIDAY_DAYS.
    Emitted next to the last row, so no union and no further shuffle is needed.
    When every series is known to end in ``last_week`` (a dense table), passing
    it saves the look-ahead window and its sort.
    """
    if last_week is None:
        kept = _by_series(kept)
        is_last = F.lead("WEEK_START").over(_series_order()).isNull()
    else:
        is_last = F.col("WEEK_START") == last_week
    copies = F.when(F.col("_LAST"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = kept.withColumn("_LAST", is_last).withColumn("IS_FUTURE", F.explode(copies))
    future = F.col("IS_FUTURE") == 1
    changed = {
        "WEEK_START": next_week, "SALES": F.lit(None), "STORE_TRANSACTIONS": F.lit(None),
        "HOLIDAY_DAYS": F.col("NEXT_HOLIDAY_DAYS"),
    }
    return rows.select(*[
        F.when(future, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in FEATURE_INPUTS
    ])


def add_features(rows: DataFrame) -> DataFrame:
    """Lags, rolling statistics of past weeks only, and calendar columns.

    Rolling sums are differences of running sums of exact decimals, of amounts and of their squares: each
    row costs the same whatever the window, and neither order nor earlier amounts touch the last digits.
    Amounts count to four decimals; a series' sums must stay below 10^12.
    """
    amount = F.when(~F.isnan("SALES"), F.col("SALES")).cast("decimal(16,4)")
    order = _series_order()
    until_now = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.select(
        *rows.columns,
        *[F.lag("SALES", k).over(order).alias(f"SALES_LAG_{k}") for k in LAG_WEEKS],
        F.count(amount).over(until_now).alias("_N"),
        F.sum(amount).over(until_now).cast("decimal(20,4)").alias("_SUM"),
        F.sum(amount * amount).over(until_now).cast("decimal(36,8)").alias("_SQUARES"),
    )

    def past(column: str, weeks: int) -> Column:
        """The running value's growth over the ``weeks`` rows before this one."""
        return F.lag(column, 1).over(order) - F.coalesce(F.lag(column, weeks + 1).over(order), F.lit(0).cast(running.schema[column].dataType))

    def mean(weeks: int) -> Column:
        return F.try_divide(past("_SUM", weeks).cast("double"), past("_N", weeks))

    def deviation(weeks: int) -> Column:
        n = past("_N", weeks)
        total, squares = past("_SUM", weeks).cast("decimal(16,4)"), past("_SQUARES", weeks).cast("decimal(32,8)")
        spread = n.cast("decimal(3,0)") * squares - total * total
        return F.when(n > 1, F.sqrt(spread.cast("double") / (n * (n - 1))))

    week = F.col("WEEK_START")
    return running.select(
        *rows.columns,
        *[f"SALES_LAG_{k}" for k in LAG_WEEKS],
        *[mean(n).alias(f"SALES_ROLL_MEAN_{n}") for n in ROLLING_MEAN_WEEKS],
        deviation(ROLLING_STD_WEEKS).alias(f"SALES_ROLL_STD_{ROLLING_STD_WEEKS}"),
        F.weekofyear(week).alias("WEEK_OF_YEAR"), F.month(week).alias("MONTH"), F.year(week).alias("YEAR"),
    )


def build_features(
    weekly: DataFrame, holidays: DataFrame, edges: DataFrame | None = None, dense: bool = True, oldest: Column | None = None
) -> DataFrame:
    """The FEATURES table: trimmed weeks, forecast rows, features.

    ``dense`` fills missing weeks first, which makes row lags calendar lags.
    After the weekly rollup everything runs in one shuffle by series. With
    ``edges`` the kept weeks are taken to lie between them without a gap at
    either end; otherwise they are read from ``weekly`` (best a stored table).

    ``oldest`` (a scalar) gives the rows from that week on alone, the same as without it: every series takes
    part, but only the weeks that these rows look back to are laid out. This needs a dense table.
    """
    if oldest is not None and not dense:
        raise ValueError("only rows of a dense table look back a known number of weeks")
    kept = trim_edge_weeks(weekly, edges)
    if dense:
        if edges is None:
            inner = weekly_edges(kept)
            first_week, last_week = inner.select("FIRST_WEEK").scalar(), inner.select("LAST_WEEK").scalar()
            next_week = F.date_add(last_week, 7)
        else:
            next_week = edges.select("LAST_WEEK").scalar()
            first_week, last_week = F.date_add(edges.select("FIRST_WEEK").scalar(), 7), F.date_sub(next_week, 7)
        since = None if oldest is None else F.greatest(first_week, F.date_sub(oldest, 7 * LOOK_BACK))
        kept = densify(with_next_holidays(kept, holidays, next_week), first_week, last_week, since)
        found = add_features(add_next_week(kept, next_week, last_week))
        return found if oldest is None else found.where(F.col("WEEK_START") >= oldest)
    next_week = next_week_of(kept)
    return add_features(add_next_week(with_next_holidays(kept, holidays, next_week), next_week))


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values with their 0-based position in text order.

    The values are split by ranges and stored, so that the ranges stay the same; each is
    numbered on its own, from the number of values in the ranges before it.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    path = scratch_path(df.sparkSession, "codes")
    split = values.repartitionByRange(column).withColumn("_PART", F.spark_partition_id())
    split.write.parquet(path)
    ranged = df.sparkSession.read.schema(split.schema).parquet(path)
    before = Window.orderBy("_PART").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    firsts = ranged.groupBy("_PART").agg(F.count(F.lit(1)).alias("N")).select(
        "_PART", F.coalesce(F.sum("N").over(before), F.lit(0)).alias("FIRST"))
    place = F.row_number().over(Window.partitionBy("_PART").orderBy(column)) - 1
    return ranged.withColumn("PLACE", place).join(firsts, "_PART").select(column, (F.col("FIRST") + F.col("PLACE")).cast("int").alias("CODE"))


def attach_codes(df: DataFrame, column: str, codes: DataFrame, name: str) -> DataFrame:
    """Join the code table, broadcast or not as Spark sees its size; missing values get -1."""
    joined = df.join(codes.withColumnRenamed("CODE", name), column, "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(-1)))


def series_position(df: DataFrame) -> DataFrame:
    """Add T = 0, 1, 2, ... in week order per series."""
    return df.withColumn("T", F.row_number().over(_series_order()) - 1)


def fourier_columns(t: Column, period: int = SEASON_WEEKS, order: int = FOURIER_ORDER) -> list[Column]:
    angles = [(k, 2 * F.pi() * k * t / period) for k in range(1, order + 1)]
    return [wave for k, a in angles for wave in (F.sin(a).alias(f"SIN_{k}"), F.cos(a).alias(f"COS_{k}"))]


def series_tail(df: DataFrame, weeks: int) -> DataFrame:
    """The newest ``weeks`` rows of every series."""
    newest = Window.partitionBy(*SERIES).orderBy(F.desc("WEEK_START"))
    return df.withColumn("_RN", F.row_number().over(newest)).where(F.col("_RN") <= weeks).drop("_RN")
