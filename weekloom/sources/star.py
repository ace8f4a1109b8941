"""Raw retail tables derived from an order/line-item star schema.

Gives the pipeline its six-table text input from the Parquet tables at hand:
supplier = store, part type = family, ship date = sales date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.session import partitions_for

EVENT_SHIFT_DAYS = 95
SCHEMAS = {  # known types: no footer pass before each query
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
Table = Callable[[str], DataFrame]  # gives the star-schema table of a name


def _sales_lines(table: Table) -> DataFrame:
    line = table("lineitem").select(
        F.col("l_shipdate").cast("date").alias("DATE"),
        (F.col("l_suppkey") + 1).alias("STORE_NBR"),
        F.col("l_partkey"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("PRICE"),
        (F.col("l_discount").cast("decimal(4,2)") >= F.lit("0.05").cast("decimal(4,2)")).alias("PROMO"),
    )
    part = table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("FAMILY"))
    return line.join(part, "l_partkey")


def train(table: Table) -> DataFrame:
    lines = _sales_lines(table).repartition(partitions_for(table("lineitem")), "DATE", "STORE_NBR", "FAMILY")
    daily = lines.groupBy("DATE", "STORE_NBR", "FAMILY").agg(
        F.sum("PRICE").alias("SALES"), F.count_if("PROMO").alias("ONPROMOTION")
    )
    return daily.select(*[F.col(c).cast("string").alias(c) for c in ["DATE", "STORE_NBR", "FAMILY", "SALES", "ONPROMOTION"]])


def sales_dates(table: Table) -> DataFrame:
    """The sales dates alone (one per line), for calendar bounds without grouping."""
    return _sales_lines(table).select("DATE")


def _nation_region(table: Table) -> DataFrame:
    nation, region = table("nation"), table("region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def stores(table: Table) -> DataFrame:
    supplier = table("supplier")
    places = _nation_region(table)
    return supplier.join(places, supplier.s_nationkey == places.n_nationkey).select(
        (F.col("s_suppkey") + 1).cast("string").alias("STORE_NBR"),
        F.col("n_name").alias("CITY"),
        F.col("r_name").alias("STATE"),
        F.expr("substring('ABCDE', cast(s_suppkey % 5 + 1 as int), 1)").alias("TYPE"),
        (F.col("s_suppkey") % 17 + 1).cast("string").alias("CLUSTER"),
    )


def oil(table: Table) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    priced = table("orders").where(F.weekday(day) < 5).groupBy(day.alias("DAY")).agg(
        F.min(F.col("o_totalprice").cast("decimal(18,2)")).alias("PRICE"), F.min("o_orderkey").alias("FIRST_ORDER")
    )
    return priced.select(
        F.col("DAY").cast("string").alias("DATE"),
        F.when(F.col("FIRST_ORDER") % 29 != 0, F.col("PRICE").cast("string")).alias("DCOILWTICO"),
    )


def holidays_events(table: Table) -> DataFrame:
    day = F.date_add(F.col("o_orderdate").cast("date"), EVENT_SHIFT_DAYS)
    order = F.struct("o_orderkey", "o_custkey", "o_orderpriority")
    picked = (
        table("orders").where(F.dayofmonth(day).isin(1, 15))
        .groupBy(day.alias("DAY")).agg(F.min(order).alias("lo"), F.max(order).alias("hi"))
        .select("DAY", F.explode(F.array("lo", "hi")).alias("o"))
        .select("DAY", "o.*")
    )
    customer = table("customer").select("c_custkey", "c_nationkey")
    places = _nation_region(table)
    placed = picked.join(customer, picked.o_custkey == customer.c_custkey).join(
        places, customer.c_nationkey == places.n_nationkey
    )
    kind = F.col("o_orderkey") % 3
    return placed.select(
        F.col("DAY").cast("string").alias("DATE"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Work Day").otherwise("Holiday").alias("TYPE"),
        F.when(kind == 0, "National").when(kind == 1, "Regional").otherwise("Local").alias("LOCALE"),
        F.when(kind == 0, F.lit("Ecuador")).when(kind == 1, F.col("r_name")).otherwise(F.col("n_name")).alias("LOCALE_NAME"),
        F.when(F.col("o_orderkey") % 10 == 0, "True").otherwise("False").alias("TRANSFERRED"),
    )


def transactions(table: Table) -> DataFrame:
    lines = table("lineitem").select(
        F.col("l_shipdate").cast("date").alias("DAY"), (F.col("l_suppkey") + 1).alias("STORE"), "l_orderkey"
    )
    per_day = lines.repartition(partitions_for(lines), "DAY", "STORE").groupBy("DAY", "STORE").agg(F.count_distinct("l_orderkey").alias("N"))
    return per_day.select(
        F.col("DAY").cast("string").alias("DATE"), F.col("STORE").cast("string").alias("STORE_NBR"),
        F.col("N").cast("string").alias("TRANSACTIONS"),
    )


def raw_tables(table: Table) -> dict[str, DataFrame]:
    return {
        "TRAIN": train(table), "STORES": stores(table), "OIL": oil(table),
        "HOLIDAYS_EVENTS": holidays_events(table), "TRANSACTIONS": transactions(table),
    }
