"""Every named query against its SQL counterpart at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from weekloom.catalog.oracle import all_sql
from weekloom.catalog.queries import all_queries

QUERIES, SQL = all_queries(), all_sql()  # optional packages have tests of their own
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings"]
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(SQL[name])
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert {c: TYPES[t] for c, t in result.dtypes} == types
    expected = cursor.fetchall()
    got = [tuple(r) for r in result.collect()]
    assert table(result.columns, got) == table(list(types), expected)


def test_every_sql_text_has_a_query_and_only_trained_models_lack_one():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {
        "gbt_forecast", "gbt_gate", "gbt_importance", "arima_fourier_backtest", "trend_season_backtest"}


@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - set(SQL) if not n.startswith("gbt_")))
def test_trained_queries_give_one_row_per_unit(spark, sf_dir, name):
    expected = {"arima_fourier_backtest": 480, "trend_season_backtest": 480}  # boosting at its full size takes minutes
    assert QUERIES[name](spark, sf_dir).count() == expected[name]


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert frame.count() == 60 * 356


@pytest.mark.parametrize("name", ["weekly_rollup", "sales_enriched", "feature_table", "store_holidays", "hybrid_search", "sql_audit"])
def test_no_cross_join(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
