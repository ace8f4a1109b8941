import pytest
from pyspark.sql import functions as F

from helpers import by, day, rows
from weekloom.fixed_values import NA_TOKENS
from weekloom.functions.casts import to_date, to_double, to_long
from weekloom.schemas import STORES
from weekloom.sources import raw, tables


def test_dates_are_iso_only_unless_a_format_is_given(spark):
    texts = ["2013-01-01", "01/02/2013", "2013", "2013-01", "2013-13-01", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows(df.select(to_date(F.col("t")), to_date(F.col("t"), ("MM/dd/yyyy",))))
    assert [g[0] for g in got] == [day("2013-01-01")] + [None] * 6
    assert got[1][1] == day("2013-01-02")
    assert got[0][1] == day("2013-01-01")


def test_numbers_round_half_up_and_never_raise(spark):
    df = spark.createDataFrame([(t,) for t in ["3.7", "2.5", " 5 ", "x", "NaN", None, "-7"]], "t string")
    got = rows(df.select(to_long(F.col("t")), to_double(F.col("t"))))
    assert [g[0] for g in got] == [4, 3, 5, None, None, None, -7]
    assert [g[1] for g in got] == [3.7, 2.5, 5.0, None, None, None, -7.0]


def test_every_missing_token_becomes_null(spark):
    assert len(NA_TOKENS) == 19
    df = spark.createDataFrame([(t,) for t in NA_TOKENS + ["Quito", "na"]], "t string")
    assert [r[0] for r in rows(raw.blank_missing(df)) if r[0] is not None] == ["Quito", "na"]


def test_load_raw_counts_uppercases_and_fails_on_a_missing_file(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "stores.csv").write_text('store_nbr,city,type\n1,"Quito, north",A\n2,NA,\n')
    (folder / "oil.csv").write_text("date,dcoilwtico\n2013-01-01,\n")
    files = {"stores.csv": "STORES", "oil.csv": "OIL"}
    assert raw.load_raw(spark, str(folder), str(tmp_path / "out"), files) == {"STORES": 2, "OIL": 1}
    loaded = raw.read_raw(spark, str(tmp_path / "out"), files)
    assert loaded["STORES"].columns == ["STORE_NBR", "CITY", "TYPE"]
    assert {t for _, t in loaded["STORES"].dtypes} == {"string"}
    assert rows(loaded["STORES"], "STORE_NBR") == [("1", "Quito, north", "A"), ("2", None, None)]
    with pytest.raises(Exception):
        raw.load_raw(spark, str(folder), str(tmp_path / "out"), {"absent.csv": "X"})


def test_csv_keeps_line_breaks_pads_short_rows_and_refuses_long_ones(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text('a,b,c\n1,"two\nlines, ""quoted""",x\n2,NA,\n3\n')
    assert rows(raw.read_csv_text(spark, str(good)), "A") == [("1", 'two\nlines, "quoted"', "x"), ("2", None, None), ("3", None, None)]
    for row in ("1,2,3,4", "1,2,3,", '1,2,3,""', "1,2,3,4,5"):
        bad = tmp_path / "bad.csv"
        bad.write_text(f"a,b,c\n{row}\n")
        with pytest.raises(Exception, match="more than 3 fields"):
            raw.read_csv_text(spark, str(bad)).collect()


def test_json_numbers_have_at_most_ten_decimals(spark):
    import datetime as dt
    import json

    df = spark.createDataFrame([(1, 0.1 + 0.2, None, dt.datetime(2024, 1, 2, 3, 4, 5))], "k int, x double, y double, t timestamp")
    text = rows(tables.rows_as_json(df))[0][0]
    assert '"x":0.3,' in text and json.loads(text) == {"k": 1, "x": 0.3, "y": None, "t": "2024-01-02T03:04:05.000"}


def test_overwrite_replaces_and_append_adds_runs(spark, tmp_path):
    path = str(tmp_path / "stores")
    first = spark.createDataFrame([(1, "Quito", "P", "A", 3)], STORES)
    assert tables.overwrite_table(first, path) == 1
    assert tables.overwrite_table(first.limit(0), path) == 0
    assert tables.read_table(spark, path, STORES).count() == 0

    schema = "V bigint, RUN_TS string"
    log = str(tmp_path / "log")
    for run_ts, values in [("2024-01-01 00:00:00", [1, 2]), ("2024-01-08 00:00:00", [3])]:
        tables.append_run(spark.createDataFrame([(v, run_ts) for v in values], schema), log)
    stored = tables.read_table(spark, log, schema)
    assert stored.count() == 3
    assert rows(tables.latest_run(stored)) == [(3, "2024-01-08 00:00:00")]


def test_json_rows_keep_nulls_and_iso_dates(spark):
    df = spark.createDataFrame([(day("2024-01-02"), 5, None), (day("2024-01-01"), None, "x")], "D date, N bigint, S string")
    got = [r[0] for r in rows(tables.rows_as_json(df, F.col("D")))]
    assert got == ['{"D":"2024-01-01T00:00:00.000","N":null,"S":"x"}', '{"D":"2024-01-02T00:00:00.000","N":5,"S":null}']
    assert tables.rows_as_json(spark.range(500)).count() == 100


def test_latest_run_prunes_to_one_folder(spark, tmp_path):
    log = str(tmp_path / "log")
    for ts in ("2024-01-01 00:00:00", "2024-01-08 00:00:00"):
        tables.append_run(spark.createDataFrame([(1, ts)], "V bigint, RUN_TS string"), log)
    stored = tables.read_table(spark, log, "V bigint, RUN_TS string")
    text = tables.latest_run(stored)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(RUN_TS" in text
    assert by(tables.latest_run(stored), "RUN_TS").keys() == {"2024-01-08 00:00:00"}
