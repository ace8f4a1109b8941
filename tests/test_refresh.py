"""Replaced runs and incremental document refreshes."""

import pytest
from pyspark.sql import functions as F

from helpers import by, day, rows
from weekloom.plans import refresh
from weekloom.sources import tables

LOG = "V bigint, RUN_TS string"
FACTS = (
    "STORE_NBR bigint, FAMILY string, WEEK_START date, FORECAST double, LAST_WEEK double, SAME_WEEK_LAST_YEAR double, AVG_4WK double, "
    "PROMO_ITEMS double, HOLIDAY_DAYS double, CITY string, STATE string, STORE_TYPE string"
)


def test_a_repeated_run_replaces_its_rows_only(spark, tmp_path):
    path = str(tmp_path / "log")
    write = lambda run, values: tables.append_run(spark.createDataFrame([(v, run) for v in values], LOG), path)
    assert [write("a", [1, 2, 3]), write("b", [4]), write("a", [7, 8])] == [3, 1, 2]
    assert rows(tables.read_table(spark, path, LOG), "RUN_TS", "V") == [(7, "a"), (8, "a"), (4, "b")]
    assert rows(tables.run_status(spark, path, LOG), "RUN_TS") == [("a", 2, 2, True), ("b", 1, 1, True)]
    assert tables.append_run(spark.createDataFrame([], LOG), path) == 0
    assert tables.read_table(spark, path, LOG).count() == 3


def test_a_run_that_was_cut_off_is_seen(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.append_run(spark.createDataFrame([(1, "a"), (2, "a")], LOG), path)
    spark.createDataFrame([(9, "b")], LOG).write.mode("append").partitionBy("RUN_TS").parquet(path)  # no note was written
    (next((tmp_path / "log" / "RUN_TS=a").glob("part-*.parquet"))).unlink()
    assert {r["RUN_TS"]: r["SETTLED"] for r in tables.run_status(spark, path, LOG).collect()} == {"a": False, "b": False}


def test_finished_asks_for_a_committed_write(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.finished(spark, path) and not tables.exists(spark, path)
    spark.range(3).write.parquet(path)
    assert tables.finished(spark, path) and tables.exists(spark, path)
    (tmp_path / "t" / "_SUCCESS").unlink()
    assert not tables.finished(spark, path)


def facts(spark, stores):
    data = [(s, f, day("2024-01-08"), fc, 10.0, None, 9.0, 1.0, 0.0, city, None, "A") for s, (city, fc) in stores.items() for f in ("X", "Y")]
    return spark.createDataFrame(data, FACTS)


@pytest.fixture
def embedding():
    seen = []

    def embed(documents):
        seen.append(sorted(r[0] for r in documents.select("STORE_NBR").collect()))
        return documents.withColumn("VECTOR", F.array(F.length("SUMMARY").cast("float")))

    return embed, seen


def test_only_what_changed_is_written_and_embedded(spark, tmp_path, embedding):
    embed, seen = embedding
    out = str(tmp_path)
    first = {1: ("Quito", 5.0), 2: (None, 6.0), 3: ("Loja", 7.0), 4: (None, 8.0)}
    states = refresh.refresh_changed(spark, facts(spark, first), out, "r1", embed)
    assert {r["STATE"] for r in states.collect()} == {"new"} and seen == [[0, 1, 2, 3, 4]]
    # the same again: nothing to write, not even for the chain
    states = refresh.refresh_changed(spark, facts(spark, first), out, "r2", embed)
    assert {r["STATE"] for r in states.collect()} == {"same"} and seen[1] == []
    second = {1: ("Quito", 5.0), 2: ("", 6.0), 4: (None, 8.5), 5: ("Ambato", 1.0)}
    for _ in range(2):  # a repeated run gives the same
        states = refresh.refresh_changed(spark, facts(spark, second), out, "r3", embed)
        assert {r["STORE_NBR"]: r["STATE"] for r in states.collect()} == {0: "changed", 1: "same", 2: "changed", 3: "vanished", 4: "changed", 5: "new"}
        assert seen[-1] == [0, 2, 4, 5]
    log = refresh.document_log(spark, out)
    assert rows(log.groupBy("RUN_TS").count(), "RUN_TS") == [("r1", 5), ("r3", 5)]
    current = by(refresh.current_documents(log), "STORE_NBR")
    assert set(current) == {0, 1, 2, 4, 5} and current[1]["RUN_TS"] == "r1" and current[4]["RUN_TS"] == "r3"
    assert current[4]["VECTOR"] == [float(len(current[4]["SUMMARY"]))] and "Ambato" in current[5]["SUMMARY"]
    # a store that comes back is new
    states = refresh.refresh_changed(spark, facts(spark, {**second, 3: ("Loja", 7.0)}), out, "r4", embed)
    assert by(states, "STORE_NBR")[3]["STATE"] == "new"
    assert 3 in by(refresh.current_documents(refresh.document_log(spark, out)), "STORE_NBR")


def test_digests_tell_nulls_from_empty_texts_and_ignore_row_order(spark):
    plain = facts(spark, {1: (None, 5.0), 2: ("b", 1.0)})
    digest = lambda df: {r["STORE_NBR"]: r["DIGEST"] for r in refresh.facts_digests(df).collect()}
    assert digest(plain) == digest(plain.orderBy(F.desc("FAMILY"), F.desc("STORE_NBR")))
    other = digest(facts(spark, {1: ("", 5.0), 2: ("b", 1.0)}))
    assert other[1] != digest(plain)[1] and other[2] == digest(plain)[2] and other[0] != digest(plain)[0]
    assert digest(plain.limit(0)) == {}
