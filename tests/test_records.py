"""Records from byte ranges: against Python's csv module, on files cut into many ranges."""

import csv
import io
import random

import pytest
from pyspark.errors import PySparkException

from helpers import plan
from weekloom.fixed_values import NA_TOKENS
from weekloom.sources import raw, records


def random_file(seed, n, breaks=0.3, wide=12):
    """A CSV with quoted separators, quotes and line breaks, and its rows."""
    draw = random.Random(seed)
    words = ["plain", "with, comma", 'a "quoted" word', "two\nlines", "a\r\nb", '"', '""', ",\n,", "x" * wide, "é🙂", 'say ""hi""\n"']
    rows = [[str(i), draw.choice(words) if draw.random() < breaks else f"word{i}", draw.choice(words) if draw.random() < breaks else "end"] for i in range(n)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["Nr", "First", "second"])
    writer.writerows(rows)
    return out.getvalue(), rows


@pytest.fixture
def small_ranges(spark):
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(key, "2000")
    yield
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


def test_line_state_follows_the_csv_rules():
    cases = [("a,b", False, False), ('"a', False, True), ('"a"', False, False), ('"a""', False, True), ('x"y', False, False), ('a,"b', False, True),
             ('b",c', True, False), ('b"",c', True, True), ('b","c', True, True), ("plain", True, True), ('"', True, False), ('""', False, False), ('5" pipe,x', False, False)]
    for line, inside, expected in cases:
        assert records.open_after(line, inside) is expected, line
    for seed in range(20):
        text, rows = random_file(seed, 40, 0.7)
        inside, count = False, 0
        for line in text.removesuffix("\n").split("\n"):
            inside = records.open_after(line, inside)
            count += not inside
        assert not inside and count == len(rows) + 1


def test_one_file_is_read_by_many_tasks_and_keeps_its_breaks(spark, tmp_path, small_ranges):
    for seed, (n, breaks) in enumerate([(400, 0.3), (300, 0.0), (150, 0.9)]):
        text, expected = random_file(seed, n, breaks)
        path = tmp_path / f"{seed}.csv"
        path.write_bytes(text.encode())
        assert records.records(spark, str(path)).rdd.getNumPartitions() >= min(4, len(text) // 2500)
        got = {r[0]: list(r) for r in raw.read_csv_text(spark, str(path)).collect()}
        assert got == {r[0]: [None if v in NA_TOKENS else v for v in r] for r in expected}


def test_records_longer_than_ranges_are_joined(spark, tmp_path, small_ranges):
    rows = [["1", "short", "x"], ["2", "\n".join(f"line {i} \"quoted\", more" for i in range(700)), "y"], ["3", "a\nb", "z"], ["4", "\n" * 5000, ""]]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["a", "b", "c"], *rows])
    path = tmp_path / "long.csv"
    path.write_text(out.getvalue())
    starts = records.range_starts(records.lines(spark, str(path)))
    assert sum(owner is not None for owner in starts.values()) >= 5
    assert sorted(tuple(r) for r in raw.read_csv_text(spark, str(path)).collect()) == [(a, b, c or None) for a, b, c in rows]


def test_long_rows_stop_every_reading(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('x,y,z\n1,2,3\n4,"5,5",6\n7,8,9,10\n')
    frame = raw.read_csv_text(spark, str(path))
    for reading in (frame.count, frame.select("X").collect, frame.select("Y").collect, frame.select("Z").collect, frame.where("Y = '2'").collect):
        with pytest.raises(PySparkException, match="more than 3 fields"):
            reading()


def test_short_rows_blank_lines_line_ends_and_clashing_names(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_bytes(b'_record,b,c\r\n1,"x\r\ny",z\r\n\r\n2\r\n3,"",w\r\n4,a b,"last"')
    assert raw.read_csv_text(spark, str(path)).columns == ["_RECORD", "B", "C"]
    got = sorted(tuple(r) for r in raw.read_csv_text(spark, str(path)).collect())
    assert got == [("1", "x\r\ny", "z"), ("2", None, None), ("3", None, "w"), ("4", "a b", "last")]
    (tmp_path / "only.csv").write_text("a,b\n")
    assert raw.read_csv_text(spark, str(tmp_path / "only.csv")).count() == 0


def test_changed_ranges_are_refused(spark, tmp_path, small_ranges):
    path = tmp_path / "big.csv"
    path.write_text(random_file(3, 400)[0])
    frame = raw.read_csv_text(spark, str(path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3100")
    spark.conf.set("spark.sql.files.openCostInBytes", "3100")
    with pytest.raises(PySparkException, match="byte ranges of the files have changed"):
        frame.collect()


def test_only_ranges_with_quotes_are_looked_at_line_by_line(spark, tmp_path, small_ranges, monkeypatch):
    text, expected = random_file(5, 300, 0.0)
    (tmp_path / "plain.csv").write_text(text)
    (tmp_path / "mixed.csv").write_text(text + random_file(6, 200, 0.9)[0].split("\n", 1)[1])
    mixed = records.range_starts(records.lines(spark, str(tmp_path / "mixed.csv")))
    assert len(mixed) >= 4
    got = [list(r) for r in raw.read_csv_text(spark, str(tmp_path / "mixed.csv")).collect()]
    assert sorted(got, key=str) == sorted([[None if v in NA_TOKENS else v for v in r] for r in expected + random_file(6, 200, 0.9)[1]], key=str)
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", None)
    plain = records.range_starts(records.lines(spark, str(tmp_path / "plain.csv")))
    assert len(plain) >= 3 and set(plain.values()) == {None}


def test_records_with_few_separators_are_parsed_once(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    assert "octet_length(replace" in plan(raw.read_csv_text(spark, str(tmp_path / "x.csv")))
