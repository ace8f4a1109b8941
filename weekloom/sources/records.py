"""CSV records from byte ranges of text files, many tasks per file.

A line break may stand inside quotes, so where a byte range starts decides how its lines are
read. A first pass over the lines tells for each range how it ends if it starts outside or
inside quotes; put together in the order of the ranges, that gives every range its start. A
second pass gives the records. A record that runs over the end of a range is joined from
its pieces.
"""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

QUOTE, SEPARATOR = '"', ","


def open_after(line: str, inside: bool) -> bool:
    """Whether a line that starts inside or outside quotes ends inside; quotes are doubled within quotes."""
    if QUOTE not in line:
        return inside
    at = 0
    while True:
        if inside:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line.startswith(QUOTE, at + 1):
                at += 2
                continue
            inside, at = False, at + 1
        elif line.startswith(QUOTE, at):
            inside, at = True, at + 1
            continue
        at = line.find(SEPARATOR, at) + 1
        if not at:
            return False


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, start (of the byte range) of all lines, in order within each range."""
    return spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: every record of the files but their first ones (the headers) and empty ones."""
    rows = lines(spark, path)
    starts = range_starts(rows)
    known = spark.sparkContext.broadcast(starts)

    def whole(batches):
        yield from _read(batches, known.value, False)

    def cut(batches):
        yield from _read(batches, known.value, True)

    found = rows.mapInArrow(whole, "record string")
    torn = {(file, at) for (file, at), owner in starts.items() if owner is not None}
    torn |= {(file, starts[file, at]) for file, at in torn}
    if torn:
        # At most one row per byte range.
        these = F.broadcast(spark.createDataFrame(sorted(torn), "file string, start long"))
        pieces = rows.join(these, ["file", "start"], "left_semi").select("value", "file", "start").mapInArrow(cut, "file string, owner long, start long, piece string")
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "piece"))), lambda p: p["piece"]), "\n")
        found = found.unionByName(pieces.groupBy("file", "owner").agg(text.alias("record")).select("record"))
    ended = F.when(F.contains("record", F.lit("\r")), F.regexp_replace("record", "\r$", "")).otherwise(F.col("record"))
    return found.select(ended.alias("record")).where("record != ''")


def range_starts(rows: DataFrame) -> dict[tuple[str, int], int | None]:
    """For each byte range: where the range starts in which the record lies that is open at its start; None if none is.

    One row per byte range passes through the driver, as the ranges themselves do. Only lines of ranges that
    hold a quote are looked at one by one; any other range ends as it starts.
    """
    ranges = rows.groupBy("file", "start").agg(F.max(F.contains("value", F.lit(QUOTE))).alias("quoted")).collect()
    quoted = [(r.file, r.start) for r in ranges if r.quoted]
    plain = [Row(file=r.file, start=r.start, outside=False, inside=True, fresh=False) for r in ranges if not r.quoted]
    if len(quoted) < len(ranges):
        # At most one row per byte range.
        these = F.broadcast(rows.sparkSession.createDataFrame(quoted, "file string, start long"))
        rows = rows.join(these, ["file", "start"], "left_semi").select("value", "file", "start")

    def ends(batches):
        now, outside, inside, fresh = None, False, True, False
        for batch in batches:
            out = []
            for value, key in _grouped(batch):
                if key != now:
                    if now is not None:
                        out.append((*now, outside, inside, fresh))
                    now, outside, inside, fresh = key, False, True, False
                if pc.any(pc.match_substring(value, QUOTE)).as_py():
                    for line in value.to_pylist():
                        outside = open_after(line, outside)
                        fresh = fresh or not inside
                        inside = open_after(line, inside)
                else:
                    fresh = fresh or not inside
            yield _batch(out, [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()], ["file", "start", "outside", "inside", "fresh"])
        if now is not None:
            yield _batch([(*now, outside, inside, fresh)], [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()], ["file", "start", "outside", "inside", "fresh"])

    schema = "file string, start long, outside boolean, inside boolean, fresh boolean"
    found = plain + (rows.mapInArrow(ends, schema).collect() if quoted else [])
    out: dict[tuple[str, int], int | None] = {}
    file, owner = None, None
    for r in sorted(found, key=lambda r: (r.file, r.start)):
        if r.file != file:
            file, owner = r.file, None
        out[r.file, r.start] = owner
        if owner is None:
            owner = r.start if r.outside else None
        elif not r.inside:
            owner = None
        elif r.fresh:
            owner = r.start
    return out


def _read(batches, starts: dict, torn: bool):
    """Complete records of each range, or (``torn``) the pieces of those that run over its ends."""
    now, held, inside, owner, header = None, [], False, None, False
    kinds, names = ([pa.string(), pa.int64(), pa.int64(), pa.string()], ["file", "owner", "start", "piece"]) if torn else ([pa.string()], ["record"])
    for batch in batches:
        out = []
        for value, key in _grouped(batch):
            if key != now:
                if now is not None and held and torn:
                    out.append((now[0], owner, now[1], "\n".join(held)))
                if key not in starts:
                    raise ValueError("the byte ranges of the files have changed since they were read; read the files again")
                now, held, owner = key, [], starts[key]
                inside, header = owner is not None, key[1] == 0
            if header and not inside and not held and not pc.any(pc.match_substring(value, QUOTE)).as_py():
                value, header = value.slice(1), False
            if not inside and not torn and not header and not pc.any(pc.match_substring(value, QUOTE)).as_py():
                yield _batch(out, kinds, names)
                out = []
                yield pa.RecordBatch.from_arrays([value], names=names)
                continue
            for line in value.to_pylist():
                if not held and not inside:
                    owner = now[1]
                inside = open_after(line, inside)
                held.append(line)
                if not inside:
                    if header:
                        header = False
                    elif torn and owner != now[1]:
                        out.append((now[0], owner, now[1], "\n".join(held)))
                    elif not torn and owner == now[1]:
                        out.append(("\n".join(held),))
                    held = []
        yield _batch(out, kinds, names)
    if held and torn:
        yield _batch([(now[0], owner, now[1], "\n".join(held))], kinds, names)


def _grouped(batch: pa.RecordBatch):
    """(values, (file, start)) of each run of lines of one byte range."""
    value, files, starts = (batch.column(name) for name in ("value", "file", "start"))
    if not batch.num_rows:
        return
    changed = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(starts[1:], starts[:-1]))
    cuts = [0, *(at + 1 for at in pc.indices_nonzero(changed).to_pylist()), batch.num_rows]
    for at, end in zip(cuts, cuts[1:]):
        yield value.slice(at, end - at), (files[at].as_py(), starts[at].as_py())


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
