"""Running values along sorted rows, whatever share of them one key holds.

Rows are dealt to parts by ranges of their whole sort order, so the rows of a hot key fill
several parts. Each part streams through one task, which starts from nothing and marks its
last row. What that row says is carried to the next parts: one value per part, added by a
join on the part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import map_batches, stored

Scan = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def scanned(rows: DataFrame, order: list[Column | str], scan: Scan, schema: str, name: str) -> DataFrame:
    """``scan`` over each part of the sorted rows, stored; ``part`` and ``last`` (of its part) are added.

    ``scan`` sees the rows of one part in order, batch by batch, and gives one row for each.
    """
    parts = 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def work(batches):
        part: list[int] = []

        def seen():
            for batch in batches:
                if batch.num_rows:
                    part[:] = batch.column("part")[:1].to_pylist()
                    yield batch

        held = None
        for batch in scan(seen()):
            if held is not None:
                yield marked(held, part[0], False)
            held = batch
        if held is not None:
            yield marked(held, part[0], True)

    return stored(map_batches(sorted_rows, work, f"{schema}, part int, last boolean", 10_000), name)


def marked(batch: pa.RecordBatch, part: int, ends: bool) -> pa.RecordBatch:
    n = batch.num_rows
    flags = [False] * (n - 1) + [ends]
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array([part] * n, pa.int32()), pa.array(flags, pa.bool_())], names=[*batch.schema.names, "part", "last"])


def carried(scan: DataFrame, key: list[str], values: list[str], join: Callable[[tuple, tuple], tuple]) -> DataFrame:
    """part, key, values: what the rows of a key before a part sum up to, for keys that run on into it.

    At most one row per part; only the last row of each part passes through the driver.
    ``join`` adds the values of two runs that follow each other.
    """
    kinds = dict(scan.dtypes)
    ends = scan.where("last").select("part", *key, *values).collect()
    rows, before = [], None
    for end in sorted(ends, key=lambda r: r["part"]):
        own, sums = tuple(end[k] for k in key), tuple(end[v] for v in values)
        if before is not None:
            rows.append((end["part"], *before[0], *before[1]))
            if own == before[0]:
                sums = join(before[1], sums)
        before = own, sums
    schema = ", ".join(["part int", *(f"{c} {kinds[c]}" for c in [*key, *values])])
    return scan.sparkSession.createDataFrame(rows, schema)
