"""Gradient-boosted regression trees over binned inputs, grown by the tasks of one stage together (numpy).

The rows lie in the memory of the tasks as numbers of bins and stay there for all trees; only sums per bin pass
between tasks, once a level, as files in the shared folder (Spark's own exchange takes a second each time and
serves where Python can't open that folder). Of two sister nodes the smaller one is summed, the other is what remains of their
parent. A split sends missing values (bin -1) to the left or to the right; an input that can be missing is two
columns in the draw of columns, one for either side. Trees and their weights are those of squared error in Spark ML:
the first tree fits the label, each further one twice the rest, at the learning rate.
"""

from __future__ import annotations

import base64
import os
import sys
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, StorageLevel, TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: Rows kept as one value, fewest rows of a task, and bytes that a task sends or gets at once.
BLOCK, LEAST_ROWS, MESSAGE = 32_768, 25_000, 24 << 20
#: Seconds between looks for the other tasks' sums, and until they count as lost.
LOOK, LOST = 0.001, 3600
#: Errors are summed as whole numbers of this many bits, together with their number, in exact doubles: so many rows at a time.
BITS, CHUNK = 19, 1 << 16
COUNTED = 2.0 ** (BITS + 17)
#: A split must gain more than this share of its node's sum.
LEAST_GAIN = 1e-12
TREES = "TREE int, NODE int, INPUT int, MISSING_LEFT boolean, LAST_LEFT int, LEFT int, RIGHT int, VALUE double, GAIN double"


class Model:
    """Trees as one row per node in ``table``: leaves have INPUT -1, values are already weighted by the learning rate."""

    def __init__(self, table: pa.Table, inputs: int):
        self.table, self.inputs = table.sort_by([("TREE", "ascending"), ("NODE", "ascending")]), inputs

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.table, TREES).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, inputs: int) -> Model:
        return Model(spark.read.schema(TREES).parquet(path).toArrow(), inputs)

    def predicted(self, columns: list[str]) -> Column:
        """The prediction from columns of bin numbers."""
        data = {f.name: self.table.column(f.name).to_numpy() for f in self.table.schema}
        return F.arrow_udf(_predictor(data), "double")(*columns)

    def gains(self, upper: list[int]) -> np.ndarray:
        """Share of each column in all gains: the inputs, then those of ``upper`` as they are with missing values on the right."""
        data = {f.name: self.table.column(f.name).to_numpy(zero_copy_only=False) for f in self.table.schema}
        place = np.append(np.arange(self.inputs), -1)
        above = np.full(self.inputs + 1, -1)
        above[upper] = self.inputs + np.arange(len(upper))
        column = np.where(data["MISSING_LEFT"], place[data["INPUT"]], above[data["INPUT"]])
        split = data["INPUT"] >= 0
        total = np.bincount(column[split], weights=data["GAIN"][split], minlength=self.inputs + len(upper))
        return total / (total.sum() or 1.0)


def _predictor(data: dict[str, np.ndarray]) -> Callable:
    starts = np.flatnonzero(np.append(True, np.diff(data["TREE"]) != 0)) if len(data["TREE"]) else []
    first = np.repeat(starts, np.diff(np.append(starts, len(data["TREE"])))).astype(np.int64) if len(starts) else np.empty(0, np.int64)
    leaf = data["INPUT"] < 0
    here = np.arange(len(leaf))
    left, right = (np.where(leaf, here, first + data[c]) for c in ("LEFT", "RIGHT"))
    inputs, missing_left, last_left, values = np.maximum(data["INPUT"], 0), data["MISSING_LEFT"], data["LAST_LEFT"], data["VALUE"]

    def predict(*columns: pa.Array) -> pa.Array:
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in columns], axis=1)
        out, every = np.zeros(len(x)), np.arange(len(x))
        for root in starts:
            at = np.full(len(x), root)
            while True:
                value = x[every, inputs[at]]
                onward = np.where(np.where(value < 0, missing_left[at], value <= last_left[at]), left[at], right[at])
                if (onward == at).all():
                    break
                at = onward
            out += values[at]
        return pa.array(out)

    return predict


def fit(
    train: DataFrame, label: str, columns: list[str], upper: list[int], trees: int, depth: int, rate: float, rows: float,
    share: float, bins: int, seed: int,
) -> Model:
    """Grow ``trees`` trees on ``label`` from ``columns`` of bin numbers (-1: missing).

    Inputs ``upper`` may also send missing values to the right. ``rows`` and ``share`` are the shares of rows drawn per tree
    and of columns drawn per node; inputs of more than ``bins`` bins get ``bins`` groups of them. The same
    table gives the same trees. The stage needs all its tasks at once (no dynamic allocation), and room for about
    60 bytes a row in them; a task that is lost ends the fit.
    """
    spark = train.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    numbers = [F.col(c).cast("smallint").alias(f"X{i}") for i, c in enumerate(columns)]
    blocks = train.select(F.col(label).cast("double").alias("Y"), *numbers).mapInArrow(_packed(len(columns)), "PART int, BLOCK int, N int, Y binary, X binary")
    blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = blocks.agg(F.sum("N")).first()[0]
        if not total:
            raise ValueError("no rows to train on")
        tasks = max(1, min(_slots(spark), total // LEAST_ROWS))
        grow = _grower(_folder(spark), tasks, len(columns), upper, trees, depth, rate, rows, share, bins, seed)
        return Model(blocks.repartition(tasks).mapInArrow(grow, TREES, barrier=True).toArrow(), len(columns))
    finally:
        blocks.unpersist()


def _slots(spark: SparkSession) -> int:
    """Tasks that can run at once."""
    context = spark.sparkContext._jsc.sc()
    return context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())


def _folder(spark: SparkSession) -> str | None:
    """A new path in the shared folder as Python opens it; None if only Spark reaches that."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "boosting"))
    local = path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"
    return path.toUri().getPath() if local else None


def _packed(inputs: int) -> Callable:
    """Rows of label and bin numbers as blocks: labels, then one run of numbers per input."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, count = TaskContext.get().partitionId(), 0, [], 0

        def block(some: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(some)
            y = whole.column("Y").to_numpy().astype(float)
            x = np.stack([whole.column(f"X{i}").to_numpy().astype(np.int16) for i in range(inputs)])
            return pa.RecordBatch.from_pydict({
                "PART": pa.array([part], pa.int32()), "BLOCK": pa.array([number], pa.int32()), "N": pa.array([len(y)], pa.int32()),
                "Y": pa.array([y.tobytes()], pa.binary()), "X": pa.array([x.tobytes()], pa.binary())})

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(at, BLOCK)
                if count and count + piece.num_rows > BLOCK:
                    yield block(held)
                    number, held, count = number + 1, [], 0
                held.append(piece)
                count += piece.num_rows
        if count:
            yield block(held)

    return pack


def _grower(folder: str | None, tasks: int, inputs: int, upper: list[int], *size) -> Callable:
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [tuple(row.values()) for batch in batches for row in batch.to_pylist()]
        grown = Forest(sorted(blocks), exchange(tasks, folder), inputs, upper, *size).grown()
        if BarrierTaskContext.get().partitionId() == 0:
            columns = list(zip(*grown))
            names = [c.split()[0] for c in TREES.split(", ")]
            types = [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return grow


def exchange(tasks: int, folder: str | None) -> Callable[[np.ndarray], list[np.ndarray]]:
    """A function that gives the values of every task, in the order of the tasks; all call it alike."""
    if tasks == 1:
        return lambda values: [values]
    context = BarrierTaskContext.get()
    if folder is None:

        def gather(values: np.ndarray) -> list[np.ndarray]:
            found = context.allGather(base64.b64encode(values.tobytes()).decode("ascii"))
            return [np.frombuffer(base64.b64decode(x), values.dtype).reshape(values.shape) for x in found]

        return gather
    os.makedirs(folder, exist_ok=True)
    me, step = context.partitionId(), 0

    def swap(values: np.ndarray) -> list[np.ndarray]:
        nonlocal step
        mine = f"{folder}/{step}-{me}"
        with open(f"{mine}.new", "wb") as file:
            file.write(values.tobytes())
        os.rename(f"{mine}.new", mine)
        found, until = [], time.monotonic() + LOST
        for task in range(tasks):
            while task != me:
                try:
                    with open(f"{folder}/{step}-{task}", "rb") as file:
                        found.append(np.frombuffer(file.read(), values.dtype).reshape(values.shape))
                    break
                except FileNotFoundError:
                    if time.monotonic() > until:
                        raise RuntimeError(f"task {task} is lost")
                    time.sleep(LOOK)
            else:
                found.append(values)
        if step:  # who sent this step has read the one before
            os.remove(f"{folder}/{step - 1}-{me}")
        step += 1
        return found

    return swap


class Forest:
    """One task's rows, and the trees that all tasks grow alike from the sums of all."""

    def __init__(
        self, blocks: list[tuple], all_of: Callable[[np.ndarray], list[np.ndarray]], inputs: int, upper: list[int], trees: int,
        depth: int, rate: float, rows: float, share: float, bins: int, seed: int,
    ):
        self.all_of, self.inputs, self.upper = all_of, inputs, np.array(upper, int)
        self.trees, self.depth, self.rate, self.rows, self.share, self.seed = trees, depth, rate, rows, share, seed
        self.parts = [(part, number, n) for part, number, n, *_ in blocks]
        self.rest = np.concatenate([np.empty(0), *(np.frombuffer(y) for *_, y, _ in blocks)])
        raw = [np.frombuffer(x, np.int16).reshape(inputs, -1) for *_, x in blocks]
        columns = [np.concatenate([np.empty(0, np.int16), *(x[i] for x in raw)]) for i in range(inputs)]
        self._bin(columns, bins)
        found = self.all_of(np.array([np.isfinite(self.rest).all()]))
        self.tasks, self.finite = len(found), all(x[0] for x in found)

    def _bin(self, columns: list[np.ndarray], bins: int) -> None:
        """Groups of bins where there are too many; each input's missing values become its last bin."""
        most = np.max(self.all_of(np.array([c.max(initial=-1) for c in columns], np.int64)), axis=0)
        places = np.concatenate([[0], np.cumsum(most + 1)])
        mine = np.concatenate([np.bincount(c[c >= 0], minlength=m + 1)[: m + 1] for c, m in zip(columns, most)])
        counts = np.sum(self.all_of(mine.astype(np.int64)), axis=0)
        self.bins, self.last = [], []  # per input: bin of each row, and the last given number of each bin
        for column, a, b in zip(columns, places, places[1:]):
            own = counts[a:b]
            group = np.arange(b - a)
            if b - a > bins:
                group = np.unique(((np.cumsum(own) - own) * bins) // max(1, own.sum()), return_inverse=True)[1]
            last = np.flatnonzero(np.append(group[1:] != group[:-1], True)) if b > a else np.empty(0, int)
            table = np.append(group, len(last)).astype(np.uint8 if len(last) < 256 else np.uint16)
            self.bins.append(table[column])  # -1 is the last of the table
            self.last.append(last)
        widths = np.array([len(x) + 1 for x in self.last])
        self.starts = np.concatenate([[0], np.cumsum(widths)])
        self.width = self.starts[-1]
        self.input_of = np.repeat(np.arange(self.inputs), widths)
        self.missing = self.starts[1:] - 1
        self.place = np.arange(self.width) - self.starts[self.input_of]

    def grown(self) -> list[tuple]:
        if not self.finite:  # as sums of missing numbers are
            return [(0, 0, -1, False, 0, 0, 0, float("nan"), 0.0)]
        out = []
        for tree in range(self.trees):
            out += [(tree, *node) for node in self._tree(tree)]
        return out

    def _tree(self, tree: int) -> list[tuple]:
        target = self.rest if tree == 0 else 2 * self.rest
        largest = np.abs(target).max(initial=0.0)
        self.unit = 2.0 ** (np.ceil(np.log2(largest)) - BITS) if largest > 0 else 1.0
        most = 2**BITS - 1
        self.packed = np.clip(np.rint(target / self.unit), -most, most) + COUNTED
        if self.rows < 1:
            drawn = np.concatenate([np.empty(0, bool), *(
                np.random.default_rng([self.seed, tree, part, number]).random(n) < self.rows for part, number, n in self.parts)])
            members = [(np.flatnonzero(drawn), np.flatnonzero(~drawn))]
        else:
            members = [(np.arange(len(self.rest)), np.empty(0, np.intp))]
        nodes: list[list] = [[-1, False, 0, 0, 0, 0.0, 0.0]]
        leaves: list[tuple[int, tuple, int]] = []  # node, rows, how many of all tasks
        ids, sums = [0], self._sums(members)
        totals = [int(sums[0][0, : self.starts[1]].sum())]
        for level in range(self.depth):
            if not ids:
                break
            splits = self._splits(*sums, np.random.default_rng([self.seed, tree, level]))
            below, parents = [], []
            for k, (node, rows) in enumerate(zip(ids, members)):
                gain, place, low, count = (x[k] for x in splits)
                if not gain > 0:
                    leaves.append((node, rows, totals[k]))
                    continue
                i = self.input_of[place]
                at = self.place[place]
                missing = len(self.last[i])
                goes = np.arange(missing + 1) <= at if at < missing else np.zeros(missing + 1, bool)
                goes[missing] = low
                halves = [goes[self.bins[i][r]] for r in rows]
                children = len(nodes), len(nodes) + 1
                nodes[node][:5] = int(i), bool(low), int(self.last[i][at]) if at < missing else -1, *children
                nodes[node][6] = float(gain)
                nodes += [[-1, False, 0, 0, 0, 0.0, 0.0] for _ in children]
                sides = [tuple(r[h] for r, h in zip(rows, halves)), tuple(r[~h] for r, h in zip(rows, halves))]
                below.append((children, sides, (int(count), totals[k] - int(count))))
                parents.append(k)
            if level + 1 == self.depth:
                leaves += [(child, rows, n) for both in below for child, rows, n in zip(*both)]
                ids = []
                break
            small = [int(n[1] < n[0]) for *_, n in below]
            summed = self._sums([sides[s] for s, (_, sides, _) in zip(small, below)])
            larger = [x[parents] - y for x, y in zip(sums, summed)]
            pick = [(2 * k + side, child, sides[side], n[side], side == s)
                    for k, (s, (both, sides, n)) in enumerate(zip(small, below)) for side, child in enumerate(both)]
            sums = tuple(np.array([(y if smaller else x)[at // 2] for at, *_, smaller in pick]).reshape(-1, self.width) for x, y in zip(larger, summed))
            ids, members, totals = [p[1] for p in pick], [p[2] for p in pick], [p[3] for p in pick]
        leaves += list(zip(ids, members, totals))
        self._settle(tree, target, nodes, leaves)
        return [(k, *node) for k, node in enumerate(nodes)]

    def _settle(self, tree: int, target: np.ndarray, nodes: list[list], leaves: list[tuple]) -> None:
        """Leaves get the mean of their drawn rows; all their rows go on with the rest."""
        totals = np.zeros(len(leaves))
        for found in self.all_of(np.array([target[rows[0]].sum() for _, rows, _ in leaves])):
            totals = totals + found
        weight = 1.0 if tree == 0 else self.rate
        rest = self.rest.copy() if tree == 0 else self.rest
        for (node, rows, n), total in zip(leaves, totals):
            value = nodes[node][5] = float(weight * total / n) if n else 0.0
            for r in rows:
                rest[r] -= value
        self.rest = rest

    def _sums(self, members: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Number and sum of the drawn rows of each node in each bin, over all tasks."""
        counts, sums = np.zeros((len(members), self.width), np.int64), np.zeros((len(members), self.width))
        at_once = max(1, MESSAGE // (self.tasks * self.width * 16))
        for first in range(0, len(members), at_once):
            mine = np.zeros((2, min(at_once, len(members) - first), self.width))
            for k, (rows, _) in enumerate(members[first : first + at_once]):
                for at in range(0, len(rows), CHUNK):
                    some = rows[at : at + CHUNK]
                    packed = self.packed[some]
                    both = np.concatenate([
                        np.bincount(column[some], weights=packed, minlength=len(last) + 1) for column, last in zip(self.bins, self.last)])
                    number = np.rint(both / COUNTED)
                    mine[0, k] += number
                    mine[1, k] += (both - number * COUNTED) * self.unit
            for found in self.all_of(mine):
                counts[first : first + at_once] += found[0].astype(np.int64)
                sums[first : first + at_once] += found[1]
        return counts, sums

    def _splits(self, counts: np.ndarray, sums: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, ...]:
        """Per node: gain (0 if there is no split), place of the last bin on the left, whether missing values go left, rows on the left."""
        m, first = len(counts), self.starts[self.input_of]
        columns = self.inputs + len(self.upper)
        drawn = np.zeros((m, columns), bool)
        chosen = draw.random((m, columns)).argsort(axis=1)[:, : int(np.ceil(self.share * columns))]
        np.put_along_axis(drawn, chosen, True, axis=1)
        raised = np.zeros((m, self.inputs), bool)
        raised[:, self.upper] = drawn[:, self.inputs :]
        last = np.isin(np.arange(self.width), self.missing)
        lefts = []
        for values in (counts, sums):
            running = np.concatenate([np.zeros((m, 1), values.dtype), values.cumsum(axis=1)], axis=1)
            until = running[:, 1:] - running[:, first]
            absent = values[:, self.missing[self.input_of]]
            lefts.append((np.where(last, absent, until + absent), until, values[:, : self.starts[1]].sum(axis=1)[:, None]))
        (n_low, n_high, n), (s_low, s_high, s) = lefts
        base = s**2 / np.maximum(n, 1)
        gains = []
        for left, total, allowed in ((n_low, s_low, drawn[:, : self.inputs][:, self.input_of]), (n_high, s_high, raised[:, self.input_of] & ~last)):
            right = n - left
            gain = total**2 / np.maximum(left, 1) + (s - total) ** 2 / np.maximum(right, 1) - base
            gains.append(np.where(allowed & (left > 0) & (right > 0) & (gain > LEAST_GAIN * base), gain, 0.0))
        gains = np.concatenate(gains, axis=1)
        best = gains.argmax(axis=1)
        every = np.arange(m)
        return gains[every, best], best % self.width, best < self.width, np.concatenate([n_low, n_high], axis=1)[every, best]
