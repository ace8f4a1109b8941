"""Spark session and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: File bytes of input per shuffle partition, and the most partitions.
PARTITION_BYTES, MOST_PARTITIONS = 2 << 20, 20_000
_OWN_FOLDERS: dict[str, str] = {}


def get_session(app: str = "weekloom", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution, skew-join splitting, fair scheduling and UTC dates.

    ``forceOptimizeSkewedJoin`` lets AQE split a hot store or part even when the
    split costs one more shuffle later; results do not change.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.scheduler.mode": "FAIR",
        "spark.sql.maxMetadataStringLength": "1000",  # plans name whole paths
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        app = context.applicationId
        named = _OWN_FOLDERS.setdefault(app, "") or tempfile.mkdtemp(prefix="weekloom-")
        _OWN_FOLDERS[app] = named
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def partitions_for(df: DataFrame) -> int:
    """Shuffle partitions in proportion to the files that ``df`` reads, so that a task's memory doesn't grow with
    them; one per core at least."""
    spark = df.sparkSession
    config, total = spark._jsc.hadoopConfiguration(), 0
    for name in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        total += path.getFileSystem(config).getFileStatus(path).getLen()
    return max(spark.sparkContext.defaultParallelism, min(MOST_PARTITIONS, -(-total // PARTITION_BYTES)))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables written inside give back the disk of their shuffles when they are written; otherwise that waits until the
    driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
