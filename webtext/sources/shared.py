"""Work folders that every executor can reach, and tables written to them.

Intermediate results that are read more than once, or that must not change when
a lost task is run again, are written as parquet under the folder the cluster
names in ``spark.checkpoint.dir``. They survive the loss of any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPREAD_BYTES = 8 << 20
MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def work_dir(spark: SparkSession, label: str) -> str:
    """New, not yet existing folder path under ``spark.checkpoint.dir``.

    Without that setting a local session gets a temporary folder; a cluster
    session is refused, since a machine-local folder would not be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="webtext-")
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if (made := MADE.get()) is not None:
        made.append(path)
    return path


@contextmanager
def work_listed() -> Iterator[list[str]]:
    """List of the work folders named inside; remove them when nothing reads them any more."""
    made: list[str] = []
    token = MADE.set(made)
    try:
        yield made
    finally:
        MADE.reset(token)


def remove_work(spark: SparkSession, paths: list[str]) -> None:
    """Remove work folders, in whatever store they are; those that are gone are passed over."""
    conf = spark._jsc.hadoopConfiguration()
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of what was written."""
    path = path or work_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give a small input one partition per core; a larger one is left alone.

    For CPU-heavy projections over one or two small files, which would run in
    as many tasks. The size is the optimizer's estimate, so nothing is run to
    find it; from ``SPREAD_BYTES`` per core on no shuffle is added.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * SPREAD_BYTES else df


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that later filters on them reuse their value.

    A plain projection would be copied into every filter above it and run
    again there; a generator is not.
    """
    entry = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(entry)))


def absent_from(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``table``, for a small ``df`` and a
    table that keeps growing.

    The table is first cut to the keys of ``df``: while these are small enough
    for Spark to broadcast, the table is scanned but not shuffled.
    """
    hits = table.select(key).join(df.select(key), key, "left_semi")
    return df.join(hits, key, "left_anti")
