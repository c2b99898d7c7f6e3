"""Keys that earlier micro-batches have written, kept so that a batch reads little of them.

Beside the keys stands a filter of all of them, of fixed size. Keys of a batch that the
filter does not know are new without a look at any table; the others are compared exactly,
with the buckets they fall into alone. Every batch writes its own folders and reads those
of the batches before it, so one that is run again gives the same result. Each
``COMPACT``-th batch writes all keys as one table and the next ones read that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtext.operators.membership import BLOCKS, key_filter, probably_in
from webtext.sources.readers import exists
from webtext.sources.shared import materialize, remove_work

BUCKETS = 64
COMPACT = 16


class SeenKeys:
    """Distinct non-null strings under ``root``; one name ``key`` in tables given and returned."""

    def __init__(self, spark: SparkSession, root: str, key: str, batch_id: int, blocks: int = BLOCKS):
        self.spark, self.root, self.key, self.batch_id, self.blocks = spark, root, key, batch_id, blocks
        # The last batch before this one that wrote all keys as one table.
        self.base = batch_id // COMPACT * COMPACT - 1

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.lit(2), self.key), F.lit(BUCKETS)).cast("int").alias("bucket")

    def folders(self) -> list[str]:
        """What holds the keys of the batches before: the last whole table and at most
        ``COMPACT - 1`` batches after it."""
        whole = [f"{self.root}/whole-{self.base}"] if self.base >= 0 else []
        paths = whole + [f"{self.root}/keys-{i}" for i in range(self.base + 1, self.batch_id)]
        return [p for p in paths if exists(self.spark, p)]

    def keys(self, paths: list[str], buckets: list[int] | None = None) -> DataFrame:
        """Keys in ``paths``, of some buckets; folders of other buckets are not opened."""
        rows = self.spark.createDataFrame([], f"{self.key} string, bucket int")
        for path in paths:
            rows = rows.unionByName(self.spark.read.schema(rows.schema).parquet(path))
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    def known(self) -> DataFrame | None:
        path = f"{self.root}/filter-{self.batch_id - 1}"
        return self.spark.read.schema("_block int, _bits binary").parquet(path) if exists(self.spark, path) else None

    def unseen(self, rows: DataFrame) -> DataFrame:
        """``rows`` whose key no earlier batch has written. ``rows`` are read more than once."""
        known = self.known()
        if known is None:
            return rows
        perhaps = probably_in(rows.select(self.key), [self.key], known, self.blocks)
        perhaps = materialize(perhaps.select(self.key, self.bucket()).distinct(), "perhaps", f"{self.root}/perhaps")
        buckets = sorted(r.bucket for r in perhaps.select("bucket").distinct().collect())
        if not buckets:
            return rows
        hits = self.keys(self.folders(), buckets).join(perhaps, [self.key, "bucket"], "left_semi")
        return rows.join(hits.select(self.key), self.key, "left_anti")

    def add(self, fresh: DataFrame) -> None:
        """Remember the keys of ``fresh``; call it once the batch's own rows are written."""
        new = fresh.select(self.key, self.bucket())
        path = f"{self.root}/keys-{self.batch_id}"
        new.repartition(F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)
        made, known = key_filter(fresh, [self.key], self.blocks), self.known()
        if known is not None:
            made = made.unionByName(known).groupBy("_block").agg(F.bitmap_or_agg("_bits").alias("_bits"))
        materialize(made, "filter", f"{self.root}/filter-{self.batch_id}")
        if self.batch_id % COMPACT == COMPACT - 1:
            whole = self.keys([*self.folders(), path]).repartition(F.col("bucket"))
            whole.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/whole-{self.batch_id}")
        # This batch may run again and needs the filter before it; older ones are done with.
        gone = [f"{self.root}/filter-{self.batch_id - 2}"]
        if self.batch_id == self.base + 1 and self.base >= 0:
            gone += [f"{self.root}/whole-{self.base - COMPACT}"]
            gone += [f"{self.root}/keys-{i}" for i in range(self.base - COMPACT + 1, self.base + 1)]
        remove_work(self.spark, gone)
