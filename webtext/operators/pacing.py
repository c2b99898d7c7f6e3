"""Request pacing and retries over request and attempt logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtext.operators.ordering import HOT_ROWS, in_blocks

MICROS = 1_000_000


def politeness_wait(
    requests: DataFrame,
    delay_seconds: float,
    last_request: DataFrame | None = None,
    block_seconds: int = 60,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``wait_us``, how long each request should have waited.

    ``requests`` has ``domain, ts_us, id`` and perhaps more. The wait is the
    delay minus the time since the domain's previous request, never below 0; a
    domain's first request waits 0. ``last_request`` (``domain, last_us``)
    holds earlier requests of the domains.

    A domain with more than ``hot_rows`` requests is not sorted in one task:
    its window runs inside blocks of ``block_seconds``, and the last request of
    each block is carried to the domain's next block. Choose ``block_seconds``
    so that the busiest domain's block fits a task.
    """
    blocked = in_blocks(requests, ["domain"], "ts_us", block_seconds * MICROS, hot_rows)
    tails = blocked.where("_hot").groupBy("domain", "_block").agg(F.max("ts_us").alias("_tail"))
    by_domain = Window.partitionBy("domain").orderBy("_block")
    carried = tails.select("domain", "_block", F.lag("_tail").over(by_domain).alias("_carried"))
    if last_request is not None:
        last = last_request.select("domain", "last_us")
        hot = tails.select("domain").distinct()
        carried = carried.join(last, "domain", "left").select(
            "domain", "_block", F.coalesce("_carried", "last_us").alias("_carried")
        )
        carried = carried.unionByName(
            last.join(hot, "domain", "left_anti").select(
                "domain", F.lit(0).cast("bigint").alias("_block"), F.col("last_us").alias("_carried")
            )
        )
    inside = Window.partitionBy("domain", "_block").orderBy("ts_us", "id")
    previous = F.coalesce(F.col("_inside"), F.col("_carried"))
    gap = F.lit(round(delay_seconds * MICROS)) - (F.col("ts_us") - previous)
    return (
        blocked.withColumn("_inside", F.lag("ts_us").over(inside))
        .join(carried, ["domain", "_block"], "left")
        .withColumn("wait_us", F.greatest(F.lit(0).cast("bigint"), gap))
        .drop("_block", "_hot", "_inside", "_carried")
    )


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; zone-less times are read in the session zone."""
    return F.unix_micros(ts.cast("timestamp"))


def retry_resolution(attempts: DataFrame, retries: int, *order: str) -> DataFrame:
    """``url, attempts, success`` after at most ``retries`` attempts per URL.

    Attempts are taken in ``order`` and stop at the first success. The rank
    filter lets Spark keep only ``retries`` rows per URL on the map side, so a
    URL with very many attempts does not travel whole.
    """
    in_order = Window.partitionBy("url").orderBy(*order)
    tried = attempts.withColumn("_n", F.row_number().over(in_order)).where(F.col("_n") <= retries)
    first_success = F.min(F.when(F.col("success"), F.col("_n")))
    return tried.groupBy("url").agg(
        F.coalesce(first_success, F.max("_n")).alias("attempts"),
        F.max("success").alias("success"),
    )
