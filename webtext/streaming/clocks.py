"""Pacing of a request stream with each domain's clock in a keyed state store.

Requests of a domain are first cut into slices of time. Inside a slice all waits but the
first one's follow from the slice itself, in whichever task has it; only the ends of each
slice, one row, go to the domain's state. So a domain with most of the requests sends few
rows to the one task that holds its clock, and the state is one number a domain.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from webtext.operators.pacing import MICROS
from webtext.streaming.batches import write_batch

# The process that prepares the state has its own import path: send these classes whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Read when a query starts. Timers run in batches that have data; batches of their own would
# follow one another without end.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
REQUEST = "id long, domain string, ts_us long"
WAIT = f"{REQUEST}, wait_us long"
# Rows of a slice; the wait of its first request is not known yet, and that row carries
# the time of its last.
CUT = f"{WAIT}, last_us long"


def cut_slices(delay_us: int):
    """Function of a partition that holds whole slices (``id, domain, ts_us, slice``)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(parts)
        if not sum(b.num_rows for b in batches):
            return
        rows = pa.Table.from_batches(batches)
        rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in ("domain", "slice", "ts_us", "id")]))
        domain = pc.dictionary_encode(rows["domain"].combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        slices, ts = rows["slice"].to_numpy(), rows["ts_us"].to_numpy()
        first = np.append(True, (domain[1:] != domain[:-1]) | (slices[1:] != slices[:-1]))
        wait = np.maximum(0, delay_us - np.diff(ts, prepend=ts[:1]))
        starts = np.flatnonzero(first)
        last = np.zeros(len(ts), np.int64)
        last[starts] = ts[np.append(starts[1:], len(ts)) - 1]
        columns = [rows["id"], rows["domain"], rows["ts_us"], pa.array(wait, mask=first), pa.array(last, mask=~first)]
        yield from pa.Table.from_arrays(columns, ["id", "domain", "ts_us", "wait_us", "last_us"]).to_batches(10_000)

    return run


class DomainClock(StatefulProcessor):
    """Keeps a domain's last request and gives the wait of the first request of each slice.

    A domain idle for ``forget_ms`` of the cluster's time is forgotten at the next batch. Its next request
    then waits 0, as it would anyway if requests arrive as they are made and
    ``forget_ms`` is no shorter than the delay."""

    def __init__(self, delay_us: int, forget_ms: int):
        self.delay_us, self.forget_ms = delay_us, forget_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last_us long, due_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ends = pd.concat(list(rows)).sort_values(["ts_us", "id"])
        reached = np.maximum.accumulate(ends.last_us.to_numpy(np.int64))
        known = self.last.get() if self.last.exists() else None
        before = np.append(known[0] if known else np.nan, reached[:-1].astype(float))
        gap = ends.ts_us.to_numpy(float) - before
        wait = np.where(np.isnan(gap), 0, np.maximum(0, self.delay_us - gap))
        due = timerValues.getCurrentProcessingTimeInMs() + self.forget_ms
        if known:
            self.handle.deleteTimer(known[1])
        self.handle.registerTimer(due)
        self.last.update((int(max(reached[-1], known[0] if known else reached[-1])), due))
        yield pd.DataFrame({"id": ends.id, "domain": ends.domain, "ts_us": ends.ts_us, "wait_us": wait.astype(np.int64)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


def pace_with_clocks(
    requests: DataFrame, delay_seconds: float, out: str, checkpoint: str,
    slice_seconds: int = 60, forget_seconds: float = 7 * 86_400, **trigger,
) -> StreamingQuery:
    """Write ``id, domain, ts_us, wait_us`` of the arriving ``domain, ts_us, id``.

    The same rows as ``jobs.pace_requests``, which keeps a table of clocks instead of
    keyed state. Requests of a domain must not arrive in a later micro-batch than requests
    made after them; clocks of different domains are independent, so there is no watermark
    and no request is dropped. Restarts continue from the checkpoint; a micro-batch that runs
    again overwrites its own folder.
    """
    spark = requests.sparkSession
    delay_us = round(delay_seconds * MICROS)
    given = requests.select(F.col("id").cast("long"), F.col("domain").cast("string"), F.col("ts_us").cast("long"))
    sliced = given.withColumn("slice", F.expr(f"ts_us div {slice_seconds * MICROS}")).repartition("domain", "slice")
    cut = sliced.mapInArrow(cut_slices(delay_us), CUT)
    known = cut.where("wait_us is not null").drop("last_us")
    clock = DomainClock(delay_us, round(forget_seconds * 1000))
    firsts = cut.where("wait_us is null").groupBy("domain").transformWithStateInPandas(clock, WAIT, "Append", "ProcessingTime")
    writer = known.unionByName(firsts).writeStream.foreachBatch(lambda batch, n: write_batch(batch, out, n))
    writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return writer.start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
