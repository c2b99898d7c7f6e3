"""Streaming jobs. Each returns a started query; results are batch tables.

They carry state in tables rather than in a keyed operator: a keyed operator
would send every row of a hot URL or domain to one task, while here the rows
of a micro-batch are combined on the map side, or split by time, first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webtext.functions import identity as I
from webtext.operators.links import page_links
from webtext.operators.pacing import politeness_wait
from webtext.plans.stages import documents, page_metadata
from webtext.sources.shared import absent_from, materialize
from webtext.streaming.batches import read_batch, read_before, write_batch
from webtext.streaming.seen import SeenKeys

URLS = "url string"
LAST_REQUEST = "domain string, last_us bigint"
WAITS = "id bigint, domain string, ts_us bigint, wait_us bigint"
DOCUMENTS = "document_id string, url string, title string, content string, n_words int"
METADATA = "id string, title string, url string, created_at timestamp"


def _start(stream: DataFrame, on_batch, checkpoint: str, trigger: dict) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def seen_links(spark: SparkSession, out: str, batch_id: int) -> SeenKeys:
    """Links of the batches before; those of an ``out`` that has no such table yet are put in."""
    seen = SeenKeys(spark, f"{out}-seen", "url", batch_id)
    if batch_id and seen.known() is None:
        SeenKeys(spark, f"{out}-seen", "url", batch_id - 1).add(read_before(spark, out, URLS, batch_id))
    return seen


def discover_links(
    pages: DataFrame, site: Column | str, out: str, checkpoint: str, known: DataFrame | None = None,
    **trigger,
) -> StreamingQuery:
    """Write each internal link of the arriving pages once, across restarts. Links already
    written are remembered in ``{out}-seen``."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = seen_links(spark, out, batch_id)
        found = page_links(batch, site).select(F.col("link").alias("url")).distinct().persist()
        fresh = seen.unseen(found)
        if known is not None:
            fresh = absent_from(fresh, known, "url")
        write_batch(fresh, out, batch_id)
        found.unpersist()
        seen.add(read_batch(spark, out, URLS, batch_id))

    return _start(pages, on_batch, checkpoint, trigger)


def pace_requests(
    requests: DataFrame, delay_seconds: float, out: str, state: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Write ``id, domain, ts_us, wait_us`` of the arriving ``domain, ts_us, id``.

    ``state`` holds the last request per domain after every micro-batch, which
    is all the next one needs. Requests of a domain must not arrive in a later
    micro-batch than requests made after them; clocks of different domains are
    independent, so the state keeps every domain: one row each.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("domain", F.col("domain").cast("string"))
        last = read_batch(spark, state, LAST_REQUEST, batch_id - 1)
        waits = politeness_wait(batch, delay_seconds, last).select("id", "domain", "ts_us", "wait_us")
        write_batch(waits, out, batch_id)
        now = batch.groupBy("domain").agg(F.max("ts_us").alias("last_us"))
        merged = now.unionByName(last).groupBy("domain").agg(F.max("last_us").alias("last_us"))
        write_batch(merged, state, batch_id)

    return _start(requests, on_batch, checkpoint, trigger)


def clean_stream(
    pages: DataFrame, out: str, metadata: str, checkpoint: str, created_at: Column, **trigger
) -> StreamingQuery:
    """Write the documents and metadata of the arriving pages, once per id."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        present = read_before(spark, out, DOCUMENTS, batch_id).select("document_id")
        batch = batch.withColumn("document_id", I.document_id(F.col("url")))
        # Ids are compared first, without the HTML; of one id the first page wins.
        winners = batch.groupBy("document_id").agg(F.min("page_id").alias("page_id"))
        winners = absent_from(winners, present, "document_id")
        fresh = documents(batch.join(winners, ["document_id", "page_id"], "left_semi"))
        written = materialize(fresh, "documents", f"{out}/batch_id={batch_id}")
        write_batch(page_metadata(written, created_at), metadata, batch_id)

    return _start(pages, on_batch, checkpoint, trigger)
