"""Streams over several files and restarts equal their batch forms."""

import os
import shutil

from pyspark.sql import functions as F

from checks.inputs import own_site
from webtext.operators import links, pacing
from webtext.plans import stages
from webtext.streaming import jobs
from webtext.streaming.batches import read_all, read_before, stream_table, write_batch


def split_files(df, order, folder, parts):
    """One file per slice of ``df`` in order, with rising modification times."""
    os.makedirs(folder)
    rows = df.orderBy(order).toPandas()
    step = -(-len(rows) // parts)
    for i in range(parts):
        path = f"{folder}/part-{i}.parquet"
        rows.iloc[i * step : (i + 1) * step].to_parquet(path, index=False, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_discovery_over_files_and_a_restart(spark, sf, new_dir):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    source, out, checkpoint = new_dir("in"), new_dir("out"), new_dir("cp")
    split_files(pages, "page_id", source, 4)
    later = new_dir("later")
    os.makedirs(later)
    shutil.move(f"{source}/part-3.parquet", later)
    known = links.page_links(pages.where("page_id < 5"), own_site()).select(F.col("link").alias("url"))

    def run():
        stream = stream_table(spark, source, pages.schema, files_per_trigger=1)
        jobs.discover_links(stream, own_site(), out, checkpoint, known).awaitTermination()

    run()
    partial = read_all(spark, out, jobs.URLS).count()
    shutil.copy(f"{later}/part-3.parquet", source)
    run()
    found = links.page_links(pages, own_site()).select(F.col("link").alias("url"))
    assert rows(read_all(spark, out, jobs.URLS), "url") == rows(links.minus(found, known), "url")
    assert 0 < partial < read_all(spark, out, jobs.URLS).count()


def test_pacing_over_files_equals_batch(spark, sf, new_dir):
    events = spark.read.parquet(f"{sf}/events.parquet")
    source = new_dir("in")
    split_files(events, "ts", source, 5)

    def requests(df):
        return df.select(
            F.col("event_id").alias("id"),
            F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("user_id").cast("string")).alias("domain"),
            pacing.micros(F.col("ts")).alias("ts_us"),
        )

    out, state = new_dir("out"), new_dir("state")
    stream = requests(stream_table(spark, source, events.schema, files_per_trigger=1))
    jobs.pace_requests(stream, 7200, out, state, new_dir("cp")).awaitTermination()
    assert len([d for d in os.listdir(out) if d.startswith("batch_id=")]) == 5
    want = pacing.politeness_wait(requests(events), 7200)
    columns = ("id", "domain", "ts_us", "wait_us")
    assert rows(read_all(spark, out, jobs.WAITS), *columns) == rows(want, *columns)


def test_cleaning_over_files_keeps_one_document_per_id(spark, sf, new_dir):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    copies = pages.where("page_id % 4 = 0").withColumn("page_id", F.col("page_id") + 1000)
    source, out, metadata = new_dir("in"), new_dir("out"), new_dir("meta")
    split_files(pages.unionByName(copies), "page_id", source, 3)
    stream = stream_table(spark, source, pages.schema, files_per_trigger=1)
    at = F.to_timestamp(F.lit("2025-04-22 15:08:45"))
    jobs.clean_stream(stream, out, metadata, new_dir("cp"), at).awaitTermination()
    columns = ("document_id", "url", "title", "content", "n_words")
    assert rows(read_all(spark, out, jobs.DOCUMENTS), *columns) == rows(stages.documents(pages), *columns)
    assert read_all(spark, metadata, jobs.METADATA).select("id").distinct().count() == pages.count()


def test_a_repeated_batch_replaces_its_own_folder(spark, new_dir):
    root = new_dir("table")
    for batch_id, value in ((0, "a"), (1, "b"), (1, "c")):
        write_batch(spark.createDataFrame([(value,)], jobs.URLS), root, batch_id)
    assert rows(read_all(spark, root, jobs.URLS), "url") == [("a",), ("c",)]
    assert rows(read_before(spark, root, jobs.URLS, 1), "url") == [("a",)]
    assert read_before(spark, root + "-none", jobs.URLS, 1).count() == 0
