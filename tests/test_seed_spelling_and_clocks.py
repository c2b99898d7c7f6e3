"""Seeds in other spellings load their page; clocks of domains are independent."""

import os

import pytest
from pyspark.sql import functions as F

from webtext.plans import stages
from webtext.streaming import jobs
from webtext.streaming.batches import read_all, stream_table

SITE = "ex.org"
ROWS = [
    (1, "https://ex.org/", '<a href="/a">a</a> <a href="/b">b</a>'),
    (2, "https://ex.org/a", '<a href="/c">c</a>'),
    (3, "https://ex.org/b", "none"),
    (4, "https://ex.org/c", "none"),
]


@pytest.mark.parametrize("start", ["https://ex.org", "https://ex.org/", "https://ex.org/?utm=1", "https://ex.org/#x", "https://ex.org/a;v=1"])
def test_start_url_in_any_spelling(spark, start):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    crawl = stages.crawl_site(pages, SITE, start)
    visited = {r["url"]: r["success"] for r in crawl.visited.collect()}
    assert visited[start] and all(visited.values())
    assert set(visited) - {start} == ({"https://ex.org/c"} if "/a" in start else {"https://ex.org/a", "https://ex.org/b", "https://ex.org/c"})


def test_known_url_with_a_slash(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    known = spark.createDataFrame([("https://ex.org/a/",)], "url string")
    visited = {r["url"]: r["success"] for r in stages.crawl_site(pages, SITE, "https://ex.org", known=known).visited.collect()}
    assert visited["https://ex.org/a/"] and visited["https://ex.org/c"]


def test_domains_with_offset_clocks(spark, new_dir):
    source, out, state = new_dir("in"), new_dir("out"), new_dir("state")
    os.makedirs(source)
    schema = "id long, domain string, ts_us long"
    for i, batch in enumerate(([(1, "A", 1_000_000_000), (2, "B", 10_000_000)], [(3, "B", 20_000_000)])):
        part = new_dir("part")
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(part)
        (name,) = [f for f in os.listdir(part) if f.startswith("part-")]
        target = f"{source}/part-{i}.parquet"
        os.rename(f"{part}/{name}", target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    frame = spark.createDataFrame([], schema)
    stream = stream_table(spark, source, frame.schema, files_per_trigger=1)
    jobs.pace_requests(stream, 50, out, state, new_dir("cp")).awaitTermination()
    waits = {r["id"]: r["wait_us"] for r in read_all(spark, out, jobs.WAITS).select("id", F.col("wait_us")).collect()}
    assert waits == {1: 0, 2: 0, 3: 40_000_000}
