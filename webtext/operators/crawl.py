"""Crawl of a link table: breadth-first rounds with a page cap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from webtext.operators.links import minus
from webtext.operators.ordering import first_rows, running_total
from webtext.sources.shared import absent_from, materialize, work_dir

SAVE_EVERY = 5
# Beyond this many visited pages a round compares its links in two steps.
LARGE_VISITED = 1_000_000
# After this many rounds the folders of the visited pages are merged.
MERGE_ROUNDS = 16


def bounded_crawl(
    links: DataFrame,
    seeds: DataFrame,
    failed: DataFrame | None = None,
    max_pages: int | None = None,
) -> DataFrame:
    """``url, level, success`` of every page visited, levels counted from 0.

    ``links`` holds ``url, link``. Pages are visited by (level, url) until
    nothing new is found or ``max_pages`` are visited. A failed page counts as
    visited but adds no links.

    Each round is written to the work folder, so the plan of round n does not
    contain round n-1, and the next frontier has a known size: Spark broadcasts
    it when that is small, so the edges are only scanned. Beyond that the
    semi-join shuffles, and adaptive execution splits a page that holds a large
    share of the links. Once many pages are visited, the links found are
    written too, so that a small round does not shuffle all visited pages.
    """
    spark = links.sparkSession
    root = work_dir(spark, "crawl")
    edges = links.select("url", "link")
    if failed is not None:
        edges = edges.join(failed.select("url").distinct(), "url", "left_anti")
    edges = materialize(edges, "edges", f"{root}/edges")

    def read(*paths: str) -> DataFrame:
        return spark.read.schema("url string, level int").parquet(*paths)

    def unvisited(urls: DataFrame, visited: DataFrame) -> DataFrame:
        if total <= LARGE_VISITED:
            return minus(urls, visited)
        return absent_from(materialize(urls.distinct(), "found", f"{root}/found-{level:06d}"), visited, "url")

    paths: list[str] = []
    total, level, found = 0, 0, seeds.select("url").distinct()
    while max_pages is None or total < max_pages:
        size = Observation()
        path = f"{root}/level-{level:06d}"
        leveled = found.select("url", F.lit(level).alias("level"))
        leveled.observe(size, F.count("*").alias("rows")).write.parquet(path)
        rows = size.get["rows"]
        if rows == 0:
            break
        if max_pages is not None and total + rows > max_pages:
            rows = max_pages - total
            kept = first_rows(read(path), rows, "url")
            path = f"{root}/last"
            materialize(kept, "last", path)
        paths.append(path)
        total, level = total + rows, level + 1
        if len(paths) > MERGE_ROUNDS:
            merged = f"{root}/merged-{level:06d}"
            materialize(read(*paths), "merged", merged)
            paths = [merged]
        next_links = edges.join(read(path).select("url"), "url", "left_semi")
        found = unvisited(next_links.select(F.col("link").alias("url")), read(*paths).select("url"))

    visited = read(*paths) if paths else spark.createDataFrame([], "url string, level int")
    if failed is None:
        return visited.withColumn("success", F.lit(True))
    marks = failed.select("url").distinct().withColumn("_failed", F.lit(True))
    return visited.join(marks, "url", "left").select(
        "url", "level", F.col("_failed").isNull().alias("success")
    )


def discovery_curve(
    visits: DataFrame, keys: list[str], known_count: int = 0, every: int = SAVE_EVERY
) -> DataFrame:
    """``visit, urls_count``: unique links known after every ``every``-th visit.

    ``visits`` has the keys, ``visit`` counted from 1, ``new_links`` and
    ``success``; visits that failed save nothing.
    """
    summed = running_total(visits, keys, "visit", "new_links", "_found")
    return summed.where((F.col("visit") % every == 0) & F.col("success")).select(
        *keys, "visit", (F.col("_found") + F.lit(known_count)).alias("urls_count")
    )
