"""The registered capped crawl visits up to half as many pages as there are."""

import os

from pyspark.sql import functions as F

from checks import inputs as I
from checks.catalog import QUERIES, first_page
from webtext.operators.crawl import bounded_crawl


def test_cap_is_half_the_pages(spark, new_dir):
    folder = new_dir("pages")
    os.makedirs(folder)
    rows = spark.range(1, 25).select(
        F.col("id").alias("page_id"), F.concat(F.lit("https://s.example/p"), F.col("id")).alias("url"), F.lit("").alias("html")
    )
    rows.toPandas().to_parquet(f"{folder}/pages.parquet", index=False)
    found = [r.url for r in QUERIES["bounded_crawl_capped"](spark, folder).collect()]
    reached = bounded_crawl(I.link_table(spark, folder), first_page(spark, folder)).count()
    assert reached > 24 // 8
    assert len(found) == len(set(found)) == min(reached, 12)
