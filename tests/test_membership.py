"""The filter of keys, and the scrape that never shuffles HTML."""

import pytest
from pyspark.sql import functions as F

from webtext.operators.membership import MOST_BLOCKS, key_filter, probably_in
from webtext.plans import stages
from webtext.sources import shared


def test_every_key_passes_and_few_others(spark):
    keys = spark.range(0, 40_000, 2).select(F.col("id").alias("k"), F.concat(F.lit("u"), "id").alias("u"))
    rows = spark.range(40_000).select(F.col("id").alias("k"), F.concat(F.lit("u"), "id").alias("u"), F.lit("x").alias("_extra"))
    # 163,840 bits for 20,000 keys: 8 a key.
    got = probably_in(rows, ["k", "u"], key_filter(keys.unionByName(keys), ["k", "u"], 5), 5)
    assert got.columns == ["k", "u", "_extra"]
    found = [r.k for r in got.collect()]
    assert len(found) == len(set(found)) and set(range(0, 40_000, 2)) <= set(found)
    assert len(found) < 20_000 * 1.06


def test_nulls_empty_tables_and_repeated_rows(spark):
    rows = spark.createDataFrame([(None,), ("",), ("a",), ("a",), ("b",)], "u string")
    assert probably_in(rows, ["u"], key_filter(rows.where("false"), ["u"])).count() == 0
    assert probably_in(rows.where("false"), ["u"], key_filter(rows, ["u"])).count() == 0
    got = [r.u for r in probably_in(rows, ["u"], key_filter(rows.where("u = 'a' or u is null"), ["u"])).collect()]
    assert sorted(map(str, got)) == ["None", "a", "a"]


@pytest.mark.parametrize("blocks", [0, MOST_BLOCKS + 1])
def test_size_of_the_filter_is_bounded(spark, blocks):
    with pytest.raises(ValueError):
        key_filter(spark.range(1), ["id"], blocks)


def shuffled_columns(node):
    """Names of the columns that each exchange below ``node`` carries, broadcasts aside."""
    out = []
    if "ShuffleExchange" in node.getClass().getSimpleName():
        columns = node.output()
        out.append({columns.apply(i).name() for i in range(columns.size())})
    children = node.children()
    for i in range(children.size()):
        out += shuffled_columns(children.apply(i))
    return out


def test_no_exchange_carries_html(spark, sf, monkeypatch):
    """With tables too large to broadcast, texts are shuffled and pages are not."""
    monkeypatch.setattr(shared, "SPREAD_BYTES", 0)
    given = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in given}
    try:
        for k, v in given.items():
            spark.conf.set(k, v)
        pages = spark.read.parquet(f"{sf}/pages.parquet")
        docs, _ = stages.scrape(pages.select("url").where("page_id % 3 = 0"), pages)
        carried = shuffled_columns(docs._jdf.queryExecution().executedPlan())
        assert any("content" in c for c in carried) and not any("html" in c for c in carried)
        assert docs.count() == pages.where("page_id % 3 = 0").select("url").distinct().count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
