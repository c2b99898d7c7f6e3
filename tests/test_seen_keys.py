"""The table of keys that earlier batches wrote."""

import os

from pyspark.sql import functions as F

from webtext.streaming import jobs, seen
from webtext.streaming.batches import write_batch
from webtext.streaming.seen import SeenKeys


def keys(spark, start, end):
    return spark.range(start, end).select(F.concat(F.lit("k"), "id").alias("url"))


def step(spark, root, batch_id, rows):
    table = SeenKeys(spark, root, "url", batch_id, blocks=8)
    fresh = sorted(r.url for r in table.unseen(rows).collect())
    opened = len(table.folders())
    table.add(spark.createDataFrame([(u,) for u in fresh], "url string"))
    return fresh, opened


def test_each_key_is_new_once_over_compactions_and_reruns(spark, new_dir, monkeypatch):
    monkeypatch.setattr(seen, "COMPACT", 3)
    root, written = new_dir("seen"), set()
    for i in range(8):
        rows = keys(spark, i * 10, i * 10 + 25)
        want = {r.url for r in rows.collect()} - written
        fresh, opened = step(spark, root, i, rows)
        assert set(fresh) == want and opened <= 3
        if i in (2, 3, 5):  # after a failure the batch comes again, the compacting one too
            assert step(spark, root, i, rows)[0] == fresh
        written |= want
    assert len(written) == 95
    left = os.listdir(root)
    assert sum(n.startswith("filter-") for n in left) == 2 and sum(n.startswith("whole-") for n in left) == 1


def test_new_keys_open_no_table_of_keys(spark, new_dir):
    root = new_dir("seen")
    step(spark, root, 0, keys(spark, 0, 100))
    table = SeenKeys(spark, root, "url", 1, blocks=8)
    fresh = table.unseen(keys(spark, 1000, 1003))
    assert not any("keys-0" in f for f in fresh.inputFiles()) and fresh.count() == 3
    # One key seen before: one bucket of the earlier table is read.
    again = table.unseen(keys(spark, 50, 51))
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan and again.count() == 0
    assert SeenKeys(spark, root, "url", 1, blocks=8).unseen(keys(spark, 0, 0)).count() == 0


def test_an_output_without_the_table_is_taken_over(spark, new_dir):
    for last in (0, seen.COMPACT - 1):
        out = new_dir("out")
        for i in {0, last}:
            write_batch(keys(spark, i, i + 20), out, i)
        got = jobs.seen_links(spark, out, last + 1).unseen(keys(spark, 0, last + 25))
        assert sorted(r.url for r in got.collect()) == sorted(f"k{i}" for i in range(last + 20, last + 25))
