"""Pacing with keyed state: several batches, a restart, a hot domain and forgotten domains."""

import os
import random
import shutil

from webtext.operators import pacing
from webtext.streaming import clocks
from webtext.streaming.batches import read_all, stream_table

SCHEMA = "id long, domain string, ts_us long"


def files(spark, new_dir, batches):
    """A folder with one parquet file per batch, in order of time, and their paths."""
    source = new_dir("in")
    os.makedirs(source)
    for i, batch in enumerate(batches):
        part = new_dir("part")
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.parquet(part)
        (name,) = [f for f in os.listdir(part) if f.startswith("part-")]
        shutil.copy(f"{part}/{name}", f"{source}/part-{i}.parquet")
        os.utime(f"{source}/part-{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return source


def pace(spark, source, out, checkpoint, delay=30, **options):
    stream = stream_table(spark, source, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    clocks.pace_with_clocks(stream, delay, out, checkpoint, **options).awaitTermination()


def rows(df):
    return sorted(tuple(r) for r in df.select("id", "domain", "ts_us", "wait_us").collect())


def log(seed=5, n=3000):
    """Requests in time order: one domain with a third of them, ties, and rare domains."""
    rng = random.Random(seed)
    at, out = 0, []
    for i in range(n):
        at += rng.choice([0, 1, 400_000, 9_000_000, 70_000_000])
        out.append((i, rng.choice(["hot", "a", f"d{rng.randrange(400)}"]), at))
    return out


def test_batches_and_a_restart_equal_the_batch_form(spark, new_dir):
    requests = log()
    source, out, checkpoint = files(spark, new_dir, [requests[i : i + 1000] for i in range(0, 3000, 1000)]), new_dir("out"), new_dir("cp")
    later = new_dir("later")
    os.makedirs(later)
    shutil.move(f"{source}/part-2.parquet", later)
    pace(spark, source, out, checkpoint)
    assert read_all(spark, out, clocks.WAIT).count() == 2000
    shutil.move(f"{later}/part-2.parquet", source)
    pace(spark, source, out, checkpoint)
    want = pacing.politeness_wait(spark.createDataFrame(requests, SCHEMA), 30)
    assert rows(read_all(spark, out, clocks.WAIT)) == rows(want)
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "last").load()
    assert state.count() == len({d for _, d, _ in requests})


def test_independent_clocks_and_idle_domains(spark, new_dir):
    batches = [[(1, "A", 1_000_000_000), (2, "B", 10_000_000)], [(3, "B", 20_000_000)], [(4, "C", 5)]]
    source, out = files(spark, new_dir, batches), new_dir("out")
    pace(spark, source, out, new_dir("cp"), delay=50)
    assert [r[3] for r in rows(read_all(spark, out, clocks.WAIT))] == [0, 0, 40_000_000, 0]
    checkpoint, out = new_dir("cp"), new_dir("out")
    pace(spark, source, out, checkpoint, delay=50, forget_seconds=0)
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "last").load()
    assert state.count() <= 1 and read_all(spark, out, clocks.WAIT).count() == 4


def test_a_slice_sends_one_row_to_its_clock():
    import pyarrow as pa

    table = pa.table({"id": range(1000), "domain": ["hot"] * 990 + [None] * 10, "ts_us": range(1000), "slice": [i // 100 for i in range(1000)]})
    (got,) = clocks.cut_slices(30)(iter(table.to_batches()))
    ends = got.filter(pa.compute.is_null(got["wait_us"]))
    assert got.num_rows == 1000 and ends.num_rows == 11
    assert ends["last_us"].to_pylist() == [99, 199, 299, 399, 499, 599, 699, 799, 899, 989, 999]
    assert list(clocks.cut_slices(30)(iter([]))) == []
