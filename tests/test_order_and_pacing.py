"""Order, running totals, pacing, retries and crawls, with hot keys."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from webtext.operators import crawl, links, ordering, pacing
from webtext.operators.crawl import bounded_crawl, discovery_curve


def urls(spark, values):
    return spark.createDataFrame([(v,) for v in values], "url string")


def test_numbers_follow_the_order_over_many_partitions(spark):
    values = [f"u{random.Random(i).random()}" for i in range(5000)]
    numbered = ordering.number_rows(urls(spark, values).repartition(7), "url").collect()
    assert [r.url for r in sorted(numbered, key=lambda r: r.pos)] == sorted(values)
    assert sorted(r.pos for r in numbered) == list(range(5000))


def test_code_point_order(spark):
    values = ["b", "B", "é", "z", "a", "￿", "😀", "a"]
    got = {r.url: r.pos for r in ordering.sorted_urls(urls(spark, values)).collect()}
    assert sorted(got, key=got.get) == sorted(set(values))


@pytest.mark.parametrize("top_k", [10_000, 10])
def test_first_rows_by_top_k_and_by_position(spark, monkeypatch, top_k):
    monkeypatch.setattr(ordering, "TOP_K_ROWS", top_k)
    values = [f"{i:04d}" for i in range(300)]
    got = ordering.first_rows(urls(spark, values[::-1]), 120, "url").collect()
    assert sorted(r.url for r in got) == values[:120]


def test_random_order_is_a_seeded_permutation(spark):
    df = urls(spark, [str(i) for i in range(50)])
    orders = [
        [r.url for r in sorted(ordering.random_order(df.repartition(n), seed).collect(), key=lambda r: r.pos)]
        for n, seed in ((1, 1), (5, 1), (1, 2))
    ]
    assert orders[0] == orders[1] != orders[2] and len(set(orders[2])) == 50


@pytest.mark.parametrize("block, hot_rows", [(1, 0), (7, 100), (1000, 0), (7, 1000)])
def test_running_total_with_a_hot_key(spark, block, hot_rows):
    rng = random.Random(2)
    rows = [("hot" if i % 3 == 0 else f"k{i % 40}", i, rng.randrange(9)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, i bigint, v bigint")
    want, sums = {}, defaultdict(int)
    for k, i, v in rows:
        sums[k] += v
        want[i] = sums[k]
    got = ordering.running_total(df, ["k"], "i", "v", "t", block, hot_rows).collect()
    assert {r.i: r.t for r in got} == want


@pytest.mark.parametrize("block_seconds, hot_rows", [(1, 100), (60, 0), (100_000, 100), (60, 1000)])
def test_waits_with_a_hot_domain(spark, block_seconds, hot_rows):
    rng = random.Random(4)
    rows = [
        ("hot" if i % 3 == 0 else f"d{rng.randrange(30)}", rng.randrange(3_000_000_000), i) for i in range(900)
    ] + [("tied", 5, 1001), ("tied", 5, 1000), (None, 7, 1002)]
    df = spark.createDataFrame(rows, "domain string, ts_us bigint, id bigint")
    earlier = {"hot": -1_000_000, "d3": -2_000_000, "d4": -9_000_000, "unused": 1}
    last = spark.createDataFrame(list(earlier.items()), "domain string, last_us bigint")
    before, want = dict(earlier), {}
    for domain, ts, i in sorted(rows, key=lambda r: (r[1], r[2])):
        gap = ts - before[domain] if domain in before else None
        want[i] = max(0, 3_000_000 - gap) if gap is not None else 0
        before[domain] = ts
    got = pacing.politeness_wait(df, 3, last, block_seconds, hot_rows).collect()
    assert {r.id: r.wait_us for r in got} == want


def test_retries_stop_at_the_first_success(spark):
    rows = [("a", 1, False), ("a", 2, True), ("a", 3, True), ("b", 1, False), ("b", 2, False), ("c", 1, True)]
    rows += [("hot", i, i == 500) for i in range(600)]
    df = spark.createDataFrame(rows, "url string, n int, success boolean")
    got = {r.url: (r.attempts, r.success) for r in pacing.retry_resolution(df, 3, "n").collect()}
    assert got == {"a": (2, True), "b": (2, False), "c": (1, True), "hot": (3, False)}


def test_hot_url_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, True)], "url string, n int, success boolean")
    plan = pacing.retry_resolution(df, 3, "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_minus(spark):
    got = links.minus(urls(spark, ["a", "b", "b", "c"]), urls(spark, ["c", "c"]), urls(spark, ["d"]))
    assert sorted(r.url for r in got.collect()) == ["a", "b"]


def test_seeds(spark):
    assert [r.url for r in links.crawl_seeds(urls(spark, []), "s").collect()] == ["s"]
    assert sorted(r.url for r in links.crawl_seeds(urls(spark, ["a", "b", "a"]), "s").collect()) == ["a", "b"]


def walk(edges, seeds, failed, cap):
    out, level, found = {}, 0, set(seeds)
    while found and (cap is None or len(out) < cap):
        chosen = sorted(found)[: None if cap is None else cap - len(out)]
        out.update({u: (level, u not in failed) for u in chosen})
        found = {b for a in chosen if a not in failed for b in edges[a]} - set(out)
        level += 1
    return out


@pytest.mark.parametrize("cap, large", [(None, 1000), (None, 10), (1, 1000), (37, 0), (100, 1000), (1000, 1000)])
def test_crawl_equals_walk(spark, monkeypatch, cap, large):
    monkeypatch.setattr(crawl, "LARGE_VISITED", large)
    monkeypatch.setattr(crawl, "MERGE_ROUNDS", 3)
    rng = random.Random(6)
    names = [f"u{i:03d}" for i in range(400)]
    edges = defaultdict(set)
    for a in names:
        edges[a] = {rng.choice(names) for _ in range(2)}
    edges["u007"] = set(names[:150])  # a page with a large share of the links
    failed = {"u003", "u050", "u399"}
    table = spark.createDataFrame([(a, b) for a in edges for b in edges[a]] * 2, "url string, link string")
    got = bounded_crawl(table, urls(spark, ["u000", "u001", "u001"]), urls(spark, sorted(failed)), cap)
    assert {r.url: (r.level, r.success) for r in got.collect()} == walk(edges, ["u000", "u001"], failed, cap)


def test_crawl_of_nothing(spark):
    table = spark.createDataFrame([("a", "b")], "url string, link string")
    assert bounded_crawl(table, urls(spark, [])).count() == 0


def test_new_links_and_discovery(spark):
    visits = spark.createDataFrame([(i, i != 10) for i in range(1, 13)], "visit bigint, success boolean")
    found = [(1, "a"), (1, "b"), (2, "a"), (2, "c"), (7, "k"), (7, "d"), (12, "d"), (12, "e")]
    table = spark.createDataFrame(found, "visit bigint, link string")
    counted = links.new_links_per_visit(visits, table, urls(spark, ["k"]))
    assert {r.visit: r.new_links for r in counted.where("new_links > 0").collect()} == {1: 2, 2: 1, 7: 1, 12: 1}
    assert counted.count() == 12
    curve = discovery_curve(counted, [], known_count=1)
    assert [(r.visit, r.urls_count) for r in curve.collect()] == [(5, 4)]


def test_recent_pages_is_a_top_k_plan(spark, sf):
    listed = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("event_id").alias("id"), F.col("ts").alias("created_at")
    )
    newest = ordering.recent_pages(listed, F.lit("2024-01-02").cast("timestamp_ntz"), F.lit("2024-02-01").cast("timestamp_ntz"), 5)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_recent_pages_of_a_large_k_are_the_same_rows(spark, monkeypatch):
    listed = spark.range(1000).select("id", F.expr("timestamp_seconds(id div 3)").alias("created_at"))
    bounds = F.expr("timestamp_seconds(10)"), F.expr("timestamp_seconds(300)")
    expected = [r.id for r in ordering.recent_pages(listed, *bounds, 100).collect()]
    monkeypatch.setattr(ordering, "TOP_K_ROWS", 10)
    newest = ordering.recent_pages(listed, *bounds, 100)
    assert [r.id for r in newest.collect()] == expected
    assert expected[:4] == [897, 898, 899, 894]


def test_robots_results_of_every_url(spark):
    from webtext.operators import outcomes

    urls = spark.createDataFrame([("http://a/x",), ("http://a/y",), ("http://a/y",), ("http://b/",), ("http://c/",), ("none",), (None,)], "url string")
    responses = spark.createDataFrame([("http://a/robots.txt", 200, "x"), ("http://b/robots.txt", 200, "")], "robots_url string, status int, body string")
    targets = outcomes.robots_targets(urls, F.lit("s"))
    rows = [(r.url, r.outcome, r.file) for r in outcomes.robots_url_results(urls, targets, responses).collect()]
    file = targets.where("origin = 'http://a'").first().file
    expected = [("http://a/x", "successful", file)] + 2 * [("http://a/y", "successful", file)]
    expected += [(u, "failed", None) for u in ("http://b/", "http://c/", "none", None)]
    assert sorted(rows, key=str) == sorted(expected, key=str)
