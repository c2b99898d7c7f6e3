"""Readers, writers, whole stages and their plans."""

import json

import pytest
from pyspark.sql import functions as F

from webtext.functions import identity as D
from webtext.functions import urls as U
from webtext.operators import outcomes
from webtext.plans import stages
from webtext.sources import readers, shared, writers

AT = "2025-04-22 15:08:45"


def stamp():
    return F.to_timestamp(F.lit(AT))


def urls(spark, values):
    return spark.createDataFrame([(v,) for v in values], "url string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("single", [False, True])
def test_manifest_round_trip(spark, new_dir, single):
    path = writers.write_manifest(urls(spark, ["b", "é", "a", "b"]), new_dir(), stamp(), single)
    rows = readers.manifest_worklist(spark, path).orderBy("pos").collect()
    assert [(r.pos, r.url) for r in rows] == [(0, "a"), (1, "b"), (2, "é")]
    folder = path if single else f"{path}/summary"
    told = spark.read.schema(readers.MANIFEST).json(folder).first()
    assert (told["count"], told["last_updated"]) == (3, AT)


def test_large_manifest_is_refused_as_one_object(spark, new_dir, monkeypatch):
    monkeypatch.setattr(writers, "SINGLE_OBJECT_URLS", 2)
    with pytest.raises(ValueError):
        writers.write_manifest(urls(spark, ["a", "b", "c"]), new_dir(), stamp(), True)


def test_manifest_written_by_hand(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"urls": ["b", "a", "b"], "count": 3}, indent=2))
    (tmp_path / "none.json").write_text("{}")
    listed = readers.manifest_worklist(spark, str(tmp_path / "m.json")).orderBy("pos")
    assert [r.url for r in listed.collect()] == ["b", "a", "b"]
    assert sorted(r.url for r in readers.read_manifest(spark, str(tmp_path / "m.json")).collect()) == ["a", "b"]
    assert readers.read_manifest(spark, str(tmp_path / "none.json")).count() == 0
    assert readers.read_manifest(spark, str(tmp_path / "missing.json")).count() == 0


def test_corpus_ids_are_file_stems(spark, tmp_path):
    (tmp_path / "a.b.md").write_text("one\ntwo\n", encoding="utf-8")
    (tmp_path / "c.md").write_text("é", encoding="utf-8")
    (tmp_path / "d.txt").write_text("no", encoding="utf-8")
    got = {r.document_id: r.text for r in readers.read_corpus(spark, str(tmp_path)).collect()}
    assert got == {"a.b": "one\ntwo\n", "c": "é"}


def test_failed_manifest_only_when_some_failed(spark, new_dir):
    assert writers.write_failed(urls(spark, []), new_dir(), stamp()) is None
    path = writers.write_failed(urls(spark, ["x"]), new_dir(), stamp())
    assert [r.url for r in readers.read_manifest(spark, path).collect()] == ["x"]


def test_metadata_is_appended_once_per_id(spark, new_dir):
    path = new_dir("metadata")
    rows = [("1", "t", "u"), ("2", "t2", "u2"), ("2", "t2", "u2")]
    first = spark.createDataFrame(rows, "id string, title string, url string").withColumn("created_at", stamp())
    more = first.unionByName(
        spark.createDataFrame([("3", "t", "u")], "id string, title string, url string").withColumn(
            "created_at", stamp() + F.expr("interval 1 day")
        )
    )
    for batch in (first, first, more):
        writers.append_metadata(batch, path)
    table = spark.read.parquet(path)
    assert sorted(r.id for r in table.collect()) == ["1", "2", "3"]
    assert writers.metadata_problems(table).count() == 0
    later = F.to_timestamp(F.lit("2025-04-23 00:00:00"))
    from webtext.operators.ordering import recent_pages

    newest = recent_pages(table, later, later + F.expr("interval 1 day"), 10)
    assert [r.id for r in newest.collect()] == ["3"]
    assert "PartitionFilters: [isnotnull(created_date" in plan_of(newest)


def test_metadata_problems(spark):
    rows = [("1", None, "u", None), ("2", "t", "u", None), ("2", "t", "u", None)]
    bad = spark.createDataFrame(rows, "id string, title string, url string, created_at timestamp")
    found = writers.metadata_problems(bad.withColumn("created_at", stamp())).collect()
    assert sorted((r.id, r.problem) for r in found) == [("1", "null column"), ("2", "repeated id")]


def test_report_round_trip(spark, new_dir):
    one = spark.createDataFrame([(1, 2)], "processed bigint, failed bigint")
    report = outcomes.pipeline_report(stamp(), one, one, one)
    path = writers.write_report(report, new_dir())
    got = spark.read.json(path).first().asDict(recursive=True)
    assert got["timestamp"] == "20250422_150845" and "speech" not in got
    assert got["translator"] == {"processed": 1, "failed": 2}


def test_work_dir_follows_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    made = shared.work_dir(spark, "x")
    assert made != shared.work_dir(spark, "x")
    assert root is None or made.startswith(root)


class FakeSession:
    def __init__(self, master, setting=None):
        self.conf = {"spark.checkpoint.dir": setting}
        self.sparkContext = type("Context", (), {"master": master})


def test_work_dir_without_the_setting():
    assert "webtext-" in shared.work_dir(FakeSession("local[2]"), "x")
    with pytest.raises(ValueError):
        shared.work_dir(FakeSession("yarn"), "x")
    assert shared.work_dir(FakeSession("yarn", "hdfs://n/c/"), "x").startswith("hdfs://n/c/x-")


def test_document_id_is_the_same_every_time(spark):
    ids = [spark.range(1).select(D.document_id(F.lit("http://h/a"))).first()[0] for _ in range(2)]
    assert ids[0] == ids[1] and [len(p) for p in ids[0].split("-")] == [8, 4, 4, 4, 12]


def test_cleaning_large_input_has_no_shuffle_and_runs_once(spark, sf, monkeypatch):
    monkeypatch.setattr(shared, "SPREAD_BYTES", 0)
    plan = plan_of(stages.clean_pages(spark.read.parquet(f"{sf}/pages.parquet")))
    assert "Exchange" not in plan and "ReadSchema: struct<url:string,html:string>" in plan
    assert plan.count("<article[^<>]*+>") == 1


def test_scrape_takes_the_first_copy_of_a_page(spark):
    pages = spark.createDataFrame(
        [(2, "http://h/a", "<p>second</p>"), (1, "http://h/a", "<p>first</p>"), (3, "http://h/b", "<p>b</p>")],
        "page_id bigint, url string, html string",
    )
    docs, rows = stages.scrape(urls(spark, ["http://h/a", "http://h/c", "bad", "http://h/a"]), pages)
    assert [(r.url, r.content) for r in docs.collect()] == [("http://h/a", "first")]
    assert {r.url: r.error for r in rows.collect()} == {
        "http://h/a": None, "http://h/c": "page not loaded", "bad": "malformed url",
    }


def page(body):
    return f"<html><head><title>T</title></head><body><article><p>{body}</p></article></body></html>"


def test_pipeline(spark):
    rows = [
        (0, "http://h.com/", page('the start <a href="/a/">a</a><a href="/b?utm=1">b</a><a href="/x.pdf">p</a>')),
        (1, "http://h.com/a", page('the a page. Two. <a href="http://www.h.com/c?id=1#z">c</a>')),
        (2, "http://h.com/b", page('b <a href="http://other.com/">o</a><a href="/missing">m</a>')),
        (3, "http://www.h.com/c?id=1", page("of c")),
        (4, "http://h.com/never", page("not linked")),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    run = stages.pipeline(
        pages, "h.com", "http://h.com", {"the": "le"}, stamp(), failed=urls(spark, ["http://h.com/b"]),
        with_speech=True,
    )
    visited = {r.url: (r.visit, r.level, r.success) for r in run.crawl.visited.collect()}
    assert visited == {
        "http://h.com": (1, 0, True), "http://h.com/a": (2, 1, True), "http://h.com/b": (3, 1, False),
        "http://www.h.com/c?id=1": (4, 2, True),
    }
    # The start page was not linked, so it is not among the discovered URLs.
    assert sorted(r.url for r in run.crawl.urls.collect()) == [
        "http://h.com/a", "http://h.com/b", "http://www.h.com/c?id=1",
    ]
    report = run.report.first().asDict(recursive=True)
    assert report["crawler"]["urls_count"] == 3 and report["crawler"]["failed_urls"] == 1
    assert report["scraper"] == {"successful": 2, "failed": 1}
    assert report["translator"] == {"processed": 2, "failed": 0}
    assert report["speech"]["mp3_count"] == 2
    texts = {r.text for r in run.translations.collect()}
    assert "le a page. Two. [c](" in texts or any(t.startswith("le a page.") for t in texts)


def test_summaries_mark_blank_documents(spark):
    docs = spark.createDataFrame([("a", "One. Two."), ("b", " \n")], "document_id string, text string")
    got = {r.document_id: (r.name, r.text, r.error) for r in stages.summaries(docs).collect()}
    assert got == {"a": ("a_summary.txt", "One. Two.", None), "b": ("b_summary.txt", None, "empty text")}


def test_robots_file_names(spark):
    got = spark.range(1).select(U.robots_url(F.lit("https://a.b.c:8/x?y")), U.robots_file_name(F.lit("https://a.b.c:8/x"), F.lit("S"))).first()
    assert tuple(got) == ("https://a.b.c:8/robots.txt", "a_b_c:8_S_robots.txt")


def test_directory_run(spark, tmp_path, new_dir):
    (tmp_path / "a.md").write_text("the cat. The end.")
    (tmp_path / "b.md").write_text(" \n")
    (tmp_path / "c.txt").write_text("not read")
    for stage, suffix, text in (
        (stages.summaries, "_summary.txt", "the cat. The end."),
        (lambda docs: stages.translations(docs, {"the": "le"}), "_translated.txt", "le cat. The end."),
        (stages.model_stage(lambda: lambda t: [x.upper() for x in t], "_up.txt"), "_up.txt", "THE CAT. THE END."),
    ):
        out = new_dir()
        rows = stages.run_directory(spark, str(tmp_path), out, stage)
        got = {r.input.rsplit("/", 1)[1]: (r.output, r.error, r.success) for r in rows.collect()}
        assert got == {"a.md": ("a" + suffix, None, True), "b.md": (None, "empty text", False)}
        assert [tuple(r) for r in spark.read.parquet(out).collect()] == [("a" + suffix, text)]
        assert tuple(outcomes.outcome_rollup(rows).first()) == (1, 1)


def test_work_folders_are_listed_and_removed(spark):
    with shared.work_listed() as made:
        kept = shared.materialize(spark.range(3), "inside")
    outside = shared.materialize(spark.range(2), "outside")
    assert len(made) == 1 and kept.count() == 3
    shared.remove_work(spark, made)
    shared.remove_work(spark, made)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(made[0])
    assert outside.count() == 2


def test_files_of_one_stem_stay_apart(spark, tmp_path, new_dir):
    for i, name in enumerate(("a.md", "a.txt", "b c+é%.md")):
        (tmp_path / name).write_text(f"Words of file {i}.")
    out = new_dir()
    rows = stages.run_directory(spark, str(tmp_path), out, stages.summaries, "*.*").collect()
    assert sorted(r.output for r in rows) == ["a.md_summary.txt", "a.txt_summary.txt", "b c+é%_summary.txt"]
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [
        ("a.md_summary.txt", "Words of file 0."), ("a.txt_summary.txt", "Words of file 1."), ("b c+é%_summary.txt", "Words of file 2."),
    ]
