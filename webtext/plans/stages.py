"""The stages of a run over a page snapshot. ``crawl_site``, ``pipeline`` and ``run_directory``
run jobs and write tables; the others compose plans."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtext.functions import html as H
from webtext.functions import identity as I
from webtext.functions import text as T
from webtext.functions import urls as U
from webtext.operators import chunks, links, outcomes
from webtext.operators.crawl import bounded_crawl
from webtext.operators.glossary import translate_with_table
from webtext.operators.inference import batch_inference
from webtext.operators.membership import BLOCKS, key_filter, probably_in
from webtext.operators.ordering import number_rows
from webtext.operators.summary import summarize
from webtext.sources import readers, writers
from webtext.sources.shared import compute_once, materialize, spread


def documents(pages: DataFrame, paragraph_breaks: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """``document_id, url, title, content, n_words`` of every page, and the columns of ``keep``.

    A narrow projection over the scan: the pages are never shuffled.
    """
    html, url = F.col("html"), F.col("url")
    cleaned = compute_once(
        spread(pages.select("url", "html", *keep)), content=H.html_to_markdown(html, paragraph_breaks)
    )
    titled = cleaned.select(
        *keep, I.document_id(url).alias("document_id"), "url", I.full_title(url, html).alias("title"), "content"
    )
    return compute_once(titled, n_words=T.word_count(F.col("content")))


def clean_pages(pages: DataFrame, minimum: int = T.MIN_DOCUMENT_WORDS) -> DataFrame:
    """Documents of at least ``minimum`` words."""
    return documents(pages).where(F.col("n_words") >= minimum)


@dataclass
class Crawl:
    visited: DataFrame  # url, level, success, visit
    links: DataFrame  # visit, link
    urls: DataFrame  # url: known before or found now
    summary: DataFrame  # one row


def crawl_site(
    pages: DataFrame,
    site: str,
    start_url: str,
    known: DataFrame | None = None,
    failed: DataFrame | None = None,
    max_pages: int | None = None,
    output_file: str = "urls.json",
) -> Crawl:
    """Crawl a page snapshot from the known URLs, or from ``start_url``.

    A page is looked up by its normalised URL, seeds with a last slash, a query, a
    fragment or parameters too; a link without a page in the
    snapshot is visited and fails. The start URL counts as discovered only if
    some page links to it.
    """
    spark = pages.sparkSession
    known = spark.createDataFrame([], "url string") if known is None else known
    per_page = links.link_source(pages.withColumn("url", U.normalize(F.col("url")))).select(
        "url",
        "page_id",
        links.internal_links(links.all_links(F.col("base"), F.col("tags")), site).alias("links"),
    )
    # Of several copies of a page the first one counts, as one visit loads one copy.
    held = materialize(per_page.groupBy("url").agg(F.min_by("links", "page_id").alias("links")), "links")
    if failed is not None:
        held = held.join(failed.select("url").distinct(), "url", "left_anti")
    seeds = links.crawl_seeds(known, start_url)
    # A seed keeps its own spelling and loads the page of its normalised form.
    other = seeds.select("url", U.normalize(F.col("url")).alias("page")).where("url <> page")
    respelled = other.join(held.select(F.col("url").alias("page"), "links"), "page")
    held = held.unionByName(respelled.select("url", "links"))
    found = held.select("url", F.explode("links").alias("link"))
    reached = bounded_crawl(found, seeds, max_pages=max_pages).drop("success")
    loaded = held.select("url", F.lit(True).alias("_held"))
    reached = reached.join(loaded, "url", "left").select(
        "url", "level", F.col("_held").isNotNull().alias("success")
    )
    visited = number_rows(reached, "level", "url", name="visit").withColumn("visit", F.col("visit") + 1)
    visited_links = (
        found.join(visited.where("success").select("url", "visit"), "url").select("visit", "link")
    )
    urls = links.distinct_urls(known, visited_links.select(F.col("link").alias("url")))
    return Crawl(visited, visited_links, urls, outcomes.crawl_summary(visited, urls, output_file))


def scrape(
    worklist: DataFrame, pages: DataFrame, failed: DataFrame | None = None, filter_blocks: int = BLOCKS
) -> tuple[DataFrame, DataFrame]:
    """Documents of the listed URLs, and ``url, error, success`` per URL.

    A URL without a page, without a host, or in ``failed``, failed. Of several
    copies of a page the first is taken. The copies are chosen and the outcomes
    compared by URL and page id alone. The page scan is cut by a filter of the
    chosen copies (``filter_blocks`` times 4 KB, broadcast) and cleaned in its own
    stage; an exact join of the texts follows, so HTML is never shuffled.
    """
    wanted = worklist.select("url").distinct()
    usable = wanted.where(U.domain(F.col("url")).isNotNull())
    copies = pages.groupBy("url").agg(F.min("page_id").alias("page_id"))
    if failed is not None:
        copies = copies.join(failed.select("url").distinct(), "url", "left_anti")
    chosen = copies.join(usable, "url", "left_semi")
    key = ["url", "page_id"]
    loaded = probably_in(spread(pages.select(*key, "html")), key, key_filter(chosen, key, filter_blocks), filter_blocks)
    docs = documents(loaded, keep=("page_id",)).join(chosen, key, "left_semi").drop("page_id")
    held = copies.select("url", F.lit(True).alias("_held"))
    error = F.when(U.domain(F.col("url")).isNull(), "malformed url").when(
        F.col("_held").isNull(), "page not loaded"
    )
    rows = wanted.join(held, "url", "left").select("url", error.alias("error"))
    return docs, rows.withColumn("success", F.col("error").isNull())


def page_metadata(docs: DataFrame, created_at: Column) -> DataFrame:
    return docs.select(
        F.col("document_id").alias("id"), "title", "url", created_at.cast("timestamp").alias("created_at")
    )


def summaries(docs: DataFrame) -> DataFrame:
    """``document_id, name, text, error, success`` for ``document_id, text``."""
    out = summarize(spread(docs.select("document_id", T.blank_to_null(F.col("text")).alias("text"))))
    error = F.when(F.col("text").isNull(), outcomes.EMPTY_TEXT).when(
        F.col("summary").isNull(), "no sentence fits"
    )
    return _derived(out, "_summary.txt", "summary", error)


def translations(docs: DataFrame, glossary: Mapping[str, str] | DataFrame) -> DataFrame:
    """``document_id, name, text, error, success`` for ``document_id, text``.

    A glossary of any size: as a table (``word, translation``), or a mapping, which
    becomes a table when it is too large for a literal.
    """
    if not isinstance(glossary, DataFrame) and len(glossary) > T.MAX_GLOSSARY:
        glossary = docs.sparkSession.createDataFrame(list(glossary.items()), "word string, translation string")
    if isinstance(glossary, DataFrame):
        done = translate_with_table(docs.select("document_id", "text"), glossary)
        done = done.select("document_id", F.nullif("text", F.lit("")).alias("translated"))
        out = docs.select("document_id").join(done, "document_id", "left")
    else:
        out = compute_once(docs.select("document_id", "text"), translated=T.translate(F.col("text"), glossary))
    error = F.when(F.col("translated").isNull(), outcomes.EMPTY_TEXT)
    return _derived(out, "_translated.txt", "translated", error)


def _derived(df: DataFrame, suffix: str, column: str, error: Column) -> DataFrame:
    return df.select(
        "document_id",
        T.output_name(F.col("document_id"), suffix).alias("name"),
        F.col(column).alias("text"),
        error.alias("error"),
    ).withColumn("success", F.col("error").isNull())


def model_stage(
    make_model: Callable[[], Callable[[list[str]], list[str]]], suffix: str, batch_size: int = 32
) -> Callable[[DataFrame], DataFrame]:
    """A stage like ``summaries`` that runs a model on whole documents."""

    def stage(docs: DataFrame) -> DataFrame:
        out = batch_inference(docs.select("document_id", "text"), make_model, batch_size)
        return _derived(out, suffix, "output", F.col("error"))

    return stage


def run_directory(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    stage: Callable[[DataFrame], DataFrame],
    pattern: str = "*.md",
) -> DataFrame:
    """Run a stage over the text files of a folder and write what succeeded.

    Returns ``input, output, error, success`` per file; ``outcome_rollup``
    counts them. A file is known to the stage by its path, so two files of one stem stay
    apart; only such files keep their last suffix in the name of their output. The
    stage is run once: its rows are written before they are split into texts and outcomes.
    """
    files = readers.read_corpus(spark, input_dir, pattern)
    # Paths hold no line break: odd characters are escaped there, but not in the stem.
    done = stage(files.select(F.concat("path", F.lit("\n"), "document_id").alias("document_id"), "text"))
    added = F.substr("name", F.length("document_id") + 1).alias("name")
    path, stem = (F.regexp_extract("document_id", r"(?s)\A([^\n]*)\n(.*)\z", g) for g in (1, 2))
    done = materialize(done.select(path.alias("path"), stem.alias("stem"), added, "text", "error", "success"), "directory")
    shared_stems = done.groupBy("stem").agg(F.count("*").alias("files")).where("files > 1")
    ending = F.when(F.col("files").isNull(), "").otherwise(F.regexp_extract("path", r"(\.[^./]*)\z", 1))
    named = done.join(shared_stems, "stem", "left").withColumn("name", F.concat("stem", ending, "name"))
    writers.write_derived(named.where("success"), output_dir)
    return named.select(F.col("path").alias("input"), F.when(F.col("success"), F.col("name")).alias("output"), "error", "success")


@dataclass
class Pipeline:
    crawl: Crawl
    documents: DataFrame
    scrape_outcomes: DataFrame
    translations: DataFrame
    segments: DataFrame | None
    report: DataFrame


def pipeline(
    pages: DataFrame,
    site: str,
    start_url: str,
    glossary: Mapping[str, str] | DataFrame,
    stamp: Column,
    known: DataFrame | None = None,
    failed: DataFrame | None = None,
    max_pages: int | None = None,
    with_speech: bool = False,
) -> Pipeline:
    """Crawl, scrape, translate and, if asked, cut speech segments; then report.

    Stages hand over by document id. The documents are written once because
    several stages read them.
    """
    crawl = crawl_site(pages, site, start_url, known, failed, max_pages)
    by_link = pages.withColumn("url", U.normalize(F.col("url")))
    docs, scraped = scrape(crawl.urls, by_link, failed)
    docs = materialize(docs, "documents")
    texts = docs.select("document_id", F.col("content").alias("text"))
    translated = translations(texts, glossary)
    segments = speech = None
    if with_speech:
        segments = chunks.speech_segments(translated.where("success").select("document_id", "text"))
        speech = segments.agg(F.countDistinct("document_id").alias("mp3_count"))
    report = outcomes.pipeline_report(
        stamp,
        crawl.summary,
        outcomes.scrape_outcome(scraped),
        outcomes.outcome_rollup(translated),
        speech,
    )
    return Pipeline(crawl, docs, scraped, translated, segments, report)
