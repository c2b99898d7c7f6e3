"""Outcome rows of a stage, their roll-ups and the run report.

Outcomes stay one row per item; roll-ups are counts that combine on the map
side, never a collected list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtext.functions import identity as I
from webtext.functions import urls as U

EMPTY_TEXT = "empty text"
TOO_SHORT = "too short"
ROBOTS_FAILED = "Failed to fetch or save"


def outcome_rows(df: DataFrame, stem: str, suffix: str, error: Column) -> DataFrame:
    """``input, output, error, success`` per document; ``error`` NULL is success."""
    name = F.col(stem).cast("string")
    rows = df.select(F.concat(name, F.lit(".md")).alias("input"), name.alias("_stem"), error.alias("error"))
    success = F.col("error").isNull()
    return rows.select(
        "input",
        F.when(success, F.concat("_stem", F.lit(suffix))).alias("output"),
        "error",
        success.alias("success"),
    )


def outcome_rollup(outcomes: DataFrame) -> DataFrame:
    """One row: ``processed, failed``."""
    return outcomes.agg(
        F.count_if(F.col("success")).alias("processed"),
        F.count_if(~F.col("success")).alias("failed"),
    )


def scrape_outcome(outcomes: DataFrame) -> DataFrame:
    """One row: ``successful, failed``; the failed URLs are ``failed_urls``."""
    return outcome_rollup(outcomes).withColumnRenamed("processed", "successful")


def failed_urls(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(~F.col("success")).select("url")


def crawl_summary(visited: DataFrame, urls: DataFrame, output_file: str) -> DataFrame:
    """One row: ``urls_count, pages_visited, failed_urls, output_file``."""
    visits = visited.agg(
        F.count("*").alias("pages_visited"), F.count_if(~F.col("success")).alias("failed_urls")
    )
    found = urls.agg(F.countDistinct("url").alias("urls_count"))
    both = one_row(visits, found)
    return both.select("urls_count", "pages_visited", "failed_urls", F.lit(output_file).alias("output_file"))


def one_row(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row frames side by side, without a join.

    The rows are stacked, each NULL in the others' columns, and the non-NULL
    value of every column is taken.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def robots_targets(urls: DataFrame, stamp: Column) -> DataFrame:
    """``origin, robots_url, file`` for every distinct origin of the URLs."""
    origins = urls.select(U.origin(F.col("url")).alias("origin")).where(F.col("origin") != "").distinct()
    return origins.select(
        "origin",
        F.concat("origin", F.lit("/robots.txt")).alias("robots_url"),
        U.robots_file_name(F.col("origin"), stamp).alias("file"),
    )


def robots_accept(responses: DataFrame) -> DataFrame:
    """Responses that count as a capture: status 200 with a body."""
    return responses.where((F.col("status") == 200) & (F.col("body") != ""))


def robots_results(targets: DataFrame, responses: DataFrame) -> DataFrame:
    """``url, outcome, file, reason`` per target.

    ``responses`` holds one row per ``robots_url``; a target without a
    response failed.
    """
    captured = robots_accept(responses).select("robots_url", F.lit(True).alias("_ok"))
    ok = F.col("_ok").isNotNull()
    return targets.join(captured, "robots_url", "left").select(
        F.col("origin").alias("url"),
        F.when(ok, "successful").otherwise("failed").alias("outcome"),
        F.when(ok, F.col("file")).alias("file"),
        F.when(~ok, ROBOTS_FAILED).alias("reason"),
    )


def robots_url_results(urls: DataFrame, targets: DataFrame, responses: DataFrame) -> DataFrame:
    """``url, outcome, file, reason`` of every row of ``urls``: that of its origin.

    Each origin is captured once, whatever the number of its URLs. A URL without
    an origin failed. Results have one row per origin, so a hot origin meets a
    single row and its URLs may be split among tasks.
    """
    results = robots_results(targets, responses).withColumnRenamed("url", "origin")
    asked = urls.select("url", U.origin(F.col("url")).alias("origin"))
    return asked.join(results, "origin", "left").select(
        "url",
        F.coalesce("outcome", F.lit("failed")).alias("outcome"),
        "file",
        F.when(F.col("outcome").isNull(), ROBOTS_FAILED).otherwise(F.col("reason")).alias("reason"),
    )


def robots_outcome(results: DataFrame) -> DataFrame:
    return results.groupBy("outcome").agg(F.count("*").alias("urls"))


def stage_lineage(stages: dict[str, DataFrame]) -> DataFrame:
    """Which stages hold each document: ``document_id, has_<stage>…, missing``.

    One grouped union instead of a chain of outer joins: a single shuffle that
    combines on the map side, and a document known to any stage is kept, so
    an orphan metadata row shows as missing its document.
    """
    tagged = [df.select("document_id", F.lit(name).alias("stage")) for name, df in stages.items()]
    rows = reduce(lambda a, b: a.unionByName(b), tagged)
    flags = rows.groupBy("document_id").agg(
        *[F.max(F.col("stage") == name).alias(f"has_{name}") for name in stages]
    )
    gaps = F.array_compact(F.array(*[F.when(~F.col(f"has_{n}"), F.lit(n)) for n in stages]))
    return flags.withColumn("missing", F.array_join(gaps, ","))


def pipeline_report(
    stamp: Column, crawler: DataFrame, scraper: DataFrame, translator: DataFrame,
    speech: DataFrame | None = None,
) -> DataFrame:
    """One row: ``timestamp`` and a struct per stage; speech only when given."""
    stages = {"crawler": crawler, "scraper": scraper, "translator": translator}
    if speech is not None:
        stages["speech"] = speech
    rows = [df.select(F.struct(*df.columns).alias(name)) for name, df in stages.items()]
    return one_row(*rows).select(I.file_stamp(stamp).alias("timestamp"), *stages)


def as_json(df: DataFrame, name: str = "report") -> DataFrame:
    """Every row as one JSON object."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))
