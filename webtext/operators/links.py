"""Links of a page, found inside the page's own row, and URL sets.

Extraction, resolution, filtering and normalisation are array expressions on
one row; only sets across pages shuffle, and they combine on the map side
first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtext.functions import patterns as P
from webtext.functions import urls as U
from webtext.functions.html import decode_entities
from webtext.operators.ordering import union_all
from webtext.sources.shared import spread


def visible_html(html: Column) -> Column:
    """The page without scripts, styles, no-script parts and comments."""
    return F.regexp_replace(html, P.OPAQUE, "")


def attributes(tag: Column) -> Column:
    """``name, value`` of each attribute of a start tag in order: names in lower case,
    values without quotes and with entities decoded, null where there is none."""
    found = F.regexp_extract_all(tag, F.lit(P.ATTRIBUTE), F.lit(1))

    def parts(a: Column) -> Column:
        raw = F.regexp_replace(F.regexp_extract(a, P.ATTRIBUTE_VALUE, 1), P.QUOTED, "$1$2")
        return F.struct(
            F.lower(F.regexp_extract(a, P.ATTRIBUTE_NAME, 1)).alias("name"), F.when(F.contains(a, F.lit("=")), decode_entities(raw)).alias("value")
        )

    return F.transform(found, parts)


def start_tags(html: Column) -> Column:
    """``name, attributes`` of the page's start tags that can hold a link, in order. Links
    are read from these alone, so text that shows markup gives none."""
    tags = F.regexp_extract_all(visible_html(html), F.lit(P.START_TAG), F.lit(0))
    tags = F.filter(tags, lambda t: t.rlike(P.LINK_ATTRIBUTE))
    return F.transform(
        tags, lambda t: F.struct(F.lower(F.regexp_extract(t, P.TAG_NAME, 1)).alias("name"), attributes(t).alias("attributes"))
    )


def _first_values(tags: Column, attribute: str) -> Column:
    """Value of the first attribute of that name of each tag that gives it one."""
    own = lambda t: F.filter(t["attributes"], lambda a: a["name"] == attribute)
    return F.filter(F.transform(tags, lambda t: F.get(own(t), F.lit(0))["value"]), lambda v: v.isNotNull())


def anchor_hrefs(tags: Column) -> Column:
    return _first_values(F.filter(tags, lambda t: t["name"] == "a"), "href")


def anchor_links(base: Column, tags: Column) -> Column:
    """Followable ``a[href]`` targets, resolved against ``base_parts`` ``base``."""
    hrefs = F.filter(anchor_hrefs(tags), U.is_followable)
    return F.transform(hrefs, lambda h: U.resolve(base, h))


def href_links(base: Column, tags: Column) -> Column:
    """Targets of every element with an ``href``; a bare ``#x`` gives the page."""
    links = F.transform(_first_values(tags, "href"), lambda h: U.resolve(base, h))
    return F.filter(links, lambda x: ~x.rlike(r"(?i)\A(?:javascript|mailto|tel):"))


def onclick_links(tags: Column) -> Column:
    """Targets that click handlers assign to the location, as written."""
    handlers = _first_values(tags, "onclick")
    return F.flatten(
        F.transform(handlers, lambda h: F.regexp_extract_all(h, F.lit(P.ONCLICK_TARGET), F.lit(1)))
    )


def data_links(tags: Column) -> Column:
    """``data-*`` values that start with ``http``."""
    values = F.filter(F.flatten(F.transform(tags, lambda t: t["attributes"])), lambda a: a["name"].startswith("data-") & a["value"].startswith("http"))
    return F.transform(values, lambda a: a["value"])


def all_links(base: Column, tags: Column) -> Column:
    """Distinct links of one page over the four methods."""
    methods = F.concat(
        anchor_links(base, tags), href_links(base, tags), onclick_links(tags), data_links(tags)
    )
    return F.array_distinct(methods)


def internal_links(links: Column, site: Column | str) -> Column:
    """Distinct normalised links that stay on ``site`` and are not assets."""
    kept = F.filter(links, lambda x: U.is_internal(x, site) & ~U.is_asset(x))
    return F.array_distinct(F.transform(kept, U.normalize))


def link_source(pages: DataFrame) -> DataFrame:
    """Pages with ``base`` and their start ``tags``, computed once for all methods."""
    kept = [c for c in pages.columns if c != "html"]
    return spread(pages).select(
        *kept, U.base_parts(F.col("url")).alias("base"), start_tags(F.col("html")).alias("tags")
    )


def page_links(pages: DataFrame, site: Column | str) -> DataFrame:
    """``url, link``: internal links of every page."""
    found = link_source(pages.select("url", "html")).select(
        "url", all_links(F.col("base"), F.col("tags")).alias("links")
    )
    return found.select("url", F.explode(internal_links(F.col("links"), site)).alias("link"))


def distinct_urls(*frames: DataFrame) -> DataFrame:
    """Union of URL sets."""
    return union_all(*[f.select("url") for f in frames]).distinct()


def minus(urls: DataFrame, *others: DataFrame) -> DataFrame:
    """Distinct URLs of ``urls`` that are in none of ``others``.

    One grouping over the marked union: repeated URLs shrink to one row per
    task before the only shuffle, so a URL that makes up much of either side
    weighs no more than any other.
    """
    marked = urls.select("url", F.lit(False).alias("taken"))
    for other in others:
        marked = marked.unionByName(other.select("url", F.lit(True).alias("taken")))
    return marked.groupBy("url").agg(F.max("taken").alias("taken")).where(~F.col("taken")).select("url")


def crawl_seeds(known: DataFrame, start_url: str) -> DataFrame:
    """All known URLs, or the start URL when nothing is known."""
    if known.isEmpty():
        return known.sparkSession.createDataFrame([(start_url,)], "url string")
    return known.select("url").distinct()


def first_seen(visits: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``url, visit``: the visit on which each new link was first found.

    ``visits`` has ``visit, link`` with visits counted from 1; links already
    known count as seen at visit 0 and are not new.
    """
    seen = visits.select(F.col("link").alias("url"), F.col("visit").cast("bigint").alias("visit"))
    if known is not None:
        seen = seen.unionByName(known.select("url", F.lit(0).cast("bigint").alias("visit")))
    return seen.groupBy("url").agg(F.min("visit").alias("visit")).where(F.col("visit") > 0)


def new_links_per_visit(
    visits: DataFrame, links: DataFrame, known: DataFrame | None = None
) -> DataFrame:
    """Add ``new_links`` to every visit, 0 where a page found nothing new.

    Counts are one row per visit, so the outer join has no repeated key.
    """
    counts = first_seen(links, known).groupBy("visit").agg(F.count("*").alias("new_links"))
    return visits.join(counts, "visit", "left").withColumn(
        "new_links", F.coalesce("new_links", F.lit(0))
    )

