"""Inputs that Spark derives from the given tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sql as S
from webtext.functions import patterns as P
from webtext.functions import urls as U
from webtext.operators.ordering import number_rows
from webtext.operators.pacing import micros

# One block with every kind of link, put before the end of each article.
BLOCK = (
    '<a href="mailto:a@b.example">m</a><a href=\'#top\'>t</a><a href="/doc.pdf">p</a>'
    '<a href="/doc.pdf?x=1&amp;page=2">q</a><a class=k href="https://{SITE}/abs/?id=7&utm=1">abs</a>'
    '<a href="http://www.{SITE}/w/">w</a><a href="https://other.example.org/z">ext</a>'
    '<a href="//{SITE}/s;v=1">s</a><a href=../up/x>u</a><a href="?page=3">n</a>'
    '<link rel="x" href="/style.css">'
    "<div onclick=\"window.location.href='https://{SITE}/click'\">c</div>"
    '<span data-url="https://{SITE}/data?p=3&amp;z=1" data-n="1">d</span>'
    '<p style="a"><b>solo</b></p><h2 id="h" class=\'c\'>Sub &amp; title</h2><code>c</code>'
    "<ul><li>one</li><li><em>two</em></li></ul>***\n \n\n---\n[doc](https://a.example/b) x  y"
)
GLOSSARY = {"the": "le", "of": "de", "and": "et", "to": "à", "is": "est"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark, sf_dir) -> DataFrame:
    """``document_id, text``."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), "text")


DOCS = "SELECT doc_id AS document_id, text FROM documents"


def own_site() -> F.Column:
    """Host of the page itself without a leading ``www.``."""
    return F.regexp_replace(U.netloc(F.col("url")), r"\Awww\.", "")


def rich_pages(spark, sf_dir) -> DataFrame:
    """Pages with ``BLOCK`` inserted; ``page_id, url, html``."""
    block = F.replace(F.lit(BLOCK + "</article>"), F.lit("{SITE}"), own_site())
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", F.replace(F.col("html"), F.lit("</article>"), block).alias("html")
    )


RICH = (
    f"SELECT page_id, url, replace(html, '</article>', "
    f"replace({S.q(BLOCK + '</article>')}, '{{SITE}}', {S.site('url')})) AS html FROM pages"
)


def page_urls(spark, sf_dir) -> DataFrame:
    """``page_id, url`` with the URL normalised."""
    return table(spark, sf_dir, "pages").select("page_id", U.normalize(F.col("url")).alias("url"))


PAGE_URLS = f"SELECT page_id, {S.normalize('url')} AS url FROM pages"


def known_urls(spark, sf_dir) -> DataFrame:
    return page_urls(spark, sf_dir).where("page_id % 3 = 0").select("url").distinct()


def failed_urls(spark, sf_dir) -> DataFrame:
    return page_urls(spark, sf_dir).where("page_id % 11 = 0").select("url").distinct()


KNOWN = f"SELECT DISTINCT url FROM ({PAGE_URLS}) WHERE page_id % 3 = 0"
FAILED = f"SELECT DISTINCT url FROM ({PAGE_URLS}) WHERE page_id % 11 = 0"


def link_table(spark, sf_dir) -> DataFrame:
    """Closed link graph over the pages: number i links to 2i+1 and 3i+2."""
    pages = number_rows(page_urls(spark, sf_dir), "page_id", name="i")
    n = pages.count()
    ends = pages.select(
        "url", F.explode(F.array((F.col("i") * 2 + 1) % n, (F.col("i") * 3 + 2) % n)).alias("j")
    )
    targets = pages.select(F.col("i").alias("j"), F.col("url").alias("link"))
    return ends.join(targets, "j").select("url", "link")


LINKS = f"""SELECT a.url AS url, b.url AS link FROM
  (SELECT url, unnest([(2 * i + 1) % n, (3 * i + 2) % n]) AS j FROM
    (SELECT url, row_number() OVER (ORDER BY page_id) - 1 AS i, count(*) OVER () AS n FROM ({PAGE_URLS}))) a
  JOIN (SELECT url, row_number() OVER (ORDER BY page_id) - 1 AS i FROM ({PAGE_URLS})) b ON a.j = b.i"""


def requests(spark, sf_dir) -> DataFrame:
    """``id, domain, ts_us``."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("domain"),
        micros(F.col("ts")).alias("ts_us"),
    )


def attempts(spark, sf_dir) -> DataFrame:
    """``url, ts, event_id, success``."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd")).alias("url"),
        "ts", "event_id", (F.col("event_type") != "error").alias("success"),
    )


ATTEMPTS = """SELECT user_id::VARCHAR || '/' || strftime(ts, '%Y-%m-%d') AS url, ts, event_id,
  event_type <> 'error' AS success FROM events"""


def robots_log(spark, sf_dir) -> DataFrame:
    """``robots_url, status, body`` per page origin."""
    first = table(spark, sf_dir, "pages").groupBy(U.origin(F.col("url")).alias("o")).agg(
        F.min("page_id").alias("m")
    )
    return first.select(
        F.concat("o", F.lit("/robots.txt")).alias("robots_url"),
        F.when(F.col("m") % 5 == 0, 404).otherwise(200).alias("status"),
        F.when(F.col("m") % 7 == 0, "").otherwise("User-agent: *").alias("body"),
    )


ROBOTS_LOG = f"""SELECT o, o || '/robots.txt' AS robots_url, CASE WHEN m % 5 = 0 THEN 404 ELSE 200 END AS status,
  CASE WHEN m % 7 = 0 THEN '' ELSE 'User-agent: *' END AS body
  FROM (SELECT {S.origin('url')} AS o, min(page_id) AS m FROM pages GROUP BY 1)"""


def own_links(spark, sf_dir) -> DataFrame:
    """``page_id, link``: normalised links of a rich page to its own site."""
    from webtext.operators import links as L

    found = L.link_source(rich_pages(spark, sf_dir)).select(
        "page_id", "url", L.all_links(F.col("base"), F.col("tags")).alias("links")
    )
    return found.select("page_id", F.explode(L.internal_links(F.col("links"), own_site())).alias("link"))


def sql_hrefs(source: str, pattern: str) -> str:
    return f"""SELECT page_id, url, unnest({S.attributes('html', pattern)}) AS href
      FROM (SELECT page_id, url, {S.visible('html')} AS html FROM ({source}))"""


ATTR = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
SQL_ANCHORS = S.resolve(
    f"""SELECT * FROM ({sql_hrefs(RICH, r'(?is)<a\s(?:[^>]*?\s)?href\s*=\s*' + ATTR)})
    WHERE href <> '' AND NOT {S.matches('href', S.FOLLOWABLE)}""",
    "page_id, url, href",
)
SQL_HREFS = f"""SELECT page_id, url, link FROM ({S.resolve(
    sql_hrefs(RICH, r'(?is)<[a-z][^>]*?' + chr(92) + r'shref\s*=\s*' + ATTR), 'page_id, url')})
    WHERE NOT {S.matches('link', r'(?i)^(javascript|mailto|tel):')}"""
SQL_ONCLICK = f"""SELECT page_id, url, unnest({S.rall('href', P.ONCLICK_TARGET)}) AS link
    FROM ({sql_hrefs(RICH, r'(?is)' + chr(92) + r'sonclick\s*=\s*' + ATTR)})"""
_DATA = r'''(?is)\sdata-[a-z0-9_.-]+\s*=\s*("http[^"]*"|'http[^']*'|http[^\s"'>]+)'''
SQL_DATA = f"SELECT page_id, url, href AS link FROM ({sql_hrefs(RICH, _DATA)})"
SQL_ALL = " UNION ".join(
    f"SELECT page_id, url, link FROM ({x})" for x in (SQL_ANCHORS, SQL_HREFS, SQL_ONCLICK, SQL_DATA)
)
SQL_OWN = f"""SELECT DISTINCT page_id, {S.normalize('link')} AS link FROM ({SQL_ALL})
    WHERE {S.internal('link', S.site('url'))} AND NOT {S.matches('link', S.ASSET)}"""
