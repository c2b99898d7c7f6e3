"""URL expressions. Every function takes and returns a Column.

They follow RFC 3986 splitting with three site rules: an empty query or
fragment is dropped when a link is resolved, the host is compared exactly
(port, user info and case included), and only listed query parts survive
normalisation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from webtext.functions import patterns as P


def _starts_with_any(c: Column, prefixes) -> Column:
    return c.rlike(r"\A(?:" + "|".join(re.escape(p) for p in prefixes) + ")")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, P.SCHEME, 1))


def netloc(url: Column) -> Column:
    """Authority part, as written: ``user@Host:port``."""
    return F.regexp_extract(url, P.NETLOC, 1)


def origin(url: Column) -> Column:
    return F.regexp_extract(url, P.ORIGIN, 1)


def domain(url: Column) -> Column:
    """Third ``/``-part of the URL; NULL when there is none."""
    return F.get(F.split(url, "/"), F.lit(2))


def slug(url: Column) -> Column:
    """Last ``/``-part of the URL with its query and fragment."""
    return F.element_at(F.split(url, "/"), -1)


def is_followable(href: Column) -> Column:
    return (href != "") & ~_starts_with_any(href, P.SKIPPED_PREFIXES)


def is_internal(url: Column, site: Column | str) -> Column:
    site = F.lit(site) if isinstance(site, str) else site
    host = netloc(url)
    return (host == site) | (host == F.concat(F.lit("www."), site))


def is_asset(url: Column) -> Column:
    return url.rlike("(?:" + "|".join(re.escape(s) for s in P.ASSET_SUFFIXES) + r")\z")


def kept_query(url: Column) -> Column:
    """``?`` and the listed query parts in their order, or an empty string."""
    parts = F.split(F.regexp_extract(url, P.QUERY, 1), "&")
    kept = F.array_join(F.filter(parts, lambda x: _starts_with_any(x, P.KEPT_QUERY_KEYS)), "&")
    return F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")


def normalize(url: Column) -> Column:
    """Scheme, authority and path without ``;params`` of the last segment and
    without one trailing slash, then the kept query parts."""
    base = F.regexp_extract(url, r"\A([^?#]*)", 1)
    base = F.regexp_replace(base, r"\A([^:]+://[^/]*/.*?);[^/]*\z", "$1")
    base = F.regexp_replace(base, r"\A([^:]+://.*)/\z", "$1")
    rest = F.regexp_replace(base, P.SCHEME, "")
    return F.concat(scheme(url), F.lit(":"), rest, kept_query(url))


def _without_dot_segments(path: Column) -> Column:
    """``/a/../b/.`` becomes ``/b/``; ``..`` at the root is ignored."""
    walked = F.aggregate(
        F.split(path, "/"),
        F.lit(""),
        lambda acc, seg: F.when(seg == "..", F.regexp_replace(acc, r"/[^/]*\z", ""))
        .when(seg == ".", acc)
        .otherwise(F.concat(acc, F.lit("/"), seg)),
    )
    ends_in_dots = path.rlike(r"/\.\.?\z")
    walked = F.concat(F.substr(walked, F.lit(2)), F.when(ends_in_dots, "/").otherwise(""))
    rooted = F.when(walked.startswith("/"), walked).otherwise(F.concat(F.lit("/"), walked))
    return F.when(path.rlike(r"/\.\.?(?:/|\z)"), rooted).otherwise(path)


def base_parts(url: Column) -> Column:
    """Parts of a page URL that its links are resolved against.

    Computed once per page and handed to ``resolve`` for each link.
    """
    path = F.regexp_extract(url, r"\A[^:]+://[^/?#]*([^?#]*)", 1)
    return F.struct(
        scheme(url).alias("scheme"),
        F.concat(scheme(url), F.lit("://"), netloc(url)).alias("root"),
        path.alias("path"),
        # Directory of the page: its path up to the last slash.
        F.regexp_extract(F.concat(F.lit("/"), path), r"\A(.*/)", 1).alias("dir"),
        F.regexp_extract(url, r"\A[^?#]*(\?[^#]+)", 1).alias("query"),
    )


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` on the page with ``base_parts`` ``base``.

    Dot segments are walked only for the few links that contain them.
    """
    href = F.regexp_replace(href, r"\A[\x{00}-\x{20}]+|[\x{00}-\x{20}]+\z|[\t\r\n]", "")
    no_fragment = F.regexp_replace(F.regexp_extract(href, r"\A([^#]*)", 1), r"\A([^?]*)\?\z", "$1")
    fragment = F.regexp_extract(href, r"\A[^#]*(#.+)\z", 1)
    path = F.regexp_extract(no_fragment, r"\A([^?]*)", 1)
    query = F.regexp_extract(no_fragment, r"(\?.*)\z", 1)
    relative = F.regexp_replace(F.concat(base["dir"], path), r"/{2,}", "/")
    target = F.when(path.startswith("/"), path).otherwise(relative)
    base_scheme = F.concat(base["scheme"], F.lit(":"))

    return (
        F.when(
            scheme(href) == base["scheme"],
            F.concat(base_scheme, F.regexp_replace(no_fragment, P.SCHEME, ""), fragment),
        )
        .when(href.rlike(P.SCHEME), href)
        .when(href.startswith("//"), F.concat(base_scheme, no_fragment, fragment))
        .when(
            path == "",
            F.concat(
                base["root"], base["path"], F.when(query != "", query).otherwise(base["query"]), fragment
            ),
        )
        .otherwise(F.concat(base["root"], _without_dot_segments(target), query, fragment))
    )


def robots_url(url: Column) -> Column:
    return F.concat(origin(url), F.lit("/robots.txt"))


def robots_file_name(url: Column, stamp: Column) -> Column:
    return F.concat(F.replace(netloc(url), F.lit("."), F.lit("_")), F.lit("_"), stamp, F.lit("_robots.txt"))
