"""URL expressions against the standard library and fixed cases."""

from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from webtext.functions import urls as U

BASES = [
    "http://h.com", "https://www.h.com/a/b/c?x=1#f", "http://h.com/a//b;p=1?q",
    "https://H.com:80/x/", "http://h.com/a/b/",
]
HREFS = [
    "/x", "x", "../x", "../../../x", "./x", "..", ".", "../", "./", "?q=1", "#f", "//o.com/p?", "//o.com",
    "https://z.com/a/../b#", "http://z.com?", "a//b/", "a/./b/../c", ";p", "x;p=1?q#f", "/a/../../b", "/..",
    "/.", "/a/./b/..", "mailto:x@y", "x?", "x#", "/a//b", "x/..", "g?y/../x", "/b/...", "HTTP://z.com/A",
]


def test_resolve_equals_urljoin(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(rows, "b string, h string")
    got = df.select("b", "h", U.resolve(U.base_parts(F.col("b")), F.col("h")).alias("r")).collect()
    wrong = []
    for r in got:
        want = urljoin(r.b, r.h)
        # A link of another scheme is returned as written.
        if r.r != want:
            wrong.append((r.b, r.h, want, r.r))
    assert not wrong


NORMALIZED = {
    "https://h.com/": "https://h.com",
    "https://h.com//": "https://h.com/",
    "https://H.com:80/a//?p=1&q=2&id=#x?y": "https://H.com:80/a/?p=1&id=",
    "https://h.com/a;b?id=1": "https://h.com/a?id=1",
    "HTTP://h/a;b/c;d/": "http://h/a;b/c;d",
    "http://u@h/?page=2&x&p=&id": "http://u@h?page=2&p=",
    "http://h/a/;x?p=1": "http://h/a?p=1",
    "http://h?idx=1&id=2": "http://h?id=2",
}


def apply(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_normalize(spark):
    assert apply(spark, NORMALIZED, U.normalize) == list(NORMALIZED.values())


def test_normalizing_twice_takes_a_second_slash(spark):
    once = apply(spark, ["http://h//"], U.normalize)
    assert apply(spark, once, U.normalize) == ["http://h"] != once


@pytest.mark.parametrize("url, inside", [
    ("https://h.com/a", True), ("https://www.h.com", True), ("https://m.h.com/", False),
    ("https://h.com:80/", False), ("https://u@h.com/", False), ("https://H.com/", False),
    ("mailto:a@h.com", False), ("ftp://h.com/x", True),
])
def test_internal(spark, url, inside):
    assert apply(spark, [url], lambda u: U.is_internal(u, "h.com")) == [inside]


def test_asset_suffix_is_case_sensitive_and_last(spark):
    urls = ["http://h/a.pdf", "http://h/a.PDF", "http://h/a.pdf?x", "http://h/a.pdf#p", "http://h/apdf"]
    assert apply(spark, urls, U.is_asset) == [True, False, False, False, False]


def test_followable(spark):
    hrefs = ["", "#x", "mailto:a", "tel:1", "javascript:void(0)", "Mailto:a", "/x", "x#y"]
    assert apply(spark, hrefs, U.is_followable) == [False] * 5 + [True] * 3


def test_domain_and_slug(spark):
    urls = ["https://h.com/a/b?x/y", "https://h.com/", "nohost", "https://h.com"]
    assert apply(spark, urls, U.domain) == ["h.com", "h.com", None, "h.com"]
    assert apply(spark, urls, U.slug) == ["y", "", "nohost", "h.com"]


def test_agrees_with_urlparse_on_all_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    for r in pages.select("url", U.netloc(F.col("url")).alias("n"), U.scheme(F.col("url")).alias("s")).collect():
        assert (r.n, r.s) == (urlparse(r.url).netloc, urlparse(r.url).scheme)
