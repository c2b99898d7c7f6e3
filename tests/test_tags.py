"""Nested boilerplate and links of malformed tags, against scanners of single characters."""

import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from webtext.functions import html as H
from webtext.functions import patterns as P
from webtext.operators import links as L

BASE = "https://s.example/dir/page"


def apply(spark, values, step):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", step(F.col("v")).alias("x")).orderBy("i").collect()]


def values_of(name, tag="a"):
    def step(c):
        tags = F.filter(L.start_tags(c), lambda t: t["name"] == tag)
        return F.transform(tags, lambda t: F.array_join(F.transform(F.filter(t["attributes"], lambda a: a["name"] == name), lambda a: a["value"]), "|"))

    return step


@pytest.mark.parametrize("page, want", [
    ('<a href="/x"">A</a> <a href="/y">B</a>', ["/x", "/y"]),
    ("<a title=it's href=\"/z\">C</a>", ["/z"]),
    ("<a href='/q' x='>' title=\"a > b\">D</a><a HREF = /u>", ["/q", "/u"]),
    ('<a title="x href=/no" href="/yes">', ["/yes"]),
    ('<a data-href="/no" href=/a/b/>', ["/a/b/"]),
    ('<a"href="/no"> <a/href="/slash">', ["/slash"]),
    ('<a href="/one" href="/two">', ["/one"]),
    ('<a href="/open>text</a> <a href="/next">', ["/open>text</a> <a href="]),
    ('<a href=\'/never>text</a> <b><a href="/next">', ["'/never", "/next"]),
    ("<a name=k>no</a><a href>none</a><a href=''>empty</a>", [""]),
    ('<script>"<a href=/s>"</script><!-- <a href=/c> --><a href="/v&amp;w">', ["/v&w"]),
    ("", []),
])
def test_hrefs(spark, page, want):
    assert apply(spark, [page], lambda c: L.anchor_hrefs(L.start_tags(c))) == [want]


def test_other_methods(spark):
    page = (
        "<div ONCLICK=\"window.location.href='/k'\" data-u='http://d.example/1' DATA-V=http://d.example/2 data-w=\"ftp://x\">"
        "<link rel=x href=style.css><img src=it's data-x=\"https://d.example/3\"\"><a href=#top>"
    )
    steps = (L.onclick_links, L.data_links, lambda t: L.href_links(L.U.base_parts(F.lit(BASE)), t))
    got = [apply(spark, [page], lambda c, step=step: step(L.start_tags(c)))[0] for step in steps]
    assert got == [["/k"], ["http://d.example/1", "http://d.example/2", "https://d.example/3"], ["https://s.example/dir/style.css", BASE + "#top"]]


class Tags(HTMLParser):
    """Hrefs of anchors as the standard library reads them."""

    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.found += [v for k, v in attrs if k == "href" and v is not None][:1]

    handle_startendtag = handle_starttag


def test_attributes_equal_a_parser(spark):
    rng = random.Random(12)
    values = ['"/a b"', "'/c>d'", "/e", '"x=y"', "'it\"s'", '""']
    pages = []
    for _ in range(300):
        page = ""
        for _ in range(rng.randint(1, 5)):
            attrs = [f"{rng.choice(['href', 'title', 'HREF', 'data-k', 'x:y', 'href2'])}{rng.choice(['', '', ' ', chr(10)])}={rng.choice(['', ' '])}{rng.choice(values)}" for _ in range(rng.randint(0, 4))]
            page += f"<{rng.choice('aAb')} {'  '.join(attrs)}>text</a>"
        pages.append(page)
    want = []
    for page in pages:
        parser = Tags()
        parser.feed(page)
        want.append(parser.found)
    assert apply(spark, pages, lambda c: L.anchor_hrefs(L.start_tags(c))) == want


NAMES = [n for n in P.BOILERPLATE_TAGS if n not in ("script", "style", *P.VOID_TAGS)]


def scan(page):
    """Boilerplate removed by walking the page once, tag by tag."""
    out, i, name, depth = [], 0, "", 0
    low = page.lower()
    while i < len(page):
        end = -1
        if low[i] == "<":
            close = low[i + 1 : i + 2] == "/"
            start = i + 1 + close
            stop = start
            while stop < len(low) and low[stop].isalpha():
                stop += 1
            tag = low[start:stop]
            after = low[stop : stop + 1]
            if tag in P.BOILERPLATE_TAGS and (after in ("", ">", "/") or after.isspace()):
                end = low.find(">", stop)
                end = len(low) if end < 0 else end + 1
                if not close and tag in ("script", "style"):
                    at = low.find(f"</{tag}>", end)
                    i = len(low) if at < 0 else at + len(tag) + 3
                    continue
                if tag in ("script", "style"):
                    end = -1
        if end < 0:
            out.append(page[i] if not depth else "")
            i += 1
            continue
        text, i = page[i:end], end
        if not close and (tag in P.VOID_TAGS or text.endswith("/>")):
            continue
        if not depth:
            if close:
                out.append(text)
            else:
                name, depth = tag, 1
        elif tag == name:
            depth += -1 if close else 1
    return "".join(out)


@pytest.mark.parametrize("page, want", [
    ("a<aside>1<aside>2</aside>3</aside>b", "ab"),
    ("a<NAV x=1><nav>m<nav/></Nav><p>n</nav >b</nav>c", "ab</nav>c"),
    ("a<nav><nav>never closed", "a"),
    ("a<svg><path d=1></path><svg></svg></svg>b<path><path></path></path>c", "abc"),
    ('<header><script>"</header><header>"</script><header></header>x</header>y', "y"),
    ("<navy><navy></navy>t<form><form></form></form>", "<navy><navy></navy>t"),
    ("<footer><aside></footer><footer></footer></aside>z</footer>t", "</aside>z</footer>t"),
    ("x</nav><nav><nav></nav></nav>y", "x</nav>y"),
])
def test_nested(spark, page, want):
    assert apply(spark, [page], H.strip_boilerplate) == [want] == [scan(page)]


def test_scan_on_random_nesting(spark, monkeypatch):
    monkeypatch.setattr(H, "TAGS_AT_ONCE", 4)
    rng = random.Random(3)
    parts = ["x", "<b>", "\n"] + [f"<{n}>" for n in NAMES] + [f"</{n}>" for n in NAMES] + ["<nav>", "</nav>", "<aside a='1'>", "</aside >"] * 4
    parts += ["<meta c>", "<script>'<nav>'</script>", "<path d/>", "<navy>", "</style>"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    assert apply(spark, pages, H.without_nested) == [scan(p) for p in pages]


def test_pages_without_nesting_agree(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    one, other = (F.sha2(step(F.col("html")), 256) for step in (H.without_nested, H.strip_boilerplate))
    assert pages.where(one != other).count() == 0


def test_time_is_linear_in_nested_pages(spark):
    """Twice the page takes about twice the time, up to a megabyte."""
    def seconds(n):
        page = "<aside>" * n + "t" + "</aside>" * n + "<nav><nav>" * n
        start = time.perf_counter()
        assert apply(spark, [page], H.strip_boilerplate) == [""]
        return time.perf_counter() - start

    seconds(100)
    assert seconds(40_000) < 20


@pytest.mark.parametrize("unit", ["<a href=\"", "<a href='", "<a =\"", "<a x", "<a href=\"x\" "])
def test_time_is_linear_in_broken_tags(spark, unit):
    start = time.perf_counter()
    apply(spark, [unit * (600_000 // len(unit))], lambda c: F.size(L.anchor_hrefs(L.start_tags(c))))
    assert time.perf_counter() - start < 20
