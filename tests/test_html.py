"""Golden cases and brute-force models of the HTML and markdown steps."""

import random

import pytest
from pyspark.sql import functions as F

from webtext.functions import html as H

SPACE = set("\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0     　") | {
    chr(c) for c in range(0x2000, 0x200B)
}


def apply(spark, values, step):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", step(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("step, text, want", [
    (H.strip_urls, 'see [doc](https://a.b/c) now [d](http://x.y "t") z http://q.r/#f',
     'see [doc]( now [d]( "t") z #f'),
    (H.article_body, "<article></article>after", ""),
    (H.article_body, "no article", "no article"),
    (H.article_body, "<article>never closed", "<article>never closed"),
    (H.article_body, "x<article a=1>one</article><article>two</article>", "one"),
    (H.strip_tags, "x<!-- c > d -->y", "x d -->y"),
    (H.unwrap_paragraphs, "<p>a.</p><p>b</p>", "a.b"),
    (H.unwrap_paragraphs, '<p style="x"><b><i>b</i></b></p>', "b"),
    (H.unwrap_paragraphs, "<p>a<br>b</p>", "<p>a<br>b</p>"),
    (lambda c: H.unwrap_paragraphs(c, True), "<p>a.</p><p>b</p>", "\n\na.\n\n\n\nb\n\n"),
    (H.unwrap_markdown_links, "[a](b) [c]() [](d)", "a [c]() [](d)"),
    (H.drop_symbol_lines, "***\na\n", "a\n"),
    (H.drop_symbol_lines, "²\n_\ń\n***\nx", "²\n_\nx"),
    (H.squeeze_spaces, "a   b \t  c", "a b \t c"),
    (H.paragraph_spacing, " \n a\n\n\n\nb \x85", "a\n\nb"),
    (H.strip_boilerplate, "a<nav x=1>b<footer>c</footer></nav>d<meta y>e<path d='m'/>f<link>g", "adefg"),
    (H.strip_boilerplate, '<script>var t="<nav>";</script>a</nav>b', "a</nav>b"),
    (H.strip_boilerplate, "<navy>a</navy><formula>b</formula>", "<navy>a</navy><formula>b</formula>"),
    (H.strip_class_and_id, '<p class="a b" data-x=1 id=c>t</p>', "<p data-x=1>t</p>"),
    (H.drop_relative_links, '<a href="/x">gone</a><a name=k>kept</a><a href=\'http://y\'>z</a>',
     "<a name=k>kept</a><a href='http://y'>z</a>"),
    (H.drop_relative_links, '<a title="t" href= "https://y">z</a><a href=HTTP://y>gone</a>',
     '<a title="t" href= "https://y">z</a>'),
    (H.markup_to_markdown, "<h2 a=b>T</h2><li>x</li><br/><b>y</b><em>z</em><code>c</code>",
     "\n\n## T\n\n\n* x\n__y___z_`c`"),
    (H.markup_to_markdown, '<a href="http://u" t=1>x</a>&amp;lt;&lt;', "[x](http://u)&lt;<"),
    (H.title, "<title>\n a &amp;\tb </title>", "a & b"),
    (H.title, "<p>none</p>", ""),
])
def test_golden(spark, step, text, want):
    assert apply(spark, [text], step) == [want]


def test_whole_conversion(spark):
    page = (
        "<html><head><title>T</title><script>x</script></head><body><nav>menu</nav>"
        "<article><h1>Head</h1><p>One  two.</p><p><b>three</b> <a href='/r'>rel</a>"
        '<a href="https://x.y/z">abs</a></p>***\n</article><footer>f</footer></body></html>'
    )
    # The address takes the closing bracket with it, as in the golden case above.
    assert apply(spark, [page], H.html_to_markdown) == ["# Head\n\nOne two.__three__ [abs]("]


# --- scanners written without regular expressions --------------------------
def scan_tags(text):
    out, i = [], 0
    while i < len(text):
        end = text.find(">", i + 1) if text[i] == "<" else -1
        if end > 0:
            i = end + 1
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def scan_spaces(text):
    return "".join(c for i, c in enumerate(text) if not (c == " " and i and text[i - 1] == " "))


def scan_blank_lines(text):
    out, i = [], 0
    while i < len(text):
        if text[i] == "\n":
            j = i + 1
            while j < len(text) and text[j] in SPACE:
                j += 1
            last = text.rfind("\n", i + 1, j)
            if last > 0:
                out.append("\n\n")
                i = last + 1
                continue
        out.append(text[i])
        i += 1
    return "".join(out)


def scan_strip(text):
    start, end = 0, len(text)
    while start < end and text[start] in SPACE:
        start += 1
    while end > start and text[end - 1] in SPACE:
        end -= 1
    return text[start:end]


@pytest.mark.parametrize("step, model", [
    (H.squeeze_spaces, scan_spaces),
    (H.collapse_blank_lines, scan_blank_lines),
    (lambda c: F.btrim(c, F.lit(H.P.WS_CHARS)), scan_strip),
])
def test_random_text_equals_scanner(spark, step, model):
    rng = random.Random(7)
    alphabet = list("ab \n\n\t\x0b\r\x1c\x85\xa0  ​<>[]()*_²é.")
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(1500)]
    assert apply(spark, texts, step) == [model(t) for t in texts]


def test_random_tags_equal_scanner(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab<> \n") for _ in range(rng.randrange(40))) for _ in range(1500)]
    plain = [t for t in texts if "<>" not in t]
    assert len(plain) > 500
    assert apply(spark, plain, H.strip_tags) == [scan_tags(t) for t in plain]


def test_symbol_lines_on_random_lines(spark):
    rng = random.Random(9)
    pool = ["***", "- -", "a*", "_", "²", "x", "!?", "　", "é."]
    for_lines = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9))) for _ in range(500)]
    word = {"a*", "_", "²", "x", "é."}

    def model(text):
        lines = text.split("\n")
        kept = [l for l in lines[:-1] if l in word]
        return "\n".join(kept + lines[-1:])

    assert apply(spark, for_lines, H.drop_symbol_lines) == [model(t) for t in for_lines]


@pytest.mark.parametrize("step, text, want", [
    (H.unwrap_paragraphs, "<p><span><b><i><u>x</u></i></b></span></p>", "x"),
    (H.unwrap_paragraphs, "<p><font>x</font></p><p><div>y</div></p>", "xy"),
    (H.unwrap_paragraphs, "<p><br>x</p>", "<p><br>x</p>"),
    (H.strip_class_and_id, "<p class=a id='b' class=\"c > d\" id=e data-id=f>class=g</p>", "<p data-id=f>class=g</p>"),
    (H.strip_class_and_id, "a class=b <i hidden class=c>d</i>", "a class=b <i hidden>d</i>"),
    (H.strip_boilerplate, "a<nav>b</nav>c<script>d<p>e", "ac"),
    (H.strip_boilerplate, "a<form x", "a"),
    (H.markup_to_markdown, "<li>a</li><li>b", "\n* a<li>b"),
    (H.markup_to_markdown, "<h1>a<h2>b</h2>", "<h1>a\n\n## b\n\n"),
    (H.drop_relative_links, "<a href=/x>a</a><a href=/y>b", "<a href=/y>b"),
    (H.unwrap_markdown_links, "[a [b](c) [d] e](f) [g [h] i [j](k", "a [b [d] e](f) [g [h] i [j](k"),
    (H.strip_tags, "a<b>c<d", "ac<d"),
])
def test_unclosed_and_nested_parts(spark, step, text, want):
    assert apply(spark, [text], step) == [want]


def test_text_that_shows_markup_gives_no_links(spark):
    from webtext.operators import links as L

    page = (
        "<pre>&lt;div onclick=\"window.location.href='https://a/1'\" data-u=\"https://a/2\"&gt;</pre>"
        "<div title='a > b' onclick=\"window.location.href='https://a/3'\" data-u=https://a/4><!-- <a href=https://a/5>"
    )
    df = spark.createDataFrame([(1, "https://a/", page)], "page_id int, url string, html string")
    row = L.link_source(df).select(L.all_links(F.col("base"), F.col("tags")).alias("x")).first()
    assert sorted(row.x) == ["https://a/3", "https://a/4"]


@pytest.mark.parametrize("unit", ["<li>item text ", "<a ", "[", "<", "<nav>x ", "<article>", "<h1>x <h2>y ", "<p><b>", "<a href=/x>y ", "[x] ", "<b ", '<i class="a" ', "<!-- "])
def test_unclosed_parts_take_linear_time(spark, unit):
    import time

    def seconds(size: int) -> float:
        df = spark.createDataFrame([(unit * (size // len(unit)),)], "v string")
        start = time.time()
        df.select(F.length(H.html_to_markdown(F.col("v"))), F.size(L.start_tags(F.col("v")))).collect()
        return time.time() - start

    from webtext.operators import links as L

    seconds(1_000)
    small, large = seconds(24_000), seconds(960_000)
    # 40 times the text; by the square it would be 1,600 times the time.
    assert large < 80 * max(small, 0.1)
