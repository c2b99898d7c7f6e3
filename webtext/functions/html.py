"""HTML to clean markdown as a chain of built-in string expressions.

The whole conversion is one narrow projection: no Python, no shuffle. Each step
is usable on its own; ``html_to_markdown`` composes them in the fixed order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from webtext.functions import patterns as P


def _steps(c: Column, *steps) -> Column:
    return reduce(lambda acc, step: step(acc), steps, c)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def closed(c: Column, end: str, *edits) -> Column:
    """Apply ``edits`` to the text up to the last match of ``end``; the rest stays.

    The result is that of edits on the whole text by patterns that must close with
    ``end``, but no opener looks in vain for its end, so time stays linear.
    """

    def run(x: Column) -> Column:
        head = F.regexp_extract(x, rf"(?is)\A.*{end}", 0)
        return _let(head, lambda h: F.concat(_steps(h, *edits), F.substr(x, F.length(h) + 1)))

    return _let(c, run)


def _replacing(pattern: str, replacement: str):
    return lambda c: F.regexp_replace(c, pattern, replacement)


def decode_entities(c: Column) -> Column:
    return reduce(lambda acc, e: F.replace(acc, F.lit(e[0]), F.lit(e[1])), P.ENTITIES, c)


def title(html: Column) -> Column:
    """Page title, entities decoded and ASCII whitespace collapsed."""
    upto = F.regexp_extract(html, rf"(?is)\A.*{P.TITLE_END}", 0)
    raw = decode_entities(F.regexp_extract(upto, P.TITLE, 1))
    return F.regexp_replace(F.regexp_replace(raw, r"[\t\n\f\r ]+", " "), r"\A | \z", "")


# Tags folded in one go by ``without_nested``; copying what a fold has gathered costs time
# in proportion to this many.
TAGS_AT_ONCE = 256


def without_nested(html: Column) -> Column:
    """The page without removed elements, however deep elements of one name are nested.

    The tags of removed elements are read in one scan and folded in order: an element
    opens, its depth counts start and closing tags of its own name, and all is dropped
    until the depth is 0 again. Other tags inside do not count, a closing tag of nothing
    open is text, and an element that is never closed takes the rest of the page.
    """
    tags = F.regexp_extract_all(html, F.lit(P.BOILERPLATE_TOKEN), F.lit(0))
    gaps = F.split(html, P.BOILERPLATE_TOKEN, -1)
    word = lambda t: F.lower(F.regexp_extract(t, r"\A</?([A-Za-z]+)", 1))
    single = lambda t: t.endswith("/>") | word(t).isin(*P.VOID_TAGS, *P.RAW_TAGS)
    items = F.zip_with(
        tags, F.slice(gaps, F.lit(2), F.greatest(F.size(gaps) - 1, F.lit(0))),
        lambda t, g: F.struct(
            word(t).alias("name"), F.when(t.startswith("</"), -1).when(single(t), 0).otherwise(1).alias("step"), t.alias("tag"), g.alias("gap")
        ),
    )

    def fold(state: Column, item: Column) -> Column:
        idle = state["depth"] == 0
        own = state["name"] == item["name"]
        depth = (
            F.when(idle, F.greatest(item["step"], F.lit(0))).when(own, state["depth"] + item["step"]).otherwise(state["depth"])
        )
        piece = (
            F.when(depth > 0, "").when(idle & (item["step"] < 0), F.concat(item["tag"], item["gap"])).otherwise(item["gap"])
        )
        return F.struct(
            F.when(idle, item["name"]).otherwise(state["name"]).alias("name"), depth.alias("depth"),
            F.array_append(state["kept"], piece).alias("kept"),
        )

    def fold_block(state: Column, block: Column) -> Column:
        start = F.struct(state["name"].alias("name"), state["depth"].alias("depth"), F.array().cast("array<string>").alias("kept"))
        done = F.aggregate(block, start, fold)
        return F.struct(
            done["name"].alias("name"), done["depth"].alias("depth"),
            F.array_append(state["kept"], F.array_join(done["kept"], "")).alias("kept"),
        )

    def run(found: Column) -> Column:
        count = F.greatest(F.ceil(F.size(found) / TAGS_AT_ONCE).cast("int"), F.lit(1))
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(found, b * TAGS_AT_ONCE + 1, F.lit(TAGS_AT_ONCE)))
        start = F.struct(F.lit("").alias("name"), F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))
        return F.array_join(F.aggregate(blocks, start, fold_block)["kept"], "")

    return F.concat(gaps[0], _let(items, run))


def strip_boilerplate(html: Column) -> Column:
    """The page without menus, scripts, forms and the like, with all they hold.

    One expression does it, but for pages where an element is nested in one of its own
    name: only for these are tags counted.
    """
    return _let(html, lambda h: F.when(h.rlike(P.NESTED_BOILERPLATE), without_nested(h)).otherwise(F.regexp_replace(h, P.BOILERPLATE, "")))


def strip_class_and_id(html: Column) -> Column:
    return F.regexp_replace(html, P.CLASS_OR_ID, "$1$2")


def drop_relative_links(html: Column) -> Column:
    """Delete anchors whose href is not http(s), together with their text."""
    return closed(html, P.A_END, _replacing(P.RELATIVE_ANCHOR, ""))


def unwrap_paragraphs(html: Column, paragraph_breaks: bool = False) -> Column:
    """Replace a paragraph that holds a single string by that string.

    No break is inserted, so neighbouring paragraphs run together;
    ``paragraph_breaks`` puts a blank line around every paragraph instead.
    """
    if not paragraph_breaks:
        return F.regexp_replace(html, P.SINGLE_STRING_P, "$1")
    unwrapped = F.regexp_replace(html, P.SINGLE_STRING_P, "\n\n$1\n\n")
    return F.regexp_replace(unwrapped, P.PARAGRAPH_TAG, "\n\n")


def markup_to_markdown(html: Column) -> Column:
    """Headings, list items, breaks, emphasis, code and links; then entities."""
    headings = [lambda c, end=end, edit=_replacing(*edit): closed(c, end, edit) for end, *edit in P.HEADINGS]
    out = closed(_steps(html, *headings), P.LI_END, _replacing(P.LIST_ITEM, "\n* $1"))
    for pattern, replacement in (
        (P.LINE_BREAK, "\n"),
        (P.BOLD, "__$1__"),
        (P.ITALIC, "_$1_"),
        (P.CODE, "`$1`"),
    ):
        out = F.regexp_replace(out, pattern, replacement)
    out = closed(out, P.A_END, _replacing(P.MD_ANCHOR, "[$2]($1)"))
    return decode_entities(out)


def article_body(text: Column) -> Column:
    """Content of the first article element, or the whole text without one."""
    return F.regexp_replace(text, P.FIRST_ARTICLE, "$1")


def collapse_blank_lines(text: Column) -> Column:
    return F.regexp_replace(text, P.BLANK_LINES, "\n\n")


def strip_tags(text: Column) -> Column:
    return closed(text, P.TAG_END, _replacing(P.ANY_TAG, ""))


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, P.HTTP_URL, "")


def unwrap_markdown_links(text: Column) -> Column:
    edit = _replacing(P.MD_LINK_OR_BRACKET, "$1$2")
    return closed(text, P.MD_END, lambda c: closed(c, P.MD_LINK_END, edit))


def squeeze_spaces(text: Column) -> Column:
    return F.regexp_replace(text, P.SPACES, " ")


def drop_symbol_lines(text: Column) -> Column:
    return F.regexp_replace(text, P.SYMBOL_LINES, "")


def paragraph_spacing(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, P.MANY_NEWLINES, "\n\n"), F.lit(P.WS_CHARS))


def clean_markdown(text: Column) -> Column:
    return _steps(
        text,
        article_body,
        collapse_blank_lines,
        strip_tags,
        strip_urls,
        unwrap_markdown_links,
        squeeze_spaces,
        drop_symbol_lines,
        paragraph_spacing,
    )


def html_to_markdown(html: Column, paragraph_breaks: bool = False) -> Column:
    return _steps(
        html,
        strip_boilerplate,
        strip_class_and_id,
        drop_relative_links,
        lambda c: unwrap_paragraphs(c, paragraph_breaks),
        markup_to_markdown,
        clean_markdown,
    )
