"""SQL fragments for the comparison queries (DuckDB, RE2 patterns).

They state the same rules as the library, often by another route: RE2 has no
look-ahead or back-references, so anchors are protected and restored, and
heading levels take one pass each.
"""

from __future__ import annotations

from functools import reduce

from webtext.functions import patterns as P

WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rr(x: str, pattern: str, replacement: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(replacement)}, 'g')"


def rx(x: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract({x}, {q(pattern)}, {group})"


def rall(x: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract_all({x}, {q(pattern)}, {group})"


def matches(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


# --- URLs -----------------------------------------------------------------
SCHEME = r"\A([A-Za-z][A-Za-z0-9+.-]*):"


def scheme(u):
    return f"lower({rx(u, SCHEME)})"


def netloc(u):
    return rx(u, r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)")


def origin(u):
    return rx(u, r"\A([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)")


def site(u):
    return rr(netloc(u), r"\Awww\.")


def slug(u):
    return f"string_split({u}, '/')[-1]"


def kept_query(u):
    parts = f"string_split({rx(u, r'^[^?#]*[?]([^#]*)')}, '&')"
    kept = f"array_to_string(list_filter({parts}, lambda x: {matches('x', r'^(id|page|category|p)=')}), '&')"
    return f"CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END"


def normalize(u):
    base = rr(rx(u, r"^([^?#]*)"), r"^([^:]+://[^/]*/.*?);[^/]*$", r"\1")
    base = rr(base, r"^([^:]+://.*)/$", r"\1")
    return f"({scheme(u)} || ':' || {rr(base, SCHEME)} || {kept_query(u)})"


def resolve(source: str, keep: str) -> str:
    """Rows of ``source`` (``url``, ``href`` and the ``keep`` columns) with ``link``."""
    bs = "\\"
    dots = (
        "list_reduce(string_split(target, '/'), lambda acc, seg: CASE WHEN seg = '..' THEN "
        "regexp_replace(acc, '/[^/]*$', '') WHEN seg = '.' THEN acc ELSE acc || '/' || seg END, '')"
    )
    return f"""SELECT {keep}, CASE
        WHEN lower({rx('h', SCHEME)}) = sch THEN sch || ':' || {rr('nf', SCHEME)} || frag
        WHEN {matches('h', SCHEME)} THEN h
        WHEN h LIKE '//%' THEN sch || ':' || nf || frag
        WHEN p = '' THEN root || bpath || CASE WHEN qu <> '' THEN qu ELSE bquery END || frag
        WHEN {matches('target', r'/[.][.]?(/|$)')} THEN
            root || CASE WHEN walked LIKE '/%' THEN walked ELSE '/' || walked END || qu || frag
        ELSE root || target || qu || frag END AS link
      FROM (SELECT *, substr({dots}, 2) || CASE WHEN {matches('target', r'/[.][.]?$')} THEN '/' ELSE '' END AS walked
      FROM (SELECT *, CASE WHEN p LIKE '/%' THEN p ELSE {rr('bdir || p', r'/{2,}', '/')} END AS target
      FROM (SELECT *, {rx('nf', r'^([^?]*)')} AS p, {rx('nf', r'([?].*)$')} AS qu
      FROM (SELECT *, {rr(rx('h', r'^([^#]*)'), r'^([^?]*)[?]$', bs + '1')} AS nf,
                   {rx('h', r'^[^#]*(#.+)$')} AS frag,
                   {rx("('/' || bpath)", r'^(.*/)')} AS bdir
      FROM (SELECT *, {rr('href', r'^[\x{00}-\x{20}]+|[\x{00}-\x{20}]+$|[\t\r\n]')} AS h,
                   {scheme('url')} AS sch, {scheme('url')} || '://' || {netloc('url')} AS root,
                   {rx('url', r'^[^:]+://[^/?#]*([^?#]*)')} AS bpath,
                   {rx('url', r'^[^?#]*([?][^#]+)')} AS bquery
      FROM ({source}))))))"""


FOLLOWABLE = r"^(javascript:|mailto:|tel:|#)"
ASSET = r"\.(pdf|jpg|png|gif|zip|mp3|mp4)$"


def internal(u, s):
    return f"({netloc(u)} = {s} OR {netloc(u)} = 'www.' || {s})"


# --- HTML -----------------------------------------------------------------
REMOVED = "script|style|iframe|nav|footer|header|aside|noscript|meta|link|button|form|input|svg|path"
VOID = "meta|link|input"
BOILERPLATE = (
    rf"(?is)<(?:(?:{REMOVED})(?:\s[^>]*)?/>|(?:{VOID})(?:\s[^>]*)?>|"
    + "|".join(rf"{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in REMOVED.split("|") if t not in VOID.split("|")) + ")"
)
CLASS_OR_ID = r"""(?is)(<[a-z][^>]*?)\s(?:class|id)\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
INLINE = "a|b|cite|code|em|i|mark|q|s|small|span|strong|sub|sup|u"
SINGLE_STRING_P = rf"(?is)<p(?:\s[^>]*)?>(?:<(?:{INLINE})(?:\s[^>]*)?>){{0,3}}([^<]+)(?:</(?:{INLINE})\s*>){{0,3}}</p\s*>"
LIST_ITEM = r"(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>"
LINE_BREAK = r"(?is)<br\s*/?>"
BOLD = r"(?is)<(?:b|strong)(?:\s[^>]*)?>([^<]*)</(?:b|strong)\s*>"
ITALIC = r"(?is)<(?:i|em)(?:\s[^>]*)?>([^<]*)</(?:i|em)\s*>"
CODE = r"(?is)<code(?:\s[^>]*)?>([^<]*)</code\s*>"
MD_ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["']?([^\s"'>]*)["']?[^>]*>(.*?)</a\s*>"""
ANY_TAG = r"<[^>]+>"
HTTP_URL = r"https?://[!$-_a-z]+"
MD_LINK = r"\[([^\]]+)\]\([^\)]+\)"
MANY_NEWLINES = r"\n{3,}"


def entities(x):
    return reduce(lambda acc, e: f"replace({acc}, {q(e[0])}, {q(e[1])})", P.ENTITIES, x)


def visible(h):
    for tag in ("script", "style", "noscript"):
        h = rr(h, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>")
    return rr(h, r"(?s)<!--.*?-->")


def attributes(h, pattern):
    values = rall(h, pattern)
    trimmed = rr("v", r"""^["']|["']$""")
    return f"list_transform({values}, lambda v: {entities(trimmed)})"


def title(h):
    raw = rr(entities(rx(h, r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>")), r"[\t\n\f\r ]+", " ")
    return f"trim({raw}, ' ')"


def boilerplate(h):
    return rr(h, BOILERPLATE)


def class_id(h):
    return rr(rr(h, CLASS_OR_ID, r"\1"), CLASS_OR_ID, r"\1")


def relative_anchors(h):
    protected = rr(h, r"""(?is)<a(\s(?:[^>]*?\s)?href\s*=\s*["']?(?-i:https?://))""", r"<" + "\x01" + r"\1")
    deleted = rr(protected, r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*[^>]*>.*?</a\s*>")
    return f"replace({deleted}, '<' || chr(1), '<a')"


def paragraphs(h):
    return rr(h, SINGLE_STRING_P, r"\1")


def markup(h):
    for level in range(1, 7):
        h = rr(h, rf"(?is)<h{level}(?:\s[^>]*)?>(.*?)</h{level}\s*>", f"\n\n{'#' * level} \\1\n\n")
    h = rr(h, LIST_ITEM, "\n* \\1")
    h = rr(h, LINE_BREAK, "\n")
    h = rr(h, BOLD, r"__\1__")
    h = rr(h, ITALIC, r"_\1_")
    h = rr(h, CODE, r"`\1`")
    h = rr(h, MD_ANCHOR, r"[\2](\1)")
    return entities(h)


def article(t):
    p = r"(?s)<article[^>]*>(.*?)</article>"
    return f"CASE WHEN {matches(t, p)} THEN {rx(t, p)} ELSE {t} END"


def blank_lines(t):
    return rr(t, rf"\n{WS}*\n", "\n\n")


def tags(t):
    return rr(t, ANY_TAG)


def urls(t):
    return rr(t, HTTP_URL)


def md_links(t):
    return rr(t, MD_LINK, r"\1")


def spaces(t):
    return rr(t, " +", " ")


def symbol_lines(t):
    return rr(t, r"(?m)^[^\p{L}\p{N}_]+$\n")


def spacing(t):
    return rr(rr(t, MANY_NEWLINES, "\n\n"), rf"\A{WS}+|{WS}+\z")


def chain(source: str, column: str, *steps, keep: str) -> str:
    """``keep`` columns and ``column`` after the steps, one subquery per step."""
    sql = source
    for step in steps:
        sql = f"SELECT {keep}, {step(column)} AS {column} FROM ({sql})"
    return sql


HTML_STEPS = (boilerplate, class_id, relative_anchors, paragraphs, markup)
TEXT_STEPS = (article, blank_lines, tags, urls, md_links, spaces, symbol_lines, spacing)

# --- text -----------------------------------------------------------------


def words(t):
    return f"list_filter(string_split_regex({t}, {q(WS + '+')}), lambda w: w <> '')"


def n_words(t):
    return f"len({words(t)})"


def not_blank(t):
    return f"{rr(t, WS + '+')} <> ''"


def uuid(u):
    return rr(f"md5({u})", r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", r"\1-\2-\3-\4-\5")
