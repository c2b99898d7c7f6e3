"""Regular expressions and word lists shared by the column functions.

All patterns run inside Spark's built-in regexp functions (Java syntax). Groups are
repeated without bound only possessively, which the engine runs as a loop, so a
hostile page cannot overflow its stack. No pattern scans far from an opener that may
never be closed: gaps inside a tag end at the next angle bracket, and patterns with a
closing part run only on the text up to the last such part (``html.closed``), so
time grows in proportion to the page.
"""

# --- Fixed values ---------------------------------------------------------
# Links that are not followed, files that are not pages, query parts kept.
SKIPPED_PREFIXES = ("javascript:", "mailto:", "tel:", "#")
ASSET_SUFFIXES = (".pdf", ".jpg", ".png", ".gif", ".zip", ".mp3", ".mp4")
KEPT_QUERY_KEYS = ("id=", "page=", "category=", "p=")
# Assignment of a location in a click handler.
ONCLICK_TARGET = r"""window\.location\.href\s*=\s*['"]([^'"]+)['"]"""
# Elements removed with their content.
BOILERPLATE_TAGS = (
    "script", "style", "iframe", "nav", "footer", "header", "aside", "noscript",
    "meta", "link", "button", "form", "input", "svg", "path",
)
# Markdown cleaning.
ANY_TAG = r"<[^>]+>"
HTTP_URL = r"https?://[!$-_a-z]+"
MD_LINK = r"\[([^\]]+)\]\([^\)]+\)"
MANY_NEWLINES = r"\n{3,}"
# Entities decoded to text; &amp; must stay last.
ENTITIES = (
    ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\xa0"), ("&copy;", "©"),
    ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"),
)
# The characters of WS below, for trimming and splitting.
WS_CHARS = (
    "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- Unicode-aware classes; Java's own \s and \W are ASCII-only -----------
WS = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
NON_WORD = r"[^\p{L}\p{N}_]"

# --- URL parts ------------------------------------------------------------
SCHEME = r"\A([A-Za-z][A-Za-z0-9+.-]*):"
NETLOC = r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
QUERY = r"\A[^?#]*\?([^#]*)"
ORIGIN = r"\A([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"

# --- Links in a page ------------------------------------------------------
# Start tags. A quote opens a value only after "=", and such a value may hold angle
# brackets; any other quote is an ordinary character.
START_TAG = r"""(?is)<[a-z](?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
# Tags worth walking.
LINK_ATTRIBUTE = r"(?i)href|onclick|data-"
TAG_NAME = r"(?i)\A<([a-z][^\s/>]*+)"
# Walks a start tag from where the last match ended: one attribute a match (group 1), its
# name and, after "=", its value in any of the three quoting styles.
ATTRIBUTE = (
    r"""(?is)(?:\A<[a-z][^\s/>]*+|(?!\A)\G)[\s/]*+([^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)"""
)
ATTRIBUTE_NAME = r"\A([^\s/>=]+)"
ATTRIBUTE_VALUE = r"""(?s)\A[^\s/>=]+\s*=\s*(.*)\z"""
QUOTED = r"""(?s)\A"(.*)"\z|\A'(.*)'\z"""
# Parts of a page that a browser does not expose as elements; without their end they
# take the rest of the page.
OPAQUE = (
    r"(?is)<(?:script(?:\s[^>]*+)?+(?:>|\z).*?(?:</script\s*+>|\z)"
    r"|style(?:\s[^>]*+)?+(?:>|\z).*?(?:</style\s*+>|\z)"
    r"|noscript(?:\s[^>]*+)?+(?:>|\z).*?(?:</noscript\s*+>|\z)"
    r"|!--.*?(?:-->|\z))"
)

# --- HTML to markdown -----------------------------------------------------
# Of the removed elements, those that never have a closing tag.
VOID_TAGS = ("meta", "link", "input")
# Elements without content, which make a paragraph hold more than a single string.
EMPTY_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def _boilerplate() -> str:
    any_tag, void = "|".join(BOILERPLATE_TAGS), "|".join(VOID_TAGS)
    rest = r"(?:\s[^>]*+)?+(?:>|\z)"
    branches = [rf"(?:{any_tag})(?:\s[^>]*)?/>", rf"(?:{void}){rest}"]
    branches += [rf"{t}{rest}.*?(?:</{t}\s*+>|\z)" for t in BOILERPLATE_TAGS if t not in VOID_TAGS]
    return "(?is)<(?:" + "|".join(branches) + ")"


# One pass over the page: the leftmost element goes first, with all it holds.
# The leading "<" stays outside the alternation so that other characters are
# skipped at once. An element that is never closed takes the rest of the page.
BOILERPLATE = _boilerplate()
# Tags of removed elements, for pages that nest an element in one of its name: scripts and
# styles whole, since they hold no tags, and single start and closing tags of the others.
RAW_TAGS = ("script", "style")
BOILERPLATE_TOKEN = (
    r"(?is)<(?:"
    + "|".join(rf"{t}(?:\s[^>]*+)?+(?:>|\z).*?(?:</{t}\s*+>|\z)" for t in RAW_TAGS)
    + rf"|/?+(?:{'|'.join(t for t in BOILERPLATE_TAGS if t not in RAW_TAGS)})(?:\s[^>]*+|/)?+(?:>|\z))"
)
# A start tag that another of its name follows before any closing tag of that name.
NESTED_BOILERPLATE = (
    rf"(?is)<({'|'.join(t for t in BOILERPLATE_TAGS if t not in (*RAW_TAGS, *VOID_TAGS))})(?:\s[^<>]*+)?+(?<!/)>"
    r"(?:[^<]++|<(?!/?\1[\s/>]))*+<\1[\s/>]"
)
# Walks a start tag: its name (group 1), then attribute by attribute from where the last
# match ended; kept attributes are group 2.
CLASS_OR_ID = (
    r"""(?is)(<[a-z][^\s<>]*+)|(?!\A)\G(?:\s++(?:class|id)\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'<>]++)"""
    r"""|(\s++[^\s<>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'<>]++))?+))"""
)
# The atomic group pins the first href, so the look-ahead sees its real value.
RELATIVE_ANCHOR = (
    r"""(?is)<a\s(?>(?:[^<>]*?\s)?href\s*=\s*)(?!["']?(?-i:https?://))[^<>]*+>.*?</a\s*>"""
)
# Elements of any name and depth around one string.
SINGLE_STRING_P = (
    r"(?is)<p(?:\s[^<>]*+)?+>(?:<(?!(?:p|{0})[\s/>])[a-z][^<>]*+>)*+([^<]++)(?:</(?!p\s*+>)[a-z][^<>]*+>)*+</p\s*+>"
).format("|".join(EMPTY_TAGS))
PARAGRAPH_TAG = r"(?is)</?p(?:\s[^>]*)?>"
TITLE = r"(?is)<title(?:\s[^<>]*+)?+>(.*?)</title\s*+>"
TITLE_END = r"</title\s*+>"
HEADINGS = tuple((rf"</h{n}\s*+>", rf"(?is)<h{n}(?:\s[^<>]*+)?+>(.*?)</h{n}\s*+>", f"\n\n{'#' * n} $1\n\n") for n in range(1, 7))
LIST_ITEM = r"(?is)<li(?:\s[^<>]*+)?+>(.*?)</li\s*+>"
LINE_BREAK = r"(?is)<br\s*+/?>"
BOLD = r"(?is)<(?:b|strong)(?:\s[^<>]*+)?+>([^<]*+)</(?:b|strong)\s*+>"
ITALIC = r"(?is)<(?:i|em)(?:\s[^<>]*+)?+>([^<]*+)</(?:i|em)\s*+>"
CODE = r"(?is)<code(?:\s[^<>]*+)?+>([^<]*+)</code\s*+>"
MD_ANCHOR = r"""(?is)<a\s(?>(?:[^<>]*?\s)?href\s*=\s*["']?)([^\s"'<>]*+)["']?[^<>]*+>(.*?)</a\s*+>"""
# Closing parts, for ``html.closed``.
LI_END, A_END, TAG_END = r"</li\s*+>", r"</a\s*+>", ">"
MD_END, MD_LINK_END = r"\)", r"\]\([^)]*+\)"

# --- Markdown cleaning ----------------------------------------------------
# Anchored at both ends: a text without an article is left as it is, and an
# empty article gives an empty text.
FIRST_ARTICLE = r"(?s)\A(?>.*?<article[^<>]*+>)(.*?)</article>.*\z"
# A bracket that no address follows is passed over (group 1), as are those within it.
MD_LINK_OR_BRACKET = rf"(\[[^\]]*+\](?!\([^)]+\)))|{MD_LINK}".replace(r"\[([^\]]+)\]", r"\[([^\]]++)\]")
BLANK_LINES = rf"\n{WS}*\n"
SPACES = r" {2,}"
SYMBOL_LINES = rf"(?md)^{NON_WORD}+$\n"

# --- Plain text -----------------------------------------------------------
SEGMENT = r"[^.!?\n]+[.!?]*"
