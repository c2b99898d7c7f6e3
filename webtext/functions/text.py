"""Words, chunks, segments and summaries as row-local array expressions.

Each function works inside one row, so a document is never shuffled to be
split, translated or summarised.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from webtext.functions import patterns as P

# Sizes in words.
CHUNK_WORDS = 500
MAX_INPUT_WORDS = 1024
MAX_SUMMARY_WORDS = 800
MIN_SUMMARY_WORDS = 150
MIN_DOCUMENT_WORDS = 100

MAX_GLOSSARY = 200


def words(text: Column) -> Column:
    """Whitespace-separated words, without empty ones."""
    spaced = F.translate(text, P.WS_CHARS, " " * len(P.WS_CHARS))
    return F.array_remove(F.split(spaced, " "), "")


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.size(words(text)), F.lit(0))


def blank_to_null(text: Column) -> Column:
    """NULL for a text of whitespace only, else the text unchanged."""
    return F.when(text.rlike(f"[^{P.WS[1:-1]}]"), text)


def has_min_words(text: Column, minimum: int = MIN_DOCUMENT_WORDS) -> Column:
    return word_count(text) >= minimum


def truncate_words(text: Column, limit: int = MAX_INPUT_WORDS) -> Column:
    """First ``limit`` whitespace words, single-spaced.

    Whitespace words stand in for model tokens.
    """
    return F.array_join(F.slice(words(text), 1, limit), " ")


def chunks(text: Column, size: int = CHUNK_WORDS) -> Column:
    """Array of single-spaced chunks of at most ``size`` words; empty for a
    text without words.

    One scan of the single-spaced text; slicing an array of words would copy
    it for every chunk.
    """
    single_spaced = F.array_join(words(text), " ")
    return F.regexp_extract_all(single_spaced, F.lit(rf"[^ ]++(?: [^ ]++){{0,{size - 1}}}"), F.lit(0))


def translate(text: Column, glossary: Mapping[str, str], size: int = CHUNK_WORDS) -> Column:
    """Word-for-word glossary translation, one line per chunk; NULL for blank
    text. Words outside the glossary pass through.

    The glossary becomes a literal that is searched for every word, so its size
    is checked; ``operators.glossary`` takes a larger one as a table.
    """
    if not 0 < len(glossary) <= MAX_GLOSSARY:
        raise ValueError(f"glossary must hold 1 to {MAX_GLOSSARY} entries, got {len(glossary)}")
    table = F.create_map(*[F.lit(x) for pair in glossary.items() for x in pair])

    def line(chunk: Column) -> Column:
        out = F.transform(F.split(chunk, " "), lambda w: F.coalesce(F.try_element_at(table, w), w))
        return F.array_join(out, " ")

    return F.nullif(F.array_join(F.transform(chunks(text, size), line), "\n"), F.lit(""))


def segments(text: Column) -> Column:
    """Speech segments: sentences, or lines without end punctuation."""
    return F.regexp_extract_all(text, F.lit(P.SEGMENT), F.lit(0))


def segment_name(index: Column) -> Column:
    """``0000.wav``, ``0001.wav`` and on; wider than four digits when needed."""
    return F.format_string("%04d.wav", index)


def output_name(stem: Column, suffix: str) -> Column:
    return F.concat(stem.cast("string"), F.lit(suffix))
