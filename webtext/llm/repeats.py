"""Removal of repeated passages by hashing lines and the sentences within them.

A unit is a sentence, or the part of one on its line. The key of a unit of at least
``MIN_WORDS`` words is the unit. A shorter one is keyed together with its neighbours:
those after it, then those before it, on its line; if the line is too short, likewise
in its paragraph, then in the text. So keys of a line or paragraph that is long enough
depend on nothing outside it, and it goes as a whole wherever it is repeated. Words are
normalised (lower case, punctuation at their edges dropped); in scripts without spaces
two characters count as a word. Digests of keys are grouped over all documents, the
earliest occurrence stays and the others go. Keys below ``MIN_WORDS`` words (texts
shorter than that) are never removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.sources.shared import materialize

MIN_WORDS = 8
# A digest with more than this share of all units is joined without a shuffle.
HOT_SHARE = 1 / 1000
# Ends a sentence or a line, with the white space after it.
BREAK = regex.compile(r"(?<=[.!?])\s++|(?<=[。！？｡])\s*+|(?<!\s)[^\S\n]*+\n\s*+")
EDGES = regex.compile(r"^[^\w]+|[^\w]+$")
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"
# Characters of scripts written without spaces, with their marks.
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}ー\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}\p{Tai_Le}\p{New_Tai_Lue}\p{Tai_Tham}\p{Tai_Viet}\p{Javanese}\p{Balinese}]\p{M}*+"
HAS_UNSPACED = regex.compile(UNSPACED)
PAIRS = regex.compile(rf"(?:{UNSPACED}){{1,2}}+|(?:(?!{UNSPACED}).)++", regex.DOTALL)


def normal_words(text: str) -> list[str]:
    words = text.lower().split()
    if not text.isascii() and HAS_UNSPACED.search(text):
        words = [x for w in words for x in PAIRS.findall(w)]
    # Most words need no expression: they are letters but for marks at the edges.
    words = [w if w.isalpha() else w.strip(MARKS) for w in words]
    return [w for w in (x if x.isalpha() else EDGES.sub("", x) for x in words) if w]


def units(text: str | None) -> list[tuple[int, int, list[str], list[str]]]:
    """``(start, end, words, key)`` of each unit: offsets in code points, the white space
    after the unit included; units cover the text without gaps."""
    text, at = text or "", 0
    # Line and paragraph of each piece, by number.
    pieces: list[tuple[int, int, list[str]]] = []
    scopes: list[tuple[int, int, int]] = []
    line = paragraph = 0
    for end, gap in [*((m.end(), m.group()) for m in BREAK.finditer(text)), (len(text), "")]:
        if end > at:
            pieces.append((at, end, normal_words(text[at:end])))
            scopes.append((line, paragraph, 0))
        line += "\n" in gap
        paragraph += gap.count("\n") > 1
        at = end
    # Pieces without words are no neighbours, so each step adds a word at least.
    worded = [i for i, piece in enumerate(pieces) if piece[2]]
    keys = {i: key_of(n, worded, pieces, scopes) for n, i in enumerate(worded)}
    return [(start, end, words, keys.get(i, [])) for i, (start, end, words) in enumerate(pieces)]


def key_of(n: int, worded: list[int], pieces: list[tuple[int, int, list[str]]], scopes: list[tuple[int, int, int]]) -> list[str]:
    """Words of the ``n``-th piece that has any, with neighbours up to ``MIN_WORDS``. Beside
    neighbours its first word is marked: two pieces may be keyed by the same words."""
    key = pieces[worded[n]][2]
    if len(key) >= MIN_WORDS:
        return key
    for level in range(3):
        own = scopes[worded[n]][level]
        key = ["\0" + pieces[worded[n]][2][0], *pieces[worded[n]][2][1:]]
        for step in (1, -1):
            at = n + step
            while len(key) < MIN_WORDS and 0 <= at < len(worded) and scopes[worded[at]][level] == own:
                words = pieces[worded[at]][2]
                key = key + words if step > 0 else words + key
                at += step
        if len(key) >= MIN_WORDS:
            break
    return key


def unit_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, th, start, end, n_words, digest, again`` of every unit long enough;
    ``again`` marks units that came earlier in the same text."""
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("n_words", pa.int32()), ("digest", pa.binary()), ("again", pa.bool_())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for doc_id, th, text in zip(*[c.to_pylist() for c in part.columns]):
                seen = set()
                for start, end, words, key in units(text):
                    if words and len(key) >= MIN_WORDS:
                        digest = hashlib.blake2b(" ".join(key).encode("utf-8", "surrogatepass"), digest_size=16).digest()
                        rows.append((doc_id, th, start, end, len(words), digest, digest in seen))
                        seen.add(digest)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    given = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    return given.mapInArrow(run, "doc_id long, th long, start int, end int, n_words int, digest binary, again boolean")


def repeated(docs: DataFrame) -> DataFrame:
    """``doc_id, th, start, end, n_words, kept_doc_id`` of each unit to remove.

    The earliest occurrence is that of the least id (null ids last, then the hash of the
    text), and in it the first. Rows equal in id and text count as one document: they
    keep and lose the same units. Null, empty and short texts have no units. Digests are
    combined before the shuffle, so a line found everywhere is no single group; the digests
    of more than ``HOT_SHARE`` of all units, at most its inverse, are broadcast to them.
    """
    rows = materialize(unit_rows(docs), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("kept_doc_id"), F.col("th").alias("kept_th"))
    many = rows.groupBy("digest").agg(F.min(rank).alias("kept"), F.count("*").alias("times")).where("times > 1")
    many = materialize(many, "repeated")
    hot = F.col("times") > max(1000, int(rows.count() * HOT_SHARE))
    common = F.broadcast(many.where(hot))
    hits = rows.join(common, "digest").unionByName(rows.join(common, "digest", "left_anti").join(many.where(~hot), "digest"))
    own = F.col("doc_id").eqNullSafe(F.col("kept.kept_doc_id")) & (F.col("th") == F.col("kept.kept_th"))
    return hits.where(~own | F.col("again")).select("doc_id", "th", "start", "end", "n_words", F.col("kept.kept_doc_id").alias("kept_doc_id"))


def without(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for t, cuts in zip(text.to_pylist(), spans.to_pylist()):
        if t is not None and cuts:
            at, kept = 0, []
            for cut in sorted(cuts, key=lambda c: c["start"]):
                kept.append(t[at : cut["start"]])
                at = max(at, cut["end"])
            t = "".join([*kept, t[at:]])
        out.append(t)
    return pa.array(out, pa.string())


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated units cut from ``text``, ``n_chars`` (where there is such a
    column) counted anew for changed texts, and ``removed``: the cuts as structs of
    ``start, end, kept_doc_id``, offsets in code points of the original text; null where
    nothing was cut. All rows stay, also those whose text is then empty."""
    cuts = repeated(docs).groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "kept_doc_id"))).alias("removed")
    )
    keyed = docs.drop("removed").withColumn("_th", F.xxhash64("text")).alias("d")
    on = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d._th") == F.col("c.th"))
    both = keyed.join(cuts.alias("c"), on, "left").select("d.*", "c.removed").drop("_th")
    both = both.withColumn("text", F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.arrow_udf(without, "string")("text", "removed")))
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.when(F.col("removed").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return both
