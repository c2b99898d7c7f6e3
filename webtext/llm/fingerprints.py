"""Document fingerprints by one-permutation MinHash. Native operations only.

Every five-word shingle is hashed once; the top bits of the hash choose a bin and each
bin keeps its least hash. An empty bin takes the value of another: it looks at bins
drawn from its own index until one was filled (optimal densification), and hashes what
it found with its index. Of each bin's value the four lowest bits are stored, as one hexadecimal digit. Two fingerprints agree
by chance in one bin of 16, which the likeness corrects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtext.llm.common import WORD, let
from webtext.sources.shared import materialize

BINS = 256
WIDTH = 5
BITS = 4
# Bins that an empty bin draws before the filled ones are ranked for it.
DRAWS = 6


def shingle_hashes(text: str | Column, width: int = WIDTH) -> Column:
    """Hash of each shingle; fewer words than ``width`` are one shingle, none give none."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def join(h: Column) -> Column:
        whole = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, width)]))
        return F.slice(whole, 1, F.greatest(F.size(h) - (width - 1), F.lit(1)))

    return let(hashes, lambda h: F.when(F.size(h) > 0, join(h)).otherwise(F.array().cast("array<bigint>")))


def signature(text: str | Column, bins: int = BINS, width: int = WIDTH) -> Column:
    """Low bits of each bin's least hash, as ``array<tinyint>``; empty array without words.

    Bins are numbered by the top bits of the hash, so in a sorted array of hashes each
    bin is a run that begins with its least.
    """
    shift = 64 - (bins - 1).bit_length()
    if bins != 1 << (64 - shift):
        raise ValueError("bins must be a power of two")

    # Signed order starts at the middle bin; bins are renumbered in that order.
    def bin_of(x: Column) -> Column:
        return F.shiftright(x, shift) + bins // 2

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1))))

    def dense(f: Column) -> Column:
        none = F.lit(None).cast("bigint")
        gaps = F.transform(
            f,
            lambda x, i: F.concat(
                F.array(x),
                F.array_repeat(none, (F.coalesce(bin_of(F.get(f, i + 1)), F.lit(bins)) - bin_of(x) - 1).cast("int")),
            ),
        )
        return F.concat(F.array_repeat(none, bin_of(f[0]).cast("int")), F.flatten(gaps))

    def ranked(f: Column, b: Column) -> Column:
        return F.array_min(F.transform(f, lambda x: F.struct(F.xxhash64(b, bin_of(x)).alias("o"), x.alias("x"))))["x"]

    def filled(f: Column) -> Column:
        def value(x: Column, i: Column, all_bins: Column) -> Column:
            b = i.cast("long")
            drawn = [F.get(all_bins, F.pmod(F.xxhash64(b, F.lit(d)), F.lit(bins)).cast("int")) for d in range(DRAWS)]
            # A borrowed value is hashed with the bin, or a lone shingle would fill all bins alike.
            chosen = F.coalesce(x, F.xxhash64(b, F.coalesce(*drawn, ranked(f, b))))
            return chosen.bitwiseAND(F.lit((1 << BITS) - 1)).cast("tinyint")

        return let(dense(f), lambda a: F.transform(a, lambda x, i: value(x, i, a)))

    sorted_hashes = F.sort_array(shingle_hashes(text, width))
    return let(
        let(sorted_hashes, firsts),
        lambda f: F.when(F.size(f) > 0, filled(f)).otherwise(F.array().cast("array<tinyint>")),
    )


def packed(signature: str | Column) -> Column:
    """Fingerprint as a string of hexadecimal digits, one a bin; empty without words."""
    col = F.col(signature) if isinstance(signature, str) else signature
    digits = F.array(*[F.lit(d) for d in "0123456789abcdef"])
    return let(digits, lambda d: F.array_join(F.transform(col, lambda x: F.get(d, x.cast("int"))), ""))


def likeness(a: str | Column, b: str | Column) -> Column:
    """Estimated share of common shingles (0 to 1) of two signatures, corrected for bins
    that agree by chance. Two texts without words are alike, one against words is not."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
    chance = 1 / (1 << BITS)
    part = (same / F.size(a) - chance) / (1 - chance)
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(F.greatest(part, F.lit(0.0)))
    )


def neighbours(docs: DataFrame) -> DataFrame:
    """Distinct documents ``doc_id, _h, n_chars`` with the key of the one before and after
    them in descending ``doc_id`` (nulls last, then hash of the text), in a ring.

    Only keys are sorted: they are range-partitioned and written, and the first and last
    key of each part (one row a part) link the parts.
    """
    key = ["doc_id", "_h"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("_h"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("_h")]
    keys = materialize(
        rows.groupBy(*key).agg(F.first("n_chars").alias("n_chars"))
        .repartitionByRange(*order)
        .withColumn("_part", F.spark_partition_id()),
        "keys",
    )
    one = F.struct(*key, "n_chars")
    inside = Window.partitionBy("_part").orderBy(*order)
    ends = keys.groupBy("_part").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.bitwise_not(F.coalesce("doc_id", F.lit(0))), "_h", one.alias("k")))["k"].alias("_first"),
        F.max(F.struct(F.col("doc_id").isNull(), F.bitwise_not(F.coalesce("doc_id", F.lit(0))), "_h", one.alias("k")))["k"].alias("_last"),
    )
    parts = Window.orderBy("_part")
    whole = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "_part",
        F.coalesce(F.lead("_first").over(parts), F.first("_first").over(whole)).alias("_after"),
        F.coalesce(F.lag("_last").over(parts), F.last("_last").over(whole)).alias("_before"),
    )
    linked = keys.withColumn("_prev", F.lag(one).over(inside))
    return linked.join(ends, "_part").select(
        *key, "n_chars", F.coalesce("_prev", "_before").alias("_prev")
    )


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last third (rounded down) replaced by as many first characters
    of ``following``, or all of it."""
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(following, F.lit(1), third))


def with_next(docs: DataFrame, bins: int = BINS, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The next document is the next distinct pair of id and text in descending id (null
    ids last, equal ids by a hash of the text), the first after the last; a single
    document is its own next. Null text counts as empty. Rows equal in id and text have
    the same next. Texts are shuffled once, by id, with their signature; a third of a
    text at most travels to the document before it.
    """
    text = F.coalesce("text", F.lit("")).alias("_text")
    base = docs.select("doc_id", F.xxhash64("text").alias("_h"), text)
    base = base.withColumn("_sig", signature("_text", bins, width))
    ring = neighbours(docs).select("doc_id", "_h", F.col("_prev.doc_id").alias("_to"), F.col("_prev._h").alias("_to_h"), F.floor(F.col("_prev.n_chars") / 3).cast("int").alias("_need"))

    def same(a: str, b: str, *names: tuple[str, str]) -> Column:
        (i, j), (h, k) = names
        return F.col(f"{a}.{i}").eqNullSafe(F.col(f"{b}.{j}")) & (F.col(f"{a}.{h}") == F.col(f"{b}.{k}"))

    sent = (
        base.alias("a").join(ring.alias("r"), same("a", "r", ("doc_id", "doc_id"), ("_h", "_h")))
        .select("r._to", "r._to_h", F.substring(F.col("a._text"), F.lit(1), F.col("r._need")).alias("_head"), F.col("a._sig").alias("_next_sig"))
        .groupBy("_to", "_to_h").agg(F.first("_head").alias("_head"), F.first("_next_sig").alias("_next_sig"))
    )
    both = base.alias("a").join(sent.alias("s"), same("a", "s", ("doc_id", "_to"), ("_h", "_to_h")))
    both = both.select("a.doc_id", "a._text", "a._sig", "s._next_sig", edited(F.col("a._text"), F.col("s._head")).alias("_edited"))
    both = both.withColumn("_edited_sig", signature("_edited", bins, width))
    return both.select(
        "doc_id",
        F.length("_text").cast("long").alias("n_chars"),
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        packed("_sig").alias("fingerprint"),
        packed("_edited_sig").alias("edited_fingerprint"),
        likeness("_sig", "_edited_sig").alias("near_edited"),
        likeness("_sig", "_next_sig").alias("near_next"),
    )
