"""Fill-in-the-middle transformation of documents.

A text is cut after two counts of units into prefix, middle and suffix, and written in
another order between markers. A Fenwick tree over fixed blocks of the text's UTF-8 bytes
stores how many units and how many code points begin in each block; a descent by powers of
two finds the block of a cut, and only that block is searched for the place itself. Tasks
in Python give places only: texts are cut and joined, and rebuilt, by Spark expressions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Bytes in a block of the tree.
BLOCK = 1024
PLAN = "n bigint, first_byte bigint, second_byte bigint, prefix_chars bigint, middle_chars bigint"


class Fenwick:
    """Sums over the first blocks, and the block in which a sum is passed."""

    def __init__(self, counts: np.ndarray):
        size = len(counts)
        self.counts = counts
        before = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(1, size + 1)
        # Node i holds the blocks after i without its lowest bit, up to i.
        self.tree = np.concatenate([[0], before[at] - before[at - (at & -at)]])
        self.top = 1 << (size.bit_length() - 1) if size else 0

    def before(self, block: int) -> int:
        """Sum over the blocks before ``block``."""
        total = 0
        while block:
            total += int(self.tree[block])
            block &= block - 1
        return total

    def descend(self, rank: int) -> tuple[int, int]:
        """Block that holds the item of ``rank`` (from 0), and the rank inside it."""
        at, step = 0, self.top
        while step:
            if at + step < len(self.tree) and self.tree[at + step] <= rank:
                at += step
                rank -= int(self.tree[at])
            step >>= 1
        return at, rank


class Marks:
    """Where units and code points of one text begin, with a tree for each."""

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        self.points = (data & 0xC0) != 0x80
        lower = data | 0x20
        letters = (lower >= ord("a")) & (lower <= ord("z"))
        self.units = self.points.copy()
        self.units[1:] &= ~(letters[1:] & letters[:-1])
        if self.size:
            starts = np.arange(0, self.size, BLOCK)
            self.unit_tree = Fenwick(np.add.reduceat(self.units, starts, dtype=np.int64))
            self.point_tree = Fenwick(np.add.reduceat(self.points, starts, dtype=np.int64))
            self.n = self.unit_tree.before(len(starts))
            self.n_points = self.point_tree.before(len(starts))
        else:
            self.n = self.n_points = 0

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` units."""
        if units >= self.n:
            return self.size, self.n_points
        block, rank = self.unit_tree.descend(units)
        start = block * BLOCK
        place = int(np.flatnonzero(self.units[start : start + BLOCK])[rank])
        return start + place, self.point_tree.before(block) + int(np.count_nonzero(self.points[start : start + place]))


def places(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    """Units of each text and the two cuts that the hashes choose, in bytes and code points."""
    rows = []
    for i in range(len(text)):
        raw = text[i].as_buffer() if text[i].is_valid else None
        marks = Marks(np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8))
        units = sorted(h[i].as_py() % (marks.n + 1) for h in (h1, h2))
        (first, head), (second, both) = (marks.cut(u) for u in units)
        rows.append((marks.n, first, second, head, both - head))
    names = [f.split()[0] for f in PLAN.split(", ")]
    columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))]
    return pa.StructArray.from_arrays(columns, names)


def hash_of(key: Column, group: int) -> Column:
    """The ``group``-th 8-digit group (from 0) of the sha256 of ``1:`` and the key, as a number."""
    digits = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digits, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", plain: int = 10, spm: int = 20) -> DataFrame:
    """``key, text, n, form, prefix_chars, middle_chars, output`` of each row of ``docs``.

    ``n`` counts units: runs of ASCII letters, and every other code point. Of all texts
    ``plain`` in 100 stay as they are, as do empty texts and those that contain a marker;
    of the others ``spm`` in 100 begin with their suffix. Choices and cuts follow from the
    key alone, so rows of one key have the same hashes and equal texts of one key the same
    output; a null key counts as an empty one. A null text is empty. Texts are whole, valid
    UTF-8 and of any length that Spark holds; other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("*", *[hash_of(F.col("key"), g).alias(f"h{g + 1}") for g in range(4)])
    find = F.arrow_udf(places, PLAN)
    rows = rows.withColumn("at", find("text", "h1", "h2"))
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains("text", F.lit(marker))
    stays = (F.col("text") == "") | marked | (F.col("h3") % 100 >= 100 - plain)
    form = F.when(stays, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm")
    data, first, second = F.col("text").cast("binary"), F.col("at.first_byte").cast("int"), F.col("at.second_byte").cast("int")

    def part(start: Column, end: Column) -> Column:
        return F.substring(data, start + 1, end - start).cast("string")

    head, middle, tail = part(F.lit(0), first), part(first, second), part(second, F.octet_length("text"))
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), head, F.lit(SUFFIX), tail, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), tail, F.lit(PREFIX), head, F.lit(MIDDLE), middle))
    )
    chars = [F.when(F.col("form") != "plain", F.col(f"at.{c}")).alias(c) for c in ("prefix_chars", "middle_chars")]
    made = rows.withColumn("form", form).select(F.col("key").alias(key), F.col("text").alias(text), F.col("at.n").alias("n"), "form", *chars, output.alias("output"))
    return made


def restored(output: str | Column, form: str | Column) -> Column:
    """The text that ``fill_in_middle`` was given (empty for null), from its output and form."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    joined = {f: F.concat(*[F.get(parts, F.lit(i)) for i in at]) for f, at in order.items()}
    return F.when(form == "psm", joined["psm"]).when(form == "spm", joined["spm"]).otherwise(output)
