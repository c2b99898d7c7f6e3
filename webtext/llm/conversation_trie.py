"""Trie of conversation prefixes by range minima over sorted common-prefix lengths.

Conversations become sequences of turn digests, cut into segments and sorted. In a block
of sorted segments the lengths of the prefixes that neighbours share (LCPs) get a sparse
table of range minima. Every prefix that is new at its row is a candidate node: it searches
its left and its right end by halving steps over that table, each on its own, and the rows
between are its members. A block counts what lies inside it; parts of one node from several
blocks have equal keys and add up, so no node is gathered in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtext.llm.common import prefix_sums, word_count
from webtext.sources.shared import materialize

# Bytes of a turn's digest; segments of a conversation are this long at least, and at most
# LEVELS to the longest one; sorted rows in a block; ids joined into one string at once.
DIGEST = 16
SEGMENT = 256
LEVELS = 64
BLOCK = 16384
IDS_AT_ONCE = 8192
ROOT_KEY = hashlib.md5(b"").hexdigest()

PARTS = pa.schema([
    ("key", pa.string()), ("parent", pa.string()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_leaves", pa.int64()), ("saved", pa.int64()), ("top", pa.bool_()),
])
PARTS_SQL = "key string, parent string, depth long, conv_id long, n_convs long, n_leaves long, saved long, top boolean"


def digest_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, digest, words`` of each turn with an id: its place in the conversation
    from 0, a digest of role and text, and the words of the text.

    Turns are ordered by ``turn``, null first; ties by role, then by digest. A null role or
    text is empty. Rows without ``conv_id`` belong to no conversation and take no part.
    Repeated rows are turns of their own. A conversation of any length is numbered by range
    partitions, not in one task, and texts are not shuffled.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    both = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"),
        F.unhex(F.substring(both, 1, 2 * DIGEST)).alias("digest"), word_count(text).alias("words"), F.lit(1).cast("long").alias("one"),
    )
    return prefix_sums(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "digest"], pos="one").select("conv_id", "pos", "digest", "words")


def tables(values: np.ndarray, pick) -> list[np.ndarray]:
    """Sparse table: entry ``i`` of level ``k`` picks from ``values[i : i + 2**k]``."""
    levels = [values]
    while len(levels[-1]) > (half := 1 << (len(levels) - 1)):
        levels.append(pick(levels[-1][:-half], levels[-1][half:]))
    return levels


def right_ends(levels: list[np.ndarray], rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """Last row of the run after each row whose neighbours share ``depths`` turns."""
    at = rows.copy()
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        inside = at < len(level)
        step = np.zeros(len(at), bool)
        step[inside] = level[at[inside]] >= depths[inside]
        at += step.astype(np.int64) << k
    return at


def left_ends(levels: list[np.ndarray], rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """First row of the run before each row whose neighbours share ``depths`` turns."""
    at = rows.copy()
    for k in range(len(levels) - 1, -1, -1):
        back = at - (1 << k)
        inside = back >= 0
        step = np.zeros(len(at), bool)
        step[inside] = levels[k][back[inside]] >= depths[inside]
        at -= step.astype(np.int64) << k
    return at


def range_min(levels: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value between two rows, both included: two overlapping entries of one level."""
    k = np.frexp((last - first + 1).astype(float))[1] - 1
    out = np.empty(len(first), np.int64)
    for level in np.unique(k):
        at = k == level
        out[at] = np.minimum(levels[level][first[at]], levels[level][last[at] + 1 - (1 << int(level))])
    return out


def shared(a: tuple | None, b: tuple | None) -> int:
    """Turns that two rows ``(anchor, seq, …)`` share; -1 if they hang at different nodes."""
    if a is None or b is None or a[0] != b[0]:
        return -1
    x, y = a[1], b[1]
    most = min(len(x), len(y))
    if x[:most] == y[:most]:
        return most // DIGEST
    return int(np.flatnonzero(np.frombuffer(x, np.uint8, most) != np.frombuffer(y, np.uint8, most))[0]) // DIGEST


def block_nodes(rows: list[tuple], before: tuple | None, after: tuple | None, base: int, segment: int) -> pa.RecordBatch:
    """Parts of nodes that a block of sorted distinct rows gives.

    Rows are ``(anchor, seq, words, convs, least, below_leaves, below_saved, next_anchor)``;
    ``base`` is the depth at which they hang, ``before`` and ``after`` the rows next to the
    block. ``saved`` sums, below a node, its words times members here, less its words once:
    where the block's first row or an earlier block shares the prefix, that one counts them.
    """
    m = len(rows)
    lengths = np.array([len(r[1]) // DIGEST for r in rows], np.int64)
    lcp = np.array([shared(a, b) for a, b in zip(rows, rows[1:])], np.int64)
    levels = tables(lcp, np.minimum) if m > 1 else []
    known = shared(before, rows[0])
    following = np.append(lcp, shared(rows[-1], after))
    convs = np.array([r[3] for r in rows], np.int64)
    below_leaves = np.array([r[5] or 0 for r in rows], np.int64)
    below_saved = np.array([r[6] or 0 for r in rows], np.int64)
    leaf = np.where(below_leaves > 0, below_leaves, ((following < lengths) & (lengths > 0)).astype(np.int64))
    # Candidates: the prefixes longer than what a row shares with the row before it.
    first_depth = np.append(-1, lcp) + 1
    many = lengths - first_depth + 1
    row = np.repeat(np.arange(m), many)
    starts = np.concatenate([[0], np.cumsum(many)])
    depth = np.arange(len(row)) - starts[row] + first_depth[row]
    left, right = left_ends(levels, row, depth), right_ends(levels, row, depth)
    sums = [np.concatenate([[0], np.cumsum(v)]) for v in (convs, leaf, below_saved)]
    n_convs, n_leaves, saved_below = (s[right + 1] - s[left] for s in sums)
    least = range_min(tables(np.array([r[4] for r in rows], np.int64), np.minimum), left, right)
    words = np.array([rows[i][2][d - 1] if d else 0 for i, d in zip(row.tolist(), depth.tolist())], np.int64)
    owned = (row > 0) | (depth > known)
    own = np.concatenate([[0], np.cumsum(words * n_convs - words * owned)])
    saved = saved_below + own[starts[right + 1]] - own[starts[left] + depth - first_depth[left]]
    heads = [r[0].encode() for r in rows]
    keys, parents = [], []
    for i, d in zip(row.tolist(), depth.tolist()):
        seq = rows[i][1]
        keys.append(hashlib.md5(rows[i][7].encode() if d == segment else heads[i] + seq[: DIGEST * d]).hexdigest())
        parents.append(hashlib.md5(heads[i] + seq[: DIGEST * (d - 1)]).hexdigest() if d else None)
    columns = [keys, parents, depth + base, least, n_convs, n_leaves, saved, depth == 0]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PARTS)], schema=PARTS)


def level_nodes(rows: DataFrame, level: int, segment: int) -> DataFrame:
    """Nodes of one level of segments: ``key, parent, depth, conv_id, n_convs, n_leaves,
    saved, top``. ``rows`` holds distinct segments with ``anchor, seq, …`` as in ``block_nodes``."""
    order = ["anchor", "seq"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("_part", F.shiftright(F.monotonically_increasing_id(), 33)), "segments")
    edge = F.struct(*order)
    ends = placed.groupBy("_part").agg(F.min(edge).alias("a"), F.max(edge).alias("z")).orderBy("_part").collect()
    # One row a partition: the rows next to each partition.
    before = {x["_part"]: (p["z"]["anchor"], bytes(p["z"]["seq"])) for p, x in zip(ends, ends[1:])}
    after = {p["_part"]: (x["a"]["anchor"], bytes(x["a"]["seq"])) for p, x in zip(ends, ends[1:])}
    names = [*order, "words", "convs", "least", "below_leaves", "below_saved", "next_anchor"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        part = None
        last = None
        for batch in parts:
            given = list(zip(*[batch.column(c).to_pylist() for c in names]))
            for number, r in zip(batch.column("_part").to_pylist(), given):
                if held and (number != part or len(held) >= BLOCK):
                    yield block_nodes(held, last, r if number == part else after.get(part), level * segment, segment)
                    last, held = held[-1], []
                if number != part:
                    part, last = number, before.get(number)
                held.append(r)
        if held:
            yield block_nodes(held, last, after.get(part), level * segment, segment)

    sorted_again = placed.repartition("_part").sortWithinPartitions("_part", *order).select("_part", *names)
    made = sorted_again.mapInArrow(run, PARTS_SQL)
    totals = [F.sum(c).alias(c) for c in ("n_convs", "n_leaves", "saved")]
    one = [F.first(c).alias(c) for c in ("parent", "depth", "top")]
    return made.groupBy("key").agg(*one, F.min("conv_id").alias("conv_id"), *totals)


def end_hashes(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of ``key, conv_id``: sha256 of each key's ids, ascending and joined
    by commas. Ids are sorted and joined by range partitions; what one task reads of a key
    is its strings of ``IDS_AT_ONCE`` ids, one at a time."""

    def join(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for batch in parts:
            out = []
            for k, i in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (k != key or len(ids) == IDS_AT_ONCE):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(i)
            yield strings(out)
        if ids:
            yield strings([(key, ids[0], ",".join(map(str, ids)))])

    def strings(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["key", "first", "ids"])

    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in parts:
            out = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k == key:
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(ids.encode())
            yield hashes(out)
        if key is not None:
            yield hashes([(key, state.hexdigest())])

    def hashes(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(2)], ["key", "ends_sha256"])

    ranged = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = ranged.mapInArrow(join, "key string, first long, ids string")
    return joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digest, "key string, ends_sha256 string")


def segments_of(turns: DataFrame, ids: DataFrame, segment: int) -> DataFrame:
    """``conv_id, level, anchor, next_anchor, seq, words, final`` of each segment; a
    conversation without turns has one empty segment.

    An anchor names all turns before a segment by sums of hashes of (place, digest) in four
    32-bit parts, so that a long conversation is no single row.
    """
    at = F.struct("pos", "digest")
    halves = [F.xxhash64(F.lit(seed), at) for seed in (1, 2)]
    quarters = [q for h in halves for q in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    item = F.struct("pos", "digest", "words")
    rows = turns.withColumn("level", F.expr(f"pos div {segment}")).groupBy("conv_id", "level").agg(
        F.array_sort(F.collect_list(item)).alias("items"), *[F.sum(q).alias(f"q{i}") for i, q in enumerate(quarters)]
    )
    upto = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("conv_id").orderBy("level")
    zero = F.lit(0).cast("long")
    rows = rows.select("*", *[F.sum(f"q{i}").over(upto).alias(f"s{i}") for i in range(4)], F.lead("level").over(later).isNull().alias("final"))

    def name(level: Column, sums: list[Column]) -> Column:
        return F.when(level == 0, F.lit("")).otherwise(F.concat_ws(":", level.cast("string"), *[s.cast("string") for s in sums]))

    rows = rows.select(
        "conv_id", "level",
        name(F.col("level"), [F.col(f"s{i}") - F.col(f"q{i}") for i in range(4)]).alias("anchor"),
        name(F.col("level") + 1, [F.col(f"s{i}") for i in range(4)]).alias("next_anchor"),
        F.unhex(F.array_join(F.transform("items.digest", F.hex), "")).alias("seq"),
        F.col("items.words").alias("words"), "final",
    )
    empty = ids.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", zero.alias("level"), F.lit("").alias("anchor"), F.lit("").alias("next_anchor"),
        F.unhex(F.lit("")).alias("seq"), F.array().cast("array<long>").alias("words"), F.lit(True).alias("final"),
    )
    return rows.unionByName(empty)


def prefix_trie(turns: DataFrame, ids: DataFrame | None = None, segment: int | None = None) -> DataFrame:
    """One row per distinct prefix of turns: ``key, parent, conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns`` is ``conv_id, pos, digest, words``, places gapless from 0; ``ids`` names all
    conversations, also those without turns (by default those of ``turns``). The root has
    depth 0, no parent and the key of no turns; without any conversation there is no root.
    Equal conversations are one sorted row with their number; groups of copies are counted
    on the map side. Rows grow to a ``LEVELS``-th of the longest conversation at most.
    """
    ids = turns.select("conv_id").distinct() if ids is None else ids.select("conv_id").where("conv_id is not null").distinct()
    if segment is None:
        longest = turns.agg(F.max("pos")).first()[0] or 0
        segment = max(SEGMENT, ceil((longest + 1) / LEVELS))
    rows = materialize(segments_of(turns, ids, segment), "conversations")
    full = F.octet_length("seq") == segment * DIGEST
    ends = rows.where("final").select(F.when(full, F.md5("next_anchor")).otherwise(F.md5(F.concat(F.col("anchor").cast("binary"), "seq"))).alias("key"), "conv_id")
    distinct = rows.groupBy("level", "anchor", "seq").agg(
        F.first("words").alias("words"), F.first("next_anchor").alias("next_anchor"), F.count("*").alias("convs"), F.min("conv_id").alias("least")
    )
    distinct = materialize(distinct, "distinct-segments")
    top = distinct.agg(F.max("level")).first()[0]
    nothing = F.lit(None).cast("long")
    below, found = None, []
    for level in range(-1 if top is None else int(top), -1, -1):
        here = distinct.where(F.col("level") == level)
        if below is None:
            here = here.withColumn("below_leaves", nothing).withColumn("below_saved", nothing)
        else:
            tops = below.where("top").select(F.col("key").alias("next_key"), F.col("n_leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))
            next_key = F.when(full, F.md5("next_anchor"))
            here = here.withColumn("next_key", next_key).join(tops, "next_key", "left")
        below = materialize(level_nodes(here, level, segment), "nodes")
        # The top of a deeper level is the last node of a segment above it.
        found.append(below.where(~F.col("top") | (F.col("depth") == 0)).drop("top"))
    if not found:
        return empty_trie(turns)
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(above, "parent", "left").join(children, "key", "left").join(end_hashes(ends), "key", "left")
    return whole.select(
        "key", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        # A root without any turn below is childless itself.
        F.when(F.col("n_children").isNull(), F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def empty_trie(turns: DataFrame) -> DataFrame:
    schema = "key string, parent string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    return turns.sparkSession.createDataFrame([], schema)


def grafted(turns: DataFrame, ids: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Turns of conversations rebuilt on common openings: conversation c takes the first h
    turns of conversation ``c - c % every``, then its own after its first h, where h is the
    crc32 of decimal c modulo ``most``. At most ``most - 1`` turns of a conversation and
    ``every`` ids meet in the join."""
    key = F.col("conv_id")
    heads = ids.select("conv_id", (key - key % every).alias("base"), (F.crc32(key.cast("string").cast("binary")) % most).alias("h"))
    opening = F.array_sort(F.collect_list(F.struct("pos", "digest", "words")))
    bases = turns.where((key % every == 0) & (F.col("pos") < most - 1)).groupBy(key.alias("base")).agg(opening.alias("opening"))
    heads = materialize(
        heads.join(bases, "base", "left").select("conv_id", "h", F.slice(F.coalesce("opening", F.array()), F.lit(1), F.col("h").cast("int")).alias("opening")), "openings"
    )
    taken = heads.select("conv_id", F.inline("opening"))
    own = turns.join(heads.select("conv_id", "h", F.size("opening").alias("taken")), "conv_id").where("pos >= h")
    return taken.unionByName(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words"))
