"""N-gram Jaccard join by a token-group matrix.

1. Equal shingle sets are one class, so copies cost nothing further.
2. Similar classes are brought side by side: sorted by the least class with which they
   share a minhash band, and cut into groups of at most ``GROUP`` classes.
3. Each group stores the union of its tokens and which member has which token.
4. The classes of a group query the groups with which theirs shares a band. If fewer
   of a class's tokens than the threshold asks for are in the union, the group stays shut;
   otherwise its members are compared exactly.

Bands only route queries to groups. A band holds 1 / (1 - t) minhashes, and there are so
many bands that two sets of similarity ``t`` share none with a chance of 1e-9 (less for
more similar ones). Every link reported is exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.llm.common import words_of
from webtext.llm.components import components
from webtext.operators.ordering import number_rows
from webtext.sources.shared import materialize

# Classes in a group, and queries that meet a group in one task.
GROUP = 64
QUERIES_AT_ONCE = 512
# A band of this many groups, at least one in so many from its first group to its last, is a run.
RUN, SPARSE = 8, 2
MISS = 1e-9
SEED = 20


class WordHashes(dict):
    """64-bit hash of each word; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


HASHES = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than ``width`` are one
    shingle, no words none."""
    words = words_of(text)
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, n)
    size = min(n, width)
    acc = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        acc = mixed(acc + np.uint64(0x9E3779B97F4A7C15)) ^ h[k : n - size + 1 + k]
    return np.unique(mixed(acc))


def banding(threshold: float) -> tuple[int, int]:
    """Minhashes per band and number of bands."""
    rows = max(1, round(1 / (1 - threshold))) if threshold < 1 else 1
    return rows, math.ceil(math.log(MISS) / math.log(1 - min(threshold, 0.999) ** rows))


@lru_cache(maxsize=4)
def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(SEED))
    a = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a, rng.integers(0, 1 << 32, n, dtype=np.uint32)


def bands_of(tokens: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit value per band, from the least values of its hash functions."""
    a, b = multipliers(rows * bands)
    high = (tokens >> np.uint64(32)).astype(np.uint32)
    least = np.full(rows * bands, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(high), 512):
        np.minimum(least, (high[i : i + 512, None] * a + b).min(axis=0), out=least)
    value = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for row in least.reshape(bands, rows).T.astype(np.uint64):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + row)
    return value.view(np.int64)


def identity(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def sketch(docs: DataFrame, width: int, threshold: float) -> DataFrame:
    """``doc_id, th, n, sid, bands`` of each row; ``sid`` and ``bands`` null without words."""
    rows, bands = banding(threshold)
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("n", pa.int64()), ("sid", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for text in part.column(2):
                tokens = shingle_set(text.as_py(), width)
                n = len(tokens)
                out.append((n, identity(tokens), bands_of(tokens, rows, bands)) if n else (0, None, None))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *[pa.array([x[k] for x in out], schema.field(k + 2).type) for k in range(3)]],
                schema=schema,
            )

    given = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    return given.mapInArrow(run, "doc_id long, th long, n long, sid binary, bands array<long>")


def tokens_of(texts: DataFrame, width: int) -> DataFrame:
    """``cid, copies, g, tokens`` of rows ``cid, copies, g, sid, text`` whose text has that set."""
    schema = pa.schema([("cid", pa.int64()), ("copies", pa.int64()), ("g", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for cid, copies, g, sid, text in zip(*[c.to_pylist() for c in part.columns]):
                tokens = shingle_set(text, width)
                if identity(tokens) == bytes(sid):
                    rows.append((cid, copies, g, tokens.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], schema.field(k).type) for k in range(4)], schema=schema)

    return texts.select("cid", "copies", "g", "sid", "text").mapInArrow(run, "cid long, copies long, g long, tokens array<long>")


def matches(percent: int):
    """Function of a group's members and its queries, giving ``cid, root, links``.

    ``links`` counts the documents of linked classes; ``root`` is a class of the same
    local component, so chains of roots join what is linked without naming every pair.
    """

    def run(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"cid": [], "root": [], "links": []}, dtype="int64")
        if not len(members) or not len(queries):
            return empty
        sets = [np.asarray(t, np.int64) for t in members.tokens]
        union, place = np.unique(np.concatenate(sets), return_inverse=True)
        sizes = np.array([len(s) for s in sets])
        has = np.zeros((len(union), len(sets)), np.uint8)
        has[place, np.repeat(np.arange(len(sets)), sizes)] = 1
        cids, copies = members.cid.to_numpy(), members.copies.to_numpy()
        root: dict[int, int] = {}
        links: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for cid, n_copies, home, tokens in zip(queries.q, queries.q_copies, queries.home, queries.q_tokens):
            tokens = np.asarray(tokens, np.int64)
            at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
            at = at[union[at] == tokens]
            if 100 * len(at) < percent * len(tokens):
                continue
            inter = has[at].sum(axis=0, dtype=np.int64)
            linked = (100 * inter >= percent * (sizes + len(tokens) - inter)) & (cids != cid)
            if not linked.any():
                continue
            links[cid] = links.get(cid, 0) + int(copies[linked].sum())
            for other in cids[linked].tolist():
                if home != members.g.iloc[0]:
                    links[other] = links.get(other, 0) + int(n_copies)
                a, b = find(cid), find(other)
                root[max(a, b)] = min(a, b)
        nodes = list(root)
        return pd.DataFrame({"cid": nodes, "root": [find(x) for x in nodes], "links": [links.get(x, 0) for x in nodes]}, dtype="int64")

    return run


def dense_blocks(routed: DataFrame) -> DataFrame:
    """``g, block`` of each group of ``routed`` (``sig, g``, distinct). Where a band's groups lie
    close together, all of them from the first to the last are a run; a group's block is the
    longest run it lies in, or the group alone. So any two groups of a block lie in one run."""
    runs = routed.groupBy("sig").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.count("*").alias("k"))
    runs = runs.where(f"k >= {RUN} and hi - lo < {SPARSE} * k").groupBy("lo").agg(F.max("hi").alias("hi"))
    longest = F.max(F.struct((F.col("hi") - F.col("lo")).alias("size"), "lo")).alias("run")
    inside = runs.select("lo", "hi", F.explode(F.sequence("lo", "hi")).alias("g")).groupBy("g").agg(longest)
    return routed.select("g").distinct().join(inside, "g", "left").select("g", F.coalesce("run.lo", -1 - F.col("g")).alias("block"))


def group_pairs(routed: DataFrame) -> DataFrame:
    """``home, g`` of any two groups that share a band (``home <= g``), each with itself as well.

    The groups of a large cluster share very many bands. They are one block, whose pairs are
    named once and not for every band; bands are compared between blocks only. In a block
    some pairs may be named that share no band: their members are compared, which costs time
    but changes no result.
    """
    blocks = materialize(dense_blocks(routed), "blocks")
    within = blocks.withColumnRenamed("g", "home").join(blocks, "block").where("g >= home").select("home", "g")
    placed = routed.join(blocks, "g")
    # Bands of a single block have nothing left to name.
    apart = placed.groupBy("sig").agg(F.min("block").alias("a"), F.max("block").alias("b")).where("a < b").select("sig")
    placed = materialize(placed.join(apart, "sig", "left_semi"), "apart")
    homes = placed.select("sig", F.col("g").alias("home"), F.col("block").alias("home_block"))
    across = homes.join(placed, "sig").where("g > home and block <> home_block").select("home", "g").distinct()
    return within.unionByName(across)


def jaccard_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of each row of ``docs`` (see ``named_rows``)."""
    return named_rows(docs, width, percent).select("doc_id", "n_shingles", "component_id", "n_links")


def named_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, th, n_shingles, component_id, n_links, stays`` of each row of ``docs``.

    Two documents link when ``100 * common >= percent * union`` of their distinct
    shingles of ``width`` words (A-Z in lower case; fewer words are one shingle).
    ``component_id`` is the least id reachable over links, itself included. Null, empty
    and blank texts have no shingles and no links: each is a component of its own.
    Repeated rows link with each other; null ids take part and name no component, so it
    is null where no document of the component has an id. ``n_links`` counts rows.
    ``stays`` marks one text of each component, that of the least id (null last, then the
    least hash ``th`` of the text), and texts without words.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be 50 to 100")
    sketches = materialize(sketch(docs, width, percent / 100), "sketches")
    classes = (
        sketches.where("n > 0").groupBy("sid")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first"),
            F.count("*").alias("copies"),
            F.first("bands").alias("bands"),
        )
        .select(F.monotonically_increasing_id().alias("cid"), "sid", F.col("first.doc_id").alias("least"), F.col("first.th").alias("th"), "copies", "bands")
    )
    classes = materialize(classes, "classes")
    entries = classes.select("cid", F.explode("bands").alias("sig"))
    shared = entries.groupBy("sig").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo < hi")
    members = materialize(entries.join(shared.select("sig", "lo"), "sig"), "members")

    # The least class that any of its bands leads to: similar classes mostly agree on it.
    homes = members.groupBy("cid").agg(F.min("lo").alias("home"))
    placed = number_rows(homes, "home", "cid", name="pos").select("cid", F.expr(f"pos div {GROUP}").alias("g"))
    placed = materialize(placed, "groups")
    picked = classes.select("cid", "sid", "least", "th", "copies").join(placed, "cid")
    texts = docs.select(F.col("doc_id").cast("long").alias("least"), F.xxhash64("text").alias("th"), "text")
    same = picked.least.eqNullSafe(texts.least) & (picked.th == texts.th)
    tokens = tokens_of(texts.join(picked, same).select("cid", "copies", "g", "sid", "text"), width)
    tokens = materialize(tokens.dropDuplicates(["cid"]), "tokens")

    routed = materialize(members.join(placed, "cid").select("sig", "g").distinct(), "routed")
    near = group_pairs(routed)
    pairs = materialize(near.join(placed.withColumnRenamed("g", "home"), "home").select("cid", "home", "g"), "pairs")
    blocks = pairs.groupBy("g").agg(F.expr(f"(count(*) + {QUERIES_AT_ONCE - 1}) div {QUERIES_AT_ONCE}").alias("blocks"))
    members_of = tokens.join(blocks, "g").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    queries = (
        pairs.join(blocks, "g").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks"))).drop("blocks")
        .join(tokens.select("cid", F.col("copies").alias("q_copies"), F.col("tokens").alias("q_tokens")), "cid")
        .select(F.col("g").alias("qg"), F.col("block").alias("qb"), F.col("cid").alias("q"), "home", "q_copies", "q_tokens")
    )
    found = members_of.groupBy("g", "block").cogroup(queries.groupBy("qg", "qb"))
    found = materialize(found.applyInPandas(matches(percent), "cid long, root long, links long"), "links")

    joined = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    ids = classes.select("cid", "sid", "least", "copies").join(joined.withColumnRenamed("node", "cid"), "cid", "left")
    ids = materialize(ids.withColumn("root", F.coalesce("root", "cid")).join(links, "cid", "left"), "components")
    ids = ids.join(classes.select("cid", "th"), "cid")
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "th"))
    least = ids.groupBy("root").agg(first.alias("first")).select("root", F.col("first.least").alias("component_id"), F.col("first.th").alias("first_th"))
    named = ids.join(least, "root").select("sid", "component_id", "first_th", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = sketches.drop("bands").join(named, "sid", "left")
    chosen = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("th") == F.col("first_th"))
    return out.select(
        "doc_id", "th",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        ((F.col("n") == 0) | chosen).alias("stays"),
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the one of least id.

    Texts without words are kept. Rows equal in id and text are one document: all of
    them stay or go. Of a component without any id the text of the least hash stays.
    """
    kept = named_rows(docs, width, percent).where("stays").select("doc_id", "th").distinct().alias("k")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.xxhash64("d.text") == F.col("k.th"))
    return docs.alias("d").join(kept, same, "left_semi").select(*[F.col(f"d.`{c}`") for c in docs.columns])
