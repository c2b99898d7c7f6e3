"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors of one label are dealt to overlapping shards around cluster centres until every
shard is small. Each shard links every vector to a pruned list of its nearest ones (a
candidate goes when a kept neighbour is nearer to it, by a factor, than the vector is);
a few more are kept for long ways), and the lists of a vector from all its shards are
united. Every vector then searches the united graph around its first shard: a greedy beam
from medoids, and from there every vector in range is expanded until none is left; where the
beam has not come to the vector's own node, the search goes on from that too. What is
reported was verified by its cosine. An audit compares a sample of the searches with brute force; if it finds less than
the recall asked for, shards and beams are widened, at last to all pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.llm.components import components
from webtext.sources.shared import materialize

# Vectors in a shard; shards that a vector joins at each split; centres of one split, and
# vectors that each of them is fitted on; splits that follow centres.
SHARD = 2048
OVERLAP = 2
SPLITS = 4
CENTERS = 64
FIT_ROWS = 32
# Neighbours kept of a vector, near and by chance; candidates the near are chosen from;
# pruning factor (of distance); starts of a search and width of its beam.
DEGREE = 24
FAR = 4
POOL = 64
ALPHA = 1.2
MEDOIDS = 16
BEAM = 16
# Searches that the audit repeats by brute force, and rows of a block there.
AUDIT = 512
BLOCK = 8192


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def matrix(column) -> np.ndarray:
    """Vectors of a pandas or Arrow column as rows of doubles."""
    return np.array(column.tolist() if isinstance(column, pd.Series) else column.to_pylist(), np.float64)


def pruned(u: np.ndarray) -> np.ndarray:
    """Neighbour lists (rows of positions, -1 where there are fewer) of unit vectors."""
    n = len(u)
    pool, degree = min(POOL, n - 1), min(DEGREE, n - 1)
    out = np.full((n, degree + FAR if n > 1 else 0), -1)
    if n < 2:
        return out
    out[:, degree:] = np.random.Generator(np.random.PCG64(n)).integers(0, n, (n, FAR))
    for start in range(0, n, 256):
        own = np.arange(start, min(n, start + 256))
        near = u[own] @ u.T
        near[np.arange(len(own)), own] = -np.inf
        cands = np.argpartition(-near, pool - 1, axis=1)[:, :pool]
        near = np.take_along_axis(near, cands, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        cands, near = np.take_along_axis(cands, order, axis=1), np.take_along_axis(near, order, axis=1)
        far = 2 - 2 * near
        alive = np.ones(cands.shape, bool)
        lines = np.arange(len(own))
        for k in range(degree):
            pick = np.argmax(alive, axis=1)
            some = alive[lines, pick]
            if not some.any():
                break
            chosen = cands[lines, pick]
            out[own[some], k] = chosen[some]
            between = 2 - 2 * np.einsum("qd,qcd->qc", u[chosen], u[cands])
            alive &= ALPHA**2 * between > far
            alive[lines, pick] = False
    return out


def united(own: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """Positions in ``own`` (sorted ids) of the neighbours listed, -1 for those elsewhere."""
    width = max((len(x) for x in lists), default=0)
    out = np.full((len(lists), width), -1)
    flat = np.concatenate(lists) if lists else np.empty(0, np.int64)
    at = np.searchsorted(own, flat)
    at[at == len(own)] = 0
    found = np.where(own[at] == flat, at, -1)
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    places = np.arange(len(flat)) - np.repeat(np.cumsum([0, *[len(x) for x in lists][:-1]]), [len(x) for x in lists])
    out[rows, places] = found
    return out


def medoids(u: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Of the vectors ``inside``, the one nearest the middle of all, and of each part around
    evenly spaced ones the one nearest the middle of the part."""
    own = u[inside]
    part = np.argmax(own @ own[:: max(1, len(own) // MEDOIDS)][:MEDOIDS].T, axis=1)
    picks = [int(np.argmax(own @ own.mean(axis=0)))]
    for k in range(part.max() + 1):
        if len(at := np.flatnonzero(part == k)):
            picks.append(int(at[np.argmax(own[at] @ own[at].mean(axis=0))]))
    return inside[np.unique(picks)]


def in_range(self: int, u: np.ndarray, graph: np.ndarray, starts: np.ndarray, least: float, beam: int) -> np.ndarray:
    """Vectors with cosine ``least`` or more to that at ``self`` that the graph leads to.

    A beam of the best seen, at first the ``starts``, is expanded until it holds no new one.
    Then the range grows from the vector's own node and all seen within it, through vectors
    up to twice as far (in squared distance)."""
    q = u[self]
    seen = np.zeros(len(u), bool)
    done = np.zeros(len(u), bool)
    near = np.full(len(u), -np.inf)

    def meet(fresh: np.ndarray) -> None:
        fresh = np.unique(fresh[fresh >= 0])
        fresh = fresh[~seen[fresh]]
        seen[fresh] = True
        near[fresh] = u[fresh] @ q

    def expand(rows: np.ndarray) -> None:
        done[rows] = True
        meet(graph[rows].ravel())

    meet(starts)
    while True:
        known = np.flatnonzero(seen)
        best = known if len(known) <= beam else known[np.argpartition(-near[known], beam - 1)[:beam]]
        best = best[~done[best]]
        if not len(best):
            break
        expand(best)
    meet(np.array([self]))
    while len(open_ := np.flatnonzero(~done & (near >= 2 * least - 1))):
        expand(open_)
    return np.flatnonzero(near >= least - 1e-9)


def join_up(group: np.ndarray, rows: np.ndarray) -> None:
    """Give the groups of ``rows`` one number."""
    numbers = np.unique(group[rows])
    if len(numbers) > 1:
        group[np.isin(group, numbers)] = numbers[0]


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with ``q``, added up in one order for both."""
    return np.einsum("ij,j->i", x, q) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * sqrt(float(np.einsum("i,i->", q, q))))


def sharded(vectors: DataFrame, shard: int, overlap: int) -> DataFrame:
    """``label, shard, cls, x, first`` of each vector and shard it is in; ``first`` marks the
    shard of the nearest centre at every split. A shard holds vectors of one length.

    A shard with more than ``shard`` vectors is split around centres fitted on a bounded
    sample of it; each vector goes to its ``overlap`` nearest. Vectors whose centres are not
    apart, and all after ``SPLITS`` splits, are cut evenly by number and without overlap, so
    shards always shrink and a vector is in ``overlap ** SPLITS`` of them at most.
    """
    rows = vectors.select("label", F.size("x").cast("string").alias("shard"), "cls", "x", F.lit(True).alias("first"))
    types = f"label int, shard string, cls long, x {vectors.schema['x'].dataType.simpleString()}, first boolean"
    done: list[DataFrame] = []
    while True:
        sizes = materialize(rows.groupBy("label", "shard").agg(F.count("*").alias("n")), "shard-sizes")
        big = sizes.where(F.col("n") > shard)
        if not big.take(1):
            return reduce(DataFrame.unionByName, done, rows)
        done.append(rows.join(sizes.where(F.col("n") <= shard).select("label", "shard"), ["label", "shard"], "left_semi"))
        k = F.least(F.lit(CENTERS), F.ceil(F.col("n") * overlap / (shard * 0.6)) + 1).cast("int")
        marked = rows.join(big.select("label", "shard", "n", k.alias("k")), ["label", "shard"])
        drawn = marked.where(F.pmod(F.xxhash64(F.lit(len(done)), "cls"), F.col("n")) < FIT_ROWS * F.col("k"))
        fitted = drawn.groupBy("label", "shard", "k").applyInPandas(fit_centers, "label int, shard string, centers array<array<double>>")
        split = marked.drop("n", "k").join(materialize(fitted, "centers"), ["label", "shard"], "left")
        rows = materialize(split.mapInArrow(deal(overlap, len(done)), types), "split")


def fit_centers(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Up to ``k`` directions by a few rounds of spherical k-means from a fixed start."""
    u = unit(matrix(rows.sort_values("cls").x))
    k = min(int(key[2]), len(u))
    rng = np.random.Generator(np.random.PCG64(len(u)))
    c = u[rng.choice(len(u), k, replace=False)]
    for _ in range(8):
        own = np.argmax(u @ c.T, axis=1)
        for j in range(k):
            mean = u[own == j].sum(axis=0)
            if (length := sqrt(float(mean @ mean))) > 1e-9:
                c[j] = mean / length
    return pd.DataFrame({"label": [key[0]], "shard": [key[1]], "centers": [c.tolist()]})


def deal(overlap: int, depth: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            take, shards, first = [], [], []
            firsts = part["first"].to_pylist()
            classes = part["cls"].to_numpy()
            groups: dict[tuple, list[int]] = {}
            for i, g in enumerate(zip(part["label"].to_pylist(), part["shard"].to_pylist())):
                groups.setdefault(g, []).append(i)
            for (_, shard), rows in groups.items():
                c = np.array(part["centers"][rows[0]].as_py() or [])
                if depth > SPLITS or len(c) < 2 or float(np.min(c @ c[0])) > 1 - 1e-9:
                    mixed = (classes[rows].astype(np.uint64) + np.uint64(depth)) * np.uint64(0x9E3779B97F4A7C15)
                    best = ((mixed >> np.uint64(33)) % np.uint64(max(len(c), 2))).astype(np.int64)[:, None]
                else:
                    near = unit(matrix(part["x"].take(pa.array(rows)))) @ c.T
                    best = np.argsort(-near, axis=1, kind="stable")[:, :overlap]
                for i, pieces in zip(rows, best.tolist()):
                    for place, piece in enumerate(pieces):
                        take.append(i)
                        shards.append(f"{shard}/{piece}")
                        first.append(firsts[i] and place == 0)
            got = part.select(["label", "cls", "x"]).take(pa.array(take, pa.int64()))
            columns = [got["label"], pa.array(shards, pa.string()), got["cls"], got["x"], pa.array(first, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["label", "shard", "cls", "x", "first"])

    return run


def build(least: float):
    """Function of a shard giving ``cls, near, tight``: the pruned neighbour lists, and of
    them those as near as two vectors in range of a third can be."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("cls")
        ids, u = rows.cls.to_numpy(), unit(matrix(rows.x))
        out = []
        for i, near in enumerate(pruned(u)):
            near = np.unique(near[(near >= 0) & (near != i)])
            out.append((ids[i], ids[near], ids[near[u[near] @ u[i] >= 4 * least - 3 - 1e-9]]))
        return pd.DataFrame(out, columns=["cls", "near", "tight"])

    return run


def search(least: float, beam: int):
    """Function of a shard's vectors with their united lists (members, and vectors beside
    them from other shards), giving what each vector whose first shard it is has found: its
    links counted with copies, the classes linked, and one of its group in this shard;
    -1 for other vectors."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("cls")
        ids, x = rows.cls.to_numpy(), matrix(rows.x)
        u = unit(x)
        graph = united(ids, [np.asarray(a, np.int64) for a in rows.near])
        starts = medoids(u, np.flatnonzero(rows.member.to_numpy()))
        copies, group = rows.copies.to_numpy(), np.arange(len(ids))
        n, pairs = np.full(len(ids), -1), np.full(len(ids), -1)
        for i in np.flatnonzero(rows["first"].to_numpy()):
            near = in_range(i, u, graph, starts, least, beam)
            near = near[near != i]
            near = near[exact(x[near], x[i]) >= least]
            n[i], pairs[i] = copies[near].sum(), len(near)
            join_up(group, np.append(near, i))
        made = pd.DataFrame({"cls": ids, "n": n, "pairs": pairs, "root": ids[group]})
        return made[(made.n >= 0) | (made.root != made.cls)]

    return run


def count_block(least: float):
    """Function of queries and one block of their label: links by brute force, as ``search``."""

    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(block):
            return pd.DataFrame({c: np.empty(0, np.int64) for c in ("cls", "n", "pairs", "root")})
        x, ids, copies = matrix(block.x), block.cls.to_numpy(), block.copies.to_numpy()
        u = unit(x)
        asked = queries.qcls.to_numpy()
        every = np.unique(np.concatenate([ids, asked]))
        own, at = np.searchsorted(every, asked), np.searchsorted(every, ids)
        group = np.arange(len(every))
        n, pairs = np.full(len(every), -1), np.full(len(every), -1)
        for i, q in zip(own, matrix(queries.qx)):
            near = np.flatnonzero((u @ unit(q[None])[0] >= least - 1e-9) & (at != i))
            near = near[exact(x[near], q) >= least]
            n[i], pairs[i] = copies[near].sum(), len(near)
            join_up(group, np.append(at[near], i))
        made = pd.DataFrame({"cls": every, "n": n, "pairs": pairs, "root": every[group]})
        return made[(made.n >= 0) | (made.root != made.cls)]

    return run


FOUND = "cls long, n long, pairs long, root long"


def by_blocks(queries: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """``cls, n, pairs, root`` as ``links`` by comparing each query with all vectors of its
    label and length, block by block: a row per query and block."""
    blocks, chunks = (ceil(max(1, df.count()) / BLOCK) for df in (vectors, queries))
    dealt = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "cls"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = vectors.select("label", F.size("x").alias("dim"), dealt(5, blocks).alias("block"), every(chunks).alias("chunk"), "cls", "x", "copies")
    asked = queries.select(F.col("label").alias("qlabel"), F.size("x").alias("qdim"), every(blocks).alias("qblock"), dealt(6, chunks).alias("qchunk"), F.col("cls").alias("qcls"), F.col("x").alias("qx"))
    both = asked.groupBy("qlabel", "qdim", "qblock", "qchunk").cogroup(base.groupBy("label", "dim", "block", "chunk"))
    return both.applyInPandas(count_block(least), FOUND)


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``vec_id, label, x`` (x null where a vector takes no part), and the distinct
    ``label, x`` among those that do: ``cls``, how many ids have it and the least of them."""
    good = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    x = F.col("embedding")
    if vectors.schema["embedding"].dataType.elementType.simpleString() != "float":
        x = x.cast("array<double>")
    usable = F.forall(x, good) & F.exists(x, lambda v: v != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("int"), F.when(usable, x).alias("x"))
    rows = materialize(rows.distinct(), "vectors")
    distinct = rows.where("x is not null").groupBy("label", "x").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    return rows, materialize(distinct.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")


def links(classes: DataFrame, least: float = 0.98, shard: int = SHARD, overlap: int = OVERLAP, beam: int = BEAM) -> DataFrame:
    """``cls, n, pairs, root`` from one pass of the graph (see ``search``). A region is a
    shard with the neighbours of its members in other shards that are near enough to be on
    a way through the range: at most ``DEGREE`` times the shard."""
    dealt = sharded(classes, shard, overlap)
    lists = dealt.groupBy("label", "shard").applyInPandas(build(least), "cls long, near array<long>, tight array<long>")
    joined = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("near", "tight")]
    nodes = materialize(classes.select("cls", "x", "copies").join(lists.groupBy("cls").agg(*joined), "cls"), "graph")
    members = dealt.select("label", "shard", "cls", "first", F.lit(True).alias("member"))
    beside = members.join(nodes.select("cls", F.explode("tight").alias("other")), "cls").select("label", "shard", F.col("other").alias("cls")).distinct()
    beside = beside.join(members, ["label", "shard", "cls"], "left_anti").select("*", F.lit(False).alias("first"), F.lit(False).alias("member"))
    ready = members.unionByName(beside).join(nodes.drop("tight"), "cls")
    return materialize(ready.groupBy("label", "shard").applyInPandas(search(least, beam), FOUND), "links")


def recall(classes: DataFrame, found: DataFrame, least: float) -> float:
    """Share of the links of a sample of vectors that ``found`` has, and 1 without links. The
    sample is chosen by a hash and bounded by ``AUDIT`` on average; it meets all vectors."""
    total = classes.count()
    asked = classes.where(F.pmod(F.xxhash64(F.lit(11), "cls"), F.lit(max(1, total))) < AUDIT)
    true = by_blocks(asked, classes, least).where("n >= 0").groupBy("cls").agg(F.sum("pairs").alias("true"))
    got = found.where("n >= 0").select("cls", "pairs")
    row = true.join(got, "cls", "left").agg(F.sum("true").alias("t"), F.sum(F.least("true", F.coalesce("pairs", F.lit(0)))).alias("f")).first()
    return row["f"] / row["t"] if row["t"] else 1.0


def near_vectors(vectors: DataFrame, least: float = 0.98, least_recall: float = 0.97, shard: int = SHARD, beam: int = BEAM) -> DataFrame:
    """``vec_id, n_links, component_id, kept, recall`` of each distinct row of ``vec_id,
    label, embedding``.

    Two vectors link when their labels are equal and not null, their lengths are equal and
    their cosine, in double precision, is at least ``least``. Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing; nor do rows without a
    ``vec_id``, which have no component. Equal vectors of a label are one node of the graph, whose
    copies are counted and never paired. Rows equal in id, label and vector are one row; an
    id with several vectors has a row of each, and one component. ``recall`` is what the
    audit measured. Other columns of ``vectors`` are not read.
    """
    rows, classes = classes_of(vectors)
    overlap, share = OVERLAP, 0.0
    for _ in range(3):
        found = links(classes, least, shard, overlap, beam)
        share = recall(classes, found, least)
        if share >= least_recall:
            break
        overlap, beam, shard = overlap * 2, beam * 2, shard * 2
    else:
        found, share = materialize(by_blocks(classes, classes, least), "links"), 1.0
    counts = found.where("n >= 0").groupBy("cls").agg(F.sum("n").alias("n"))
    name = classes.select("cls", "least")
    edges = found.where("root <> cls").select("cls", "root").join(name, "cls").select("root", F.col("least").alias("a"))
    edges = edges.join(name.withColumnRenamed("cls", "root"), "root").select("a", F.col("least").alias("b"))
    mine = classes.select("label", "x", "copies", "least", "cls")
    both = materialize(rows.where("x is not null").join(mine, ["label", "x"]).join(counts, "cls", "left").select("vec_id", "copies", "least", "n"), "counted")
    copies = both.where("vec_id <> least").select(F.col("vec_id").alias("a"), F.col("least").alias("b"))
    roots = components(edges.unionByName(copies))
    out = both.select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = out.unionByName(rows.where("x is null").select("vec_id", F.lit(0).cast("long").alias("n_links")))
    placed = out.join(roots.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("root", "vec_id")
    return placed.select("vec_id", "n_links", component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"), F.lit(share).alias("recall"))
