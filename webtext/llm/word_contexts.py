"""Bit predictors whose contexts reach over word boundaries, mixed while a text is coded.

Common words (those with training occurrences among the words that are looked up in the
task) are the leaves of a binary tree in byte order, each inner node halving the
probability of what lies below it; one more leaf stands for all other words, which are
spelled by the mixture of the bit predictors inside a word. A text is coded word by
word along the tree's bits. Each bit has three predictors: the share of both sides of the
node, which is what the mixture inside words says, and two tables of bit counts in
hashed slots, by node and previous word and by node and previous two words. Their
log-odds are combined by weights that a gate chooses (how often the slots of both tables
have been seen), and the result is refined by a table of what came true at that probability.

Counts come from all training texts. Weights and refinement are learned online in one pass
over them, each occurrence without itself; tasks' weights are averaged.

Words are numbers here, of a text in four bytes each: the place of a common word, ``OTHER``
with a hash for others; ``~`` of that for words that other predictors have coded, which are
context only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OTHER = 1 << 29
TABLES = 2
# A table has as many lines as training words, rounded up to a power of two, within these.
LEAST_BITS, MOST_BITS = 12, 20
# Levels of the tree whose nodes share a line, so that memory is met once for all of them.
LINE = 3
# Occurrences of a node from which its confidence is the next one.
SEEN = np.array([1, 2, 4, 9, 21, 101])
GATES = (len(SEEN) + 1) ** TABLES
# Largest mixed log-odds; levels are halves of them, on both sides of 0.
MOST = 13
LEVELS = 2 * MOST
PRIOR = 0.4
RATE, DAMP = 0.25, 0.05
# Words coded at once; counts that make one row of a shuffle.
WORDS = 8192
BLOCK = 1 << 16
LEAST_MASS = 1e-9
ONE = np.int32(1)
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
# A node's state is the step of its count of zeros, and of ones. Steps begin at ``STEPS`` and
# stand for ``ABOUT`` as many.
STEPS = np.array([0, 1, 2, 3, 6, 16, 60, 400])
ABOUT = np.array([0, 1, 2, 3.9, 9, 28, 130, 1000])
STATES = len(STEPS) ** 2


def predictors(without: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For both bits and all pairs of states, numbered in this order (bit, first table, second):
    log-odds of the bit by either table, with ``without`` occurrences of it taken out, and the gate."""
    zeros, ones = np.repeat(ABOUT, len(ABOUT)), np.tile(ABOUT, len(ABOUT))
    own, rest = np.maximum(np.stack([zeros, ones]) - without, 0), np.stack([ones, zeros])
    odds, sure = np.log(own + PRIOR) - np.log(rest + PRIOR), np.searchsorted(SEEN, own + rest, side="right")
    first, second = np.broadcast_arrays(odds[:, :, None], odds[:, None])
    return first.ravel(), second.ravel(), (sure[:, :, None] * (len(SEEN) + 1) + sure[:, None]).ravel()


def lines(counts: np.ndarray) -> np.ndarray:
    """Lines of a table from the counts of their paths (eight a line): the states of the
    node above all, of the two below and of the four below these, from the last byte on."""
    out, shift = np.zeros(len(counts) // 8, np.int64), 0
    for level in range(LINE):
        sides = counts.reshape(len(out), 2 << level, -1).sum(axis=2)
        step = np.searchsorted(STEPS, sides, side="right") - 1
        for node in range(1 << level):
            out |= (step[:, 2 * node] * len(STEPS) + step[:, 2 * node + 1]) << shift
            shift += 8
    return out


def hashed(x: np.ndarray) -> np.ndarray:
    """Hash below 2**32 whose last bits, which number the paths of a line, are empty."""
    x = (x ^ (x >> np.uint64(29))) * K2
    return (x >> np.uint64(32) & ~np.uint64((1 << LINE) - 1)).astype(np.int64)


class Tree:
    """Leaves with probabilities ``mass`` in order. For each leaf: ``depth``; for every ``LINE``
    levels (root first) the hash of the node they start from with the path it takes through
    them; for each level the log-odds by mass of the bit it takes."""

    def __init__(self, mass: np.ndarray):
        n = len(mass)
        below = np.concatenate([[0.0], np.cumsum(np.maximum(mass, 1e-300))])
        low, high = np.zeros(n, np.int64), np.full(n, n)
        self.depth = np.zeros(n, np.int16)
        self.codes: list[np.ndarray] = []
        self.odds: list[np.ndarray] = []
        at = np.flatnonzero(high - low > 1)
        while len(at):
            a, b = low[at], high[at]
            if len(self.odds) % LINE == 0:
                self.codes.append(np.zeros(n, np.int64))
                self.codes[-1][at] = hashed((a.astype(np.uint64) * K1 ^ b.astype(np.uint64)) * K2)
            half = (below[a] + below[b]) / 2
            cut = np.clip(np.searchsorted(below, half), a + 1, b - 1)
            before = np.maximum(cut - 1, a + 1)
            cut = np.where(half - below[before] < below[cut] - half, before, cut)
            bit = at >= cut
            right = np.log(np.maximum(below[b] - below[cut], 1e-15)) - np.log(np.maximum(below[cut] - below[a], 1e-15))
            odds = np.zeros(n, np.float32)
            odds[at] = np.where(bit, right, -right)
            self.codes[-1][at] |= bit.astype(np.int64) << (LINE - 1 - len(self.odds) % LINE)
            self.odds.append(odds)
            self.depth[at] += 1
            low[at], high[at] = np.where(bit, cut, a), np.where(bit, b, cut)
            at = at[high[at] - low[at] > 1]

    def longest_first(self) -> np.ndarray:
        """Put the leaves in this order, and keep of each level those that go so deep."""
        order = np.argsort(-self.depth, kind="stable")
        self.depth = self.depth[order]
        self.odds = [x[order[: (self.depth > i).sum()]] for i, x in enumerate(self.odds)]
        self.codes = [x[order[: (self.depth > i * LINE).sum()]].astype(np.uint32) for i, x in enumerate(self.codes)]
        return order


class Coder:
    """Tree and tables: ``leaf`` of each common word and what is added to the log10
    probability of its leaf, ``other`` for the words that are not common."""

    def __init__(self, words: list[bytes], count: np.ndarray, mix: np.ndarray, total: int):
        order = sorted(np.flatnonzero(count > 0), key=words.__getitem__)
        mass = 10 ** mix[order]
        rest = max(1 - mass.sum(), LEAST_MASS)
        self.other = -math.log10(rest)
        self.added = np.append(np.where(count > 0, 0.0, mix + self.other), self.other)
        self.tree = Tree(np.append(mass, rest))
        # Sorted by their leaves, words with long paths come first.
        number = np.argsort(self.tree.longest_first())
        self.leaf = np.full(len(words) + 1, number[-1])
        self.leaf[order] = number[:-1]
        self.bits = min(max(total.bit_length(), LEAST_BITS), MOST_BITS)
        self.weights = np.full((GATES, 1 + TABLES), 0.4)
        self.weights[:, 0] = 1
        self.refine = 1 / (1 + np.exp(-np.arange(-LEVELS, LEVELS + 1) / 2))

    def contexts(self, words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """Hashes of the previous word and the previous two, for the words of some texts that
        begin at ``first``; there, no word goes before."""
        own = np.where(words < 0, ~words, words).astype(np.uint64) + np.uint64(2)
        before = [np.zeros(len(own), np.uint64) for _ in range(2)]
        for k, b in enumerate(before):
            b[k + 1 :] = own[: -k - 1]
            for j in range(k + 1):
                b[(first + j)[first + j < len(b)]] = 1 if j == k else 0
        before[1][first[first < len(own)]] = 0
        return [hashed(before[0] * K1), hashed((before[0] * K1 ^ before[1]) * K1 + np.uint64(1))]

    def paths(self, words: np.ndarray, first: np.ndarray, size: int = WORDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list]]:
        """Coded words, ``size`` at once, longest paths first: their places, their leaves, how many
        of them go as deep as each level, and for every ``LINE`` levels the places of their
        paths in both tables of counts."""
        mask = (8 << self.bits) - 1
        contexts = self.contexts(words, first)
        places = np.flatnonzero(words >= 0)
        for i in range(0, len(places), size):
            at = places[i : i + size]
            leaf = self.leaf.take(np.minimum(words.take(at), len(self.leaf) - 1))
            bits = len(leaf).bit_length()
            keys = np.sort(leaf << bits | np.arange(len(leaf)))
            at, leaf = at.take(keys & ((1 << bits) - 1)), keys >> bits
            own = [c.take(at) for c in contexts]
            deep = len(leaf) - np.cumsum(np.bincount(self.tree.depth.take(leaf), minlength=len(self.tree.odds)))
            deep = deep[: len(self.tree.odds)]
            met = []
            for code, n in zip(self.tree.codes, deep[::LINE]):
                taken = code.take(leaf[:n])
                met.append([(c[:n] ^ taken) & mask for c in own])
            yield at, leaf, deep, met

    def bits_of(self, leaf: np.ndarray, deep: np.ndarray, met: list, tables: list[np.ndarray]) -> Iterator[tuple]:
        """For some levels at a time, one after the other: the log-odds by mass of the bits that came, the
        numbers of bit and states by ``predictors``, and how many words go as deep as each level."""
        held = []
        for i, at in enumerate(met):
            lines = [table.take(x >> LINE, mode="clip") for table, x in zip(tables, at)]
            paths = at[0] & ((1 << LINE) - 1)
            for level, n in enumerate(deep[i * LINE : i * LINE + LINE].tolist()):
                path = paths[:n]
                state = path >> (LINE - 1 - level) & 1
                # Nodes above in the line, then those to the left: a byte each.
                shift = (path >> (LINE - level) << 3) + 8 * ((1 << level) - 1) if level else 0
                for line in lines:
                    state *= STATES
                    state += line[:n] >> shift & 255
                held.append((self.tree.odds[i * LINE + level].take(leaf[:n], mode="clip"), state))
            # Few words make short levels: these are met together.
            if sum(len(x) for x, _ in held) >= WORDS or i + 1 == len(met):
                odds, states = zip(*held)
                yield np.concatenate(odds), np.concatenate(states), [len(x) for x in odds]
                held = []

    def weighted(self, first: np.ndarray, second: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By numbers as ``predictors`` gives them: the weight of the log-odds by mass, and the
        sum of the others by their weights."""
        own, one, two = (w.take(gate) for w in self.weights.T)
        return own.astype(np.float32), (one * first + two * second).astype(np.float32)

    def count(self, words: np.ndarray, first: np.ndarray, counts: list[np.ndarray]) -> None:
        for _, _, _, met in self.paths(words, first):
            for both in met:
                for own, at in zip(counts, both):
                    np.add.at(own, at, ONE)

    def learn(self, words: np.ndarray, first: np.ndarray, tables: list[np.ndarray], came: np.ndarray, step: int) -> int:
        """One step of the weights for each ``WORDS`` words (fewer in a task's first batches), each gate along its gradient by its
        own curvature; ``came`` counts the bits at each level of mixed log-odds. Returns the
        number of the next step."""
        first_odds, second_odds, gate = by_state = predictors(1)
        size = len(gate)
        for _, leaf, deep, met in self.paths(words, first, min(WORDS, 512 << min(step, 9))):
            weight, rest = self.weighted(*by_state)
            # Added up by states first: two of the predictors and the gate depend on nothing else.
            sums = np.zeros((5, size))
            for odds, state, _ in self.bits_of(leaf, deep, met, tables):
                mixed = np.clip(weight.take(state, mode="clip") * odds + rest.take(state, mode="clip"), -MOST, MOST)
                came += np.bincount(level_of(mixed), minlength=len(came))
                miss = 1 / (1 + np.exp(mixed))
                bend = miss * (1 - miss)
                for own, x in zip(sums, (None, miss, bend, miss * odds, bend * odds * odds)):
                    own += np.bincount(state, x, size)
            met_states = np.flatnonzero(sums[0])
            n, miss, bend, slope, curve = sums[:, met_states]
            own_gate = gate[met_states]
            damp = DAMP * np.bincount(own_gate, n, GATES) + 1e-9
            rate = RATE / math.sqrt(1 + step / 20)
            each = [(slope, curve), *((miss * x, bend * x * x) for x in (first_odds[met_states], second_odds[met_states]))]
            for i, (slope, curve) in enumerate(each):
                self.weights[:, i] += np.clip(rate * np.bincount(own_gate, slope, GATES) / (np.bincount(own_gate, curve, GATES) + damp), -0.1, 0.1)
            step += 1
        return step

    def score(self, words: np.ndarray, first: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each coded word (without the spelling of those that are not
        common); 0 for the others."""
        out = np.zeros(len(words))
        weight, rest = self.weighted(*predictors(0))
        half = (self.refine / 2).astype(np.float32)
        for at, leaf, deep, met in self.paths(words, first):
            sums = np.zeros(len(at))
            for odds, state, counts in self.bits_of(leaf, deep, met, tables):
                mixed = np.clip(weight.take(state, mode="clip") * odds + rest.take(state, mode="clip"), -MOST, MOST)
                bits, end = np.log(np.float32(0.5) / (1 + np.exp(-mixed)) + half.take(level_of(mixed), mode="clip")), 0
                for n in counts:
                    sums[:n] += bits[end : end + n]
                    end += n
            out[at] = sums / math.log(10) + self.added.take(np.minimum(words.take(at), len(self.added) - 1))
        return out


def level_of(odds: np.ndarray) -> np.ndarray:
    return np.rint(odds * 2).astype(np.intp) + LEVELS


def flat(texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts of a batch, and where each text begins."""
    texts = texts.to_pylist()
    sizes = np.array([len(x) for x in texts], np.int64) // 4
    return np.frombuffer(b"".join(texts), np.int32).astype(np.int64), np.cumsum(sizes) - sizes


def texts_of(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for part in parts:
        yield flat(part.column("words"))


def learned(texts: DataFrame, coder: Coder) -> tuple[Broadcast, Broadcast]:
    """The coder and the tables from the column ``words`` of the training texts, sent to all
    tasks; sets the coder's weights and refinement here. As many tasks count as the cluster has cores, so what they pass on does not
    grow with the corpus; blocks of the counts are added up and made lines in other tasks."""
    spark = texts.sparkSession.sparkContext
    size = 8 << coder.bits
    block = min(BLOCK, size)
    shared = spark.broadcast(coder)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((TABLES, size), np.int32)
        for words, first in texts_of(parts):
            shared.value.count(words, first, list(counts))
        for i, own in enumerate(counts.reshape(-1, block)):
            if most := int(own.max()):
                kind = np.min_scalar_type(most)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([kind.itemsize], pa.int32()), pa.array([own.astype(kind).tobytes()])], ["block", "width", "counts"])

    def add(table: pa.Table) -> pa.Table:
        sums = np.zeros(block, np.int64)
        for own, width in zip(table.column("counts").to_pylist(), table.column("width").to_pylist()):
            sums += np.frombuffer(own, f"u{width}")
        return pa.table([table.column("block").slice(0, 1), pa.array([lines(sums).tobytes()])], ["block", "lines"])

    counts = texts.select("words").coalesce(spark.defaultParallelism).mapInArrow(count, "block int, width int, counts binary")
    tables = np.zeros((TABLES * size // block, block // 8), np.int64)
    for row in counts.groupBy("block").applyInArrow(add, "block int, lines binary").toLocalIterator():
        tables[row.block] = np.frombuffer(row.lines, np.int64)
    tables = list(tables.reshape(TABLES, -1))
    sent = spark.broadcast(tables)

    def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, came, step, total = copy(shared.value), np.zeros(2 * LEVELS + 1), 0, 0
        own.weights = own.weights.copy()
        for words, first in texts_of(parts):
            step = own.learn(words, first, sent.value, came, step)
            total += int((words >= 0).sum())
        if total:
            flat = np.concatenate([own.weights.ravel() * total, came, [total]])
            yield pa.RecordBatch.from_arrays([pa.array(range(flat.size), pa.int32()), pa.array(flat)], ["i", "x"])

    sums = np.zeros(coder.weights.size + 2 * LEVELS + 2)
    for i, x in texts.select("words").mapInArrow(learn, "i int, x double").groupBy("i").agg(F.sum("x")).collect():
        sums[i] = x
    if sums[-1]:
        coder.weights = (sums[: coder.weights.size] / sums[-1]).reshape(coder.weights.shape)
    came = sums[coder.weights.size : -1]
    both = came + came[::-1]
    # A level without training bits keeps its own probability; opposite ones sum to 1.
    coder.refine = np.where(both > 0, (came + PRIOR) / (both + 2 * PRIOR), coder.refine)
    return shared, sent
