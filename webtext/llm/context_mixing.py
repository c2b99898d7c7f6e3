"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is a sequence of words and one end. The bytes of each word and the space that
closes it are coded bit by bit, the end as a line feed. Six predictors each look at a
context: the place in the word, the last one to four bytes, and all of the word so far.
A predictor is a table of bit counts in hashed slots. Their log-odds are combined by
weights that a gate chooses (bit number and how well the whole beginning is known), and
the result is refined by a table of what came true at that probability. The probability
of a text is the product over its bits.

The contexts of these six begin anew at each word, so a word's probability by them is computed
once for all its occurrences, and words are sorted, so what neighbours begin with alike is coded
once for both. What all bits of a known word would say by its own counts
alone is its relative frequency; the next step mixes that with the bit model's probability,
by the weight under which the training words, each occurrence without itself, are likeliest.

That mixture is one of three predictors of each occurrence: ``word_contexts`` codes it bit by
bit in its text, with two more whose contexts are the previous word and the previous two.

Two more predictors adapt while a text is read and look across words. The match predictor
expects the word that followed the last earlier occurrence of the word before; whether it
does follow is coded first, by odds that depend on how many words in a row it has foretold.
If not, it is coded whether a rare word of this text comes again, and which one by its count
so far; if not that either, the word is coded by those three.

What is learned comes from all training texts: bit counts are weighted by how often a word
occurs; weights and refinement are learned online in one pass, by gradient steps over batches
of words, predicting each occurrence without itself; tasks' weights are averaged. The odds of
the last two predictors are counted over all training texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from copy import copy
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtext.llm.word_contexts import OTHER, Coder, flat, learned
from webtext.sources.shared import materialize

CONTEXTS = 6
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
GATES = 8 * 3
LEVELS = 33
PRIOR = 0.4
RATE = 0.25
DAMP = 0.05
BATCH = 2048
END = b"\n"
# Words that are looked up in the task itself; all others are joined.
COMMON = 100_000
# Distinct words that a task counts before it passes the counts on, when twice as many are held with repeats.
HELD_WORDS = 200_000
FLOOR = 1e-6
# Steps of words foretold in a row, and of rare words so far, at which the odds change.
MATCHED = np.array([1, 2, 4, 8, 16])
RARE = np.array([1, 2, 4, 8, 16, 64])
WEIGHTS = (0.0, 0.2, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995)
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# A number for each beginning of a byte (1 with the bits so far behind it).
NODES = ((np.arange(256, dtype=np.uint64) * K1 ^ np.uint64(0x5BD1E995)) * K2 >> np.uint64(32)).astype(np.uint32)


def trains(key: str | Column) -> Column:
    """Whether a document is learned from: crc32 of its id as text, modulo 5, is not 1.
    Documents without id are not."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 != 1, F.lit(False))


def bytes_of(words: pa.Array) -> list[bytes]:
    """The same as ``to_pylist``, in a twentieth of its time."""
    return words.to_numpy(zero_copy_only=False).tolist()


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of some texts (as ``words_of`` gives them) with the end after each text's, as numbers;
    how many each text has; what the numbers stand for."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, owner = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    # White space at either side of a text leaves an empty word there.
    some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    coded = words.cast(pa.binary()).filter(pa.array(some)).dictionary_encode()
    owner, names = owner[some], pa.concat_arrays([coded.dictionary, pa.array([END], pa.binary())])
    numbers = np.full(len(owner) + len(texts), len(names) - 1)
    numbers[np.arange(len(owner)) + owner] = coded.indices.to_numpy()
    return numbers, np.bincount(owner, minlength=len(texts)) + 1, names


def word_table(docs: DataFrame) -> DataFrame:
    """``word, c``: every distinct word of all texts and the end, with its count in training
    texts (0 where it occurs in others only). Counted per task before the shuffle."""

    def added_up(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns({"c_sum": "c"}).select(["word", "c"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for part in parts:
            numbers, tokens, names = tokens_of(part.column("text"))
            train = part.column("train").to_numpy(zero_copy_only=False).astype(bool)
            c = np.bincount(numbers[np.repeat(train, tokens)], minlength=len(names))
            held.append(pa.table([names, pa.array(c, pa.int64())], ["word", "c"]))
            if sum(map(len, held)) > 2 * HELD_WORDS:
                held = [added_up(held)]
                if len(held[0]) > HELD_WORDS:
                    yield from held.pop().to_batches()
        if held:
            yield from added_up(held).to_batches()

    seen = docs.select("text", trains("doc_id").alias("train")).mapInArrow(run, "word binary, c long")
    return seen.groupBy("word").agg(F.sum("c").alias("c"))


def powers(place: np.ndarray) -> np.ndarray:
    """Odd multiplier for each place in a word."""
    x = (place.astype(np.uint64) + np.uint64(1)) * K1
    return (x ^ (x >> np.uint64(31))) * K2 | np.uint64(1)


class Bits:
    """The coded bytes of a batch of words, flattened, with their six context hashes."""

    def __init__(self, words: list[bytes]):
        coded = [w if w == END else w + b" " for w in words]
        self.lengths = np.array([len(w) for w in coded])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(coded), np.uint8)
        self.word = np.repeat(np.arange(len(coded)), self.lengths)
        self.place = np.arange(len(self.data)) - self.starts.take(self.word)
        self.use(np.arange(len(self.data)))

    def use(self, at: np.ndarray) -> None:
        """Make the bytes ``at`` those whose bits are coded."""
        place = self.place.take(at)
        self.byte = self.data.take(at).astype(np.intp)
        salt = lambda i, x: (x + np.uint64(i + 1)) * K1
        contexts, value = [salt(0, np.minimum(place, 20).astype(np.uint64))], np.zeros(len(at), np.uint64)
        for k in range(4):
            previous = np.where(place > k, self.data.take(at - k - 1, mode="wrap"), np.uint8(0))
            value = value * np.uint64(257) + previous + np.uint64(1)
            contexts.append(salt(k + 1, value))
        # Hash of the word so far: differences of a running sum, mixed by place in the word.
        terms = (self.data + np.uint64(1)) * powers(np.arange(self.lengths.max(initial=0))).take(self.place)
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        contexts.append(salt(5, (running.take(at) - running.take(at - place)) * K2 + place.astype(np.uint64)))
        mixed = np.stack(contexts)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * K2
        self.hashes = (mixed >> np.uint64(32)).astype(np.uint32)

    def slots(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For bit ``k`` (7 first): slots of the six contexts (one row each), and the bits."""
        return slots_of(self.hashes, self.byte, k)


def slots_of(hashes: np.ndarray, byte: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    rows = (hashes ^ NODES.take((byte | 256) >> (k + 1))) & np.uint32(SLOTS - 1)
    return rows.astype(np.intp), byte >> k & 1


class Beginnings(Bits):
    """The same, with the bits that neighbours have in common, since they begin alike, once: whatever
    looks no further back than the word's start is the same for both. Sorted words share most."""

    def use(self, at: np.ndarray) -> None:
        # What each byte has unlike the byte at its place in the word before; 256 from the first such byte on.
        before = np.concatenate([[0], self.lengths[:-1]]).take(self.word)
        unlike = np.where(self.place < before, self.data ^ self.data.take(at - before, mode="wrap"), np.int16(256))
        earlier = np.cumsum(unlike != 0) - (unlike != 0)
        unlike[earlier > earlier.take(self.starts).take(self.word)] = 256
        # By place, then word: a bit in common has the same bit of the nearest word before it that doesn't have it so.
        order = np.argsort(self.place.astype(np.uint32), kind="stable")
        self.owner, unlike = self.word.take(order), unlike.take(order)
        self.new = np.flatnonzero(unlike)
        self.unlike = unlike.take(self.new)
        super().use(order.take(self.new))

    def bits(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slots and bits as ``slots`` gives them, each once, and its place among all bytes: it
        stands for these up to the next one's."""
        own = np.flatnonzero(self.unlike >> k)
        return *slots_of(self.hashes.take(own, axis=1), self.byte.take(own), k), self.new.take(own)


class Mixer:
    """Tables of counts (context, slot, bit), gate weights and refinement."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.weights = np.full((GATES, CONTEXTS), 0.3)
        self.seen = np.zeros((LEVELS, 8, 2))
        self.refine = np.full((LEVELS, 8), np.nan)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def table(self, without: int) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of every slot (context, slot, actual bit) and its gate (last context),
        with ``without`` occurrences of the actual bit taken out. Filled once a task."""
        if without not in self.tables:
            full = self.counts.astype(np.float32)
            less = np.maximum(full - np.float32(without), 0)
            log, log_less = np.log(full + np.float32(PRIOR)), np.log(less + np.float32(PRIOR))
            odds = np.stack([log[:, :, 1] - log_less[:, :, 0], log_less[:, :, 1] - log[:, :, 0]], axis=2)
            total = np.stack([less[-1, :, 0] + full[-1, :, 1], full[-1, :, 0] + less[-1, :, 1]], axis=1)
            self.tables[without] = odds.ravel(), ((total > 0).astype(np.int8) + (total > 30)).ravel()
        return self.tables[without]

    def inputs(self, slots: np.ndarray, bit: np.ndarray, without: int) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of the six predictors and the gate (0 to 2, within the bit number)."""
        odds, gates = self.table(without)
        at = slots * 2 + bit
        x = np.empty(at.shape, np.float32)
        for i, own in enumerate(odds.reshape(CONTEXTS, -1)):
            own.take(at[i], out=x[i], mode="clip")
        return x, gates.take(at[-1]).astype(np.intp)

    def mix(self, x: np.ndarray, gate: np.ndarray, k: int) -> np.ndarray:
        own = np.ascontiguousarray(self.weights[k * 3 : k * 3 + 3].T, np.float32)
        odds = own[0].take(gate) * x[0]
        for i in range(1, CONTEXTS):
            odds += own[i].take(gate) * x[i]
        return np.clip(odds, -13, 13)

    @staticmethod
    def level(odds: np.ndarray) -> np.ndarray:
        return np.clip(np.round(odds * 2) + LEVELS // 2, 0, LEVELS - 1).astype(np.intp)

    def learn(self, words: list[bytes], weight: np.ndarray, step: float) -> None:
        """One online step per bit number: what came true at each level of mixed log-odds is
        added up, then each gate's weights move along their gradient, each by its own curvature."""
        bits = Beginnings(words)
        each = weight[bits.owner]
        for k in range(7, -1, -1):
            slots, bit, at = bits.bits(k)
            share = np.add.reduceat(each, at)
            x, gate = self.inputs(slots, bit, 1)
            odds = self.mix(x, gate, k)
            self.seen[:, k] += np.bincount(self.level(odds) * 2 + bit, share, LEVELS * 2).reshape(LEVELS, 2)
            p = 1 / (1 + np.exp(-odds))
            mine = np.where(gate == np.arange(3)[:, None], share, 0.0)
            mass = mine.sum(axis=1)[:, None] + 1e-9
            x = x.T.astype(float)
            slope = (mine * (bit - p)) @ x
            bend = (mine * (p * (1 - p))) @ (x * x)
            self.weights[k * 3 : k * 3 + 3] += np.clip(step * slope / (bend + DAMP * mass), -0.1, 0.1)

    def score(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word with the space that closes it, or of the end."""
        bits = Beginnings(words)
        out = np.zeros(len(bits.owner))
        # By level, for bits 0 and 1: the refined probability of the bit that came is
        # ``share`` times the mixed one and ``half``.
        refine = np.stack([1 - self.refine, self.refine], axis=1).astype(np.float32)
        share, half = np.where(np.isnan(refine), np.float32(1), np.float32(0.5)), np.nan_to_num(refine) / 2
        for k in range(8):
            slots, bit, places = bits.bits(k)
            x, gate = self.inputs(slots, bit, 0)
            odds = self.mix(x, gate, k)
            at = self.level(odds) * 2 + bit
            p = 1 / (1 + np.exp(np.where(bit == 1, -odds, odds)))
            p = np.clip(share[:, :, k].ravel().take(at) * p + half[:, :, k].ravel().take(at), FLOOR, 1 - FLOOR)
            out += np.repeat(np.log(p), np.diff(places, append=len(out)))
        return np.bincount(bits.owner, out, len(words)) / math.log(10)


def in_batches(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    for part in parts:
        words, c = bytes_of(part.column(0)), part.column(1).to_numpy().astype(float)
        for i in range(0, len(words), BATCH):
            yield words[i : i + BATCH], c[i : i + BATCH]


def joined(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, ``BATCH`` of them or more at a time."""
    held: list[pa.RecordBatch] = []
    for part in parts:
        held.append(part)
        if sum(x.num_rows for x in held) >= BATCH:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def count_bits(counts: np.ndarray, words: list[bytes], weight: np.ndarray) -> None:
    """Add to ``counts`` (by context, slot and bit, flat) the bits of words that occur ``weight`` times."""
    bits = Beginnings(words)
    each = weight[bits.owner]
    for k in range(8):
        slots, bit, at = bits.bits(k)
        share = np.add.reduceat(each, at)
        for i, own in enumerate(slots):
            np.add.at(counts[i * 2 * SLOTS : (i + 1) * 2 * SLOTS], own * 2 + bit, share)


def learn_counts(words: DataFrame) -> np.ndarray:
    """Bit counts of all training words. Tasks count into whole tables and pass on the slots
    in use; the sum has at most ``CONTEXTS * SLOTS`` rows, whatever the corpus."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((CONTEXTS * SLOTS, 2))
        flat = counts.reshape(-1)
        for batch, c in in_batches(joined(parts)):
            count_bits(flat, batch, c)
        used = np.flatnonzero(counts.any(axis=1))
        for i in range(0, len(used), 50_000):
            part = used[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(counts[part, 0]), pa.array(counts[part, 1])], ["slot", "n0", "n1"])

    sums = words.where("c > 0").mapInArrow(run, "slot int, n0 double, n1 double").groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    rows = sums.toArrow()
    out = np.zeros((CONTEXTS * SLOTS, 2))
    at = rows.column("slot").to_numpy()
    out[at, 0], out[at, 1] = rows.column("n0").to_numpy(), rows.column("n1").to_numpy()
    return out.reshape(CONTEXTS, SLOTS, 2)


def fit(words: DataFrame) -> Mixer:
    """Tables, then weights and refinement: two passes over the training words. Each task
    of the second returns one small array, and these are averaged (weights) or added."""
    known = words.where("c > 0")
    mixer = Mixer(learn_counts(words))
    shared = words.sparkSession.sparkContext.broadcast(mixer.counts.astype(np.float32))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = Mixer(shared.value), 0.0
        for i, (batch, c) in enumerate(in_batches(parts)):
            own.learn(batch, c, RATE / math.sqrt(1 + i / 20))
            total += c.sum()
        if total:
            flat = np.concatenate([own.weights.ravel() * total, own.seen.ravel(), [total]])
            yield pa.RecordBatch.from_arrays([pa.array(range(flat.size), pa.int32()), pa.array(flat)], ["i", "x"])

    size = GATES * CONTEXTS
    sums = np.zeros(size + LEVELS * 8 * 2 + 1)
    for i, x in known.mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x")).collect():
        sums[i] = x
    if sums[-1]:
        mixer.weights = (sums[:size] / sums[-1]).reshape(GATES, CONTEXTS)
    seen = sums[size:-1].reshape(LEVELS, 8, 2)
    mixer.refine = np.where(seen.sum(axis=2) > 0, (seen[:, :, 1] + PRIOR) / (seen.sum(axis=2) + 2 * PRIOR), np.nan)
    mixer.shared = shared
    return mixer


def scored_words(words: DataFrame, mixer: Mixer, total: int, distinct: int) -> DataFrame:
    """``word, known, base, mix`` of every distinct word."""
    shared, learned, refine = mixer.shared, mixer.weights, mixer.refine
    below = math.log10(total + 0.5 * (distinct + 1))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Mixer(shared.value)
        own.weights, own.refine = learned, refine
        for batch, c in in_batches(joined(parts)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch, pa.binary()), pa.array(c.astype(np.int64)), pa.array((c > 0).astype(np.int64)), pa.array(np.log10(c + 0.5) - below), pa.array(own.score(batch))],
                ["word", "c", "known", "base", "mix"],
            )

    return materialize(words.mapInArrow(run, "word binary, c long, known long, base double, mix double"), "words")


def with_frequencies(table: DataFrame, total: int) -> DataFrame:
    """``mix`` of each word mixed with its relative frequency; the weight is the best of
    ``WEIGHTS`` over all training words, found in one aggregation."""
    if not total:
        return table

    def mixed(weight: float, c: Column, n: int) -> Column:
        return F.log10(weight * c / float(max(n, 1)) + (1 - weight) * F.pow(F.lit(10.0), "mix"))

    sums = table.where("c > 0").agg(*[F.sum(F.col("c") * mixed(w, F.col("c") - 1, total - 1)) for w in WEIGHTS]).first()
    weight = max(zip(sums, WEIGHTS))[1]
    return table.withColumn("mix", mixed(weight, F.col("c"), total))


def order_of(keys: np.ndarray) -> np.ndarray:
    """Places of small non-negative keys in their order, equal ones as they come."""
    bits = len(keys).bit_length()
    return np.sort(keys << bits | np.arange(len(keys))) & ((1 << bits) - 1)


def foretold(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of some texts (``text`` is the number of its text): whether the match
    predictor expects one, whether it comes, and the step of the words foretold in a row
    before it. Texts must end with a word that they hold once."""
    n = len(ids)
    open_, hit, run = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, np.intp)
    low = ids.min(initial=0)
    before = (ids - low + text * (ids.max(initial=0) - low + 1))[:-1]
    order = order_of(before)
    again = np.flatnonzero(before[order[1:]] == before[order[:-1]])
    here, last = order[again + 1] + 1, order[again] + 1
    open_[here] = True
    hit[here] = ids[last] == ids[here]
    at = np.arange(n)
    since = at - np.maximum.accumulate(np.where(hit, -1, at))
    run[1:] = since[:-1]
    return open_, hit, np.searchsorted(MATCHED, run, side="right")


def again_rare(ids: np.ndarray, left: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of some texts (rare ones have negative ids, of one text each): step of
    the rare words before it in its text (0: none), whether it is one of these, and its log10
    share by their counts so far where it is and ``left`` is true (0 elsewhere)."""
    rare = ids < 0
    so_far = np.cumsum(rare) - rare
    so_far -= so_far[np.searchsorted(text, text)]
    back, share = np.zeros(len(ids), bool), np.zeros(len(ids))
    at = np.flatnonzero(rare)
    if len(at):
        order = at[order_of(-1 - ids[at])]
        new = np.concatenate([[True], ids[order[1:]] != ids[order[:-1]]])
        place = np.arange(len(order))
        count = place - np.maximum.accumulate(np.where(new, place, 0))
        back[order] = count > 0
        used = (count > 0) & left[order]
        share[order[used]] = np.log10(count[used] / so_far[order[used]])
    return np.searchsorted(RARE, so_far, side="right"), back, share


def score(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte``.

    Null and blank texts are one token, the end. Documents without id are scored and not
    learned from. ``score`` is the log10 probability of the words and the end under the
    mixing model, ``bits_per_byte`` the same in bits over the coded bytes. Without any
    training document the base is log10 of 0.5 / 0.5 (V = N = 0) per token and the model
    is that of empty tables, with even odds for both adaptive predictors. Repeated rows
    are scored alike.

    Common words are looked up in the document's own task (at most ``COMMON``, so the
    table sent along is bounded); the others are joined, summed per row. The same words are
    the common ones of the adaptive predictors.
    """
    words = materialize(word_table(docs).sortWithinPartitions("word"), "counts")
    total, distinct = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    table = with_frequencies(scored_words(words, fit(words), total, distinct), total)
    top = table.orderBy(F.desc("c"), "word").limit(COMMON).select("word", "c", "known", "base", "mix").toArrow()
    common = top.column("word").to_pylist()
    c, known, base, mix = (top.column(c).to_numpy().astype(float) for c in ("c", "known", "base", "mix"))
    spark = docs.sparkSession.sparkContext
    sent = spark.broadcast((common, known, base))
    steps = len(MATCHED) + len(RARE) + 1
    names_of = ["doc_id", "train", "n_tokens", "n_bytes", "known", "base", "mix", "came", "failed", "rare", "words"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {w: i for i, w in enumerate(sent.value[0])}.get
        _, known, base = sent.value
        for part in parts:
            numbers, tokens, names = tokens_of(part.column("text"))
            n, text = len(tokens), np.repeat(np.arange(len(tokens)), tokens)
            sizes = np.bincount(text, pc.binary_length(names).to_numpy().take(numbers), n).astype(np.int64) + tokens - 1
            distinct = bytes_of(names)
            places = np.fromiter(map(get, distinct, repeat(-1)), np.int64, len(distinct))
            ids = places.take(numbers)
            # Rare words are numbered anew in each text.
            at = np.flatnonzero(ids < 0)
            _, new, again = np.unique(text[at] * len(names) + numbers[at], return_index=True, return_inverse=True)
            order = np.argsort(new)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            ids[at] = -1 - rank[again]
            rare = at[new[order]]
            first = np.concatenate([[0], np.cumsum(np.bincount(text[rare], minlength=n))])
            hashes = np.zeros(len(names), np.int64)
            unnamed = np.flatnonzero(places < 0)
            hashes[unnamed] = [crc32(distinct[i]) for i in unnamed.tolist()]
            expected, hit, run_step = foretold(ids, text)
            rare_step, back, share = again_rare(ids, ~hit, text)
            asked = ~hit & (rare_step > 0)
            step = np.concatenate([run_step[expected], rare_step[asked] + len(MATCHED)]) + steps * np.concatenate([text[expected], text[asked]])
            yes = np.bincount(step, np.concatenate([hit[expected], back[asked]]), steps * n).astype(np.int32)
            no = np.bincount(step, minlength=steps * n).astype(np.int32) - yes
            static, common = ~(hit | back), ids >= 0
            sums = [np.bincount(text[common], v[ids[common]], n) for v in (known, base)]
            words = ids.copy()
            words[~common] = OTHER | hashes[numbers[~common]] >> 3
            words = np.split(np.where(static, words, ~words).astype(np.int32), np.cumsum(tokens))[:n]
            times = [np.bincount(-1 - ids[m], minlength=len(rare)) for m in (~common, ~common & static)]
            rare = pa.StructArray.from_arrays([names.take(pa.array(numbers[rare])), *map(pa.array, times)], ["word", "n", "m"])
            whole = pa.array(np.arange(n + 1, dtype=np.int32) * steps)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("train"), pa.array(tokens, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums[0].astype(np.int64)),
                    pa.array(sums[1]), pa.array(np.bincount(text, share, n)), pa.ListArray.from_arrays(whole, yes), pa.ListArray.from_arrays(whole, no),
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), rare), pa.array([w.tobytes() for w in words], pa.binary()),
                ],
                names_of,
            )

    rows = docs.select(F.col("doc_id").cast("long"), trains("doc_id").alias("train"), "text").mapInArrow(
        run,
        "doc_id long, train boolean, n_tokens long, n_bytes long, known long, base double, mix double, "
        "came array<int>, failed array<int>, rare array<struct<word:binary,n:long,m:long>>, words binary",
    )
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    seen = rows.where("train").agg(*[F.coalesce(F.sum(F.col(c)[i]), F.lit(0)) for c in ("came", "failed") for i in range(steps)]).first()
    adaptive = F.lit(0.0)
    for i, (yes, no) in enumerate(zip(seen[:steps], seen[steps:])):
        p = (yes + 0.5) / (yes + no + 1)
        adaptive = adaptive + F.col("came")[i] * math.log10(p) + F.col("failed")[i] * math.log10(1 - p)
    rare = rows.select("row", F.inline("rare")).join(table.select("word", F.col("known").alias("k"), F.col("base").alias("b"), F.col("mix").alias("x")), "word")
    sums = rare.groupBy("row").agg(*[F.sum(F.col(times) * F.col(c)).alias(c) for times, c in (("n", "k"), ("n", "b"), ("m", "x"))])
    coder = Coder(common, c, mix, int(total))
    coding, tables = learned(rows.where("train"), coder)
    weights, refine = coder.weights, coder.refine
    kept = rows.select("row", "doc_id", "train", "n_tokens", "n_bytes", "known", "base", (F.col("mix") + adaptive).alias("mix"), "words")

    def code(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy(coding.value)
        own.weights, own.refine = weights, refine
        for part in parts:
            words, first = flat(part.column("words"))
            sums = np.add.reduceat(own.score(words, first, tables.value), first) if len(first) else np.zeros(0)
            columns = part.columns[:-1]
            columns[-1] = pa.array(columns[-1].to_numpy(zero_copy_only=False) + sums)
            yield pa.RecordBatch.from_arrays(columns, part.schema.names[:-1])

    both = kept.mapInArrow(code, kept.drop("words").schema).join(sums, "row", "left")
    add = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return both.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", add("known", "k").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), add("base", "b").alias("base_score"), add("mix", "x").alias("score"),
        (-add("mix", "x") * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"),
    )
