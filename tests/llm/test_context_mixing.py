"""The language model: base scores against a plain count, and what a probability must be."""

import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from webtext.llm.context_mixing import CONTEXTS, END, MATCHED, RARE, SLOTS, Mixer, again_rare, foretold, score
from webtext.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


def check_base(rows, got):
    """``rows``: pairs of id and text; one id has one text."""
    trains = {i: i is not None and zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows}
    c = Counter(t for i, x in rows if trains[i] for t in tokens(x))
    n, v = sum(c.values()), len(c)
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    rows = dict(rows)
    for r in got:
        own = tokens(rows[r["doc_id"]])
        base = sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        assert r["held_out"] == (not trains[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(c[t] > 0 for t in own), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op10_context_mixing"](spark, SF).collect()
    check_base(rows, got)
    held = [r for r in got if r["held_out"]]
    # The base gives each unknown word the same share without spelling it, so it is no distribution over
    # texts; the model, which is one, must come near it and know texts it has not learned from.
    assert sum(r["score"] for r in held) > 1.15 * sum(r["base_score"] for r in held)
    assert sum(r["bits_per_byte"] for r in held) / len(held) < 3
    assert all(r["score"] < 0 for r in got)


def test_odd_rows(odd, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = score(odd).collect()
    assert len(got) == odd.count()
    check_base(rows, got)
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4, 5)}) == 1
    assert score(no_docs).count() == 0


def test_bits_sum_to_one():
    """Probabilities of all first bytes sum to 1 for any tables, weights and refinement."""
    rng = np.random.default_rng(3)
    mixer = Mixer(rng.integers(0, 50, (CONTEXTS, SLOTS, 2)).astype(float))
    mixer.weights = rng.normal(0, 0.4, mixer.weights.shape)
    mixer.refine = rng.uniform(0, 1, mixer.refine.shape)
    # A word of one byte is that byte and a space; the space's share is taken out by the sum over second bytes.
    two = [bytes(p) for p in product(range(256), repeat=2) if p[1] != 32]
    first = {}
    for w, s in zip(two, 10 ** mixer.score(two)):
        first[w[:1]] = first.get(w[:1], 0.0) + s
    assert len(first) == 256 and all(x < 1 for x in first.values()) and sum(first.values()) < 1


def test_learning_helps():
    words = [b"banana", b"bandana", b"cabana", END]
    weight = np.array([5.0, 3.0, 2.0, 4.0])
    counts = np.zeros((CONTEXTS, SLOTS, 2))
    from webtext.llm.context_mixing import Bits

    bits = Bits(words)
    for k in range(8):
        slots, bit = bits.slots(k)
        for i in range(CONTEXTS):
            np.add.at(counts[i], (slots[i], bit), weight[bits.word])
    mixer = Mixer(counts)
    before = (mixer.score(words) * weight).sum()
    for i in range(20):
        mixer.learn(words, weight, 0.3)
    assert (mixer.score(words) * weight).sum() > before
    assert mixer.score([b"banana"])[0] > mixer.score([b"qzxwvk"])[0] + 5


def adaptive_plainly(ids):
    """Steps and outcomes of both adaptive predictors, and the log10 shares, word by word."""
    follows, counts, run, rare = {}, Counter(), 0, 0
    match, again, share = [], [], 0.0
    for j, w in enumerate(ids):
        before = ids[j - 1] if j else None
        hit = None
        if before in follows:
            hit = follows[before] == w
            match.append((sum(run >= s for s in MATCHED), hit))
        if not hit:
            if rare:
                again.append((sum(rare >= s for s in RARE), counts[w] > 0))
            if counts[w]:
                share += math.log10(counts[w] / rare)
        run = run + 1 if hit else 0
        if w < 0:
            counts[w] += 1
            rare += 1
        if j:
            follows[before] = w
    return sorted(match), sorted(again), share


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), max_size=30), min_size=1, max_size=4))
def test_adaptive_predictors_equal_a_plain_reading(texts):
    """Several texts at once equal each read alone; rare ids are those of one text, 9 ends each."""
    texts = [[w - 3 * i if w < 0 else w for w in t] + [9] for i, t in enumerate(texts)]
    ids, text = np.array(sum(texts, [])), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    expected, hit, run = foretold(ids, text)
    step, back, share = again_rare(ids, ~hit, text)
    asked = ~hit & (step > 0)
    for i, t in enumerate(texts):
        match, again, plain = adaptive_plainly(t)
        here = text == i
        assert sorted(zip(run[expected & here].tolist(), hit[expected & here].tolist())) == match
        assert sorted(zip(step[asked & here].tolist(), back[asked & here].tolist())) == again
        assert math.isclose(share[here].sum(), plain, abs_tol=1e-9)


def test_word_order_counts(spark):
    """A text that says things again is likelier than the same words shuffled."""
    rng = np.random.default_rng(5)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()]
    said, mixed_up = [], []
    for i in range(20):
        line = " ".join(rng.permutation((rows[i][1] or "").split()[:30]))
        words = f"{line} {line} {line}".split()
        said.append((10**9 + i, " ".join(words)))
        mixed_up.append((2 * 10**9 + i, " ".join(rng.permutation(words))))
    got = {r.doc_id: r.score for r in score(spark.createDataFrame(rows + said + mixed_up, "doc_id long, text string")).collect()}
    assert all(got[a] > got[b] for (a, _), (b, _) in zip(said, mixed_up))


def test_word_order_of_other_documents_counts(spark):
    """A text without any repetition is likelier in the order that other documents have learned."""
    rng = np.random.default_rng(6)
    names = [f"w{i}" for i in range(400)]
    lines = [[names[j] for j in rng.permutation(400)[:12]] for _ in range(20)]
    rows = [(i, " ".join(lines[i % 20])) for i in range(400)]
    held = [i for i in range(10**6, 10**6 + 400) if zlib.crc32(str(i).encode()) % 5 == 1][:40]
    said = [(i, " ".join(lines[j])) for j, i in enumerate(held[:20])]
    mixed_up = [(i, " ".join(rng.permutation(lines[j]))) for j, i in enumerate(held[20:])]
    got = {r.doc_id: r for r in score(spark.createDataFrame(rows + said + mixed_up, "doc_id long, text string")).collect()}
    for (a, _), (b, _) in zip(said, mixed_up):
        assert got[a].held_out and got[b].held_out
        assert math.isclose(got[a].base_score, got[b].base_score, rel_tol=1e-9)
        assert got[a].score > got[b].score + 2


def test_words_after_any_context_sum_to_one():
    """Whatever the tables and weights hold, the leaves of the tree share out all probability."""
    from webtext.llm.word_contexts import Coder, lines

    rng = np.random.default_rng(4)
    count = np.append(rng.integers(1, 90, 50), 0).astype(float)
    mix = np.log10(np.append(count[:-1] / count.sum() * 0.9, 0.01))
    coder = Coder([b"%03d" % i for i in range(51)], count, mix, 5000)
    tables = [lines(rng.integers(0, 9, 8 << coder.bits)) for _ in range(2)]
    coder.weights = rng.normal(0.4, 0.3, coder.weights.shape)
    up = rng.uniform(0, 1, len(coder.refine) // 2)
    coder.refine = np.concatenate([up, [0.5], 1 - up[::-1]])
    every = np.array([[~3, ~7, w] for w in [*range(50), 1 << 29 | 5]])
    got = coder.score(every.ravel(), np.arange(0, every.size, 3), tables).reshape(-1, 3)[:, 2]
    got[-1] -= coder.other
    assert math.isclose((10**got).sum(), 1, rel_tol=1e-4)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab z\xe9\x00\x1c　\x85\n\tA", max_size=12) | st.none(), max_size=6))
def test_tokens_are_words_and_ends(texts):
    from webtext.llm.common import words_of
    from webtext.llm.context_mixing import tokens_of

    numbers, tokens, names = tokens_of(pa.array(texts, pa.string()))
    names = names.to_pylist()
    assert len(set(names)) == len(names)
    assert [names[i] for i in numbers] == [w for t in texts for w in [*words_of(t), END]]
    assert tokens.tolist() == [len(words_of(t)) + 1 for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=6).map(lambda x: bytes(b"abz\xc3"[i % 4] for i in x)), min_size=1, max_size=30))
def test_bits_in_common_are_coded_once(words):
    """Counts, scores and steps are those of each word by itself; sorted words share all beginnings."""
    from webtext.llm.context_mixing import Beginnings, Bits, count_bits

    words = [*words, END]
    weight = np.arange(1.0, len(words) + 1)
    plain, counts = np.zeros((CONTEXTS, SLOTS, 2)), np.zeros(CONTEXTS * SLOTS * 2)
    bits = Bits(words)
    for k in range(8):
        slots, bit = bits.slots(k)
        for i in range(CONTEXTS):
            np.add.at(plain[i], (slots[i], bit), weight[bits.word])
    count_bits(counts, words, weight)
    assert (counts == plain.ravel()).all()
    order = sorted(words)
    once = Beginnings(order)
    paths = ["".join(f"{b:08b}" for b in (w if w == END else w + b" ")) for w in order]
    assert sum(len(once.bits(k)[1]) for k in range(8)) == len({p[:i] for p in paths for i in range(1, len(p) + 1)})
    mixer, other = Mixer(plain), Mixer(plain)
    alone = np.concatenate([mixer.score([w]) for w in words])
    assert np.allclose(mixer.score(words), alone, rtol=1e-6)
    mixer.learn(words, weight, 0.2)
    by_word = dict(zip(range(len(words)), words))
    mixed = sorted(by_word, key=lambda i: (by_word[i], i))
    other.learn([words[i] for i in mixed], weight[mixed], 0.2)
    assert np.allclose(mixer.weights, other.weights, atol=1e-6) and np.allclose(mixer.seen, other.seen)


def test_sorted_words_cost_their_new_bits():
    """CPU time of the predictors inside words goes with the bits that are coded."""
    from webtext.llm.context_mixing import Beginnings

    rng = np.random.default_rng(8)
    words = sorted({bytes(rng.integers(97, 123, 8).astype(np.uint8)) for _ in range(20_000)})[:2000]
    once, coded = Beginnings(words), sum(len(w) + 1 for w in words) * 8
    assert sum(len(once.bits(k)[1]) for k in range(8)) < 0.8 * coded


def test_levels_of_few_words_are_met_together():
    """Steps of few words cost few passes over the states, whatever the depth of the tree."""
    from webtext.llm.word_contexts import Coder, lines

    rng = np.random.default_rng(9)
    count = rng.integers(1, 90, 5000).astype(float)
    coder = Coder([b"%04d" % i for i in range(5000)], count, np.log10(count / count.sum() * 0.9), 5000)
    tables = [lines(rng.integers(0, 9, 8 << coder.bits)) for _ in range(2)]
    for _, leaf, deep, met in coder.paths(rng.integers(0, 5000, 500), np.array([0])):
        pieces = list(coder.bits_of(leaf, deep, met, tables))
        assert len(deep) > 9 and len(pieces) == 1
        assert len(pieces[0][0]) == len(pieces[0][1]) == deep.sum()
