"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are rates over a text's words and characters: hits of a lexicon of words and of
a lexicon of word beginnings, hits near second-person words, second-person words,
capitals, punctuation and disguised spellings. The lexicons are learned: terms found in
toxic texts far more often than chance allows. Trees and calibration are fitted on
different labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtext.sources.shared import materialize

# Bounds of what is learned from: labelled rows (chosen by a hash of their id), terms
# of toxic texts that are counted in the others, and terms kept.
MAX_LABELLED = 60_000
MAX_CANDIDATES = 50_000
MAX_TERMS = 5_000
TREES, DEPTH = 20, 3
NEAR = 4
# Second-person words of the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu toi te ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "usted ustedes ti tus vosotros vuestro".split()
)
# Characters that stand for letters in disguised spellings.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "+": "t", "|": "l"})
EDGE = ".,;:!?\"'()[]{}<>-_«»“”‘’…¡¿"
FEATURES = (
    "word_hits", "start_hits", "any_hits", "has_hit", "near_second_person", "second_person", "all_capitals",
    "capitals", "exclamations", "questions", "punctuation", "disguised", "disguised_hits",
)
WORD_HIT, START_HIT, SECOND, CAPITALS, DISGUISED, DISGUISED_HIT = 1, 2, 4, 8, 16, 32


def fold(key: str | Column) -> Column:
    """crc32 of the id as text, modulo 5; null ids have none."""
    return (F.crc32(F.col(key).cast("string").cast("binary")) % 5).cast("int")


def forms(word: str) -> tuple[str, str]:
    """A word in lower case without punctuation at its edges, and with disguises undone."""
    plain = word.strip(EDGE).lower()
    return plain, plain.translate(DISGUISE) if not plain.isalpha() and any(c.isalpha() for c in plain) else plain


def terms(word: str) -> list[str]:
    """Lexicon terms of a word: itself and its first 4, 5 and 6 characters (``^``)."""
    plain, clear = forms(word)
    found = {plain, clear}
    found.update(f"^{w[:n]}" for w in (plain, clear) for n in (4, 5, 6) if len(w) > n)
    return [t for t in found if len(t) > 2]


class Codes(dict):
    """Bits of each word under a lexicon; forgets all when it has grown large."""

    def __init__(self, lexicon: frozenset[str]):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        plain, clear = forms(word)
        lexicon = self.lexicon
        code = 0
        for w in {plain, clear}:
            hit = (w in lexicon) * WORD_HIT | any(len(w) > n and f"^{w[:n]}" in lexicon for n in (4, 5, 6)) * START_HIT
            code |= hit | (DISGUISED_HIT if hit and w != plain else 0)
        code |= (plain in SECOND_PERSON) * SECOND | (len(plain) > 2 and word.isupper()) * CAPITALS | (clear != plain) * DISGUISED
        self[word] = code
        return code


def features_of(text: str | None, codes: Codes) -> list[float]:
    """Values of ``FEATURES``; all 0 for null, empty and blank texts."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    bits = np.frombuffer(bytes(map(codes.__getitem__, words)), np.uint8)
    n = len(bits)
    hit = (bits & (WORD_HIT | START_HIT)) > 0
    second = (bits & SECOND) > 0
    total = np.concatenate([[0], np.cumsum(second)])
    at = np.arange(n)
    near = total[np.minimum(at + NEAR + 1, n)] - total[np.maximum(at - NEAR, 0)] > 0
    bytes_ = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    length = bytes_.sum()
    upper, lower = bytes_[65:91].sum(), bytes_[97:123].sum()
    marks = bytes_[33:48].sum() + bytes_[58:65].sum() + bytes_[91:97].sum() + bytes_[123:127].sum()
    rate = lambda mask: float(np.count_nonzero(mask)) / n
    return [
        rate(bits & WORD_HIT), rate(bits & START_HIT), rate(hit), float(hit.any()), rate(hit & near), rate(second),
        rate(bits & CAPITALS), float(upper / max(1, upper + lower)), float(bytes_[33] / length),
        float(bytes_[63] / length), float(marks / length), rate(bits & DISGUISED), rate(bits & DISGUISED_HIT),
    ]


HELD: dict[frozenset, Codes] = {}


def features(text: str | Column, lexicon: frozenset[str]) -> Column:
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if lexicon not in HELD:
            HELD.clear()
            HELD[lexicon] = Codes(lexicon)
        for part in parts:
            yield pa.array([features_of(t, HELD[lexicon]) for t in part.to_pylist()], pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>")(text)


def term_counts(docs: DataFrame, only: frozenset[str] | None = None) -> DataFrame:
    """``term, n``: in how many texts each term occurs; summed per batch before the shuffle."""
    schema = pa.schema([("term", pa.string()), ("n", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            counts: dict[str, int] = {}
            for text in part.column(0).to_pylist():
                found = {t for w in set((text or "").split()) for t in terms(w)}
                for t in found if only is None else found & only:
                    counts[t] = counts.get(t, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=schema)

    return docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def evidence(n1: int, n0: int, toxic: int, clean: int) -> float:
    """Twice the log-likelihood ratio for a term that is commoner in toxic texts, else 0."""
    share = toxic / (toxic + clean)
    n = n1 + n0
    if n1 <= n * share:
        return 0.0
    return 2 * (n1 * math.log(n1 / (n * share)) + (n0 * math.log(n0 / (n * (1 - share))) if n0 else 0.0))


def learn_lexicon(rows: DataFrame, toxic: int, clean: int) -> frozenset[str]:
    """Terms whose evidence is beyond what chance gives the best of that many terms."""
    seen = term_counts(rows.where("toxic = 1"))
    common = seen.where("n > 2").orderBy(F.desc("n"), "term").limit(MAX_CANDIDATES).collect()
    if not common:
        return frozenset()
    least = 2 * math.log(len(common) + 1000)
    others = {r["term"]: r["n"] for r in term_counts(rows.where("toxic = 0"), frozenset(r["term"] for r in common)).collect()}
    scored = [(evidence(r["n"], others.get(r["term"], 0), toxic, clean), r["term"]) for r in common]
    strong = sorted([(-e, t) for e, t in scored if e > least])
    return frozenset(t for _, t in strong[:MAX_TERMS])


class Model:
    """``fit`` on labelled rows ``doc_id, text, toxic``; ``score`` any documents.

    With fewer than five rows of either label in the trees' or the calibration's part,
    the score is the share of toxic rows among those given (0 without rows) for all.
    """

    def fit(self, rows: DataFrame) -> Model:
        rows = materialize(rows.select("doc_id", "text", "toxic"), "labelled")
        held = (F.xxhash64("doc_id") % 4 == 0).alias("held")
        counts = {(r["held"], r["toxic"]): r["n"] for r in rows.groupBy(held, "toxic").agg(F.count("*").alias("n")).collect()}
        toxic, clean = (sum(n for (_, t), n in counts.items() if t == label) for label in (1, 0))
        self.share = toxic / (toxic + clean) if toxic + clean else 0.0
        self.trees = None
        if min(counts.get((h, t), 0) for h in (True, False) for t in (0, 1)) < 5:
            return self
        self.lexicon = learn_lexicon(rows, toxic, clean)
        parts = materialize(rows.select(held, F.col("toxic").cast("double").alias("label"), features("text", self.lexicon).alias("x")), "features")
        parts = parts.withColumn("features", array_to_vector("x"))
        self.trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1).fit(parts.where("not held"))
        self.curve = IsotonicRegression(featuresCol="margin").fit(self.margin(parts.where("held")))
        return self

    def margin(self, df: DataFrame) -> DataFrame:
        out = self.trees.transform(df)
        return out.withColumn("margin", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "probability", "prediction")

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``toxicity`` (0 to 1). Null and empty texts are scored by their
        features, which are all 0. Nothing is shuffled."""
        if self.trees is None:
            return docs.withColumn("toxicity", F.lit(self.share))
        row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), features("text", self.lexicon).alias("x"))
        out = self.curve.transform(self.margin(row.withColumn("features", array_to_vector("x"))))
        # Where the calibration curve is flat, a thousandth of the score keeps the trees' order.
        slope = 1 / (1 + F.exp(-2 * F.col("margin")))
        return out.select("row.*", (F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)) * 0.999 + slope * 0.001).alias("toxicity"))


def labelled(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """Texts with labels 0 and 1, of ids outside fold 0; about ``limit`` rows at most,
    chosen by a hash of the id. The largest label of an id counts.

    The chosen labels are few by that bound, so they are broadcast and texts stay put.
    """
    chosen = labels.where("toxic in (0, 1) and doc_id is not null").withColumn("_fold", fold("doc_id")).where("_fold <> 0")
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = chosen.count()
    if n > limit:
        chosen = chosen.where(F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id"), 12) < int(limit / n * (1 << 52)))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    return Model().fit(labelled(docs, labels, limit))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` whose toxicity is below ``threshold``."""
    return train(docs, labels).score(docs).where(F.col("toxicity") < threshold).select(*docs.columns)
