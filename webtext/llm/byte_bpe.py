"""Byte-level BPE through a sentencepiece model written straight from a rank file.

A rank file lists tokens (byte strings) with their ranks. Each byte is mapped to one
character, so that every token is a piece; the score of a piece is its negative rank,
so sentencepiece merges in rank order. The model message is serialised here, with
identity normalisation, no dummy prefix and no treatment of white space. Texts are cut
into pre-tokens by the vocabulary's pattern; each pre-token is encoded by itself, and
one that is a token as a whole is that token.

Encoding and decoding happen in the document's own row: nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that stand for the 256 bytes: U+0100 to U+01FF.
FIRST_CHAR = 0x100
# Field numbers and values of the sentencepiece model message (fixed values).
PIECE, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, BPE = 1, 2, 2
# Distinct pre-tokens that a worker remembers; beyond that it forgets them all and goes on.
REMEMBERED = 120_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in rank order; ranks must be 0, 1, 2 …"""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError(f"ranks in {path} are not 0 to {len(tokens) - 1}")
    return [tokens[i] for i in range(len(tokens))]


def as_chars(data: bytes) -> str:
    return "".join([chr(FIRST_CHAR + b) for b in data])


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def number(field: int, value: int) -> bytes:
    return varint(field << 3) + varint(value)


def block(field: int, data: bytes) -> bytes:
    return varint(field << 3 | 2) + varint(len(data)) + data


def serialise(tokens: list[bytes]) -> bytes:
    """Model message whose piece ids are the ranks; the unknown piece comes last."""
    out = bytearray()
    for rank, token in enumerate(tokens):
        score = varint(2 << 3 | 5) + struct.pack("<f", -rank)
        out += block(PIECE, block(1, as_chars(token).encode()) + score + number(3, NORMAL))
    out += block(PIECE, block(1, b"<unk>") + varint(2 << 3 | 5) + struct.pack("<f", 0) + number(3, UNKNOWN))
    unknown = len(tokens)
    trainer = number(3, BPE) + number(4, unknown + 1) + number(40, unknown)
    trainer += number(41, -1) + number(42, -1) + number(43, -1)
    out += block(TRAINER, trainer)
    out += block(NORMALIZER, block(1, b"identity") + number(3, 0) + number(4, 0) + number(5, 0))
    return bytes(out)


class Encoder:
    """Encodes and decodes with one vocabulary; remembers pre-tokens it has met."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.cut = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        self.met: dict[str, bytes] = {}

    def learn(self, parts: set[str]) -> None:
        if len(self.met) + len(parts) > REMEMBERED:
            self.met = {}
        hard = []
        for p in parts:
            rank = self.ranks.get(p.encode("utf-8", "surrogatepass"))
            if rank is None:
                hard.append(p)
            else:
                self.met[p] = struct.pack("<I", rank)
        mapped = [as_chars(p.encode("utf-8", "surrogatepass")) for p in hard]
        for p, ids in zip(hard, self.model.encode(mapped, num_threads=1)):
            self.met[p] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; none for null."""
        parts = self.cut(text) if text else []
        new = set(parts).difference(self.met)
        if new:
            known = {p: self.met[p] for p in set(parts) - new} if len(self.met) + len(new) > REMEMBERED else {}
            self.learn(new)
            self.met.update(known)
        return b"".join([self.met[p] for p in parts])

    def decode(self, ids: bytes | None) -> bytes:
        ids = ids or b""
        tokens = self.tokens
        return b"".join([tokens[i] for i in memoryview(ids).cast("I")]) if ids else b""


HELD: dict[bytes, Encoder] = {}


def encoder(packed: bytes, pattern: str) -> Encoder:
    """The worker's encoder for a vocabulary (tokens as 2-byte length and bytes)."""
    key = hashlib.sha1(packed + pattern.encode()).digest()
    if key not in HELD:
        tokens, at = [], 0
        while at < len(packed):
            (n,) = struct.unpack_from("<H", packed, at)
            tokens.append(packed[at + 2 : at + 2 + n])
            at += 2 + n
        HELD.clear()
        HELD[key] = Encoder(tokens, pattern)
    return HELD[key]


class Vocabulary:
    """A rank file and its pre-token pattern, as column functions.

    The file is read on the driver and its tokens (about 1 MB) travel with the tasks,
    so workers need no access to ``path``.
    """

    def __init__(self, path: str, pattern: str):
        self.packed = b"".join(struct.pack("<H", len(t)) + t for t in read_ranks(path))
        self.pattern = pattern

    def encode(self, text: str | Column) -> Column:
        """Binary column of ids, 4 bytes each, little-endian; empty for null or empty text."""
        packed, pattern = self.packed, self.pattern

        @F.arrow_udf("binary")
        def ids(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            enc = encoder(packed, pattern)
            for part in parts:
                yield pa.array([enc.encode(x.as_py()) for x in part], pa.binary())

        return ids(text)

    def decode(self, ids: str | Column) -> Column:
        """Binary column of the bytes the ids stand for; empty for null."""
        packed, pattern = self.packed, self.pattern

        @F.arrow_udf("binary")
        def data(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            enc = encoder(packed, pattern)
            for part in parts:
                yield pa.array([enc.decode(x.as_py()) for x in part], pa.binary())

        return data(ids)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``decoded``.

    Null and empty texts give no ids and empty bytes. Repeated rows are encoded alike
    and all kept; columns of the same names are replaced. Text of any length is encoded
    whole.
    """
    out = docs.drop(*[c for c in ("ids", "n_tokens", "decoded") if c != text])
    out = out.withColumn("ids", vocabulary.encode(text))
    out = out.withColumn("decoded", vocabulary.decode("ids"))
    return out.withColumn("n_tokens", F.expr("octet_length(ids) div 4").cast("long"))
