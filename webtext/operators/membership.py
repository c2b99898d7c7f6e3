"""A Bloom filter as a small table, for cutting a wide table to keys before any shuffle.

The filter is ``blocks`` bitmaps of 4 KB. A key's hash chooses a block and ``PROBES`` bits
in it, so one lookup answers for a key. Its size depends on ``blocks`` alone, whatever the
number of keys, so it can always be broadcast. Keys that are in it always pass; of the
others a share passes that grows with the number of keys (about 2 % at 8 bits a key), so
an exact join must follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of one bitmap, as Spark's bitmap aggregates build it.
BLOCK_BITS = 32_768
PROBES = 4
# 4 MB, good for some 4 million keys; and the most that is sent to each executor, 32 MB.
BLOCKS, MOST_BLOCKS = 1024, 8192


def _block(keys: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(blocks)).cast("int")


def _probes(keys: list[str]) -> Column:
    """Bit positions of a key: 15 bits each of a second hash."""
    h = F.xxhash64(F.lit(1), *keys)
    return F.array(*[F.shiftrightunsigned(h, 15 * i).bitwiseAND(BLOCK_BITS - 1).cast("int") for i in range(PROBES)])


def key_filter(rows: DataFrame, keys: list[str], blocks: int = BLOCKS) -> DataFrame:
    """``_block, _bits``: the filter of all keys of ``rows``, at most ``blocks`` rows. Bits
    are set on the map side, so a key found in many rows costs no more than one."""
    if not 0 < blocks <= MOST_BLOCKS:
        raise ValueError(f"blocks must be 1 to {MOST_BLOCKS}")
    bits = rows.select(_block(keys, blocks).alias("_block"), F.explode(_probes(keys)).alias("_bit"))
    return bits.groupBy("_block").agg(F.bitmap_construct_agg(F.col("_bit").cast("long")).alias("_bits"))


def probably_in(rows: DataFrame, keys: list[str], table: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``rows`` whose key may be in the filter ``table``; ``rows`` are neither shuffled nor
    sorted. Columns, and their types, must be those the filter was made of."""
    held = rows.withColumn("_block", _block(keys, blocks)).join(F.broadcast(table), "_block")

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, bit.bitwiseAND(7)).bitwiseAND(1) == 1

    return held.where(F.forall(_probes(keys), is_set)).drop("_block", "_bits")
