"""Bloom filters in blocks of 32,768 bits, as plain columns.

A key's bits lie in one block, so a filter is a table (block, bits) that grows
with the keys, is merged block by block, and answers for a key with the one
row of its block.  No key that was added is ever denied.

A key's block goes by the hash that Spark buckets files by.  Where the blocks
are a multiple of a key table's buckets, a block's keys stand in one file: a
task makes few blocks and makes them whole, so about 1.6 bytes of bitmap a key
are shuffled, and not a bitmap of every block from every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 1 << 15
HASHES = 4


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.hash(key), F.lit(blocks)).cast("long").alias("block")


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def build(keys: DataFrame, key: Column, blocks: int) -> DataFrame:
    """block and bits of all keys; blocks without a key have no row."""
    each = keys.select(block_of(key, blocks), F.explode(F.array(*_bits(key))).alias("bit"))
    return each.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merge(filters: DataFrame) -> DataFrame:
    """One filter of several with as many blocks."""
    return filters.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def may_hold(bits: Column, key: Column) -> Column:
    """Whether the block's ``bits`` (null: no block) may hold ``key``."""
    out = bits.isNotNull()
    for bit in _bits(key):
        byte = F.conv(F.hex(F.substring(bits, (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        out = out & (F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(1) == 1)
    return F.coalesce(out, F.lit(False))
