"""A blocked Bloom filter as a DataFrame of bounded size, built and asked with built-in functions only.

A block is four words of 64 bits; a key sets one bit in each word of its one block. The filter never has more than
``MOST_BLOCKS`` rows, however many keys it holds, so it may always be broadcast; beyond 16 bits a key it only lets more
keys pass, which the exact join behind it turns away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.llm.common import private

#: Blocks of 32 bytes: 16 MB at most.
MOST_BLOCKS = 1 << 19
KEYS_PER_BLOCK = 16
_WORDS = ("w0", "w1", "w2", "w3")


def blocks_for(keys: int) -> int:
    """A power of two, 16 bits a key up to the bound."""
    blocks = 1
    while blocks * KEYS_PER_BLOCK < keys and blocks < MOST_BLOCKS:
        blocks *= 2
    return blocks


def _block(key: Column, blocks: int) -> Column:
    return F.xxhash64(F.lit("block"), key).bitwiseAND(F.lit(blocks - 1))


def _bit(key: Column, word: int) -> Column:
    place = F.shiftrightunsigned(F.xxhash64(F.lit("bits"), key), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def build(keys: DataFrame, name: str, count: int) -> tuple[DataFrame, int]:
    """The filter over column ``name`` of about ``count`` distinct keys, and its number of blocks."""
    blocks = blocks_for(count)
    bits = keys.filter(F.col(name).isNotNull()).groupBy(_block(F.col(name), blocks).alias("block"))
    return bits.agg(*(F.bit_or(_bit(F.col(name), i)).alias(w) for i, w in enumerate(_WORDS))), blocks


def tagged(rows: DataFrame, key: Column, bloom: DataFrame, blocks: int, flag: str) -> DataFrame:
    """The rows with ``flag``: whether the key may be in the filter. A null key is in none."""
    block, *words = private(rows, "block", *_WORDS)
    asked = bloom.select(F.col("block").alias(block), *(F.col(w).alias(n) for w, n in zip(_WORDS, words, strict=True)))
    hits = [F.col(n).bitwiseAND(_bit(key, i)) != 0 for i, n in enumerate(words)]
    passes = F.coalesce(hits[0] & hits[1] & hits[2] & hits[3] & key.isNotNull(), F.lit(False))
    # a left join with few distinct right rows: never more rows than before
    return rows.withColumn(block, _block(key, blocks)).join(F.broadcast(asked), block, "left").withColumn(flag, passes).drop(block, *words)
