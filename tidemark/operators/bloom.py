"""Blocked Bloom filters as small tables, probed by a broadcast join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits at most: 64 MB as rows of a broadcast.
MOST_WORDS = 1 << 22
#: Keys per word, on average, and bits that a key sets in its word.
KEYS_PER_WORD, BITS = 4, 4


def _hash(keys: list[Column]) -> Column:
    return F.xxhash64(F.lit(7), *keys)


def _slot(keys: list[Column], words: int) -> Column:
    return F.pmod(_hash(keys), F.lit(words)).cast("int")


def _mask(keys: list[Column]) -> Column:
    """Some bits of a word, from another hash of the key."""
    bits = F.xxhash64(F.lit(11), *keys)
    places = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS)]
    one = F.lit(1).cast("bigint")
    return reduce(lambda a, b: a.bitwiseOR(b), (F.call_function("shiftleft", one, p) for p in places))


def words_for(keys: int) -> int:
    """Words for so many keys: about one false answer in fifty, until there are no more words."""
    return min(max(1, -(-keys // KEYS_PER_WORD)), MOST_WORDS)


def bloom_filter(keys: DataFrame, on: list[str], words: int) -> DataFrame:
    """``slot`` and ``word`` of every word with a bit, at most ``words`` rows; null keys set none.

    Masks are combined before the shuffle, so the rows that a task sends are
    bounded by ``words`` as well.
    """
    columns = [F.col(c) for c in on]
    known = reduce(lambda a, b: a & b, (c.isNotNull() for c in columns))
    return keys.where(known).groupBy(_slot(columns, words).alias("slot")).agg(F.bit_or(_mask(columns)).alias("word"))


def maybe_in(df: DataFrame, on: list[str], bloom: DataFrame, words: int, name: str) -> DataFrame:
    """Adds ``name``: false where the key surely is not among the filter's keys, or is null."""
    columns = [F.col(c) for c in on]
    table = F.broadcast(bloom.select(F.col("slot").alias("_slot"), F.col("word").alias("_word")))
    mask = _mask(columns)
    joined = df.join(table, _slot(columns, words) == F.col("_slot"), "left")
    hit = F.col("_word").isNotNull() & (F.col("_word").bitwiseAND(mask) == mask)
    known = reduce(lambda a, b: a & b, (c.isNotNull() for c in columns))
    return joined.withColumn(name, hit & known).drop("_slot", "_word")
