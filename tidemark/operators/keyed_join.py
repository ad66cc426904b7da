"""Semi and anti joins of a large table with a table that holds each key once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.bloom import bloom_filter, maybe_in, words_for

BROADCAST_BYTES = 64 << 20
HOT_ROWS = 4_000_000


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows, measured by a job over them, are within ``limit`` bytes."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns),
        F.lit(32),
    )
    return (df.agg(F.sum(width)).first()[0] or 0) <= limit


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and the ``_parts`` of so many rows they make.

    Rows are counted before the shuffle, so a heavy key costs one row per task.
    The list holds one key per ``hot_rows`` rows of the table at most: a quarter
    of a million at 10**12 rows.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    parts = F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts")
    found = counts.where(F.col("_n") > hot_rows).select(key, parts)
    return df.sparkSession.createDataFrame(found.collect(), found.schema)


def _spread(df: DataFrame, key: str) -> Column:
    """A number that differs between rows of one key and is the same in every run."""
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    return F.xxhash64(*plain) if plain else F.lit(0)


def keyed_join(
    big: DataFrame,
    unique: DataFrame,
    on: Sequence[str],
    how: str,
    limit: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``big`` left_semi or left_anti ``unique``, whatever rows a key of ``big`` has.

    ``unique`` holds the key ``on[0]`` at most once. When it fits a broadcast,
    ``big`` is filtered as it is read. Otherwise a Bloom filter of the keys is
    broadcast, whose size is bounded whatever they are: rows whose key surely is
    not among them are done where they lie, without a shuffle. The others and
    ``unique`` are shuffled by key and part: the rows of a hot key are dealt to
    several parts by a hash of the row, and its row in ``unique`` is copied to
    each. ``big`` is read for the count of the keys that may match, for those
    rows and for the others. AQE would not split such keys, as it only does for
    sides that come straight from a shuffle, and ``unique`` mostly comes from an
    aggregate. Null keys match nothing and are not shuffled.
    """
    key, on = on[0], list(on)
    unique = unique.where(F.col(key).isNotNull())
    if fits_broadcast(unique, limit):
        return big.join(F.broadcast(unique), on, how)
    words = words_for(unique.count())
    names = big.columns
    marked = maybe_in(big, [key], bloom_filter(unique, [key], words), words, "_maybe")
    surely = marked.where(~F.col("_maybe")).select(names)
    found = _shuffled(marked.where("_maybe").select(names), unique, on, how, hot_rows)
    return found if how == "left_semi" else surely.unionByName(found)


def _shuffled(big: DataFrame, unique: DataFrame, on: list[str], how: str, hot_rows: int) -> DataFrame:
    """The join by shuffle, hot keys in parts. No key of ``big`` is null."""
    key = on[0]
    hot = hot_keys(big, key, hot_rows)
    columns = big.columns
    parts = F.lit(1)
    if not hot.isEmpty():
        named = F.broadcast(hot.withColumnRenamed(key, "_hot"))
        big = big.join(named, F.col(key) == F.col("_hot"), "left")
        unique = unique.join(named, F.col(key) == F.col("_hot"), "left")
        parts = F.coalesce("_parts", parts)
        copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
        unique = unique.select(*on, copies.alias("_part"))
    else:
        unique = unique.select(*on, F.lit(0).alias("_part"))
    dealt = big.withColumn("_part", F.pmod(_spread(big, key), parts).cast("int"))
    return dealt.join(unique, [*on, "_part"], how).select(*columns)
