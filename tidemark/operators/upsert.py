"""Keyed upserts as joins and unions.

Both forms drop the target rows that the batch replaces and append the batch,
matching columns by name. Null keys match nothing. The joins hold each key once
on the batch side and split the heavy keys of the other; see ``keyed_join``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keyed_join import keyed_join


class DuplicateKeys(ValueError):
    """The source of an upsert holds a key more than once."""


def distinct_keys(batch: DataFrame, key: str) -> DataFrame:
    """Non-null keys of a batch, each once."""
    return batch.where(F.col(key).isNotNull()).select(key).distinct()


def duplicate_keys(batch: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (
        batch.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
    )


def check_unique(batch: DataFrame, key: str) -> None:
    """Raise ``DuplicateKeys``, naming a few, when a key occurs more than once."""
    repeated = duplicate_keys(batch, key).limit(5).collect()
    if repeated:
        shown = ", ".join(repr(r[key]) for r in repeated)
        raise DuplicateKeys(f"source repeats {key}: {shown}")


def latest_per_key(batch: DataFrame, key: str, ordinal: Column) -> DataFrame:
    """The row of the highest ordinal per key; rows without a key all stay.

    A null ordinal is below all others; of several rows with the highest one
    stays. ``max_by`` combines before the shuffle, so a key with most of the rows
    sends one row per task.
    """
    keyed = (
        batch.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(*batch.columns), _comparable(ordinal)).alias("row"))
        .select("row.*")
    )
    return keyed.unionByName(batch.where(F.col(key).isNull()))


def _comparable(ordinal: Column) -> Column:
    """Never null, and ordered as the ordinal with nulls first: aggregates skip nulls."""
    return F.struct(ordinal.isNotNull().alias("given"), ordinal.alias("ordinal"))


def rows_of_last(batch: DataFrame, key: str, ordinal: str) -> DataFrame:
    """All rows of each key that share the key's highest ordinal; nulls are below all others."""
    held = batch.withColumn("_place", _comparable(F.col(ordinal)))
    last = held.groupBy(key).agg(F.max("_place").alias("_place"))
    keyed = keyed_join(held, last, [key, "_place"], "left_semi").drop("_place")
    return keyed.unionByName(batch.where(F.col(key).isNull()))


def replace_by_keys(
    target: DataFrame, batch: DataFrame, key: str, keyed: DataFrame | None = None
) -> DataFrame:
    """Target rows with a key of the batch go; every batch row is added.

    Repeated keys within the batch are kept, and so is a batch without keys,
    which makes it a plain append. ``keyed`` gives the keys where they are
    cheaper to read than the batch.
    """
    keys = distinct_keys(batch if keyed is None else keyed, key)
    kept = keyed_join(target, keys, [key], "left_anti")
    return kept.select(target.columns).unionByName(batch.select(target.columns))


def merge_by_key(
    target: DataFrame,
    source: DataFrame,
    key: str,
    ordinal: Column | None = None,
    check: bool = True,
) -> DataFrame:
    """Update every matched row and insert the others, as ``MERGE`` does.

    A repeated source key raises, like ``MERGE`` with several matches; with
    ``ordinal`` the row of the highest ordinal wins instead. The check runs a
    job over the key column; pass ``check=False`` for a source known unique.
    """
    if ordinal is not None:
        latest = latest_per_key(source, key, ordinal)
        return replace_by_keys(target, latest, key, keyed=source)
    if check:
        check_unique(source, key)
    return replace_by_keys(target, source, key)


def append_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append by column name."""
    return target.unionByName(batch.select(target.columns))
