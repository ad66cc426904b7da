"""Joins that hold on hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are joined by broadcast because they are hot, at most, and the rows that make a key hot at least.
HOT_KEYS, HOT_ROWS = 10_000, 1000


def lookup(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Left join with a table that holds each key once, whatever rows a key has.

    Keys with more than one ``HOT_KEYS``th of the rows are ``HOT_KEYS`` at most,
    so their rows of the table are broadcast; the others are shuffled. Both sides
    are read more than once and should be written tables. Null keys match nothing.
    """
    least = max(rows.count() // HOT_KEYS, HOT_ROWS)
    hot = rows.groupBy(*on).count().where((F.col("count") > least) & F.col(on[0]).isNotNull()).select(*on)
    hot = hot.checkpoint()
    few = F.broadcast(table.join(F.broadcast(hot), on, "left_semi"))
    rest = rows.join(F.broadcast(hot), on, "left_anti").join(table.hint("merge"), on, "left")
    return rows.join(few, on).unionByName(rest)
