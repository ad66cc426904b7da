"""Connected components of a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.storage import shared_dir


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest reachable position of each of n positions, given links between them."""
    root = np.arange(n)
    if not len(a):
        return root
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (its smallest reachable node) of every linked node.

    Alternates two steps until nothing changes: every node hands its smallest
    neighbour to the larger ones, then to the smaller ones. Each round is
    pinned with a reliable checkpoint, so a lost executor recomputes one round.
    Nodes without a link to another are left out; null nodes as well.
    """
    shared_dir(links.sparkSession)
    pair = links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    now = pair.where(F.col(a) != F.col(b)).distinct().checkpoint()
    state = _state(now)
    while True:
        both = now.select(F.col("high").alias("n"), F.col("low").alias("m")).unionByName(
            now.select(F.col("low").alias("n"), F.col("high").alias("m"))
        )
        least = both.groupBy("n").agg(F.min("m").alias("least"))
        # Written first: joined as a table of its own, a node with many links is split among tasks.
        least = least.select("n", F.least("n", "least").alias("least")).checkpoint()
        # To the larger neighbours, the node itself included among the smaller ones.
        large = both.join(least.hint("merge"), "n").where(F.col("m") > F.col("n"))
        large = large.select(F.col("m").alias("high"), F.col("least").alias("low")).distinct()
        large = large.checkpoint()
        least = large.groupBy("high").agg(F.min("low").alias("least")).checkpoint()
        small = large.join(least.hint("merge"), "high")
        now = (
            small.select(F.col("low").alias("high"), F.col("least").alias("low"))
            .where(F.col("high") != F.col("low"))
            .unionByName(least.select("high", F.col("least").alias("low")))
            .distinct()
            .checkpoint()
        )
        new = _state(now)
        if new == state:
            break
        state = new
    roots = now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return roots.unionByName(now.select(F.col("high").alias("node"), F.col("low").alias("root")))


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count("*"),
            F.sum(F.col("low").cast("decimal(38,0)")),
            F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")),
        ).first()
    )
