"""Labelled samples and logistic regression on a few features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Labelled rows a classifier is fitted on, at most. Documented bound of the sample.
SAMPLE = 20_000
#: Different texts of one id among them, at most.
PER_ID = 16


def labelled(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, path: str,
    train: Column | None = None, most: int = SAMPLE, per_id: int = PER_ID,
) -> DataFrame:
    """``doc_id``, ``text``, ``label`` (0 or 1) of at most ``most`` labelled rows, written to ``path``.

    Which ids, decides a hash of the id; which ``per_id`` texts of an id that has
    more, a hash of the text. Rows equal in both count once. Several labels of an
    id count as the largest; null labels and null ids as none. ``train`` filters
    ids. Ids, and pairs of id and hash, are ``most`` numbers at most, so they are
    broadcast; an id that holds a third of all rows sends its hashes only.
    """
    ids = labels.select(F.col(id_col).cast("bigint").alias(id_col), F.col(label_col).cast("int").alias("label"))
    ids = ids.where(F.col(id_col).isNotNull() & F.col("label").isNotNull())
    if train is not None:
        ids = ids.where(train)
    ids = ids.groupBy(id_col).agg(F.max("label").alias("label"))
    ids = ids.orderBy(F.xxhash64(id_col), id_col).limit(most)
    ids = ids.select(F.col(id_col).alias("_id"), F.least(F.greatest("label", F.lit(0)), F.lit(1)).alias("label"))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).drop("_id")
    rows = rows.withColumn("tag", F.xxhash64("text"))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("tag"))
    keys = rows.select("doc_id", "tag").distinct().withColumn("nth", nth).where(F.col("nth") <= per_id)
    keys = keys.orderBy(F.xxhash64("doc_id"), "doc_id", "tag").limit(most).select("doc_id", "tag")
    chosen = rows.join(F.broadcast(keys), ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag"])
    chosen.drop("tag").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients with the intercept first, by Newton's method with a ridge penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = probability(x[:, 1:], beta)
        w = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve(
            (x * w[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * beta
        )
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def probability(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    z = np.clip(beta[0] + x @ beta[1:], -40, 40)
    return 1 / (1 + np.exp(-z))
