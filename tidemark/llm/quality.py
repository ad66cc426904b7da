"""Quality classifier: document evidence combined with host and path posteriors by empirical Bayes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import fitting
from tidemark.llm import text as T
from tidemark.sources.storage import scratch_path, shared_dir

#: Group tables up to this number of rows are broadcast.
FEW_GROUPS = 100_000
THRESHOLD = 0.5
_LETTERS = bytes([*range(65, 91), *range(97, 123)])
_KINDS = (
    bytes(range(65, 91)),
    b"0123456789",
    b".,;:",
    b"!?",
    b"#$%&*@^~",
    b"|<>{}[]\\/_=+",
    b"\n",
)


def features(text: str) -> list[float]:
    """Shares of kinds of characters, lengths, and repetition of words and lines."""
    data = text.encode()
    n = len(data)
    lines = data.split(b"\n")
    counts = [n - len(data.translate(None, kind)) for kind in _KINDS]
    letters = n - len(data.translate(None, _LETTERS))
    words = length = upper = edge = 0
    seen: set[bytes] = set()
    last = b""
    for found in T.words(data, T.PLAIN):
        if found:
            edge = edge or len(found[0])
            last = found[-1]
        words += len(found)
        length += sum(map(len, found))
        upper += sum(map(bytes.isupper, found))
        seen.update(w.translate(T.LOWER) for w in set(found))
    m = max(words, 1)
    return [
        np.log1p(n),
        np.log1p(words),
        letters / max(n, 1),
        *[np.sqrt(c / max(n, 1)) for c in counts],
        length / m / 10,
        len(seen) / np.sqrt(m) / 10,
        len(set(lines)) / len(lines),
        max(edge, len(last)) / 20,
        upper / m,
    ]


def _evidence(rows: DataFrame, beta: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> DataFrame:
    """Adds ``evidence``, the document classifier's probability, in place of the text."""
    shared = rows.sparkSession.sparkContext.broadcast((beta, mean, scale))
    at = rows.columns.index("text")
    others = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in others) + ", evidence double"

    def run(batches):
        beta, mean, scale = shared.value
        for batch in T.slices(batches):
            x = np.array([features(t) for t in batch.column(at).to_pylist()])
            p = fitting.probability((x - mean) / scale, beta) if len(x) else np.zeros(0)
            columns = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(p)], [*others, "evidence"])

    return rows.mapInArrow(run, schema)


def _strength(groups: DataFrame, parent: Column) -> float:
    """How many documents the parent counts for: by moments of the groups' means around it.

    Groups of one document say nothing on the spread between groups.
    """
    off = F.col("total") / F.col("n") - parent
    noise = parent * (1 - parent) / F.col("n")
    row = groups.where("n >= 2").agg(
        F.sum(F.col("n") * (off * off - noise)), F.sum("n"), F.sum(F.col("n") * parent * (1 - parent))
    ).first()
    if not row[1] or row[2] <= 0:
        return 100.0
    between, inner = row[0] / row[1], row[2] / row[1]
    if between <= inner * 1e-6:
        return 1e6
    return float(np.clip(inner / between - 1, 1.0, 1e6))


def _logit(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(held / (1 - held))


def _join(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    named = table.select("*", *[F.col(k).alias(f"_of_{k}") for k in keys]).drop(*keys)
    side = F.broadcast(named) if table.count() <= FEW_GROUPS else named.hint("merge")
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    on = same[0]
    for one in same[1:]:
        on = on & one
    return rows.join(side, on).drop(*[f"_of_{k}" for k in keys])


def classify(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_rows: Column | None = None,
    sample: int = fitting.SAMPLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row ``doc_id``, ``host``, ``path``, ``evidence``, ``host_score``, ``path_score``, ``score``, ``predicted``.

    ``evidence`` is the probability by a document classifier, fitted on at most
    ``sample`` labelled rows. A host's mean evidence over all its documents is
    shrunk toward the mean of all, a path's toward its host's, each by a
    strength that the spread between groups gives: sparse sites stay near their
    parents. The score multiplies the path's odds, the document itself left out,
    by what its evidence says beyond the mean of all.

    Groups are sums, combined before the shuffle, so a hot host is no hot task.
    Null host and path are groups of their own; null text is empty. Without
    labels of both kinds, evidence is 0.5 everywhere. Repeated rows stay; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    shared_dir(spark)
    known = fitting.labelled(
        docs, labels, label_col, id_col, text_col, scratch_path(spark, "quality"), train_rows, sample
    )
    width = len(features(""))

    def points(batches):
        for batch in T.slices(batches):
            x = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["label", "x"]
            )

    got = known.select("label", "text").mapInArrow(points, "label int, x array<double>").toArrow()
    y = got.column("label").to_numpy().astype(float)
    beta, mean, scale = np.zeros(width + 1), np.zeros(width), np.ones(width)
    if len(set(y.tolist())) == 2:
        x = np.array(got.column("x").to_pylist())
        mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        beta = fitting.logistic((x - mean) / scale, y, ridge=1.0)

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    marked = _evidence(rows, beta, mean, scale).checkpoint()
    paths = marked.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("evidence").alias("total")).checkpoint()
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).checkpoint()
    every = hosts.agg(F.sum("n"), F.sum("total")).first()
    base = every[1] / every[0] if every[0] else 0.5
    strength = _strength(hosts, F.lit(base))
    shrunk = (F.col("total") + strength * base) / (F.col("n") + strength)
    hosts = hosts.select("host", shrunk.alias("host_score"))
    paths = _join(paths, hosts, ["host"])
    strength = _strength(paths, F.col("host_score"))
    paths = paths.select(
        "host", "path", "host_score", F.col("n").alias("_n"), F.col("total").alias("_total"),
        ((F.col("total") + strength * F.col("host_score")) / (F.col("n") + strength)).alias("path_score"),
    )
    joined = _join(marked, paths, ["host", "path"])
    others = F.greatest(F.col("_total") - F.col("evidence"), F.lit(0.0))
    prior = (others + strength * F.col("host_score")) / (F.col("_n") - 1 + strength)
    odds = _logit(prior) + _logit(F.col("evidence")) - _logit(F.lit(base))
    score = 1 / (1 + F.exp(-odds))
    return joined.withColumn("score", score).select(
        "doc_id", "host", "path", "evidence", "host_score", "path_score", "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
