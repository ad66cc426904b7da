"""Approximate nearest neighbours: cells, short codes of what lies beside their seeds, an exact second look.

A vector is coded by its cell and, part by part, by the nearest of 256 centres
that the parts of a bounded sample were grouped around. A query compares itself
with the codes of the cells next to it, by sums out of a small table, and scores
only the best of those in full. Every vector is coded; what a search may miss is
what lies in a cell it does not look into, or what its codes rank too low.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed
from tidemark.functions import vectors
from tidemark.operators import knn
from tidemark.operators.block_search import DECIMALS, as_matrix
from tidemark.operators.keyed_join import BROADCAST_BYTES
from tidemark.sources.storage import scratch_path

#: Rows that the centres are fitted on; fewer where vectors are so long that these exceed a broadcast.
SAMPLE = 20_000
CENTRES = 256
ROUNDS = 12
TILE_ROWS, TILE_QUERIES = 4096, 256


class CodeIndex(NamedTuple):
    """Cells with their vectors, and a second table of ``(key, code)`` by cell."""

    cells: knn.CellIndex
    path: str
    books: list[np.ndarray]
    schema: T.StructType

    def codes(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


def build_codes(
    corpus: DataFrame,
    n_cells: int,
    parts: int,
    metric: str = "cosine",
    path: str | None = None,
    sample: int = SAMPLE,
) -> CodeIndex:
    """Index the ``(key, vector)`` rows of a corpus; keys are unique.

    A code has a byte for each of the ``parts`` that a vector is cut into. The
    sample for the centres is the rows with the lowest key hashes, so they are
    the same each time; all rows are coded. Null vectors are left out, as in the
    exact searches.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"codes need the cosine or l2 metric, not {metric!r}")
    spark = corpus.sparkSession
    path = path or scratch_path(spark, "codes")
    index = knn.build_cells(corpus, n_cells, metric, f"{path}/vectors")
    rows = index.vectors(spark).select("cell", "key", "vector")
    dims = index.seeds.shape[1]
    if dims and not 0 < parts <= dims:
        raise ValueError(f"{dims} dimensions cannot be cut into {parts} parts")
    most = min(sample, max(CENTRES, BROADCAST_BYTES // (8 * max(1, dims))))
    drawn = rows.orderBy(F.xxhash64("key"), "key").limit(most).toArrow()
    books = [_centres(part) for part in _cut(_beside(drawn, index), parts)] if dims else []
    shared = spark.sparkContext.broadcast((index, books))
    schema = T.StructType([*rows.select("cell", "key").schema, T.StructField("code", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, books = shared.value
        for batch in batches:
            codes = np.empty((batch.num_rows, len(books)), dtype=np.uint8)
            for i, (part, book) in enumerate(zip(_cut(_beside(batch, index), len(books)), books)):
                codes[:, i] = _nearest_centre(part, book)
            made = pa.array([row.tobytes() for row in codes], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("cell"), batch.column("key"), made], names=["cell", "key", "code"]
            )

    coded = rows.mapInArrow(encode, schema) if dims else spark.createDataFrame([], schema)
    # Rebalanced by cell: a cell that is too large for one file gets several.
    coded.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/codes")
    return CodeIndex(index, f"{path}/codes", books, schema)


def _beside(rows, index: knn.CellIndex) -> np.ndarray:
    """Where the vectors of Arrow rows lie, seen from the seeds of their cells."""
    points = knn._placed(as_matrix(rows.column("vector")), index.metric)
    return points - index.seeds[rows.column("cell").to_numpy()] if len(points) else points


def _cut(rows: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.array_split(rows, parts, axis=1)


def _nearest_centre(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), dtype=np.int64)
    for lo in range(0, len(rows), TILE_ROWS):
        part = rows[lo : lo + TILE_ROWS]
        out[lo : lo + TILE_ROWS] = ((book * book).sum(axis=1) - 2 * part @ book.T).argmin(axis=1)
    return out


def _centres(rows: np.ndarray) -> np.ndarray:
    """At most 256 centres that the rows lie around, by Lloyd's iteration; a centre without rows stays."""
    distinct = np.unique(rows, axis=0)
    if len(distinct) <= CENTRES:
        return distinct
    book = np.random.default_rng(0).choice(distinct, CENTRES, replace=False)
    for _ in range(ROUNDS):
        place = _nearest_centre(rows, book)
        sums, count = np.zeros_like(book), np.bincount(place, minlength=CENTRES)
        np.add.at(sums, place, rows)
        book = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], book)
    return book


def nearest_by_codes(
    queries: DataFrame,
    index: CodeIndex,
    query_id: str = "query_id",
    k: int = fixed.TOP_K,
    probes: int = 8,
    rerank: int = 64,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(query_id, key, score, rank)`` of about the k nearest; the scores are exact.

    A query looks at the codes of its ``probes`` nearest cells, or of more until
    they hold ``rerank`` vectors, and scores the ``rerank`` best of these in
    full, from the cells that hold one. With all cells as probes and all rows to
    rerank the result is that of :func:`knn.nearest`. Queries are broadcast in
    blocks, a task sends on the best codes of a query only, and neither codes nor
    vectors are shuffled while the wanted keys of a block fit a broadcast.
    """
    if rerank < k:
        raise ValueError(f"{rerank} rows to rerank are fewer than {k}")
    if probes < 1:
        raise ValueError("at least one cell must be looked into")
    spark, cells = queries.sparkSession, index.cells
    asked = knn._pinned(queries.select(query_id, "vector"), "queries").where("vector IS NOT NULL")
    rows = index.codes(spark)
    schema = knn._hit_schema(asked, rows, query_id)
    if not cells.cells:
        return knn._ranked(spark.createDataFrame([], schema), query_id, k)
    size = np.zeros(len(cells.seeds), dtype=np.int64)
    for c in cells.cells:
        size[c.cell] = c.rows
    full = np.flatnonzero(size)
    near_schema = T.StructType([*schema.fields[:2], rows.schema["cell"], T.StructField("gap", T.FloatType())])

    def one(block: DataFrame):
        ids, matrix = knn._collected(block, query_id)
        matrix = matrix.astype(np.float64, copy=False)
        points = knn._placed(matrix, cells.metric)
        cut = knn.home_cuts(points, cells.seeds, size, min(rerank, int(size.sum())))
        cut = np.maximum(cut, _probe_cuts(points, cells.seeds[full], probes))
        choice = knn.Choice(points, cells.seeds, np.zeros(len(size)), cut)
        wanted = [int(c) for c in full if choice.of(c).any()]
        shared = spark.sparkContext.broadcast((ids, choice, index.books))
        names = near_schema.names

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, choice, books = shared.value
            best = np.full((len(ids), rerank), np.inf, dtype=np.float32)
            for batch in batches:
                cell = batch.column("cell").to_numpy()
                # A file holds one cell, so a batch has few runs of cells.
                at = np.flatnonzero(np.diff(cell, prepend=-1))
                for lo, hi in zip(at, [*at[1:], len(cell)]):
                    who = np.flatnonzero(choice.of(cell[lo]))
                    beside = choice.points[who] - choice.seeds[cell[lo]]
                    for q, c, gap in _near_codes(batch.slice(lo, hi - lo), who, beside, books, best):
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids.take(pa.array(q)),
                                batch.column("key").take(pa.array(c + lo)),
                                pa.array(np.full(len(q), cell[lo], dtype=np.int32)),
                                pa.array(gap),
                            ],
                            names=names,
                        )

        order = Window.partitionBy(query_id).orderBy("gap", "key")
        near = (
            rows.where(F.col("cell").isin(wanted))
            .mapInArrow(search, near_schema)
            .withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= rerank)
            .select(query_id, "key", "cell")
        )
        # Kept as a table: the cells and the second look both read it.
        path = scratch_path(spark, "near")
        near.write.parquet(path)
        near = spark.read.parquet(path)
        held = [r[0] for r in near.select("cell").distinct().collect()]  # at most one number per cell
        corpus = cells.vectors(spark).where(F.col("cell").isin(held)).select("key", "vector")
        pairs = knn.hits_with(corpus, near.drop("cell"))
        asking = F.broadcast(block.select(query_id, F.col("vector").alias("_asked")))
        score = vectors.score(F.col("_asked"), F.col("vector"), cells.metric)
        score = F.when(~F.isnan(score) & (F.abs(score) < float("inf")), F.round(score, DECIMALS))
        hits = pairs.join(asking, query_id).select(query_id, "key", score.alias("score"))
        return knn._ranked(hits, query_id, k), shared

    return knn._in_turn(asked, query_id, limit, one, schema)


def _probe_cuts(points: np.ndarray, seeds: np.ndarray, probes: int) -> np.ndarray:
    """Per point the distance of its ``probes``-th nearest seed."""
    out = np.empty(len(points))
    n = min(probes, len(seeds)) - 1
    step = max(1, knn.TILE_CELLS // max(1, len(seeds)))
    for lo in range(0, len(points), step):
        out[lo : lo + step] = np.partition(knn._distances(points[lo : lo + step], seeds), n, axis=1)[:, n]
    return out


def _near_codes(
    rows: pa.RecordBatch, who: np.ndarray, beside: np.ndarray, books: list[np.ndarray], best: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query, row and estimated squared distance of the rows of a cell that may be among a query's best.

    ``best`` keeps, per query, the least distances of this task so far; what lies
    beyond the last of them is passed over.
    """
    most = best.shape[1]
    codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), dtype=np.uint8).reshape(-1, len(books))
    for lo in range(0, len(who), TILE_QUERIES):
        mine = who[lo : lo + TILE_QUERIES]
        parts = _cut(beside[lo : lo + TILE_QUERIES], len(books))
        # Per part the squared distances of the queries to every centre.
        tables = [np.square(knn._distances(p, b)).astype(np.float32) for p, b in zip(parts, books)]
        for at in range(0, len(codes), TILE_ROWS):
            gap = np.zeros((len(mine), len(codes[at : at + TILE_ROWS])), dtype=np.float32)
            for i, t in enumerate(tables):
                gap += t[:, codes[at : at + TILE_ROWS, i]]
            found = np.partition(np.concatenate([best[mine], gap], axis=1), most - 1, axis=1)
            best[mine] = found[:, :most]
            q, c = np.nonzero(gap <= found[:, most - 1 : most])
            if len(q):
                yield mine[q], c + at, gap[q, c]
