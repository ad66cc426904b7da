"""SimHash near-duplicates: fingerprints searched in a Gray-order hierarchical index."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import components as C
from tidemark.llm import text as T
from tidemark.sources.storage import shared_dir

SEED = 42
#: A group of fingerprints with more rows is split by further bits.
HOT_ROWS = 512
#: Hot groups up to this number are broadcast, at 24 bytes each.
FEW_GROUPS = 500_000
#: Children per node of the index.
FAN_OUT = 8


def fingerprint(data: bytes, shingle: int = 3) -> int:
    """A bit is 1 if set in over half the hashes of the shingles; no words: 0."""
    counts = np.zeros(64, np.int64)
    n, carry, whole = 0, [], []
    hash_of = xxhash.xxh64_intdigest
    for found in T.words(data, T.PLAIN_LOWER):
        found = carry + found
        carry = found[-(shingle - 1) :] if shingle > 1 else []
        if len(found) < shingle:
            whole = found
            continue
        joined = b" ".join(found)
        size = np.fromiter(map(len, found), np.int64, len(found))
        end = np.cumsum(size + 1) - 1
        start = (end - size)[: len(found) - shingle + 1].tolist()
        end = end[shingle - 1 :].tolist()
        h = np.fromiter((hash_of(joined[s:e], SEED) for s, e in zip(start, end)), ">u8", len(start))
        for at in range(0, len(h), 1 << 16):
            bits = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8)).reshape(-1, 64)
            counts += bits.sum(axis=0, dtype=np.int64)
        n += len(h)
    if not n:
        return hash_of(b" ".join(whole), SEED) if whole else 0
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """``doc_id`` and ``bits`` (bigint, the fingerprint's 64 bits) of every whole text."""

    def run(batches):
        for batch in T.slices(batches):
            made = [fingerprint(t, shingle) for t in T.as_bytes(batch.column(1))]
            bits = np.array(made, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], ["doc_id", "bits"])

    return T.narrow(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, bits bigint")


class GrayIndex:
    """Index over sorted distinct fingerprints that share groups of bits.

    Fingerprints are sorted by Gray rank, so neighbours differ in few bits. A
    node covers ``FAN_OUT`` nodes below it and holds the bits that all its
    fingerprints share; a child adds only the bits that its parent lacks. A
    search adds up the differences on its way down and leaves a whole group as
    soon as they exceed the bound.
    """

    def __init__(self, codes: np.ndarray):
        rank = codes.copy()
        for shift in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(shift)
        self.codes = codes[np.argsort(rank)]
        full = np.full(len(codes), ~np.uint64(0))
        self.levels = [(self.codes, full)]
        ones, zeros = self.codes, ~self.codes
        while len(ones) > 1:
            at = np.arange(0, len(ones), FAN_OUT)
            ones = np.bitwise_and.reduceat(ones, at)
            zeros = np.bitwise_and.reduceat(zeros, at)
            self.levels.append((ones, ones | zeros))
        self.levels.reverse()

    def search(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of query and code of every pair within the distance."""
        value, mask = self.levels[0]
        query = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        apart = np.bitwise_count((queries ^ value[0]) & mask[0]).astype(np.int64)
        known = np.full(len(queries), mask[0])
        for value, mask in self.levels[1:]:
            near = apart <= distance
            query, node, apart, known = query[near], node[near], apart[near], known[near]
            child = node[:, None] * FAN_OUT + np.arange(FAN_OUT)
            real = child < len(value)
            query = np.broadcast_to(query[:, None], child.shape)[real]
            apart = np.broadcast_to(apart[:, None], child.shape)[real]
            known = np.broadcast_to(known[:, None], child.shape)[real]
            node = child[real]
            fresh = mask[node] & ~known
            apart = apart + np.bitwise_count((queries[query] ^ value[node]) & fresh)
            known = mask[node]
        near = apart <= distance
        return query[near], node[near]


def _tree_links(codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all codes which searches in the index connect; one per code at most."""
    index = GrayIndex(codes)
    a, b = index.search(index.codes, distance)
    apart = a != b
    root = C.local_roots(len(codes), a[apart], b[apart])
    linked = np.flatnonzero(root != np.arange(len(codes)))
    return index.codes[linked], index.codes[root[linked]]


def _children(mask: int, distance: int) -> list[int]:
    """Masks that add two of distance + 2 blocks of the bits that a mask leaves open.

    Codes within the distance differ in ``distance`` blocks at most, so they
    agree on two blocks under one of these masks.
    """
    free = [1 << i for i in range(64) if not mask >> i & 1]
    cuts = [len(free) * i // (distance + 2) for i in range(distance + 3)]
    blocks = [sum(free[a:b]) for a, b in zip(cuts, cuts[1:])]
    return sorted({mask | x | y for x, y in combinations(blocks, 2)})


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(codes: DataFrame, distance: int = 2, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Pairs (``a``, ``b``) of distinct fingerprints in ``bits`` that connect near ones.

    Fingerprints meet in groups that agree on a mask's bits, which are the upper
    nodes of the index. A group of more than ``hot_rows`` is split by further
    masks until it is small; with few bits left open it cannot be large, as
    fingerprints are distinct. Every two fingerprints within the distance are
    in one group, and a group's links connect them; not every pair is listed.
    """
    spark = codes.sparkSession
    shared_dir(spark)
    level = [0]
    keyed = codes.select("bits", F.lit(0).cast("bigint").alias("mask"))
    ready = None
    while True:
        below = {m: _children(m, distance) for m in level}
        level = sorted({c for found in below.values() for c in found})
        table = F.create_map(
            *(x for m, found in below.items()
              for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(c)) for c in found))))
        )
        keyed = keyed.select("bits", F.explode(F.element_at(table, F.col("mask"))).alias("mask"))
        keyed = keyed.withColumn("value", F.col("bits").bitwiseAND(F.col("mask")))
        open_bits = 64 - min(m.bit_count() for m in level)
        if 1 << open_bits <= hot_rows or open_bits <= 2 * (distance + 2):
            hot, found = None, 0
        else:
            sizes = keyed.groupBy("mask", "value").agg(F.count("*").alias("rows"))
            hot = sizes.where(F.col("rows") > hot_rows).select("mask", "value").checkpoint()
            found = hot.count()
        if not found:
            ready = keyed if ready is None else ready.unionByName(keyed)
            break
        side = F.broadcast(hot) if found <= FEW_GROUPS else hot.hint("merge")
        cool = keyed.join(side, ["mask", "value"], "left_anti")
        ready = cool if ready is None else ready.unionByName(cool)
        keyed = keyed.join(side, ["mask", "value"], "left_semi").drop("value")

    def run(batches):
        for mask, value, group in _groups(batches):
            if len(group) > 1:
                a, b = _tree_links(np.unique(group), distance)
                if len(a):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
                    )

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = ready.select("mask", "value", "bits").repartition(tasks, "mask", "value")
    return dealt.sortWithinPartitions("mask", "value").mapInArrow(run, "a bigint, b bigint")


def _groups(batches):
    """Runs of rows with the same mask and value, over batch bounds."""
    last, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        mask, value, bits = (c.to_numpy() for c in batch.columns)
        bits = bits.view(np.uint64)
        change = np.flatnonzero((np.diff(mask) != 0) | (np.diff(value) != 0)) + 1
        starts = np.concatenate(([0], change)).tolist()
        for s, e in zip(starts, [*starts[1:], len(bits)]):
            key = (mask[s], value[s])
            if key != last:
                if parts:
                    yield *last, np.concatenate(parts) if len(parts) > 1 else parts[0]
                last, parts = key, []
            parts.append(bits[s:e])
    if parts:
        yield *last, np.concatenate(parts) if len(parts) > 1 else parts[0]


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 2,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex) and ``component_id`` of every row.

    Documents link at ``distance`` or fewer differing bits; the component is the
    smallest id reachable, nulls left out (null when no other id is there).
    Null and empty texts have fingerprint zero and are linked like others.
    Repeated rows stay. An empty table gives no rows. Copies are one fingerprint
    before the search, so no group of copies is expanded.
    """
    shared_dir(docs.sparkSession)
    marks = fingerprints(docs, id_col, text_col, shingle).checkpoint()
    codes = marks.groupBy("bits").agg(F.min("doc_id").alias("least"))
    codes = codes.persist(StorageLevel.DISK_ONLY)
    roots = C.components(links(codes.select("bits"), distance), "a", "b").checkpoint()
    members = roots.withColumnRenamed("node", "bits").join(codes, "bits")
    # Written first: joined as a table of its own, a root with many members is split among tasks.
    least = members.groupBy("root").agg(F.min("least").alias("component_id")).checkpoint()
    linked = members.join(least.hint("merge"), "root").select("bits", "component_id")
    alone = codes.join(linked.select("bits"), "bits", "left_anti")
    named = linked.unionByName(alone.select("bits", F.col("least").alias("component_id")))
    named = named.checkpoint()
    codes.unpersist()
    return marks.join(named.hint("merge"), "bits").select(
        "doc_id",
        F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"),
        "component_id",
    )
