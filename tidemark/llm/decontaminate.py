"""Benchmark decontamination by winnowing."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm import text as T
from tidemark.llm.joins import lookup
from tidemark.operators.keyed_join import fits_broadcast
from tidemark.sources.storage import scratch_path

#: Words that a shared span must have at least; a shorter item counts as a whole.
WINDOW = 10
#: Words per k-gram. A window holds WINDOW - GRAM + 1 of them, of which the least is kept.
GRAM = 5
#: Benchmark words per broadcast block; the items are taken in as many blocks as it needs.
BLOCK_WORDS = 300_000
#: Blocks that are broadcast in turn; a larger benchmark is joined by shuffle.
FEW_BLOCKS = 4
#: Bits of the filter of a larger benchmark's fingerprints, at most (32 MB).
MOST_BITS = 1 << 28


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions of the least gram of every run of ``width`` grams, the last of equal ones."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at = grams[:n].copy(), np.arange(n)
    for j in range(1, width):
        other = grams[j : n + j]
        take = other <= least
        least = np.where(take, other, least)
        at = np.where(take, np.arange(j, n + j), at)
    return np.unique(at)


class Block:
    """Fingerprints and windows of some benchmark items, to be matched with any text."""

    def __init__(self, items: list[tuple[object, bytes]], window: int = WINDOW, gram: int = GRAM):
        self.vocabulary: dict[bytes, int] = {}
        self.window = window
        windows: dict[int, dict[tuple[int, ...], list[int]]] = defaultdict(dict)
        kept: dict[int, list[np.ndarray]] = defaultdict(list)
        self.items = [i for i, _ in items]
        self.shape: dict[int, tuple[int, int]] = {}
        for at, (_, data) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for ws in T.words(data, T.ALNUM_LOWER) for w in ws]
            if not ids:
                continue
            size = min(window, len(ids))
            # Of a window shorter than a gram, the window itself is the gram.
            k = gram if size == window and gram < window else size
            self.shape[size] = k, size - k + 1
            for start in range(len(ids) - size + 1):
                found = windows[size].setdefault(tuple(ids[start : start + size]), [])
                if not found or found[-1] != at:
                    found.append(at)
            grams = T.window_hashes(np.array(ids, np.uint64), k)
            kept[size].append(grams[winnow(grams, size - k + 1)])
        self.tables = {}
        for size, found in windows.items():
            cells = np.array(list(found), np.int32).reshape(len(found), size)
            h = self._hash(cells)
            order = np.argsort(h, kind="stable")
            owners = list(found.values())
            self.tables[size] = (
                np.unique(np.concatenate(kept[size])),
                h[order],
                cells[order],
                [np.array(owners[i], np.int64) for i in order],
            )

    @staticmethod
    def _hash(cells: np.ndarray) -> np.ndarray:
        h = np.full(len(cells), 99, np.uint64)
        for j in range(cells.shape[1]):
            h = h * np.uint64(0xD6E8FEB86659FD93) + cells[:, j].astype(np.uint64)
        return T.mix(h)

    def scan(self, data: bytes) -> tuple[int, list[tuple[int, int]], np.ndarray]:
        """Words of the text, the spans of hit words, and the places of items in the block."""
        get = self.vocabulary.get
        parts = [
            np.fromiter((get(w, -1) for w in found), np.int32, len(found))
            for found in T.words(data, T.ALNUM_LOWER)
        ]
        ids = parts[0] if len(parts) == 1 else np.concatenate(parts)
        n = len(ids)
        cover = np.zeros(n + 1, np.int64)
        items: list[np.ndarray] = []
        known = np.concatenate(([0], np.cumsum(ids < 0)))
        for size, (prints, hashes, cells, owners) in self.tables.items():
            if n < size:
                continue
            # Only runs of vocabulary words can hold a window; others need no fingerprints.
            able = known[size:] == known[:-size]
            if not able.any():
                continue
            k, width = self.shape[size]
            grams = T.window_hashes(ids.astype(np.uint64), k)
            at = winnow(grams, width)
            place = np.searchsorted(prints, grams[at])
            place[place == len(prints)] = 0
            at = at[prints[place] == grams[at]]
            if not len(at):
                continue
            # A hit extends to every window around it that is the benchmark's, word by word.
            near = (at[:, None] - np.arange(size - k + 1)).ravel()
            near = np.unique(near[(near >= 0) & (near <= n - size)])
            near = near[able[near]]
            if not len(near):
                continue
            mine = ids[near[:, None] + np.arange(size)]
            h = self._hash(mine)
            lo, hi = np.searchsorted(hashes, h), np.searchsorted(hashes, h, "right")
            while len(near):
                open_ = lo < hi
                near, mine, lo, hi = near[open_], mine[open_], lo[open_], hi[open_]
                same = (cells[lo] == mine).all(axis=1)
                np.add.at(cover, near[same], 1)
                np.add.at(cover, near[same] + size, -1)
                items += [owners[i] for i in np.unique(lo[same])]
                near, mine, lo, hi = near[~same], mine[~same], lo[~same] + 1, hi[~same]
        hit = np.cumsum(cover)[:n] > 0
        edges = np.flatnonzero(np.diff(hit, prepend=False, append=False)).tolist()
        return n, list(zip(edges[::2], edges[1::2])), np.unique(np.concatenate(items)) if items else np.zeros(0, np.int64)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, words: int):
    """The benchmark in blocks of about so many words, one after the other."""
    rows = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    held, size = [], 0
    for item, text in rows.where("text IS NOT NULL").toLocalIterator():
        data = text.encode()
        held.append((item, data))
        size += len(data) // 2 + 1
        if size >= words:
            yield held
            held, size = [], 0
    if held:
        yield held


def _words(benchmark: DataFrame, text_col: str) -> int:
    """The most words that the texts can have."""
    size = F.floor(F.octet_length(F.col(text_col).cast("string")) / 2) + 1
    return benchmark.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    block_words: int = BLOCK_WORDS,
    few_blocks: int = FEW_BLOCKS,
) -> DataFrame:
    """``doc_id``, ``blob``, ``n_words``, ``spans`` of hit words and ``items`` of every row.

    Texts and items are winnowed alike: of every run of k-grams that a window
    holds, the one with the least hash is kept, so two texts that share a window
    share a fingerprint there. Where fingerprints meet, the windows around are
    compared. Spans (start, end) join overlapping windows; items are those with a
    window in the text, distinct, repeated benchmark rows once.

    A benchmark of one block is broadcast to one pass over the documents, without
    a shuffle; one of a few blocks, block after block, each released before the
    next. Beyond ``few_blocks`` the fingerprints of both sides are joined by
    shuffle, so documents are read once however large the benchmark is; see
    ``_joined_route``. Null texts have no words; null item ids are kept as null;
    an empty benchmark gives no hits; an empty document table gives no rows.
    """
    rows = T.narrow(docs, id_col, text_col)
    blocks = -(-_words(benchmark, item_text_col) // block_words)
    if blocks > few_blocks:
        return _joined_route(rows, benchmark, item_col, item_text_col, window, gram)
    return _broadcast_route(rows, benchmark, item_col, item_text_col, window, gram, block_words, blocks <= 1)


def _schema(benchmark: DataFrame, item_col: str) -> ST.StructType:
    long = ST.LongType()
    span = ST.StructType([ST.StructField("start", long), ST.StructField("end", long)])
    return ST.StructType(
        [
            ST.StructField("doc_id", long),
            ST.StructField("blob", ST.StringType()),
            ST.StructField("n_words", long),
            ST.StructField("spans", ST.ArrayType(span)),
            ST.StructField("items", ST.ArrayType(benchmark.select(F.col(item_col)).schema[0].dataType)),
        ]
    )


def _broadcast_route(rows, benchmark, item_col, item_text_col, window, gram, block_words, alone) -> DataFrame:
    spark = rows.sparkSession
    schema = _schema(benchmark, item_col)
    arrow = to_arrow_schema(schema)

    def pass_over(shared, blob):
        def run(batches):
            block = shared.value
            for batch in T.slices(batches):
                sizes, spans, found = [], [], []
                for data in T.as_bytes(batch.column(1)):
                    n, hit, at = block.scan(data)
                    sizes.append(n)
                    spans.append([{"start": s, "end": e} for s, e in hit])
                    found.append([block.items[i] for i in at])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        pa.array(sizes, pa.int64()),
                        pa.array(spans, arrow.field("spans").type),
                        pa.array(found, arrow.field("items").type),
                    ],
                    schema=arrow,
                )

        return rows.select("doc_id", "text", blob.alias("blob")).mapInArrow(run, schema)

    share = lambda items: spark.sparkContext.broadcast(Block(items, window, gram))
    given = _blocks(benchmark, item_col, item_text_col, block_words)
    if alone:
        once = pass_over(share(next(given, [])), F.lit(None).cast("string"))
        return once.withColumn("items", F.array_distinct("items"))
    # Of the first block all rows are written, of the others those with a hit.
    at = scratch_path(spark, "contamination")
    for number, items in enumerate(given):
        shared = share(items)
        made = pass_over(shared, F.sha2("text", 256))
        made = made.where(F.size("spans") > 0) if number else made
        made.write.parquet(f"{at}/block={number}")
        shared.unpersist()
    every = spark.read.schema(schema).option("basePath", at).parquet(f"{at}/*").withColumn("key", T.id_key("doc_id"))
    hits = every.where(F.size("spans") > 0).dropDuplicates(["key", "blob", "block"])
    merged = hits.groupBy("key", "blob").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    return _with_hits(every.where("block = 0").drop("spans", "items", "block"), merged, schema)


def _with_hits(plain: DataFrame, hits: DataFrame, schema: ST.StructType) -> DataFrame:
    """Every row with the spans, sorted and joined, and items of its text."""
    hits = hits.withColumn("spans", _joined("spans")).checkpoint()
    none = [F.array().cast(schema[c].dataType) for c in ("spans", "items")]
    return lookup(plain, hits, ["key", "blob"]).select(
        "doc_id", "blob", "n_words", F.coalesce("spans", none[0]).alias("spans"), F.coalesce("items", none[1]).alias("items")
    )


def _prints(ids: np.ndarray, size: int, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Kept gram hashes of a text for windows of ``size``, their places, and the grams of a window."""
    k = gram if size == window and gram < window else size
    grams = T.window_hashes(ids, k) if len(ids) >= size else np.zeros(0, np.uint64)
    at = winnow(grams, size - k + 1)
    return grams[at], at, size - k + 1


def _digest(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()[:16]


def _joined_route(rows, benchmark, item_col, item_text_col, window, gram) -> DataFrame:
    """Contamination by a shuffled join of winnowed fingerprints.

    Benchmark tasks write the fingerprints and the windows (by 128 bits of the
    SHA-256 of their words) of their items. A Bloom filter of the fingerprints,
    of bounded size, is broadcast; the pass over the documents keeps the
    fingerprints that may be the benchmark's, with the windows around them. They
    are joined with the fingerprints, the windows around those that meet with
    the windows. Keys that many documents share are joined by broadcast.
    """
    spark = rows.sparkSession
    schema = _schema(benchmark, item_col)
    item = schema["items"].dataType.elementType
    at = scratch_path(spark, "contamination")
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    shape = ST.StructType(
        [ST.StructField("item", item), ST.StructField("size", ST.IntegerType()),
         ST.StructField("print", ST.LongType()), ST.StructField("sha", ST.BinaryType())]
    )
    arrow = to_arrow_schema(shape)

    def windows(batches):
        for batch in T.slices(batches, 16):
            out = []
            for name, data in zip(batch.column(0).to_pylist(), T.as_bytes(batch.column(1))):
                words = [w for ws in T.words(data, T.ALNUM_LOWER) for w in ws]
                if not words:
                    continue
                size = min(window, len(words))
                out += [(name, size, int(p), None) for p in set(_prints(T.word_hashes(data, T.ALNUM_LOWER), size, window, gram)[0].view(np.int64).tolist())]
                out += [(name, size, None, sha) for sha in {_digest(words[i : i + size]) for i in range(len(words) - size + 1)}]
            columns = [list(c) for c in zip(*out)] or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    items.where("text IS NOT NULL").mapInArrow(windows, shape).write.parquet(f"{at}/benchmark")
    bench = spark.read.parquet(f"{at}/benchmark")
    bench.where("print IS NOT NULL").select("size", "print").distinct().write.parquet(f"{at}/prints")
    prints = spark.read.parquet(f"{at}/prints")
    holders = bench.where("sha IS NOT NULL").groupBy("size", "sha").agg(F.collect_set("item").alias("items"),
        F.max(F.col("item").isNull()).alias("nameless"))
    # Sets leave nulls out; an item without an id is named by one.
    nothing = F.array(F.lit(None).cast(item))
    named = F.when(F.col("nameless"), F.concat("items", nothing)).otherwise(F.col("items"))
    holders.select("size", "sha", named.alias("items")).write.parquet(f"{at}/holders")
    holders = spark.read.parquet(f"{at}/holders")

    sizes = sorted(r["size"] for r in prints.select("size").distinct().collect())  # window numbers at most
    bits = 1 << min(max(prints.count() * 16, 64) - 1, MOST_BITS - 1).bit_length()
    bit = F.shiftrightunsigned("print", 64 - bits.bit_length() + 1)
    held = prints.select((bit / 64).cast("bigint").alias("slot"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int")).alias("w"))
    held = held.groupBy("slot").agg(F.bit_or("w").alias("w")).toArrow()
    table = np.zeros(max(bits // 64, 1), np.uint64)
    table[held.column("slot").to_numpy()] = held.column("w").to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(table)
    found = "array<struct<size:int,print:bigint,start:array<int>,sha:array<binary>>>"
    kind = pa.list_(pa.struct([("size", pa.int32()), ("print", pa.int64()), ("start", pa.list_(pa.int32())), ("sha", pa.list_(pa.binary()))]))

    def probe(batches):
        table = shared.value
        shift = np.uint64(64 - bits.bit_length() + 1)
        for batch in T.slices(batches):
            counts, hits = [], []
            for data in T.as_bytes(batch.column(1)):
                ids = T.word_hashes(data, T.ALNUM_LOWER)
                counts.append(len(ids))
                words, mine = None, []
                for size in sizes:
                    got, places, grams = _prints(ids, size, window, gram)
                    where = got >> shift
                    some = (table[where >> np.uint64(6)] >> (where & np.uint64(63))) & np.uint64(1) > 0
                    for p, place in zip(got[some].view(np.int64).tolist(), places[some].tolist()):
                        words = words or [w for ws in T.words(data, T.ALNUM_LOWER) for w in ws]
                        starts = [s for s in range(place - grams + 1, place + 1) if 0 <= s <= len(words) - size]
                        mine.append({"size": size, "print": p, "start": starts, "sha": [_digest(words[s : s + size]) for s in starts]})
                hits.append(mine)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(hits, kind)],
                ["doc_id", "blob", "n_words", "found"],
            )

    probed = rows.select("doc_id", "text", F.sha2("text", 256).alias("blob"))
    probed.mapInArrow(probe, f"doc_id bigint, blob string, n_words bigint, found {found}").write.parquet(f"{at}/probed")
    probed = spark.read.parquet(f"{at}/probed").withColumn("key", T.id_key("doc_id"))
    each = probed.dropDuplicates(["key", "blob"]).select("key", "blob", F.inline("found")).checkpoint()
    met = lookup(each, prints.withColumn("met", F.lit(True)), ["print", "size"]).where("met")
    near = met.select("key", "blob", "size", F.inline(F.arrays_zip("start", "sha"))).distinct().checkpoint()
    same = lookup(near, holders, ["sha", "size"]).where("items IS NOT NULL")
    span = F.struct(F.col("start").cast("bigint").alias("start"), (F.col("start") + F.col("size")).cast("bigint").alias("end"))
    merged = same.groupBy("key", "blob").agg(
        F.collect_set(span).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )
    return _with_hits(probed.drop("found"), merged, schema)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    block_words: int = BLOCK_WORDS,
    few_blocks: int = FEW_BLOCKS,
) -> DataFrame:
    """The rows, unchanged, whose text shares no window with the benchmark.

    One pass per block of the benchmark; what a block leaves is written to the
    shared folder before the next one. Beyond ``few_blocks`` the texts that share
    a window are found by the join of fingerprints, and their rows left out.
    """
    spark = docs.sparkSession
    if -(-_words(benchmark, item_text_col) // block_words) > few_blocks:
        blob = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
        texts = docs.select(F.lit(0).alias("id"), F.col(text_col).alias("text"))
        found = contamination(texts, benchmark, "id", "text", item_col, item_text_col, window, gram, block_words, few_blocks)
        name = "_blob"
        while name in docs.columns:
            name = f"_{name}"
        hit = found.where(F.size("spans") > 0).select(F.col("blob").alias(name)).distinct().checkpoint()
        hit = F.broadcast(hit) if fits_broadcast(hit) else hit
        return docs.join(hit, blob == F.col(name), "left_anti")
    at = docs.columns.index(text_col)
    shared = None
    for items in _blocks(benchmark, item_col, item_text_col, block_words):
        if shared is not None:
            path = scratch_path(spark, "clean")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            shared.unpersist()
        shared = spark.sparkContext.broadcast(Block(items, window, gram))
        docs = docs.mapInArrow(_keeper(shared, at), docs.schema)
    return docs


def _keeper(shared, at: int):
    def keep(batches):
        for batch in T.slices(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([not shared.value.scan(t or b"")[1] for t in texts], pa.bool_()))

    return keep


def _joined(spans: str):
    """Spans sorted, overlapping and adjoining ones made one."""
    kind = "array<struct<start:bigint,end:bigint>>"

    def add(done, one):
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], one["end"]).alias("end"))
        body = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(one["start"] <= last["end"], F.concat(body, F.array(grown))).otherwise(
            F.concat(done, F.array(one))
        )

    return F.aggregate(F.array_sort(F.col(spans)), F.array().cast(kind), add)


def hit_words(spans: str):
    """Words inside the spans."""
    return F.aggregate(F.col(spans), F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
