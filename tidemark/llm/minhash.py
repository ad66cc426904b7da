"""Document fingerprints: one-permutation MinHash with low-order bits."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text as T
from tidemark.sources.storage import scratch_path

COLUMNS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)
#: Bytes of text in a range of ids, about.
RANGE_BYTES = 64 << 20
_ENDS = "part int, first boolean, text string"
_KINDS = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
}


@dataclass(frozen=True)
class MinHash:
    """Fingerprints of ``bins`` bins with ``bits`` bits each, over shingles of ``shingle`` words.

    Each shingle is hashed once; its top bits name the bin, where the smallest
    hash stays. An empty bin takes the value of the first filled bin in a
    random order of its own (optimal densification). Each bin hashes its value
    once more with its number, so that a value which many bins hold does not
    agree by chance in all of them at once. The low bits are stored, packed, as
    hex. No words: the empty string.
    """

    bins: int = 256
    bits: int = 4
    shingle: int = 5
    seed: int = 0
    _order: np.ndarray = field(init=False, repr=False, compare=False)
    _salt: np.ndarray = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        if self.bins & (self.bins - 1) or not 2 <= self.bins <= 4096:
            raise ValueError("bins must be a power of two up to 4096")
        if self.bits not in (1, 2, 4, 8):
            raise ValueError("bits must be 1, 2, 4 or 8")
        draw = np.random.default_rng(self.seed)
        order = draw.permuted(np.tile(np.arange(self.bins, dtype=np.int16), (self.bins, 1)), axis=1)
        object.__setattr__(self, "_order", order)
        object.__setattr__(self, "_salt", draw.integers(0, 1 << 64, self.bins, np.uint64))

    def low_bits(self, data: bytes) -> np.ndarray | None:
        """The low bits of every bin; None for a text without words."""
        h = T.window_hashes(T.word_hashes(data), self.shingle, self.seed)
        if not len(h):
            return None
        h = np.sort(h)
        shift = np.uint64(65 - self.bins.bit_length())
        at = (h >> shift).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        filled = np.zeros(self.bins, bool)
        filled[at[first]] = True
        value = np.zeros(self.bins, np.uint64)
        value[at[first]] = h[first]
        empty = np.flatnonzero(~filled)
        if len(empty):
            order = self._order[empty]
            donor = order[np.arange(len(empty)), filled[order].argmax(1)]
            value[empty] = value[donor]
        low = T.mix(value + self._salt) & np.uint64((1 << self.bits) - 1)
        return low.astype(np.uint8)

    def pack(self, low: np.ndarray | None) -> str:
        if low is None:
            return ""
        per = 8 // self.bits
        shifts = np.arange(per, dtype=np.uint8) * np.uint8(self.bits)
        return np.bitwise_or.reduce(low.reshape(-1, per) << shifts, axis=1).astype(np.uint8).tobytes().hex()

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        """Estimated share of common shingles, freed of matches by chance.

        Two texts without words are alike (1), one of them is not (0).
        """
        if a is None or b is None:
            return float(a is None and b is None)
        chance = 0.5**self.bits
        return max(0.0, (float(np.mean(a == b)) - chance) / (1 - chance))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: MinHash | None = None
) -> DataFrame:
    """Fingerprint every text, its edited text, and compare with the next document.

    Documents follow each other by id, nulls first, equal ids by a hash of the
    text; the last is followed by the first, a lone one by itself. A null text is
    empty. Texts are shuffled once, sorted by ranges over all tasks; rows that are
    equal in id and text are told apart by their place, so no range is larger for
    an id that many rows share. A task compares the documents of its range; the
    first and last text of each range are compared with those of its neighbours
    afterwards. Only a byte count comes to the driver. An empty table gives no rows.
    """
    how = how or MinHash()
    spark = docs.sparkSession
    rows = T.narrow(docs, id_col, text_col).select(
        T.id_key("doc_id").alias("key"), F.xxhash64("text").alias("tag"),
        F.monotonically_increasing_id().alias("place"), "doc_id", "text",
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES + 1)
    order = ["key", "tag", "place"]
    sorted_ = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def walk(batches):
        part, last = None, None
        for batch in T.slices(batches):
            out, ends = [], []
            for at, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                low = how.low_bits(text.encode())
                if last is None:
                    part = at
                    ends.append((doc_id, part, True, text))
                else:
                    out.append(_row(how, *last, text, low))
                last = doc_id, text, low
            yield _batch(out, ends)
        if last is not None:
            yield _batch([], [(last[0], part, False, last[1])])

    at = scratch_path(spark, "fingerprints")
    walked = sorted_.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    walked.mapInArrow(walk, f"{COLUMNS}, {_ENDS}").write.option("compression", "zstd").parquet(at)
    done = spark.read.parquet(at)
    ends = done.where("part IS NOT NULL").select("part", "first", "doc_id", "text")
    heads = ends.where("first").select(F.col("part").alias("following"), F.col("text").alias("next_text"))
    # One number per range: which range comes next, after the last the first.
    parts = heads.select(F.col("following").alias("part"))
    after = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    pairs = ends.where("NOT first").join(parts.withColumn("following", after), "part").join(heads, "following")

    def close(batches):
        for batch in T.slices(batches):
            texts = [c.to_pylist() for c in batch.columns]
            out = [
                _row(how, doc_id, text, how.low_bits(text.encode()), following, how.low_bits(following.encode()))
                for doc_id, text, following in zip(*texts)
            ]
            yield pa.RecordBatch.from_arrays(_batch(out, []).columns[: len(_KINDS)], list(_KINDS))

    closed = pairs.select("doc_id", "text", "next_text").mapInArrow(close, COLUMNS)
    return done.where("part IS NULL").select(closed.columns).unionByName(closed)


def _row(how: MinHash, doc_id, text, low, following, following_low) -> tuple:
    changed = edited(text, following).encode()
    changed_low = how.low_bits(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed).hexdigest(),
        how.pack(low),
        how.pack(changed_low),
        how.likeness(low, changed_low),
        how.likeness(low, following_low),
    )


def _batch(rows: list[tuple], ends: list[tuple]) -> pa.RecordBatch:
    """Finished rows, and the ends of ranges (id, range, whether it is the first, text)."""
    made = [list(c) for c in zip(*rows)] or [[] for _ in _KINDS]
    n = len(rows)
    columns = [pa.array(c + [None] * len(ends), k) for c, k in zip(made, _KINDS.values())]
    ids, parts, firsts, texts = [list(c) for c in zip(*ends)] or [[], [], [], []]
    columns[0] = pa.array(made[0] + ids, pa.int64())
    columns += [
        pa.array([None] * n + c, k)
        for c, k in ((parts, pa.int32()), (firsts, pa.bool_()), (texts, pa.string()))
    ]
    return pa.RecordBatch.from_arrays(columns, [*_KINDS, "part", "first", "text"])
