"""Importance resampling of documents toward a target corpus, on hashed runs of words."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as T
from tidemark.operators.ranking import rank_rows
from tidemark.sources.storage import scratch_path

#: Words (and pairs) broadcast with their CRC at most, and the longest of them in bytes.
HEAD, HEAD_BYTES = 65_536, 64
#: A task reports a word that makes up at least this share of its words.
SHARE = 1 / 20_000
#: Distinct words and pairs that a task counts at once; the rarer half goes when there are more.
COUNTED = 1_000_000
#: Most buckets: their totals come to the driver and their gains are broadcast.
MOST_BUCKETS = 1 << 20
SEED = 2024


class _States(dict):
    """CRC-32 by word; a word of the tail is computed and not kept."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


class _Pairs(dict):
    """Bucket by pair of words; a pair of the tail goes on from the state of its first word."""

    def __init__(self, known, states: _States, buckets: int):
        super().__init__(known)
        self.states, self.buckets = states, buckets

    def __missing__(self, pair: tuple[bytes, bytes]) -> int:
        return zlib.crc32(b" " + pair[1], self.states[pair[0]]) % self.buckets

    def __reduce__(self):
        return _Pairs, (dict(self), self.states, self.buckets)


class Features:
    """Buckets of all runs of 1 to ``longest`` consecutive words, joined by one space.

    A run's bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``. The CRC
    of frequent words and the buckets of frequent pairs are looked up, those of
    all others computed, with the same result: which words are frequent decides
    the speed only.
    """

    def __init__(self, buckets: int, longest: int, words=(), pairs=()):
        if not 1 <= buckets <= MOST_BUCKETS or longest < 1:
            raise ValueError(f"buckets must be 1 to {MOST_BUCKETS}, runs of 1 word or more")
        self.buckets, self.longest = buckets, longest
        self.states = _States((w, zlib.crc32(w)) for w in words)
        known = ((p, zlib.crc32(b" ".join(p)) % buckets) for p in pairs)
        self.pairs = _Pairs(known, self.states, buckets)

    def of(self, data: bytes):
        """Arrays of buckets, one for each piece of the text and length of run; the words' first."""
        before: list[bytes] = []
        for found in T.words(data, T.ALNUM_LOWER):
            if not found:
                continue
            states = np.fromiter(map(self.states.__getitem__, found), np.int64, len(found))
            yield 1, states % self.buckets
            if self.longest == 1:
                continue
            run = before[-1:] + found
            yield 2, np.fromiter(map(self.pairs.__getitem__, zip(run, run[1:])), np.int64, len(run) - 1)
            for size in range(3, self.longest + 1):
                run = before[1 - size :] + found
                yield size, np.array([self._crc(run[i : i + size]) for i in range(len(run) - size + 1)], np.int64)
            before = (before + found)[1 - self.longest :]

    def _crc(self, words: list[bytes]) -> int:
        state = self.states[words[0]]
        for word in words[1:]:
            state = zlib.crc32(b" " + word, state)
        return state % self.buckets


def _frequent(rows: DataFrame, longest: int, head: int, share: float) -> tuple[list, list]:
    """Words, and pairs if runs of two count, that are frequent in some task and most frequent in all.

    A task reports no more than ``1 / share`` words and as many pairs, so what is
    shuffled stays far below the text.
    """

    def count(batches):
        words, pairs, totals = Counter(), Counter(), [0, 0]
        for batch in T.slices(batches):
            for data in T.as_bytes(batch.column(0)):
                for found in T.words(data, T.ALNUM_LOWER):
                    words.update(found)
                    totals[0] += len(found)
                    if longest > 1:
                        pairs.update(zip(found, found[1:]))
                        totals[1] += max(0, len(found) - 1)
            for counts in (words, pairs):
                if len(counts) > COUNTED:
                    kept = counts.most_common(COUNTED // 2)
                    counts.clear()
                    counts.update(dict(kept))
        firsts, seconds, numbers = [], [], []
        for counts, total in ((words, totals[0]), (pairs, totals[1])):
            for key, n in counts.items():
                parts = key if isinstance(key, tuple) else (key, None)
                if n > 1 and n >= share * total and all(p is None or len(p) <= HEAD_BYTES for p in parts):
                    firsts.append(parts[0])
                    seconds.append(parts[1])
                    numbers.append(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(firsts, pa.binary()), pa.array(seconds, pa.binary()), pa.array(numbers, pa.int64())],
            ["first", "second", "n"],
        )

    counted = rows.select("text").mapInArrow(count, "first binary, second binary, n bigint")
    counted = counted.groupBy("first", "second").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "first", "second").limit(head).collect()
    words = [bytes(r["first"]) for r in top if r["second"] is None]
    return words, [(bytes(r["first"]), bytes(r["second"])) for r in top if r["second"] is not None]


def _totals(rows: DataFrame, features: Features) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    shared = rows.sparkSession.sparkContext.broadcast(features)

    def count(batches):
        ours = shared.value
        totals = np.zeros(ours.buckets, np.int64)
        for batch in T.slices(batches):
            for data in T.as_bytes(batch.column(0)):
                for _, found in ours.of(data):
                    totals += np.bincount(found, minlength=ours.buckets)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(totals[at])], ["bucket", "n"])

    counted = rows.select("text").mapInArrow(count, "bucket bigint, n bigint")
    totals = np.zeros(features.buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        totals[bucket] = n
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, rounded down."""
    m, s, t = len(source), float(source.sum()), float(target.sum())
    ratios = (target + 1.0) * (s + m) / ((source + 1.0) * (t + m))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def noise(id_: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw that the id decides, rounded down; a null id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = SEED,
    keep: list[str] | None = None,
    head: int = HEAD,
    share: float = SHARE,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``n_words``, ``weight``, ``score`` and ``rank`` of every row, and its ``keep`` columns.

    Features are all runs of 1 to ``longest`` words in hashed buckets. A
    bucket's gain compares its share of the target's features with that of all
    documents'; ``weight`` is the mean gain of a row's features, rounded down (0
    without any). ``score`` adds Gumbel noise drawn by the id. Of the N rows with
    ``least_words`` words, the ``percent * N // 100`` with the highest scores are
    drawn, equal scores by smaller id (null first), then fewer features; ``rank``
    is their place from 1, null for all others. ``keep=["text"]`` with ``rank IS
    NOT NULL`` gives the drawn texts.

    Three passes over the texts: frequent words, totals of the buckets, weights.
    Words and pairs of the head (``head`` of 64 bytes at most), the totals and
    the gains come to the driver; one count for each distinct score as well,
    whose number the range of gains and noise bounds. Rows from the lowest drawn
    score up are sorted by ranges and numbered from the counts of the ranges
    before, so no task takes all; rows equal in all that counts are told apart
    by their place, so no range is larger for them.

    Null texts have no words. Repeated rows count as often as they occur and
    draw alike. No documents: no rows; an empty target: all of its shares are
    equal. Columns of ``docs`` named like the ones above are not kept.
    """
    spark = docs.sparkSession
    named = ("doc_id", "n_features", "n_words", "weight", "score", "rank")
    keep = [c for c in keep or () if c not in named]
    rows = T.narrow(docs, id_col, text_col)
    words = target.select(F.coalesce(F.col(target_col).cast("string"), F.lit("")).alias("text"))
    features = Features(buckets, longest, *_frequent(rows, longest, head, share))
    gain = gains(_totals(rows, features), _totals(words, features))
    shared = spark.sparkContext.broadcast((features, gain))

    def weigh(batches):
        ours, worth = shared.value
        for batch in T.slices(batches):
            sizes, counts, weights = [], [], []
            for data in T.as_bytes(batch.column(1)):
                n, size, total = 0, 0, 0
                for length, found in ours.of(data):
                    n += len(found)
                    size += len(found) if length == 1 else 0
                    total += int(worth[found].sum())
                sizes.append(size)
                counts.append(n)
                weights.append(total // n if n else 0)
            made = [pa.array(x, pa.int64()) for x in (counts, sizes, weights)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *made], ["doc_id", "rest", "n_features", "n_words", "weight"]
            )

    rest = F.struct(*(docs[c] for c in keep)) if keep else F.lit(None).cast("boolean")
    packed = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        rest.alias("rest"),
    )
    kind = packed.schema["rest"].dataType.simpleString()
    weighed = packed.mapInArrow(
        weigh, f"doc_id bigint, rest {kind}, n_features bigint, n_words bigint, weight bigint"
    )
    weighed = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    at = scratch_path(spark, "resample")
    weighed.withColumn("row", F.monotonically_increasing_id()).write.parquet(at)
    scored = spark.read.parquet(at)

    eligible = F.col("n_words") >= least_words
    counts = sorted(scored.where(eligible).groupBy("score").count().collect(), key=lambda r: -r["score"])
    drawn = percent * sum(r["count"] for r in counts) // 100
    upto, lowest = 0, None
    for r in counts:
        if upto >= drawn:
            break
        upto, lowest = upto + r["count"], r["score"]
    columns = ["doc_id", "n_features", "n_words", "weight", "score"]
    unranked = scored.withColumn("rank", F.lit(None).cast("bigint"))
    if lowest is not None:
        chosen = eligible & (F.col("score") >= lowest)
        tie = F.struct(T.id_key("doc_id"), "n_features", "row")
        ordered = scored.where(chosen).withColumns({"batch": F.lit(0), "tie": tie})
        ordered = rank_rows(ordered, "batch", "score", "tie", hot_rows=0)
        ordered = ordered.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
        unranked = unranked.where(~chosen).unionByName(ordered.select(unranked.columns))
    return unranked.select(*columns, "rank", *(F.col(f"rest.`{c}`").alias(c) for c in keep))
