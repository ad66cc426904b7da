"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as T
from tidemark.sources.storage import shared_dir

#: Buckets that n-grams are counted in; folded to fewer where there are many languages.
BUCKETS = 1 << 15
#: Cells of the broadcast matrix at most (16 MB).
MOST_CELLS = 1 << 22
#: Code points scored together; a longer text is scored in pieces that overlap.
CHUNK = 1 << 18
#: Documents counted in one sparse table at most.
GROUP = 32
SMOOTHING = 0.1
UNKNOWN = "und"


def folds(id_col: str, held: int = 0, of: int = 5) -> Column:
    """Whether a row is held out: the checksum of its id as text has this remainder."""
    checksum = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return (checksum % of) == held


@dataclass(frozen=True)
class Model:
    """Languages in order, their log priors, and log probabilities by (bucket, language)."""

    langs: tuple[str, ...]
    priors: np.ndarray
    matrix: np.ndarray
    sizes: tuple[int, ...]


def _code_points(text: str) -> np.ndarray:
    # Runs of blanks and digits are the same in all languages.
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def buckets(codes: np.ndarray, sizes: tuple[int, ...], count: int) -> np.ndarray:
    """The bucket of every n-gram of code points."""
    out = []
    shift = np.uint64(65 - count.bit_length())
    wide = codes.astype(np.uint64)
    for n in sizes:
        if len(wide) < n:
            continue
        h = np.full(len(wide) - n + 1, n, np.uint64)
        for j in range(n):
            h += wide[j : len(wide) - n + 1 + j]
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        out.append((h >> shift).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _chunks(text: str, sizes: tuple[int, ...]):
    """The code points of a text, in pieces in which every n-gram is once."""
    if len(text) <= CHUNK:
        yield _code_points(text), sizes
        return
    for n in sizes:
        for at in range(0, len(text), CHUNK):
            yield _code_points(text[at : at + CHUNK + n - 1]), (n,)


def _counts(text: str, sizes: tuple[int, ...], count: int) -> np.ndarray:
    total = np.zeros(count, np.int64)
    for codes, ns in _chunks(text, sizes):
        total += np.bincount(buckets(codes, ns, count), minlength=count)
    return total


def train(
    rows: DataFrame, text_col: str = "text", lang_col: str = "lang", sizes: tuple[int, ...] = (1, 2, 3)
) -> Model | None:
    """Learn from all rows with text and language; None if there are none.

    Tasks count n-grams per language and bucket, sums follow. At most
    ``MOST_CELLS`` sums come to the driver: the counts are folded to fewer
    buckets first where the languages are many.
    """
    shared_dir(rows.sparkSession)
    learn = rows.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    ).where("lang IS NOT NULL AND text IS NOT NULL")

    def count(batches):
        held: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}

        def flush():
            for lang, n in held.items():
                at = np.flatnonzero(n)
                yield _counted(lang, np.append(at, -1), np.append(n[at], docs[lang]))
            held.clear()
            docs.clear()

        for batch in T.slices(batches):
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                if lang not in held:
                    if len(held) >= 64:
                        yield from flush()
                    held[lang], docs[lang] = np.zeros(BUCKETS, np.int64), 0
                docs[lang] += 1
                for codes, ns in _chunks(text, sizes):
                    held[lang] += np.bincount(buckets(codes, ns, BUCKETS), minlength=BUCKETS)
        yield from flush()

    counted = (
        learn.mapInArrow(count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .checkpoint()
    )
    priors = counted.where("bucket < 0")
    many = priors.count()
    if not many:
        return None
    if many > MOST_CELLS >> 8:
        raise ValueError(f"{many} languages: more than {MOST_CELLS >> 8}")
    size = BUCKETS
    while size * many > MOST_CELLS:
        size //= 2
    folded = (
        counted.where("bucket >= 0")
        .groupBy("lang", F.expr(f"bucket div {BUCKETS // size}").cast("int").alias("bucket"))
        .agg(F.sum("n").alias("n"))
    )
    first = priors.orderBy("lang").select("lang", "n").toArrow()
    langs = first.column("lang").to_pylist()
    cells = folded.toArrow()
    sums = np.full((size, len(langs)), SMOOTHING)
    place = {lang: i for i, lang in enumerate(langs)}
    if cells.num_rows:
        at = np.array([place[lang] for lang in cells.column("lang").to_pylist()])
        sums[cells.column("bucket").to_numpy(), at] += cells.column("n").to_numpy()
    matrix = np.log(sums) - np.log(sums.sum(axis=0))
    shares = first.column("n").to_numpy().astype(np.float64)
    return Model(tuple(langs), np.log(shares / shares.sum()), matrix.astype(np.float32), tuple(sizes))


def _counted(lang: str, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n, pa.int64())],
        ["lang", "bucket", "n"],
    )


def _scores(texts: list[str], model: Model) -> np.ndarray:
    """Log scores by (text, language): sparse counts of a few texts at a time, times the matrix."""
    count = len(model.matrix)
    out = np.tile(model.priors, (len(texts), 1))
    held: list[int] = []

    def flush():
        keys = [buckets(_code_points(texts[i]), model.sizes, count) + at * count for at, i in enumerate(held)]
        dense = np.bincount(np.concatenate(keys), minlength=len(held) * count)
        cell = np.flatnonzero(dense)
        owner, bucket = np.divmod(cell, count)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(cell)]):
            out[held[owner[a]]] += dense[cell[a:b]] @ model.matrix[bucket[a:b]].astype(np.float64)
        held.clear()

    size = 0
    for i, text in enumerate(texts):
        if len(text) > CHUNK:
            n = _counts(text, model.sizes, count)
            at = np.flatnonzero(n)
            out[i] += n[at] @ model.matrix[at].astype(np.float64)
            continue
        if held and (len(held) == GROUP or size + len(text) > CHUNK):
            flush()
            size = 0
        held.append(i)
        size += len(text)
    if held:
        flush()
    return out


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (the posterior of that language) of every row.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text where nothing was learned. Equal posteriors go to the language that
    sorts first. Whole texts count; repeated rows stay.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        ours = shared.value
        for batch in T.slices(batches):
            texts = batch.column(1).to_pylist()
            known = [i for i, t in enumerate(texts) if ours and any(map(str.isalpha, t))]
            langs, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known:
                scores = _scores([texts[i] for i in known], ours)
                best = scores.argmax(axis=1)
                posterior = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
                for i, b, p in zip(known, best, posterior):
                    langs[i], sure[i] = ours.langs[b], p
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs), pa.array(sure)], ["doc_id", "lang_pred", "score"]
            )

    return T.narrow(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, lang_pred string, score double"
    )
