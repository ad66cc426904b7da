"""Words of texts as bytes, their hashes, and Arrow batches to walk over."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A text is cut at blanks into pieces of about so many bytes, which bounds the words held at once.
PIECE = 1 << 20
#: Rows that are turned into Python values together.
ROWS = 256
#: Stands for a null id where ids are ordered or joined: it comes first.
NO_ID = -(1 << 63)

_UPPER = bytes(range(65, 91))
_BLANK = bytes([32, *range(9, 14)])

#: A-Z to a-z, nothing else.
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
#: Words ``[^\x20\x09-\x0D]+``: any of the blanks becomes a space.
PLAIN = bytes.maketrans(_BLANK, b" " * 6)
#: The same, with A-Z lowered.
PLAIN_LOWER = PLAIN.translate(LOWER)
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lowered text: all else becomes a space.
ALNUM_LOWER = bytes(
    c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in LOWER
)

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 64, 256, np.uint64)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def id_key(name: str) -> Column:
    """An integer id that is never null."""
    return F.coalesce(F.col(name).cast("bigint"), F.lit(NO_ID))


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` (bigint) and ``text`` (null as empty) alone, so other columns cannot clash."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def slices(batches, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def as_bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def pieces(data: bytes, table: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text with ``table`` applied, cut at spaces; no word is cut."""
    data = data.translate(table)
    at = 0
    while len(data) - at > size:
        end = data.find(b" ", at + size)
        if end < 0:
            break
        yield data[at:end]
        at = end
    yield data[at:] if at else data


def words(data: bytes, table: bytes) -> Iterator[list[bytes]]:
    """Lists of words, one per piece."""
    for piece in pieces(data, table):
        yield piece.split()


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values in place."""
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for n positions at least."""
    global _powers
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(max(n, PIECE + 4096), base, np.uint64)
            row[0] = 1
            made.append(np.cumprod(row))
        _powers = made[0], made[1]
    return _powers


def _piece_hashes(piece: bytes) -> np.ndarray:
    a = np.frombuffer(piece, np.uint8)
    edges = np.flatnonzero(np.diff(a != 32, prepend=False, append=False))
    start, end = edges[::2], edges[1::2]
    up, down = _power_tables(len(a) + 1)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[a] * up[: len(a)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def word_hashes(data: bytes, table: bytes = PLAIN) -> np.ndarray:
    """A 64-bit hash of each word of a text."""
    made = [_piece_hashes(p) for p in pieces(data, table)]
    return made[0] if len(made) == 1 else np.concatenate(made)


def multiplier_of(seed: int) -> np.uint64:
    """An odd number for each seed."""
    return _U((0xD6E8FEB86659FD93 + seed * 0x3C6EF372FE94F82A) % (1 << 64))


def window_hashes(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of k words; of the whole sequence when it is shorter.

    Every seed has a multiplier of its own, so runs that agree under one seed do
    not agree under another for that reason.
    """
    n = len(hashes)
    if not n:
        return hashes
    k = min(k, n)
    h = np.full(n - k + 1, (seed + 1) * _BASE % (1 << 64), np.uint64)
    multiplier = multiplier_of(seed)
    for j in range(k):
        h *= multiplier
        h += hashes[j : n - k + 1 + j]
    return mix(h)
