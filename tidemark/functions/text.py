"""Text windows, blank tests and chunk keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed


def is_blank(text: Column) -> Column:
    """True when the text is whitespace only, Unicode spaces included."""
    return ~text.rlike(fixed.NOT_BLANK)


def char_windows(
    text: Column, size: int = fixed.CHUNK_SIZE, overlap: int = fixed.CHUNK_OVERLAP
) -> Column:
    """Array of non-blank windows of ``size`` code points, ``overlap`` shared.

    The text is cut once into blocks of one step, and each window is put
    together from the blocks it spans. Taking a substring per window would walk
    the UTF-8 text from its start each time, which is quadratic in its length.
    """
    if size < 1:
        raise ValueError(f"size must be at least 1, got {size}")
    step = max(1, size - overlap)
    span = -(-size // step)
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))

    def windows(cut: Column) -> Column:
        joined = F.transform(
            cut,
            lambda _, i: F.substring(
                F.array_join(F.slice(cut, i + 1, F.lit(span)), ""), 1, size
            ),
        )
        return F.filter(joined, lambda w: ~is_blank(w))

    # The outer one-element transform evaluates the blocks once per row.
    return F.transform(F.array(blocks), windows)[0]


def chunk_key(source_key: Column, index: Column) -> Column:
    """Stable 40-digit hex key of a chunk."""
    return F.sha1(
        F.concat(source_key, F.lit(fixed.CHUNK_KEY_SEPARATOR), index.cast("string"))
    )


def url_unquote(key: Column) -> Column:
    """Decode ``%xx`` and ``+``; a ``%`` without two hex digits stays as it is."""
    return F.url_decode(F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25"))
