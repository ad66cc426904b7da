"""Small document tables and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

import xxhash

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " key string, tag string, bits string, size string, blob string, part string, label string"
)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def table(spark, rows):
    """Documents from (doc_id, text[, source[, lang]]), with columns whose names clash."""
    full = []
    for r in rows:
        doc_id, text, source, lang = (*r, *("s", "en")[len(r) - 2 :])[:4]
        full.append((doc_id, text, lang, source, None if text is None else len(text), *["x"] * 7))
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    """Null ids and texts, empty, blank and very long texts, repeated rows, equal texts."""
    draw = random.Random(1)
    prose = [" ".join(draw.choice("abcdefghij") * draw.randint(1, 6) for _ in range(60)) for _ in range(4)]
    long = " ".join(f"w{i % 5000}" for i in range(260_000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "a"), (5, prose[0]), (5, prose[0]), (6, prose[0]),
        (7, prose[1] + " " + prose[0]), (8, prose[2].upper()), (9, prose[2]), (10, "é" * 50 + " ß ü"),
        (None, prose[3]), (None, None), (11, prose[3]), (12, long), (13, "x " * 500), (14, "\x00   z\x1cq"),
        (15, "!!! ... ###"),
    ]


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def simhash(text):
    words = PLAIN.findall(low(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
