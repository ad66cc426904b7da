"""License scans: an exact containment join of text blocks with license templates."""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as T

# Base phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Public license notices; a label and a text each.
TEMPLATES = (
    ("mit-notice", "Released under the MIT License."),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the software without"
        " restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the software",
    ),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0-text",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http www apache org licenses LICENSE 2.0",
    ),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-text",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation",
    ),
    (
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    ("cc-by-4.0-notice", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0-notice", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0-notice", "Licensed under CC BY-SA 4.0"),
)
THRESHOLD = 0.8
_HITS = "array<struct<label:string,base:boolean,start:bigint,end:bigint,containment:double>>"
_COLUMNS = f"doc_id bigint, n_words bigint, hits {_HITS}, best string"


@dataclass(frozen=True)
class Record:
    """A phrase or template: its words in sequence, its distinct tokens, what must be shared."""

    label: str
    base: bool
    sequence: tuple[int, ...]
    need: int
    span: int  # words a block of this record's class starts in; blocks are twice as long


class Index:
    """Records by the rarest tokens that a matching block cannot do without."""

    def __init__(self, phrases, templates, threshold: float):
        self.vocabulary: dict[bytes, int] = {}
        self.records: list[Record] = []
        for label, text, base in [(l, p, True) for p, l in phrases.items()] + [
            (l, t, False) for l, t in templates
        ]:
            found = [w for part in T.words(text.encode(), T.ALNUM_LOWER) for w in part]
            if not found:
                raise ValueError(f"no words in {text!r}")
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in found)
            size = len(set(ids))
            # The least overlap whose share of the record reaches the threshold.
            need = size if base else next(o for o in range(1, size + 1) if o / size >= threshold)
            span = 4
            while span < len(ids):
                span *= 2
            self.records.append(Record(label, base, ids, need, span))

    def order(self, counts: np.ndarray) -> None:
        """Put tokens in ascending order of their count in the corpus, and cut the prefixes."""
        rank = np.empty(len(counts), np.int64)
        rank[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
        self.rank = rank.tolist()
        self.sorted = [sorted({self.rank[t] for t in r.sequence}) for r in self.records]
        self.prefix: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at, (r, tokens) in enumerate(zip(self.records, self.sorted)):
            for i, token in enumerate(tokens[: len(tokens) - r.need + 1]):
                self.prefix[token].append((at, i))

    def tokens(self, data: bytes) -> tuple[int, array, array]:
        """Number of words, and place and id of those in the vocabulary."""
        get, n = self.vocabulary.get, 0
        places, ids = array("q"), array("i")
        for found in T.words(data, T.ALNUM_LOWER):
            for i, t in enumerate(map(get, found), n):
                if t is not None:
                    places.append(i)
                    ids.append(t)
            n += len(found)
        return n, places, ids

    def match(self, places: array, ids: array) -> list[tuple]:
        """(label, base, start, end, containment) of every match, sorted.

        A phrase matches where its words stand consecutively. A template matches
        in blocks of twice its class's span, one beginning at every multiple of
        the span, so any stretch up to the span is inside one. Each template is
        judged on its own words, whatever else matches there. The best of
        overlapping blocks is listed, by the shortest stretch that has all the
        shared words.
        """
        blocks: dict[int, dict[int, int]] = defaultdict(dict)
        rank, prefix = self.rank, self.prefix
        for place, token in zip(places, ids):
            for at, i in prefix.get(rank[token], ()):
                block, mine = place // self.records[at].span, blocks[at]
                for b in (block - 1, block) if block else (block,):
                    # The rarest shared prefix token of a candidate decides its position bound.
                    if i < mine.get(b, 1 << 30):
                        mine[b] = i
        out: set[tuple] = set()
        held: dict[tuple[int, int], tuple[int, int, list[int]]] = {}
        for at, mine in blocks.items():
            r, wanted, best = self.records[at], self.sorted[at], []
            for b, i in mine.items():
                key = (r.span, b)
                if key not in held:
                    lo = bisect_left(places, b * r.span)
                    hi = bisect_left(places, (b + 2) * r.span)
                    held[key] = lo, hi, sorted({rank[t] for t in ids[lo:hi]})
                lo, hi, tokens = held[key]
                if len(tokens) < r.need:  # length
                    continue
                j = bisect_left(tokens, wanted[i])
                if 1 + min(len(wanted) - i - 1, len(tokens) - j - 1) < r.need:  # position
                    continue
                shared = set(wanted).intersection(tokens)
                if len(shared) < r.need:
                    continue
                if r.base:
                    first, size = r.sequence[0], len(r.sequence)
                    for x in range(lo, hi - size + 1):
                        if (
                            ids[x] == first
                            and places[x + size - 1] - places[x] == size - 1
                            and tuple(ids[x : x + size]) == r.sequence
                        ):
                            out.add((r.label, True, places[x], places[x] + size, 1.0))
                    continue
                inside = [x for x in range(lo, hi) if rank[ids[x]] in shared]
                start, end = _shortest(r.sequence, inside, places, ids, len(shared))
                best.append((start, end, len(shared) / len(wanted)))
            kept: list[tuple[int, int, float]] = []
            for m in sorted(best):
                if kept and m[0] < kept[-1][1]:  # overlapping blocks of one record: the best stays
                    if m[2] <= kept[-1][2]:
                        continue
                    kept.pop()
                kept.append(m)
            out.update((r.label, False, *m) for m in kept)
        return sorted(out, key=lambda m: (m[2], m[3], m[0]))

    def best(self, matches: list[tuple]) -> str | None:
        """The likeliest template of a text: most of its words, then least besides, then the longest."""
        sizes = {r.label: len(set(r.sequence)) for r in self.records if not r.base}

        def order(m):
            shared = m[4] * sizes[m[0]]
            return -m[4], -round(shared / (m[3] - m[2]), 9), -shared, m[0]

        return min((m for m in matches if not m[1]), key=order, default=(None,))[0]


def _shortest(sequence, inside: list[int], places: array, ids: array, size: int) -> tuple[int, int]:
    """Start and end of the shortest stretch with ``size`` distinct tokens; of equals, the one most in order."""
    counts: dict[int, int] = defaultdict(int)
    left, least, found = 0, 1 << 62, []
    for x in inside:
        counts[ids[x]] += 1
        while counts[ids[inside[left]]] > 1:
            counts[ids[inside[left]]] -= 1
            left += 1
        length = places[x] - places[inside[left]]
        if len(counts) == size and length <= least:
            if length < least:
                least, found = length, []
            found.append((inside[left], x))
    if len(found) > 1:
        found.sort(key=lambda w: -_in_order(sequence, ids[w[0] : w[1] + 1]))
    return places[found[0][0]], places[found[0][1]] + 1


def _in_order(a, b) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``hits`` (label, base, start, end, containment) and ``best`` per row.

    Every block whose share of a template's distinct words reaches the threshold
    is in ``hits``, and every place of a phrase. Templates that look alike are
    all listed, each with the share of its own words; ``best`` names the template
    with the largest share, of equals the one with the fewest words in between.
    One pass counts the vocabulary's words in all texts; the next looks only at
    blocks that hold one of a record's rarest words and could still share enough
    of it by length and position. Null, empty and wordless texts have no hits;
    repeated rows stay; an empty table gives no rows. Phrases and templates are
    the caller's own lists; their words are broadcast, and only the counts of
    these words come to the driver.
    """
    spark = docs.sparkSession
    index = Index(phrases, templates, threshold)
    rows = T.narrow(docs, id_col, text_col)

    def count(batches):
        counts = np.zeros(len(index.vocabulary), np.int64)
        for batch in T.slices(batches):
            for data in T.as_bytes(batch.column(0)):
                ids = index.tokens(data)[2]
                if ids:
                    counts += np.bincount(np.frombuffer(ids, np.int32), minlength=len(counts))
        token = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(counts[token])], ["token", "n"])

    counted = rows.select("text").mapInArrow(count, "token bigint, n bigint")
    totals = np.zeros(len(index.vocabulary), np.int64)
    for token, n in counted.groupBy("token").agg(F.sum("n")).collect():
        totals[token] = n
    index.order(totals)
    shared = spark.sparkContext.broadcast(index)

    def run(batches):
        ours = shared.value
        for batch in T.slices(batches):
            sizes, hits, best = [], [], []
            for data in T.as_bytes(batch.column(1)):
                n, places, ids = ours.tokens(data)
                found = ours.match(places, ids) if len(ids) else []
                sizes.append(n)
                hits.append([dict(zip(("label", "base", "start", "end", "containment"), m)) for m in found])
                best.append(ours.best(found))
            kind = pa.list_(
                pa.struct(
                    [("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()),
                     ("end", pa.int64()), ("containment", pa.float64())]
                )
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(hits, kind), pa.array(best, pa.string())],
                ["doc_id", "n_words", "hits", "best"],
            )

    return rows.mapInArrow(run, _COLUMNS)
