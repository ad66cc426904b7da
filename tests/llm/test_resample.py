"""Importance resampling against a plain version."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import ALNUM, low, odd_rows, table

from tidemark.llm import resample


def plain(rows, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    """{(doc_id, n_features, n_words, weight, score, rank)} with multiplicity, by plain loops."""

    def features(text):
        w = ALNUM.findall(low(text))
        runs = [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
        return len(w), [zlib.crc32(r.encode()) % buckets for r in runs]

    docs = [(i, *features(t)) for i, t in rows]
    s = Counter(b for *_, f in docs for b in f)
    t = Counter(b for text in target for b in features(text)[1])
    size, wanted = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (size + buckets) / ((s[b] + 1) * (wanted + buckets))))
    out = []
    for i, n, f in docs:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), n, weight, weight + noise, None])
    able = sorted((r for r in out if r[2] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[1]))
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = k
    return Counter(map(tuple, out))


def many(n=150, seed=3):
    draw = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdeéß" for b in range(30)] + ["Code", "CODE", "don't", "x" * 80]
    pick = lambda k: " ".join(draw.choice(vocabulary) for _ in range(k))
    rows = [(i, pick(draw.randint(0, 60))) for i in range(n)]
    return rows + [(7000, rows[3][1])] * 3 + odd_rows(), [pick(40), None, "", pick(300), "Code " * 50]


def found(spark, rows, target, **how):
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    out = resample.resample(table(spark, rows), items, **how).collect()
    return Counter((r["doc_id"], r["n_features"], r["n_words"], r["weight"], r["score"], r["rank"]) for r in out)


@pytest.mark.parametrize("how", [
    {}, {"longest": 2, "percent": 35}, {"longest": 4, "buckets": 97, "least_words": 1, "percent": 100},
    {"longest": 2, "head": 5, "share": 0.01}, {"head": 0, "percent": 0, "seed": 7},
], ids=str)
def test_resample_equals_plain(spark, how):
    rows, target = many()
    names = {"least_words": "least"}
    same = {names.get(k, k): v for k, v in how.items() if k not in ("head", "share")}
    assert found(spark, rows, target, **how) == plain(rows, target, **same)


def test_runs_across_pieces_of_a_long_text(spark, monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(40_000))
    features = resample.Features(1000, 3, [b"w1", b"w2"], [(b"w1", b"w2")])
    whole = Counter(int(b) for _, f in features.of(text.encode()) for b in f)
    words = resample.T.words
    monkeypatch.setattr(resample.T, "words", lambda d, t: (p.split() for p in resample.T.pieces(d, t, 100)))
    assert Counter(int(b) for _, f in features.of(text.encode()) for b in f) == whole
    monkeypatch.setattr(resample.T, "words", words)
    w = text.split()
    runs = [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    assert whole == Counter(zlib.crc32(r.encode()) % 1000 for r in runs)


def test_ties_and_a_hot_id(spark):
    rows = [(None, "a b c " * 10)] * 400 + [(None, "a b c " * 11)] * 300 + [(i, "c d " * 15) for i in range(100)]
    got = found(spark, rows, ["a b"], percent=50)
    assert got == plain(rows, ["a b"], percent=50)
    assert sorted(k[5] for k in got.elements() if k[5]) == list(range(1, 401))


def test_kept_columns(spark):
    rows, target = many(60)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    docs = table(spark, rows)
    out = resample.resample(docs, items, keep=["text", "size", "rank"], percent=30)
    assert out.columns == ["doc_id", "n_features", "n_words", "weight", "score", "rank", "text", "size"]
    texts = Counter((r["doc_id"], r["text"], r["size"]) for r in out.collect())
    assert texts == Counter((i, t, "x") for i, t in rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert resample.resample(table(spark, []), empty).count() == 0
    rows, _ = many(40)
    assert found(spark, rows, []) == plain(rows, [])
    with pytest.raises(ValueError):
        resample.Features(0, 1)


def test_gains_lean_toward_the_target():
    s, t = np.array([100, 0, 5]), np.array([0, 50, 5])
    low_, high, _ = resample.gains(s, t)
    assert low_ < 0 < high
