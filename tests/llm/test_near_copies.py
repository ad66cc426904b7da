"""SimHash, its index and components; MinHash fingerprints."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from helpers import PLAIN, groups, odd_rows, rows_of, simhash, table
from pyspark.sql import functions as F

from tidemark.llm import components, minhash
from tidemark.llm import simhash as sh


def expected_components(rows):
    marks = [simhash(t) for _, t in rows]
    n = len(rows)
    links = [(i, j) for i in range(n) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 2]
    root = groups(n, links)
    least = {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], f"{marks[i]:016x}", least.get(root[i])) for i in range(n)), key=repr)


def test_simhash_odd_rows(spark):
    rows = odd_rows()
    found = sh.near_duplicates(table(spark, rows))
    assert rows_of(found, "doc_id", "fingerprint", "component_id") == expected_components(rows)


def test_simhash_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    found = sh.near_duplicates(docs)
    assert rows_of(found, "doc_id", "fingerprint", "component_id") == expected_components(rows)


def test_simhash_empty(spark):
    assert sh.near_duplicates(table(spark, [])).count() == 0


def codes_near(centres=6, each=60, lone=200, seed=3):
    draw = random.Random(seed)
    codes = set()
    for _ in range(centres):
        c = draw.getrandbits(64)
        for _ in range(each):
            codes.add(c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 3))))
    codes |= {draw.getrandbits(64) for _ in range(lone)}
    return np.array(sorted(codes), np.uint64)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_gray_index_finds_every_pair(distance):
    codes = codes_near()
    index = sh.GrayIndex(codes)
    a, b = index.search(codes, distance)
    got = {(int(codes[i]), int(index.codes[j])) for i, j in zip(a, b)}
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    want = {(int(codes[i]), int(codes[j])) for i, j in zip(*np.nonzero(apart <= distance))}
    assert got == want


@pytest.mark.parametrize("hot", [4, 16, 512])
def test_links_connect_what_is_near(spark, hot):
    codes = codes_near()
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "bits bigint")
    found = [tuple(r) for r in sh.links(df, 2, hot).collect()]
    place = {int(c): i for i, c in enumerate(codes.view(np.int64))}
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    want = groups(len(codes), list(zip(*np.nonzero(apart <= 2))))
    assert groups(len(codes), [(place[a], place[b]) for a, b in found]) == want


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(f"w{i * 7 % 1000}" for i in range(5000))
    whole = sh.fingerprint(text.encode())
    monkeypatch.setattr(sh.T.pieces, "__defaults__", (300,))
    assert sh.fingerprint(text.encode()) == whole == simhash(text)


def test_components(spark):
    draw = random.Random(5)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(300, 360)] + [(400, x) for x in range(401, 480)] + [(7, 7)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    found = dict(rows_of(components.components(df, "a", "b"), "node", "root"))
    want = groups(500, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: want[x] for x in linked}
    assert components.components(df.where("a < 0"), "a", "b").count() == 0


def shingles(text):
    words = PLAIN.findall(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def check_fingerprints(rows, found):
    tag = lambda t: (xxhash.xxh64_intdigest((t or "").encode(), 42) ^ 1 << 63)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tag(r[1])))
    want, near = [], []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        new = minhash.edited(text, after)
        assert new == text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        want.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest()))
        near.append((text, new, after))
    got = found.collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == sorted(want, key=repr)
    seen = {}
    by = {}
    for (doc_id, _, sha), texts in zip(want, near):
        by.setdefault((doc_id, sha), texts)
    for r in got:
        text, new, after = by[r["doc_id"], r["edited_sha256"]]
        for t, f in ((text, r["fingerprint"]), (new, r["edited_fingerprint"])):
            assert seen.setdefault(t, f) == f
        for other, mark in ((new, r["near_edited"]), (after, r["near_next"])):
            a, b = shingles(text), shingles(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(mark - true) < 0.2 and 0 <= mark <= 1


def test_fingerprints_odd_rows(spark):
    rows = [r for r in odd_rows()]
    check_fingerprints(rows, minhash.fingerprints(table(spark, rows)))


def test_fingerprints_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    check_fingerprints(rows, minhash.fingerprints(docs.orderBy(F.rand(3))))


def test_fingerprints_of_a_hot_id_are_spread(spark):
    """Null ids fill all ranges evenly, and each text is still compared with the one that follows."""
    rows = [(None, f"t{i % 40} " * 30) for i in range(3000)] + [(i, f"u{i} " * 30) for i in range(200)]
    docs = table(spark, rows)
    seen = []
    real = minhash.scratch_path
    minhash.scratch_path = lambda *a: seen.append(real(*a)) or seen[-1]
    try:
        found = minhash.fingerprints(docs).collect()
    finally:
        minhash.scratch_path = real
    sizes = [r["n"] for r in spark.read.parquet(seen[0]).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 8 and max(sizes) <= 2.5 * sum(sizes) / len(sizes)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert len(found) == len(rows) and len(by_id) == 200
    for i in range(199):
        changed = minhash.edited(f"u{i} " * 30, f"u{i + 1} " * 30)
        assert by_id[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
    nulls = [r for r in found if r["doc_id"] is None]
    # Equal texts follow each other: 40 groups of 75, of which only the last row of each meets another text.
    assert len(nulls) == 3000 and sum(r["near_next"] < 1 for r in nulls) == 40


def test_fingerprints_alone_and_empty(spark):
    text = " ".join(map(str, range(40)))
    check_fingerprints([(3, text)], minhash.fingerprints(table(spark, [(3, text)])))
    assert minhash.fingerprints(table(spark, [])).count() == 0


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_likeness_is_unbiased(bits):
    how = minhash.MinHash(bins=512, bits=bits, shingle=1)
    off = []
    for k in range(30):
        a = " ".join(f"{k}a{i}" for i in range(1000))
        b = " ".join(f"{k}a{i}" for i in range(500, 1500))
        off.append(how.likeness(how.low_bits(a.encode()), how.low_bits(b.encode())) - 1 / 3)
    assert abs(np.mean(off)) < 0.02
    assert how.pack(None) == ""


@pytest.mark.parametrize("bits", [1, 4])
def test_short_texts_differ(bits):
    """One shingle fills all bins; two of them must not agree by chance."""
    how = minhash.MinHash(bits=bits)
    marks = [how.low_bits(f"only {k}".encode()) for k in range(200)]
    assert how.likeness(marks[0], how.low_bits(b" only  0\n")) == 1
    assert max(how.likeness(marks[0], m) for m in marks[1:]) < 0.4


def test_arguments():
    with pytest.raises(ValueError):
        minhash.MinHash(bins=100)
    with pytest.raises(ValueError):
        minhash.MinHash(bits=3)
