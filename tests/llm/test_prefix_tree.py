"""The prefix trie against a plain version."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from helpers import PLAIN

from tidemark.llm import prefix_tree

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, pos string, block string, t0 string, a string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:30]


def plain(rows, shared=(20, 4)):
    """The nodes as sorted tuples, by walking every conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, digest(role, text), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % shared[1] if shared else 0
        base = c - (abs(c) % shared[0]) * (1 if c >= 0 else -1) if shared else c
        paths[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
        ends[path].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        gain = (len(members[node]) - 1) * len(PLAIN.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += gain
    return sorted(
        (
            min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n, m in members.items()
    )


def found(spark, rows, **how):
    frame = spark.createDataFrame([(*r, *"xxxxx") for r in rows], SCHEMA)
    how = {"shared": (20, 4)} | how
    out = prefix_tree.prefix_tree(frame, **how)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def some(seed=1, convs=70, most=9):
    draw = random.Random(seed)
    rows = []
    for c in range(-10, convs - 10):
        c = c * 3 if c % 2 else c
        for turn in range(draw.randint(1, most)):
            rows.append((c, turn, draw.choice(["user", "assistant"]), draw.choice(["hi there", "é b c", "x", "one two  three"])))
    draw.shuffle(rows)
    return rows


ODD = [
    (None, 1, "user", "nobody"), (500, None, None, None), (500, None, "user", ""), (500, 0, "user", "x"), (500, 0, "user", "x"),
    (500, 0, "assistant", "x"), (501, 3, "", ""), (502, 1, "a", "bc"), (503, 1, "ab", "c"), (504, 0, "user", "w " * 200_000),
    (505, 0, "user", "w " * 200_000), (23, 9, None, None), (-41, 1, "user", "x"),
]


@pytest.mark.parametrize("how", [{}, {"block": 3, "run": 2}, {"block": 1, "run": 1}, {"shared": None}], ids=str)
def test_nodes_equal_plain(spark, how):
    rows = some() + ODD
    assert found(spark, rows, **how) == plain(rows, how.get("shared", (20, 4)))


def test_long_conversations_go_on_in_further_blocks(spark):
    rows = [(c, t, "user", f"t{t % 7}" if t < 90 + c else f"own {c} {t}") for c in range(40, 60) for t in range(100 + c)]
    assert found(spark, rows, run=4) == plain(rows)


def test_hot_turns_and_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_tree, "PACK", 7)
    from tidemark.llm import joins

    monkeypatch.setattr(joins, "HOT_ROWS", 3)
    rows = [(c, t, "user", f"t{t}") for c in range(200) for t in range(4)]
    rows += [(1000 + c, t, "user", "same" if t == 0 else f"{c}") for c in range(200) for t in range(2)]
    assert found(spark, rows) == plain(rows)


def test_conversations_without_turns(spark):
    rows = [(c, 0, "user", "a") for c in range(1, 19)]  # none of them has a base, those with h > 0 lose their turn
    got = found(spark, rows)
    assert got == plain(rows) and got[0][1] == 0 and got[0][3] == 18
    assert found(spark, []) == []
