"""Linked vectors against all pairs."""

import numpy as np
import pytest
from helpers import groups

from tidemark.llm.near_vectors import Projections, near_vectors

SCHEMA = "vec_id bigint, embedding array<double>, label int, node string, unit string, key string, weight string, cell string"


def plain(rows, bound=0.93):
    units = []
    for _, v, label in rows:
        good = label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
        v = np.array(v, float) / np.abs(v).max() if good else None
        units.append(v / np.linalg.norm(v) if good else None)
    links = [
        (i, j) for i, u in enumerate(units) for j in range(i)
        if u is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(u) == len(units[j])
        and u @ units[j] >= bound
    ]
    degree = [0] * len(rows)
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
    root = groups(len(rows), links)
    least = {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    out = [(r[0], degree[i], least.get(root[i]), r[0] is not None and r[0] == least.get(root[i])) for i, r in enumerate(rows)]
    return sorted(out, key=repr)


def found(spark, rows, how=None, label="label"):
    frame = spark.createDataFrame([(*r, *"xxxxx") for r in rows], SCHEMA)
    out = near_vectors(frame, label_col=label, how=how)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def near(u, cosine, draw):
    """A unit vector at the given cosine to ``u``."""
    w = draw.standard_normal(len(u))
    w -= (w @ u) * u
    return cosine * u + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def some(n=300, dims=24, seed=1, labels=3):
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        u = draw.standard_normal(dims)
        u /= np.linalg.norm(u)
        label = int(draw.integers(labels))
        rows.append((1000 - len(rows), u.tolist(), label))
        for _ in range(int(draw.integers(0, 3)) if i % 3 == 0 else 0):
            u = near(u, draw.choice([0.9, 0.92, 0.932, 0.95, 0.99]), draw)
            rows.append((1000 - len(rows), (u * draw.choice([1, 4])).tolist(), label))
    return rows


SMALL = Projections(recall=0.999999, lines=40, reach=2.0, cell_rows=40, block_rows=16)

ODD = [
    (1, None, 1), (2, [], 1), (3, [0.0] * 4, 1), (4, [1.0, None, 0.0, 0.0], 1), (5, [1.0, float("nan"), 0.0, 0.0], 1),
    (6, [float("inf"), 1.0, 0.0, 0.0], 1), (7, [1.0, 0.0, 0.0, 0.0], None), (8, [1.0, 0.0, 0.0, 0.0], 1),
    (9, [2e300, 0.0, 0.0, 0.0], 1), (9, [2e300, 0.0, 0.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (None, [1e-300, 1e-301, 0.0, 0.0], 1),
    (None, None, None), (11, [1.0, 0.0, 0.0, 0.0], 2), (None, [0.0, 0.0, 1.0, 0.0], 2), (12, [-1.0, -0.0, 0.0, 0.0], 1), (13, [-3.0, 0.0, 0.0, 0.0], 1),
]


@pytest.mark.parametrize("how", [Projections(recall=0.999999, lines=40, reach=2.0), SMALL], ids=["whole", "cells"])
def test_links_equal_all_pairs(spark, how):
    rows = some() + ODD
    assert found(spark, rows, how) == plain(rows)


def test_without_labels(spark):
    rows = [(i, v, 0) for i, v, _ in some(120)]
    assert found(spark, rows, label=None) == plain(rows)


def test_common_vectors_and_dense_groups(spark):
    draw = np.random.default_rng(5)
    u = draw.standard_normal(16)
    u /= np.linalg.norm(u)
    rows = [(i, u.tolist(), 1) for i in range(400)]
    rows += [(1000 + i, near(u, 0.985, draw).tolist(), 1) for i in range(150)]
    assert found(spark, rows, SMALL) == plain(rows)


@pytest.mark.parametrize("rows", [200, 9000, 100_000_000])
def test_recall_at_the_bound(rows):
    """Of pairs at the bound itself, as many are found as stated: a shared cell and the count."""
    how, draw = Projections(), np.random.default_rng(rows)
    one = draw.standard_normal((20_000, 64))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    two = np.array([near(u, how.cosine, draw) for u in one])
    counts = (np.abs(how.project(one) - how.project(two)) <= how.window).sum(1)
    k = how.directions(rows)
    shared = (how.codes(one, k) == how.codes(two, k)).any(1)
    assert np.mean((counts >= how.least) & shared) >= how.recall**2 - 0.0005
    far = (np.abs(how.project(one) - how.project(one[::-1])) <= how.window).sum(1)
    assert np.mean(far >= how.least) < 0.02


def test_arguments(spark):
    assert found(spark, []) == []
    for bad in ({"cosine": 1.0}, {"recall": 1.0}, {"lines": 0}, {"block_rows": 1}):
        with pytest.raises(ValueError):
            Projections(**bad)
