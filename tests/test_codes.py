import numpy as np
import pyarrow as pa
import pytest

from tidemark.operators import codes, knn

SCHEMA = "key string, vector array<float>"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def points():
    """Clusters, many copies of one vector, one without length, one with a NaN, a null."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(7, 12)) * 3
    rows = [(centres[i % 7] + rng.normal(size=12)).tolist() for i in range(600)]
    rows += [rows[0]] * 150 + [[0.0] * 12, [float("nan")] * 12, None]
    return [(f"k{i:04d}", v) for i, v in enumerate(rows)]


def rows_of(df):
    return [tuple(r) for r in df.orderBy("query_id", "rank").collect()]


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_all_cells_and_rows_give_the_exact_result(spark, points, metric):
    corpus = frame(spark, points)
    asked = frame(spark, points[:30] + points[-4:]).withColumnRenamed("key", "query_id")
    index = codes.build_codes(corpus, 9, 5, metric)
    assert index.codes(spark).count() == len(points) - 1
    got = rows_of(codes.nearest_by_codes(asked, index, k=6, probes=9, rerank=1000))
    want = rows_of(knn.nearest(asked, corpus, k=6, metric=metric))
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    for g, w in zip(got, want):
        assert g[2] == pytest.approx(w[2], abs=2e-9) if w[2] is not None else g[2] is None
    # In blocks of queries, the same.
    assert rows_of(codes.nearest_by_codes(asked, index, k=6, probes=9, rerank=1000, limit=800)) == got


def test_few_cells_and_rows_find_most(spark, points):
    corpus = frame(spark, points)
    asked = frame(spark, points[:200]).withColumnRenamed("key", "query_id")
    index = codes.build_codes(corpus, 16, 6)
    got = codes.nearest_by_codes(asked, index, k=5, probes=6, rerank=40)
    want = knn.nearest(asked, corpus, k=5)
    # Hits as near as the exact ones count, as copies tie.
    worst = {r.query_id: r.s for r in want.groupBy("query_id").agg({"score": "min"}).toDF("query_id", "s").collect()}
    hits = rows_of(got)
    assert len(hits) == 1000
    assert sum(h[2] >= worst[h[0]] - 1e-8 for h in hits) >= 0.9 * len(hits)


def test_gap_is_the_distance_to_the_decoded_vector():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(700, 10))
    parts = codes._cut(rows, 3)
    books = [codes._centres(p) for p in parts]
    assert [b.shape for b in books] == [(256, 4), (256, 3), (256, 3)]
    made = np.column_stack([codes._nearest_centre(p, b) for p, b in zip(parts, books)])
    for row, code in zip(rows[:50], made):
        for p, b, c in zip(np.split(row, [4, 7]), books, code):
            assert ((b - p) ** 2).sum(axis=1).min() == pytest.approx(((b[c] - p) ** 2).sum())
    decoded = np.column_stack([b[c] for b, c in zip(books, made.T)])
    batch = pa.record_batch({"code": pa.array([m.astype(np.uint8).tobytes() for m in made], pa.binary())})
    queries = rng.normal(size=(4, 10))
    best = np.full((9, 20), np.inf, dtype=np.float32)
    who = np.array([1, 3, 4, 8])
    found = {}
    for q, c, gap in codes._near_codes(batch, who, queries, books, best):
        for one in zip(q, c, gap):
            found.setdefault(int(one[0]), {})[int(one[1])] = one[2]
    for i, q in enumerate(who):
        plain = ((decoded - queries[i]) ** 2).sum(axis=1)
        nearest = np.argsort(plain, kind="stable")[:20]
        assert set(nearest.tolist()) <= set(found[q])
        for c, gap in found[q].items():
            assert gap == pytest.approx(plain[c], rel=1e-4)
        assert np.sort(best[q]) == pytest.approx(np.sort(plain)[:20], rel=1e-4)
    assert np.isinf(best[[0, 2, 5, 6, 7]]).all()


def test_centres_of_few_rows_are_the_rows():
    rows = np.array([[1.0, 2.0], [1.0, 2.0], [3.0, 4.0]])
    assert codes._centres(rows).tolist() == [[1.0, 2.0], [3.0, 4.0]]


def test_empty_tables_and_bad_arguments(spark, points):
    none, some = frame(spark, []), frame(spark, points[:20])
    asked = some.withColumnRenamed("key", "query_id")
    assert rows_of(codes.nearest_by_codes(asked, codes.build_codes(none, 4, 2), k=3)) == []
    index = codes.build_codes(some, 4, 2)
    assert rows_of(codes.nearest_by_codes(asked.where("false"), index, k=3)) == []
    assert len(rows_of(codes.nearest_by_codes(asked, index, k=30, rerank=64))) == 400
    for bad in (
        lambda: codes.build_codes(some, 4, 2, "dot"),
        lambda: codes.build_codes(some, 4, 13),
        lambda: codes.nearest_by_codes(asked, index, k=9, rerank=8),
        lambda: codes.nearest_by_codes(asked, index, probes=0),
    ):
        with pytest.raises(ValueError):
            bad()


def test_codes_are_scanned_without_vectors(spark, points):
    index = codes.build_codes(frame(spark, points), 9, 4)
    assert index.codes(spark).columns.count("vector") == 0
    assert {len(r.code) for r in index.codes(spark).collect()} == {4}
