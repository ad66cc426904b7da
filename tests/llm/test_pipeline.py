"""The pipeline against plain versions of its stages, and every numbered query."""

import os
import sys

import pytest
from helpers import ALNUM, low, odd_rows, simhash, table

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as cp  # noqa: E402
from test_near_copies import expected_components  # noqa: E402
from test_spans import windows_hit  # noqa: E402

import check  # noqa: E402
from tidemark.llm import queries, secrets, toxicity  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(spark, sf, name):
    con = check.connect(sf)
    mine = queries.QUERIES[name](spark, sf).toArrow()
    assert check.compare(mine, con.sql(queries.ORACLES[name]).to_arrow_table()) == ""


def test_stages_name_the_operators():
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "source_mixing"]


def test_pipeline_against_plain_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    model = toxicity.train(
        docs, spark.read.parquet(f"{sf}/labels.parquet"), train_rows=~cp.langid.folds("doc_id", 2, 4)
    )
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if scores[r["doc_id"]] < 0.3]
    heads = {c for _, _, c in expected_components(rows)}
    rows = [r for r in rows if r[0] in heads]
    rows = [r for r in rows if not windows_hit(ALNUM.findall(low(r[1])), bench)[0]]
    scanner = secrets.Scanner()

    def cut(t):
        spans = [{"start": s, "end": e} for _, s, e in scanner.spans(t)]
        return secrets._replace(t, spans, "[SECRET]") if spans else t

    want = {i: cut(t) for i, t in rows}
    out = cp.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} <= set(want)
    assert all(r["text"] == want[r["doc_id"]] and 1 <= r["copies"] <= 3 for r in out)
    by = {r["source"]: r for r in out}
    for source, one in by.items():
        words = sum(r["taken"] for r in out if r["source"] == source)
        assert abs(words - one["target"]) <= max(r["size"] for r in out)


def small_folder(spark, tmp_path, rows):
    docs = table(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "an item that none of the documents here has in it")], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    turns = [(i, n, "user", t) for n, (i, t) in enumerate(rows)]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    vectors = [(i, None if t is None else [float(len(t)), None if t == "a" else 1.0], len(t or "") % 2 or None) for i, t in rows]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def test_near_copies_keep_one_row_of_each_group(spark, tmp_path):
    rows = odd_rows()
    folder = small_folder(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = cp.drop_near_copies(spark, docs, folder)
    marks = [simhash(t) for _, t in kept.select("doc_id", "text").collect()]
    assert all((a ^ b).bit_count() > 2 for i, a in enumerate(marks) for b in marks[:i])
    all_marks = [simhash(t) for _, t in rows]
    assert all(any((a ^ b).bit_count() <= 2 for b in marks) for a in all_marks)
    assert kept.columns == list(cp.COLUMNS)


@pytest.mark.parametrize("rows", [[], odd_rows()], ids=["empty", "odd"])
def test_pipeline_runs_on_odd_tables(spark, tmp_path, rows):
    folder = small_folder(spark, tmp_path, rows)
    out = cp.run(spark, folder)
    assert set(cp.COLUMNS) <= set(out.columns)
    assert out.count() <= len(rows)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run_on_odd_tables(spark, tmp_path, name):
    folder = small_folder(spark, tmp_path, odd_rows())
    out = queries.QUERIES[name](spark, folder)
    if name == "op12_prefix_trie":  # a row per node: the root and one for every turn
        rows = odd_rows()
        assert 1 < out.count() <= 1 + sum(i is not None for i, _ in rows)
        assert out.where("depth = 0").first()["n_convs"] == len({i for i, _ in rows if i is not None})
    else:
        assert out.count() == len(odd_rows())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run_on_empty_tables(spark, tmp_path, name):
    folder = small_folder(spark, tmp_path, [])
    assert queries.QUERIES[name](spark, folder).count() == 0

