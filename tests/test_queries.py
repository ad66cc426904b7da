"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as spec
from check import compare, connect
from tidemark.plans import queries
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)
    assert set(spec.oracle_sql()) <= set(spec.queries())
    assert set(QUERIES) <= set(spec.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    mine = df.toArrow()
    assert mine.num_rows
    assert compare(mine, con.sql(ORACLES[name]).to_arrow_table()) == ""


@pytest.mark.parametrize(
    "name", ["json_whole_files", "json_mixed_file", "card_load", "notification_upsert", "notification_outcomes"]
)
def test_files_grow_with_the_rows(spark, sf, con, name, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 5 if name in ("json_mixed_file", "card_load") else 1)
    made = []
    scratch = queries.storage.scratch_path
    monkeypatch.setattr(
        queries.storage, "scratch_path", lambda s, n: made.append((n, scratch(s, n))) or made[-1][1]
    )
    mine = QUERIES[name](spark, sf).toArrow()
    assert compare(mine, con.sql(ORACLES[name]).to_arrow_table()) == ""
    kinds = {"accounts-json": "supplier", "orders-array": "orders", "cards": "customer", "uploads": "supplier"}
    kind, path = next(m for m in made if m[0] in kinds)
    if kind == "uploads":
        path += f"/{queries.BUCKET}/{queries.fixed.DATA_PREFIX}accounts"
    files = spark.read.text(path).select("_metadata.file_path").distinct().count()
    rows = spark.read.parquet(f"{sf}/{kinds[kind]}.parquet").count()
    assert files >= rows // 10


def test_large_groups_are_sliced(spark, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 10)
    rows = spark.range(1000).selectExpr("id", "CASE WHEN id < 900 THEN 'hot' ELSE 'x' || id END AS part")
    sizes = [r["count"] for r in queries._sliced(rows, "id", "part").groupBy("part", "slice").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 40 and len(sizes) > 150
    number = queries._file_of(rows, "id", 8).alias("n")
    assert 90 < rows.select(number).distinct().count() <= 100


def test_entry(spark):
    prompts = spec.entry(spark)
    assert prompts.columns == ["question_id", "prompt"]
    assert prompts.count() > 0


def plan_of(spark, sf, name):
    return spec.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_a_model_runs_once(spark, sf):
    for name in ("embed_hash", "embed_model"):
        assert plan_of(spark, sf, name).count("ArrowEvalPython") == 1


def test_metadata_is_joined_without_the_vectors(spark, sf):
    plan = plan_of(spark, sf, "prompt_build")
    assert "ArrowEvalPython" not in plan and "BroadcastHashJoin" in plan


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = plan_of(spark, sf, "filtered_rows")
    assert "LessThan(c_acctbal,0.0)" in plan and "c_name" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan_of(spark, sf, "upsert_merge")


def test_narrow_work_has_no_shuffle(spark, sf):
    for name in ("offer_payload", "rank_envelope", "tool_calls", "notification_refs", "offer_score"):
        assert "Exchange" not in plan_of(spark, sf, name)


def test_top_rows_are_not_sorted_whole(spark, sf):
    assert "TakeOrderedAndProject" in plan_of(spark, sf, "top_by_value")
