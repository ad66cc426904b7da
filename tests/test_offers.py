import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import metadata, offers
from tidemark.operators import offers as responses
from tidemark.operators import ranking


def score(spark, offer):
    df = spark.createDataFrame([(json.dumps(offer),)], "o string")
    return df.select(offers.offer_score(F.parse_json("o")).alias("s")).first().s


BEST = {"apr": {"min": 10.0, "max": 20.0}, "annual_fee": 0, "rewards_score": 25, "bonus_score": 20}


@pytest.mark.parametrize(
    "offer, want",
    [
        (BEST, 100.0),
        ({"apr": {"min": 40.0}, "annual_fee": 0}, 25.0),
        ({"apr": {"min": 5.0}}, 30.0),
        ({"apr": 15}, 25.0),
        ({"apr": "15.5"}, 24.5),
        ({"apr": {"min": None}}, 0.0),
        ({"apr": {}}, 0.0),
        ({"apr": None}, 0.0),
        ({"apr": "n/a"}, 0.0),
        ({"annual_fee": 500}, 0.0),
        ({"annual_fee": 9000}, 0.0),
        ({"annual_fee": "95"}, 20.25),
        ({"annual_fee": -20}, 26.0),
        ({"rewards_score": 999}, 25.0),
        ({"rewards_score": None}, 0.0),
        ({"bonus_score": 999}, 20.0),
        ({"bonus_score": -3}, -3.0),
        ({}, 0.0),
        ({"apr": {"min": 12.5}, "annual_fee": "95", "bonus_score": 5}, 52.75),
        ({"apr": {"min": 10.333}}, 29.67),
    ],
)
def test_score(spark, offer, want):
    assert score(spark, offer) == want


def payload_names(spark, text):
    df = spark.createDataFrame([(text,)], "p string")
    rows = ranking.rank_payloads(df, "p").collect()
    return [
        (r["rank"], r.pos, r.score) for r in sorted(rows, key=lambda r: r["rank"])
    ]


def test_payload_shapes(spark):
    cards = [{"bonus_score": 1}, {"bonus_score": 5}, {"bonus_score": 1}]
    want = [(1, 1, 5.0), (2, 0, 1.0), (3, 2, 1.0)]
    assert payload_names(spark, json.dumps(cards)) == want
    assert payload_names(spark, json.dumps({"cards": cards})) == want
    for nothing in ("[]", '{"cards":[]}', "{}", "5", "cut [", '{"cards":null}', "[1,2]"):
        assert payload_names(spark, nothing) == []


def test_document(spark):
    cards = [
        {"name": "b", "apr": {"min": 15.5, "max": 20}, "key_features": ["x", "é"], "score": "old"},
        {"name": "a", "annual_fee": 0, "rank": 9},
    ]
    df = spark.createDataFrame([(json.dumps(cards),), ("cut [",), ("[]",)], "p string")
    at = F.lit("2024-05-06 07:08:09").cast("timestamp")
    got = [r.document for r in ranking.ranked_documents(df, "p", at=at).collect()]
    doc = json.loads(got[0])
    assert doc["generated_at"] == "2024-05-06T07:08:09.000000+00:00"
    assert (doc["source"], doc["total"]) == ("web_search", 2)
    assert doc["top_cards"] == [
        {"name": "a", "annual_fee": 0, "score": 25.0, "rank": 1},
        {
            "name": "b",
            "apr": {"min": 15.5, "max": 20},
            "key_features": ["x", "é"],
            "score": 24.5,
            "rank": 2,
        },
    ]
    assert got[1] is None
    assert json.loads(got[2])["top_cards"] == []


def test_generated_at_is_utc(spark):
    df = spark.createDataFrame([("[]",)], "p string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = F.timestamp_seconds(F.lit(0))
        got = ranking.ranked_documents(df, "p", at=at).first().document
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert json.loads(got)["generated_at"] == "1970-01-01T00:00:00.000000+00:00"


def ranks(df):
    return {r.k: r["rank"] for r in df.collect()}


@pytest.mark.parametrize("hot_rows", [10**9, 1000, 0])
def test_ranks_with_a_batch_that_holds_most_rows(spark, hot_rows):
    """Plain windows, ranges for the large batch only, and ranges for all."""
    n = 6000
    df = spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 > 0, "hot")
        .when(F.col("id") % 30 == 0, None)
        .otherwise(F.concat(F.lit("b"), F.col("id") % 7))
        .alias("batch"),
        F.when(F.col("id") % 2 == 0, 1.0).otherwise((F.col("id") * 7919 % 101).cast("double")).alias("score"),
    )
    got = ranks(ranking.rank_rows(df, "batch", "score", "k", hot_rows))
    batches = {}
    for r in df.collect():
        batches.setdefault(r.batch, []).append((-r.score, r.k))
    want = {k: i for rows in batches.values() for i, (_, k) in enumerate(sorted(rows), 1)}
    assert got == want


def test_ranges_are_spread_over_tasks(spark):
    df = spark.range(50_000).select(
        F.col("id").alias("k"), F.lit("only").alias("batch"), F.rand(1).alias("score")
    )
    ranked = ranking.rank_rows(df, "batch", "score", "k", hot_rows=100)
    assert ranked.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first()[:] == (
        50_000,
        1,
        50_000,
    )


BLOCKS = {
    "stop_reason": "tool_use",
    "content": [
        {"type": "text", "text": "thinking"},
        {"type": "tool_use", "id": "t1", "name": "save_top_cards", "input": {"cards_json": "[{}]"}},
        {"type": "server_tool_use", "id": "s1", "name": "search", "input": {}},
        {"type": "tool_use", "id": "t2", "name": "other", "input": {"x": 1}},
    ],
}
CHOICE = {
    "choices": [
        {
            "finish_reason": "tool_calls",
            "message": {
                "tool_calls": [
                    {
                        "id": "c1",
                        "function": {"name": "save_top_cards", "arguments": '{"cards_json": "[]"}'},
                    }
                ]
            },
        }
    ]
}


def test_tool_calls(spark):
    stopped = {"choices": [{"finish_reason": "stop", "message": {"content": "hi"}}]}
    cut_off = json.loads(json.dumps(CHOICE))
    cut_off["choices"][0]["finish_reason"] = "length"
    said = [
        BLOCKS,
        CHOICE,
        stopped,
        cut_off,
        {"stop_reason": "pause_turn", "content": []},
        {"stop_reason": "max_tokens", "content": []},
        {"stop_reason": "refusal", "content": []},
        {"neither": 1},
    ]
    df = spark.createDataFrame(
        [(i, json.dumps(s)) for i, s in enumerate(said)], "i int, r string"
    ).coalesce(1)
    read = responses.response_calls(df, "r").collect()
    assert [r.stop_reason for r in read] == [
        "tool_use",
        "tool_use",
        "end_turn",
        "end_turn",
        "pause_turn",
        "max_tokens",
        "end_turn",
        None,
    ]
    assert [None if r.calls is None else len(r.calls) for r in read] == [2, 1, 0, 0, 0, 0, 0, None]
    calls = responses.tool_calls(df, "r")
    assert [(r.i, r.id, r.name) for r in calls.collect()] == [
        (0, "t1", "save_top_cards"),
        (0, "t2", "other"),
        (1, "c1", "save_top_cards"),
    ]
    saved = responses.saved_payloads(calls).collect()
    assert [(r.id, r.payload) for r in saved] == [("t1", "[{}]"), ("c1", "[]")]


def test_metadata(spark):
    said = [
        '{"a":1,"b":null,"c":"t","d":{"x":1},"e":[1,2],"f":true,"g":1.5,"h":9999999999}',
        "[1]",
        "null",
        "cut {",
        None,
        "{}",
    ]
    df = spark.createDataFrame([(s,) for s in said], "t string").coalesce(1)
    got = df.select(
        F.to_json(metadata.clean_metadata(F.col("t"))).alias("m"),
        F.to_json(metadata.metadata_document(F.col("t"))).alias("d"),
    ).collect()
    first = json.loads(got[0].m)
    assert first == {
        "a": 1,
        "c": "t",
        "d": '{"x":1}',
        "e": "[1,2]",
        "f": True,
        "g": 1.5,
        "h": 9999999999,
    }
    assert json.loads(got[0].d) == first
    assert [r.m for r in got[1:]] == ["{}"] * 5


def test_documents_of_batches(spark):
    """The best of every batch, the whole count, ties by name; each task cuts before the shuffle."""
    rows = [(b, f"{b}{i:03}", 3.0 * (i % 7)) for b in ("x", "y", None) for i in range(40 if b else 3)]
    df = spark.createDataFrame(rows, "b string, name string, rewards double")
    offer = F.parse_json(F.to_json(F.struct("name", F.col("rewards").alias("rewards_score"))))
    df = df.withColumn("offer", F.when(F.col("name") != "x000", offer))
    found = ranking.ranked_batches(df.repartition(5), "b", "offer", "name", n=10)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan
    documents = {r["b"]: json.loads(r["document"]) for r in found.collect()}
    assert {b: d["total"] for b, d in documents.items()} == {"x": 40, "y": 40, None: 3}
    for b, d in documents.items():
        mine = sorted(((-score, name) for bb, name, score in rows if bb == b))[:10]
        assert [(c["rank"], c["score"], c["name"]) for c in d["top_cards"]] == [
            (i + 1, -s, n) for i, (s, n) in enumerate(mine)
        ]
    with pytest.raises(ValueError):
        ranking.ranked_batches(df, "b", "offer", "name", n=1001)
    only = ranking.ranked_batches(df.where("name = 'x000'"), "b", "offer", "name").first()
    assert json.loads(only["document"])["top_cards"] == [{"score": 0.0, "rank": 1}]
    assert ranking.ranked_batches(df.where("false"), "b", "offer", "name").count() == 0
