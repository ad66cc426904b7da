import pytest
from pyspark.sql import functions as F

from tidemark.operators import bloom
from tidemark.operators import keyed_join as kj
from tidemark.operators import upsert

ROW = "k string, v int"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merge(spark):
    target = frame(spark, ("a", 1), ("b", 2), (None, 3))
    source = spark.createDataFrame([(5, "b"), (6, "c"), (7, None)], "v int, k string")
    merged = upsert.merge_by_key(target, source, "k")
    assert rows(merged) == [("a", 1), ("b", 5), ("c", 6), (None, 3), (None, 7)]
    assert rows(upsert.merge_by_key(merged, source, "k")) == sorted(
        [*rows(merged), (None, 7)], key=repr
    )


def test_merge_last_wins(spark):
    source = frame(spark, ("b", 5), ("b", 9), ("b", 7))
    merged = upsert.merge_by_key(frame(spark, ("b", 2)), source, "k", ordinal=F.col("v"))
    assert rows(merged) == [("b", 9)]


def test_null_ordinals_come_last(spark):
    source = frame(spark, ("a", None), ("b", 4), ("b", None), (None, None))
    merged = upsert.merge_by_key(frame(spark, ("a", 1), ("z", 2)), source, "k", ordinal=F.col("v"))
    assert rows(merged) == [("a", None), ("b", 4), ("z", 2), (None, None)]
    got = upsert.rows_of_last(source.withColumn("o", F.col("v")), "k", "o").select("k", "v")
    assert rows(got) == [("a", None), ("b", 4), (None, None)]


def test_replace_keeps_copies(spark):
    target = frame(spark, ("a", 1), ("b", 2), ("b", 3))
    batch = frame(spark, ("b", 9), ("b", 9), ("c", 1), (None, 1))
    want = [("a", 1), ("b", 9), ("b", 9), ("c", 1), (None, 1)]
    assert rows(upsert.replace_by_keys(target, batch, "k")) == want


def test_empty_batch(spark):
    target = frame(spark, ("a", 1), (None, 2))
    assert rows(upsert.replace_by_keys(target, frame(spark), "k")) == rows(target)


def test_rows_of_last(spark):
    batch = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 2), ("a", 3, 2), ("b", 4, 1), (None, 5, 1), (None, 6, 2)],
        "k string, v int, o int",
    )
    got = upsert.rows_of_last(batch, "k", "o").select("k", "v")
    assert rows(got) == [("a", 2), ("a", 3), ("b", 4), (None, 5), (None, 6)]


@pytest.fixture
def skewed(spark):
    """A third of the rows have one key, some have none."""
    big = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, None)
        .otherwise((F.col("id") % 500).cast("string"))
        .alias("k"),
        F.col("id").cast("int").alias("v"),
    )
    return big


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
@pytest.mark.parametrize("with_hot", [True, False])
def test_ways_to_join_agree(spark, skewed, how, with_hot):
    unique = spark.range(0, 500, 2).select(F.col("id").cast("string").alias("k"))
    if with_hot:
        unique = unique.union(spark.createDataFrame([("hot",)], "k string"))
    want = rows(skewed.join(unique, "k", how).select("k", "v"))
    for limit, hot_rows in ((1 << 30, 10), (0, 10**9), (0, 1000), (0, 10)):
        assert rows(kj.keyed_join(skewed, unique, ["k"], how, limit, hot_rows)) == want


def joined_plan(spark, df):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        return df._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("hot_rows", [1000, 10**9])
def test_only_rows_that_may_match_are_shuffled(spark, tmp_path, hot_rows):
    """Of 200,000 rows with 100 keys of the batch among them, under a twentieth."""
    spark.range(200_000).select(F.col("id").cast("string").alias("k"), "id").write.parquet(f"{tmp_path}/big")
    big = spark.read.parquet(f"{tmp_path}/big")
    unique = spark.range(0, 200_000, 2000).select(F.col("id").cast("string").alias("k"))
    joined = kj.keyed_join(big, unique, ["k"], "left_anti", 0, hot_rows)
    plan = joined_plan(spark, joined)
    # One read for the rows that are done where they lie, one for those that are joined.
    assert plan.count("FileScan parquet") == 2 and plan.count("SortMergeJoin") == 1
    assert joined.count() == 199_900 and joined.where(F.col("id") % 2000 == 0).isEmpty()
    words = bloom.words_for(100)
    marked = bloom.maybe_in(big, ["k"], bloom.bloom_filter(unique, ["k"], words), words, "maybe")
    assert 100 <= marked.where("maybe").count() <= 10_000


def test_a_filter_loses_no_key(spark):
    keys = spark.range(5000).select((F.col("id") * 7).alias("a"), F.col("id").cast("string").alias("b"))
    for words in (1, 50, bloom.words_for(5000)):
        made = bloom.bloom_filter(keys.unionByName(keys.limit(9).select(F.lit(None).cast("bigint").alias("a"), "b")), ["a", "b"], words)
        assert made.count() <= words
        held = bloom.maybe_in(keys, ["a", "b"], made, words, "maybe")
        assert held.where("maybe").count() == 5000 and held.columns == ["a", "b", "maybe"]
    other = spark.range(50_000).select((F.col("id") + 10**6).alias("a"), F.col("id").cast("string").alias("b"))
    assert bloom.maybe_in(other, ["a", "b"], made, words, "maybe").where("maybe").count() < 2500
    empty = bloom.bloom_filter(keys.where("false"), ["a", "b"], 1)
    assert bloom.maybe_in(keys, ["a", "b"], empty, 1, "maybe").where("maybe").isEmpty()
    none = keys.select(F.lit(None).cast("bigint").alias("a"), "b")
    assert bloom.maybe_in(none, ["a", "b"], made, words, "maybe").where("maybe IS NULL OR maybe").isEmpty()


def test_a_full_filter_gives_the_same_join(spark, skewed, monkeypatch):
    monkeypatch.setattr(kj, "words_for", lambda keys: 1)
    unique = spark.range(0, 500, 2).select(F.col("id").cast("string").alias("k"))
    for how in ("left_semi", "left_anti"):
        want = rows(skewed.join(unique, "k", how).select("k", "v"))
        assert rows(kj.keyed_join(skewed, unique, ["k"], how, 0, 100)) == want


def test_hot_rows_are_dealt_to_parts(spark, skewed):
    unique = spark.createDataFrame([("hot",), ("1",)], "k string")
    joined = kj.keyed_join(skewed, unique, ["k"], "left_anti", limit=0, hot_rows=100)
    assert rows(joined) == rows(skewed.where("k IS NULL OR k NOT IN ('hot', '1')"))
    assert rows(kj.hot_keys(skewed, "k", 1000)) == [("hot", 3)]


def test_every_hot_key_is_split(spark):
    """More hot keys than any fixed number would have named."""
    big = spark.range(60_000).select((F.col("id") % 12_000).alias("k"), "id")
    assert kj.hot_keys(big, "k", 4).count() == 12_000
    assert {r._parts for r in kj.hot_keys(big, "k", 4).collect()} == {2}
    unique = spark.range(0, 12_000, 2).select(F.col("id").alias("k"))
    assert kj.keyed_join(big, unique, ["k"], "left_semi", 0, 4).count() == 30_000


def test_broadcast_is_measured(spark):
    keys = spark.range(1000).select(F.repeat(F.lit("x"), 100).alias("k"))
    assert kj.fits_broadcast(keys)
    assert not kj.fits_broadcast(keys, 100_000)
    assert kj.fits_broadcast(keys.limit(0), 0)
