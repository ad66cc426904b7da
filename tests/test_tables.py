import pytest
from pyspark.sql import functions as F

from tidemark.operators import upsert
from tidemark.sources import storage, tables, vector_table
from tidemark.sources.tables import BucketTable

ROW = "card_id string, amount double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    t = BucketTable(spark, f"{tmp_path}/t")
    t.create(frame(spark, ("a", 1.0), ("b", 2.0), ("b", 2.5), (None, 9.0)), "card_id", 4)
    return t


def test_save_creates_then_upserts(spark, tmp_path):
    first = frame(spark, ("a", 1.0), ("b", 2.0))
    save = dict(namespace="bank", table="cards", key="card_id", root=str(tmp_path))
    assert tables.save_table(first, **save) == 2
    assert tables.save_table(first, **save) == 2
    assert tables.save_table(frame(spark, ("b", 5.0), ("c", 3.0)), **save) == 3
    got = tables.read_table(spark, "bank", "cards", root=str(tmp_path))
    assert rows(got) == [("a", 1.0), ("b", 5.0), ("c", 3.0)]


@pytest.mark.parametrize(
    "wrong", [{"table": "bad-name!"}, {"catalog": "bad catalog"}, {"key": "k;"}, {"namespace": ""}]
)
def test_save_refuses_bad_names(spark, tmp_path, wrong):
    good = dict(namespace="bank", table="cards", key="card_id", catalog="local")
    with pytest.raises(ValueError):
        tables.save_table(frame(spark), **{**good, **wrong}, root=str(tmp_path))


def test_merge_sql():
    sql = tables.merge_sql("c.n.t", "v", "card_id")
    assert sql.startswith("MERGE INTO c.n.t AS target USING v AS source ON target.card_id")
    assert sql.endswith("WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")


def test_duplicate_source_keys(spark, tmp_path):
    twice = frame(spark, ("a", 1.0), ("a", 2.0))
    fresh = BucketTable(spark, f"{tmp_path}/fresh")
    with pytest.raises(upsert.DuplicateKeys):
        fresh.merge(twice, "card_id")
    assert not fresh.exists()
    assert fresh.merge(twice, "card_id", ordinal=F.col("amount")) == 1
    assert rows(fresh.read()) == [("a", 2.0)]
    with pytest.raises(upsert.DuplicateKeys):
        upsert.merge_by_key(twice, twice, "card_id")


def test_lost_race_to_create_merges(spark, table, monkeypatch):
    answers = iter([False])
    real = BucketTable.exists
    monkeypatch.setattr(
        BucketTable, "exists", lambda self: next(answers, None) is not False and real(self)
    )
    assert table.merge(frame(spark, ("z", 1.0)), "card_id", 4) == 5


def bucket_files(t):
    layout = t._layout()
    folder = t._folder(layout)
    return {b: storage.child_names(t.spark, f"{folder}/_bucket={b}") for b in t._buckets(layout)}


def test_replace(spark, table):
    before = bucket_files(table)
    assert table.replace(frame(spark), "card_id") == 0
    assert bucket_files(table) == before
    assert table.replace(frame(spark, ("b", 7.0), ("b", 8.0), ("c", 1.0)), "card_id") == 3
    assert rows(table.read()) == [("a", 1.0), ("b", 7.0), ("b", 8.0), ("c", 1.0), (None, 9.0)]
    assert table.count() == table.read().count() == 5


def test_replace_without_keys_appends(spark, table):
    batch = spark.createDataFrame([(3.0,), (4.0,)], "amount double")
    before = bucket_files(table)
    assert table.replace(batch, "card_id") == 2
    assert rows(table.read())[-3:] == [(None, 3.0), (None, 4.0), (None, 9.0)]
    after = bucket_files(table)
    assert all(after[b] == before[b] for b in before if b != tables.NO_KEY)
    assert set(before[tables.NO_KEY]) < set(after[tables.NO_KEY])


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    t = BucketTable(spark, f"{tmp_path}/t")
    t.create(spark.range(1000).select(F.col("id").cast("string").alias("card_id"), F.lit(1.0).alias("amount")), "card_id", 16)
    old = bucket_files(t)
    t.replace(frame(spark, ("7", 2.0)), "card_id")
    new = bucket_files(t)
    assert sum(old[b] != new[b] for b in old) == 1
    assert t.count() == t.read().count() == 1000


def test_drop_can_empty_a_bucket(spark, tmp_path):
    t = BucketTable(spark, f"{tmp_path}/t")
    t.create(frame(spark, ("a", 1.0), ("b", 1.0)), "card_id", 8)
    t.replace(frame(spark, ("c", 1.0)), "card_id", drop=frame(spark, ("a", 0.0)))
    assert rows(t.read()) == [("b", 1.0), ("c", 1.0)]
    t.replace(frame(spark), "card_id", drop=frame(spark, ("b", 0.0), ("c", 0.0)))
    assert rows(t.read()) == []
    t.replace(frame(spark, ("d", 1.0)), "card_id")
    assert rows(t.read()) == [("d", 1.0)]


def test_buckets_follow_the_data(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_BYTES", 4000)
    t = BucketTable(spark, f"{tmp_path}/t")
    t.create(frame(spark, *[(f"k{i}", 0.0) for i in range(10)]), "card_id")
    assert t._layout()["buckets"] == 16
    big = spark.range(100_000).select(F.sha1(F.col("id").cast("string")).alias("card_id"), F.rand(3).alias("amount"))
    t.replace(big, "card_id")
    assert t._layout()["buckets"] > 500
    assert t.count() == 100_010
    t.replace(frame(spark, ("k1", 5.0)), "card_id")
    assert t.count() == 100_010 and t.read().where("card_id = 'k1'").first().amount == 5.0


def test_wrong_key_is_refused(spark, table):
    with pytest.raises(ValueError):
        table.replace(frame(spark), "amount")


def test_heavy_key_is_split_over_files(spark, tmp_path):
    """A key with a third of the rows does not make one file or one task."""
    big = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("card_id"),
        F.rand(7).alias("amount"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        t = BucketTable(spark, f"{tmp_path}/t")
        t.create(big, "card_id", 2)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = t.read().where("card_id = 'hot'").select(F.input_file_name().alias("f")).distinct()
    assert hot.count() > 1
    assert t.count() == 300_000


CHUNK = (
    "key string, vector array<float>, metadata struct<source_bucket:string,"
    "source_key:string,chunk_index:int,text:string>"
)


def chunk(key, doc, i, text):
    return (key, [1.0, 0.0], ("b", doc, i, text))


def test_put_chunks(spark, tmp_path):
    t = BucketTable(spark, f"{tmp_path}/t")
    put = lambda *c, **k: vector_table.put_chunks(spark.createDataFrame(list(c), CHUNK), t, **k)
    assert put() == 0 and not t.exists()
    assert put(chunk("k0", "d", 0, "x"), chunk("k1", "d", 1, "y"), chunk("e0", "e", 0, "z")) == 3
    assert put() == 0
    assert put(chunk("k0", "d", 0, "new")) == 1
    assert {r.key: r.metadata.text for r in t.read().collect()} == {"k0": "new", "k1": "y", "e0": "z"}
    assert put(chunk("c", "f", 0, "low"), chunk("c", "f", 0, "top")) == 1
    t.replace(spark.createDataFrame([], CHUNK), "key", drop=spark.createDataFrame([("c",)], "key string"))
    named = spark.createDataFrame([("d", "b"), ("e", "other")], "source_key string, source_bucket string")
    assert put(chunk("k0", "d", 0, "last"), replaced=named) == 1
    assert {r.key: r.metadata.text for r in t.read().collect()} == {"k0": "last", "e0": "z"}


def test_replaced_documents_may_be_blank(spark, tmp_path):
    t = BucketTable(spark, f"{tmp_path}/t")
    columns = "source_bucket string, source_key string, text string"
    docs = [("b", "d1", "word " * 200), ("b", "d2", "word " * 200), ("c", "d1", "short")]
    vector_table.ingest_documents(spark.createDataFrame(docs, columns), t, dims=8)
    again = spark.createDataFrame([("b", "d1", "  "), ("b", "d2", "tail")], columns)
    vector_table.ingest_documents(again, t, dims=8, replace_document=True)
    kept = {(r.metadata.source_bucket, r.metadata.source_key, r.metadata.text) for r in t.read().collect()}
    assert ("b", "d2", "tail") in kept and not any(k[:2] == ("b", "d1") for k in kept)


def test_ingest_is_idempotent(spark, tmp_path):
    t = BucketTable(spark, f"{tmp_path}/t")
    docs = spark.createDataFrame(
        [("b", "d1", "word " * 200), ("b", "d2", "   "), ("b", "d3", "short")],
        "source_bucket string, source_key string, text string",
    )
    assert vector_table.ingest_documents(docs, t, dims=8).stored == 4
    assert vector_table.ingest_documents(docs, t, dims=8).stored == 4
    assert t.count() == 4
    assert {r.metadata.source_key for r in t.read().collect()} == {"d1", "d3"}


def test_a_document_fails_whole(spark, tmp_path):
    t = BucketTable(spark, f"{tmp_path}/t")
    docs = spark.createDataFrame(
        [("b", "good", "aaaa"), ("b", "bad", "aa!a"), ("c", "bad", "cc"), ("b", "odd", "zzzz")],
        "source_bucket string, source_key string, text string",
    ).coalesce(1)

    def load():
        def model(texts):
            if any("!" in x for x in texts):
                raise RuntimeError("cannot")
            return [[1.0, 2.0]] * len(texts) if "zz" not in texts else [[1.0]]

        return model

    done = vector_table.ingest_documents(docs, t, 2, 2, 0, load)
    assert done.stored == t.count() == 3
    rejected = sorted((r.source_bucket, r.source_key, r.reason) for r in done.rejects.collect())
    assert [r[:2] for r in rejected] == [("b", "bad"), ("b", "odd")]
    assert rejected[0][2] == "RuntimeError: cannot"


def test_buckets_by_size():
    assert tables.buckets_for(0) == tables.buckets_for(1 << 30) == 16
    assert tables.buckets_for(100 << 30) == 100
    assert tables.buckets_for(1 << 60) == 65_536


def test_many_upserts(spark, tmp_path):
    t = BucketTable(spark, f"{tmp_path}/t")
    held = {}
    t.create(frame(spark, *[(str(i), 0.0) for i in range(40)]), "card_id", 8)
    held.update({str(i): 0.0 for i in range(40)})
    for n in range(1, 5):
        batch = [(str(i), float(n)) for i in range(n, 60, 7 * n)]
        t.replace(frame(spark, *batch), "card_id")
        held.update(dict(batch))
        assert rows(t.read()) == sorted(held.items(), key=repr)
    assert t.read().schema.simpleString() == "struct<card_id:string,amount:double>"


def test_created_in_a_catalog(spark, tmp_path, monkeypatch):
    """The catalog route up to MERGE, which needs a catalog with row-level changes."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS spark_catalog.teller LOCATION '{tmp_path}/ns'")
    monkeypatch.setattr(tables, "has_catalog", lambda *_: True)
    save = dict(namespace="teller", table="cards", key="card_id", catalog="spark_catalog")
    try:
        assert tables.save_table(frame(spark, ("a", 1.0)), **save) == 1
        assert rows(tables.read_table(spark, "teller", "cards", "spark_catalog")) == [("a", 1.0)]
        with pytest.raises(Exception, match="MERGE"):
            tables.save_table(frame(spark, ("a", 2.0)), **save)
        monkeypatch.setattr(tables, "table_exists", lambda *_: False)
        with pytest.raises(Exception, match="MERGE"):
            tables.save_table(frame(spark, ("a", 2.0)), **save)
    finally:
        spark.sql("DROP NAMESPACE IF EXISTS spark_catalog.teller CASCADE")
