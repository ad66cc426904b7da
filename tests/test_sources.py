import gzip
import json

import pytest
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators import quality
from tidemark.operators.quality import card_quality
from tidemark.sources import documents, json_records, names, storage
from tidemark.sources.objects import read_objects

SCHEMA = "id STRING, amount DOUBLE, n INT"


def write(folder, name, body):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_bytes(body if isinstance(body, bytes) else body.encode())
    return str(path)


def test_array_and_single_object(spark, tmp_path):
    write(tmp_path, "a.json", '[{"id":"x","amount":1.5,"extra":true},\n {"id":"y"}]')
    write(tmp_path, "b.json", '{"id":"z","n":3}')
    write(tmp_path, "c.json", "[]")
    good, bad = json_records.read_json(spark, str(tmp_path), SCHEMA, key="id")
    assert sorted(map(tuple, good.collect())) == [
        ("x", 1.5, None),
        ("y", None, None),
        ("z", None, 3),
    ]
    assert bad.count() == 0


def test_bad_files_and_null_keys_are_rejected(spark, tmp_path):
    write(tmp_path, "good.json", '[{"id":"x"}]')
    write(tmp_path, "cut.json", '[{"id":"y"},{"id":')
    write(tmp_path, "typed.json", '[{"id":"t","amount":"12.5"}]')
    write(tmp_path, "nokey.json", '[{"amount":2}]')
    write(tmp_path, "list.json", '[1, {"id":"k"}, null]')
    write(tmp_path, "bytes.json", b'{"id":"\xff"}')
    good, bad = json_records.read_json(spark, str(tmp_path), SCHEMA, key="id")
    assert [r.id for r in good.collect()] == ["x"]
    reasons = {r.file.rsplit("/", 1)[1]: r.reason for r in bad.collect()}
    assert reasons == {
        "cut.json": "malformed",
        "typed.json": "malformed",
        "nokey.json": "null key",
        "list.json": "malformed",
        "bytes.json": "malformed",
    }


def test_a_bad_value_rejects_its_record_alone(spark, tmp_path):
    records = [{"id": f"k{i}", "n": "no" if i % 7 == 0 else i, "more": [i]} for i in range(2000)]
    write(tmp_path, "big.json", json.dumps(records, indent=1))
    good, bad = json_records.read_json(spark, str(tmp_path), SCHEMA, key="id")
    assert sorted(r.n for r in good.collect()) == [i for i in range(2000) if i % 7]
    rejects = bad.collect()
    assert sorted(json.loads(r.text)["id"] for r in rejects) == sorted(f"k{i}" for i in range(0, 2000, 7))
    assert {r.reason for r in rejects} == {"malformed"}


def test_compressed_files(spark, tmp_path):
    write(tmp_path, "a.json.gz", gzip.compress(b'[{"id":"x","n":1},\n{"id":"y","n":"z"}]'))
    good, bad = json_records.read_json(spark, str(tmp_path), SCHEMA, key="id")
    assert [(r.id, r.n) for r in good.collect()] == [("x", 1)]
    assert [r.text for r in bad.collect()] == ['{"id":"y","n":"z"}']


def test_values_after_the_first_are_named(spark, tmp_path):
    write(tmp_path, "two.json", '{"id":"a"}\n{"id":"b"}\n')
    write(tmp_path, "pretty.json", '{\n"id":\n"c"}\n\n')
    write(tmp_path, "lines.json", '[{"id":"d"},\n{"id":"e"}]')
    good, bad = json_records.read_json(spark, str(tmp_path), SCHEMA, key="id")
    assert sorted(r.id for r in good.collect()) == ["a", "c", "d", "e"]
    assert [(r.file.rsplit("/", 1)[1], r.reason) for r in bad.collect()] == [("two.json", "more than one value")]


GOES_ON = {
    "lines.json": '{"id":"a"}\n{"id":"b"}\n',
    "pretty.json": '{\n"id":\n"a{"}\n{\n"id":\n"b"\n}',
    "arrays.json": '[\n{"id":"a"},\n{"id":"b"}\n]\n[]',
    "tail.json": '[{"id":"a}\\""}\n] tail',
    "closer.json": '{"id":"a"}}',
    "cut.json": '{"id":"a"} {"id":"b',
    "string.json": '{"id":"a"}\n"b"',
    "wide.json": '{"id":"' + "a" * (1 << 21) + '"}\n{"id":"b"}',
}
ONE_VALUE = {
    "one.json": ' \n[ {"id":"a}{\\"]["}, {"id":"it\'s", "n": 1}\n] \n\n',
    "mark.json": "\ufeff" + '{"id":"a"}\n',
    "single.json": "{'id': 'a\"}{'}",
    "empty.json": "[]",
}


def test_files_that_go_on_are_named_at_any_size_and_layout(spark, tmp_path):
    for name, text in {**GOES_ON, **ONE_VALUE}.items():
        write(tmp_path, name, text)
    write(tmp_path, "zip.json.gz", gzip.compress(GOES_ON["pretty.json"].encode()))
    write(tmp_path, "zipped.json.gz", gzip.compress(ONE_VALUE["one.json"].encode()))
    several = "\n".join(json.dumps({"id": f"k{i}", "n": i, "t": "}{" * 40 + "'"}, indent=1) for i in range(20_000))
    write(tmp_path, "several.json", several)
    write(tmp_path, "array.json", "[" + ",".join(json.dumps({"id": f'"{i}', "t": "it's {" * 9}) for i in range(20_000)) + "]")
    for split in ("128m", "100k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            bad = json_records.read_json(spark, str(tmp_path), SCHEMA, key="id").rejects.collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        named = [r.file.rsplit("/", 1)[1] for r in bad if r.reason == "more than one value"]
        assert sorted(named) == sorted([*GOES_ON, "several.json", "zip.json.gz"])


def test_lines(spark, tmp_path):
    write(tmp_path, "l.json", '{"id":"a","n":1}\n{"id":"b","n":"x"}\n{"n":3}\ncut {\n{"id":"c"}\n')
    good, bad = json_records.read_json(spark, str(tmp_path), SCHEMA, "id", multiline=False)
    assert sorted(r.id for r in good.collect()) == ["a", "c"]
    assert sorted((r.reason, r.text or "") for r in bad.collect()) == [
        ("malformed", "cut {"),
        ("malformed", '{"id":"b","n":"x"}'),
        ("null key", ""),
    ]


@pytest.mark.parametrize(
    "text, count",
    [
        ('[{"id":"a"},{"id":"b"}]', 2),
        (' \n[ {"id":"a"} ] \n', 1),
        ('﻿{"id":"a"}', 1),
        ('{"id":"a"}', 1),
        ("[]", 0),
        ("{}", 1),
        ('{"id":"a"}\n{"id":"b"}', None),
        ('[{"id":"a"}] tail', None),
        ('[{"id":"a"}]}', None),
        ('{"id":"a"}}', None),
        ('{"id":"a"}]', None),
        ('[{"id":"a"},{"id":', None),
        ('[{"id":"a","amount":"12"}]', None),
        ("[1, 2]", None),
        ("[null]", None),
        ("null", None),
        ("5", None),
        ("", None),
        ("  \n", None),
        (None, None),
    ],
)
def test_strict_payload(spark, text, count):
    df = spark.createDataFrame([(text,)], "t string")
    parsed = json_records.parse_records(F.col("t"), SCHEMA)
    got = df.select(F.size(parsed).alias("n"), parsed.isNull().alias("bad")).first()
    assert (None if got.bad else got.n) == count


def test_objects_keep_odd_names(spark, tmp_path):
    paths = [
        write(tmp_path, "a file [1].json", '[{"id":"x"}]'),
        write(tmp_path, "b%20{c}.json", '{"id":"y"}'),
        write(tmp_path, "empty", ""),
        f"file://{tmp_path}/a file [1].json",
        f"{tmp_path}/gone",
        str(tmp_path),
    ]
    df = spark.createDataFrame([(p,) for p in [*paths, paths[0]]], "path string")
    found = {r.path: r.content for r in read_objects(df).collect()}
    assert found == {
        paths[0]: b'[{"id":"x"}]',
        paths[1]: b'{"id":"y"}',
        paths[2]: b"",
        paths[3]: b'[{"id":"x"}]',
        paths[4]: None,
        paths[5]: None,
    }


def test_objects_in_blocks(spark, tmp_path):
    paths = [write(tmp_path, f"o{i}", "x" * i) for i in range(30)] + [f"{tmp_path}/gone{i}" for i in range(5)]
    paths.append(write(tmp_path, "_hidden", "x"))
    df = spark.createDataFrame([(p,) for p in [*paths, None]], "path string")
    found = {r.path: r.content for r in read_objects(df, block=7).collect()}
    assert found == {p: b"x" * i if i < 30 else None for i, p in enumerate(paths)}
    assert read_objects(df.where("false")).collect() == []


def test_fit_schema(spark):
    df = spark.createDataFrame([("a", 1, "drop")], "id string, n bigint, other string")
    fitted = json_records.fit_schema(df, SCHEMA)
    assert fitted.schema.simpleString() == "struct<id:string,amount:double,n:int>"
    assert tuple(fitted.first()) == ("a", None, 1)


def test_documents_under_a_prefix(spark, tmp_path):
    bucket = tmp_path / "bucket"
    write(bucket / "notes", "a.txt", "héllo")
    write(bucket / "notes", "b c.txt", "two")
    write(bucket / "notes" / "deep", "d.txt", "three")
    write(bucket / "notes", "bad.txt", b"\xff\xfe\xfa")
    write(bucket / "other", "e.txt", "no")
    good, bad = documents.read_documents(spark, str(tmp_path), "bucket", "notes/")
    assert {r.source_key: r.text for r in good.collect()} == {
        "notes/a.txt": "héllo",
        "notes/b c.txt": "two",
        "notes/deep/d.txt": "three",
    }
    assert [tuple(r) for r in bad.collect()] == [("bucket", "notes/bad.txt", "not UTF-8")]
    some = documents.read_documents(spark, f"file://{tmp_path}", "bucket", "notes/b").good
    assert sorted(r.source_key for r in some.collect()) == ["notes/b c.txt"]


@pytest.mark.parametrize("spelled", ["{}", "/{}", "/.{}", "file://{}", "{}/", "{}/x/.."])
def test_root_in_any_spelling(spark, tmp_path, spelled):
    write(tmp_path / "b" / "n", "a.txt", "one")
    (tmp_path / "x").mkdir()
    root = spelled.format(tmp_path)
    assert [r.source_key for r in documents.read_documents(spark, root, "b", "n/").good.collect()] == ["n/a.txt"]


def test_empty_prefix_gives_nothing(spark, tmp_path):
    write(tmp_path / "b" / "n", "a.txt", "one")
    for prefix in ("gone/", "n/zzz", "gone/deeper/"):
        good, bad = documents.read_documents(spark, str(tmp_path), "b", prefix)
        assert good.count() == bad.count() == 0


def test_names():
    names.check_names(table="cards_1", key="_id")
    for bad in ("bad-name!", "bad catalog", "1a", "", "a\n", None):
        with pytest.raises(ValueError):
            names.check_names(table=bad)


def test_shared_dir_is_the_sessions(spark):
    named = spark.conf.get(storage.CHECKPOINT_DIR, None)
    assert storage.shared_dir(spark) == (named or storage.shared_dir(spark)).rstrip("/")


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session())


def test_write_new_refuses_a_taken_name(spark, tmp_path):
    path = f"{tmp_path}/one"
    storage.write_new(spark, path, "first")
    with pytest.raises(FileExistsError):
        storage.write_new(spark, path, "second")
    assert storage.read_small(spark, path) == "first"


def card(key, **changes):
    row = {
        "card_id": key,
        "credit_limit": 1000.0,
        "current_balance": 10.0,
        "card_status": "ACTIVE",
        "reward_points": 5,
        "is_primary": True,
        "currency": "USD",
    }
    return {**row, **changes}


def test_card_quality(spark, tmp_path):
    rows = [
        card("C1"),
        card("C2", card_status="EXPIRED"),
        card("C2", credit_limit=0.0),
        card("C3", current_balance=-1.0, currency=None),
        card("C4", card_status="LOST"),
    ]
    path = write(tmp_path, "cards.json", json.dumps(rows))
    cards = json_records.read_json(spark, path, fixed.CARD_SCHEMA, fixed.CARD_KEY).good
    assert len(cards.columns) == 21
    report = {r.check: r.violations for r in card_quality(cards, min_rows=7).collect()}
    assert report == {
        "card_status": 1,
        "credit_limit": 1,
        "current_balance": 1,
        "currency": 1,
        "unique_key": 1,
        "min_rows": 2,
    }


def test_quality_of_nothing(spark):
    cards = spark.createDataFrame([], fixed.CARD_SCHEMA)
    report = {r.check: r.violations for r in card_quality(cards, min_rows=3).collect()}
    assert report["min_rows"] == 3
    assert sum(report.values()) == 3


def test_transactions_are_typed(spark, tmp_path):
    body = '[{"transaction_id":"T1","amount":-5.0,"posted_date":null,"reward_points_earned":2}]'
    path = write(tmp_path, "t.json", body)
    good = json_records.read_json(spark, path, fixed.TRANSACTION_SCHEMA, fixed.TRANSACTION_KEY).good
    row = good.first()
    assert (row.transaction_id, row.amount, row.posted_date) == ("T1", -5.0, None)
    assert len(good.columns) == 16


def test_quality_kept_per_load(spark, tmp_path):
    """States add up to the whole; a known load is not read again, an empty one counts nothing."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 50 != 0, F.col("id") % 3000).alias("k"), (F.col("id") % 7).cast("int").alias("v"), "id"
    )
    checks = {"seven": F.col("v") > 5, "none": F.col("k").isNull()}
    kept = quality.KeptQuality(spark, f"{tmp_path}/states", checks, ["k", "v"])
    assert {r.violations for r in kept.report(min_rows=5).collect()} == {0, 5}
    for part in range(3):
        assert kept.add(rows.where(F.col("id") % 3 == part), f"p{part}")
    assert kept.add(rows.where("false"), "empty")
    unread = rows.select(*(F.raise_error(F.lit("read again")).cast("bigint").alias(c) for c in rows.columns))
    assert not kept.add(unread, "p1")
    again = quality.KeptQuality(spark, f"{tmp_path}/states", checks, ["k", "v"])
    want = quality.quality_report(rows, checks, min_rows=10_000)
    assert {tuple(r) for r in again.report(min_rows=10_000).collect()} == {tuple(r) for r in want.collect()}
    found = {r["column"]: r for r in again.distinct_values().collect()}
    exact = rows.agg(F.count_distinct("k").alias("k"), F.count_distinct("v").alias("v")).first()
    assert abs(found["k"].estimate - exact.k) <= 0.05 * exact.k and found["v"].estimate == exact.v
    assert (found["k"].nulls, found["k"].rows) == (180, 9000)
