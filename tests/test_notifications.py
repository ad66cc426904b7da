import itertools
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import notifications
from tidemark.sources.tables import BucketTable
from tidemark.streaming.notifications import NotificationJob


def notice(*names):
    """A message body about objects of the store ``b``, as the key is written in the message."""
    entries = []
    for name in names:
        store, key = name if isinstance(name, tuple) else ("b", name)
        entries.append({"s3": {"object": {"key": key}, "bucket": {"name": store}}, "extra": 1})
    return json.dumps({"Records": entries})


def enveloped(text):
    return json.dumps({"Message": text, "Type": "Notification", "TopicArn": "t"})


def event(*messages):
    return json.dumps({"Records": [{"body": b, "messageId": m} for m, b in messages]})


# How a key is written in a message, and the key it stands for.
SPELLINGS = [("inbox/q1-2024.json", "inbox/q1-2024.json"), ("inbox/week%2031.json", "inbox/week 31.json"),
             ("inbox/week+31.json", "inbox/week 31.json"), ("%C3%A9t%C3%A9/a%2Bb", "été/a+b"), ("", "")]
UNREADABLE = ["", "no object", "[7]", "null", '{"Records": null}', '{"Records": "x"}', '{"Records": [{}]}',
              '{"Records": [{"s3": {"object": {"key": "k"}}}]}', '{"Records": [{"s3": null}]}', None]
NOTHING = ["{}", '{"Records": []}', '{"Other": 3}', '{"Type": "Else", "Records": []}']


def grammar():
    """Bodies with any number of references, plain and enveloped, and those that hold none."""
    for n in range(1, 4):
        for some in itertools.islice(itertools.combinations(SPELLINGS, n), 4):
            text = notice(*[(f"store-{i}", raw) for i, (raw, _) in enumerate(some)])
            want = [(f"store-{i}", key) for i, (_, key) in enumerate(some)]
            yield text, want
            yield enveloped(text), want
    for text in NOTHING:
        yield text, []
        yield enveloped(text), []
    for text in UNREADABLE:
        yield text, None
        yield (enveloped(text), None) if text is not None else ('{"Type": "Notification"}', None)


def test_refs(spark):
    cases = list(grammar())
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, body string")
    got = df.select("i", notifications.body_refs(F.col("body")).alias("r")).orderBy("i").collect()
    for (text, want), row in zip(cases, got):
        assert (None if row.r is None else [tuple(x) for x in row.r]) == want, text


def test_event_messages(spark):
    said = [event(("m1", "x"), (None, "y")), "{}", '{"Records":[]}', "cut {", '{"Records":[5]}', "", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "n int, event string")
    got = notifications.event_messages(df, "event").orderBy("n", "position").collect()
    assert [(r.n, r.position, r.message_id, r.body, r.bad_event) for r in got] == [
        (0, 0, "m1", "x", False),
        (0, 1, None, "y", False),
        (3, -1, None, "cut {", True),
        (4, -1, None, '{"Records":[5]}', True),
        (5, -1, None, "", True),
        (6, -1, None, None, True),
    ]


def test_prefix(spark):
    df = spark.createDataFrame([("m", notice("data/x", "tmp/y"))], "id string, body string")
    got = notifications.object_refs(df, prefix="data/").collect()
    assert [(r.id, r.ref_position, r.bucket, r.key) for r in got] == [("m", 0, "b", "data/x")]


ROW = "card_id string, amount double"


@pytest.fixture
def job(spark, tmp_path):
    table = BucketTable(spark, f"{tmp_path}/table")
    table.create(spark.createDataFrame([("old", 1.0), ("a", 0.0)], ROW), "card_id", 4)
    (tmp_path / "events").mkdir()
    return NotificationJob(
        spark,
        events=f"{tmp_path}/events",
        table=table,
        key="card_id",
        state=f"{tmp_path}/state",
        object_root=f"file://{tmp_path}/objects",
    )


def upload(tmp_path, key, records):
    path = tmp_path / "objects" / "b" / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(records if isinstance(records, str) else json.dumps(records))


def notify(tmp_path, name, *events):
    (tmp_path / "events" / name).write_text("\n".join(events) + "\n")


def run(job, **kw):
    query = job.start(wait=None, **kw)
    query.awaitTermination()
    assert query.exception() is None


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def outcomes(job):
    return sorted(((r.message_id, r.status, r.reason) for r in job.outcomes().collect()), key=repr)


def test_messages_succeed_or_fail_alone(job, tmp_path):
    upload(tmp_path, "data/a.json", [{"card_id": "a", "amount": 5.0}, {"card_id": "a", "amount": 6.0}])
    upload(tmp_path, "data/my file.json", {"card_id": "n", "amount": 2.0, "extra": 1})
    upload(tmp_path, "data/half.json", [{"card_id": "h", "amount": 9.0}])
    upload(tmp_path, "data/cut.json", '[{"card_id": "c"')
    upload(tmp_path, "data/empty.json", "")
    upload(tmp_path, "data/anonymous.json", {"card_id": "q", "amount": 1.0})
    upload(tmp_path, "tmp/x.json", [{"card_id": "x", "amount": 1.0}])
    notify(
        tmp_path,
        "e1.json",
        event(
            ("m1", notice("data/a.json")),
            ("m2", enveloped(notice("data/my+file.json"))),
            ("m3", "not json"),
            (None, notice("data/anonymous.json")),
        ),
        event(("m0", notice("data/a.json")))[:-1],
        event(
            ("m4", notice("data/gone.json")),
            ("m5", notice("data/half.json", "data/cut.json")),
            ("m6", notice("tmp/x.json")),
            ("m7", notice("data/empty.json")),
            ("m8", "{}"),
            ("m8", notice("data/gone.json")),
        ),
    )
    run(job)
    assert rows(job.table.read()) == [("a", 5.0), ("a", 6.0), ("n", 2.0), ("old", 1.0)]
    assert outcomes(job) == [
        ("m1", "ok", ""),
        ("m2", "ok", ""),
        ("m3", "failed", "bad message"),
        ("m4", "failed", "missing or empty file"),
        ("m5", "failed", "bad file"),
        ("m6", "ok", ""),
        ("m7", "failed", "missing or empty file"),
        ("m8", "failed", "missing or empty file"),
        ("m8", "ok", ""),
        (None, "failed", "bad event"),
        (None, "failed", "no message id"),
    ]
    failed = [r.itemIdentifier for r in job.failures().collect()]
    assert sorted(failed, key=repr) == ["m3", "m4", "m5", "m7", "m8", None, None]


def test_last_file_wins(job, tmp_path):
    upload(tmp_path, "data/1.json", [{"card_id": "a", "amount": 1.0}, {"card_id": "b", "amount": 1.0}])
    upload(tmp_path, "data/2.json", [{"card_id": "a", "amount": 2.0}, {"card_id": "a", "amount": 2.5}, {"amount": 7.0}])
    upload(tmp_path, "data/3.json", [{"card_id": "b", "amount": 3.0}])
    first, second, third = (notice(f"data/{i}.json") for i in (1, 2, 3))
    notify(tmp_path, "e1.json", event(("m1", first), ("m2", second)), event(("m3", third)))
    run(job)
    want = [("a", 2.0), ("a", 2.5), ("b", 3.0), ("old", 1.0), (None, 7.0)]
    assert rows(job.table.read()) == want


def test_order_of_refs_in_a_message(job, tmp_path):
    upload(tmp_path, "data/1.json", {"card_id": "a", "amount": 1.0})
    upload(tmp_path, "data/2.json", {"card_id": "a", "amount": 2.0})
    notify(tmp_path, "e.json", event(("m", notice("data/2.json", "data/1.json", "data/2.json", "data/1.json"))))
    run(job)
    assert rows(job.table.read()) == [("a", 1.0), ("old", 1.0)]


def test_a_batch_runs_once(spark, job, tmp_path):
    upload(tmp_path, "data/1.json", [{"card_id": "a", "amount": 1.0}, {"amount": 2.0}])
    place = "file string, block bigint, line bigint, position int, bad_event boolean"
    new = spark.createDataFrame(
        [("m", notice("data/1.json"), "f", 0, 0, 0, False)], f"message_id string, body string, {place}"
    )
    job.process(new, 0)
    done = rows(job.table.read())
    job.process(new, 0)
    assert rows(job.table.read()) == done and outcomes(job) == [("m", "ok", "")]
    # Stopped after the table was written: keyed rows replace themselves, others come again.
    job.state += "-lost"
    job.process(new, 0)
    assert rows(job.table.read()) == [*done, (None, 2.0)] and outcomes(job) == [("m", "ok", "")]


def test_batches_of_files(job, tmp_path):
    for i in range(5):
        upload(tmp_path, f"data/{i}.json", {"card_id": f"k{i}", "amount": float(i)})
        notify(tmp_path, f"e{i}.json", event((f"m{i}", notice(f"data/{i}.json"))))
    run(job, files_per_batch=2)
    assert job.table.count() == 7
    assert {r.batch for r in job.outcomes().collect()} == {0, 1, 2}


def test_messages_of_one_file_in_batches(job, tmp_path):
    for i in range(25):
        upload(tmp_path, f"data/{i}.json", {"card_id": f"k{i % 20}", "amount": float(i)})
    notices = [event((f"m{i}", notice(f"data/{i}.json")), (f"x{i}", "no")) for i in range(0, 25)]
    notify(tmp_path, "e.json", *notices)
    run(job, messages_per_batch=15)
    got = job.outcomes().groupBy("batch", "part").agg(F.count("*").alias("n")).collect()
    assert sorted(map(tuple, got)) == [(0, 0, 15), (0, 1, 15), (0, 2, 15), (0, 3, 5)]
    firsts = {r.message_id for r in job.outcomes().where("part = 0").collect()}
    assert firsts == {f"{c}{i}" for i in range(7) for c in "mx"} | {"m7"}
    amounts = dict(rows(job.table.read()))
    assert all(amounts[f"k{i}"] == (i + 20 if i < 5 else i) for i in range(20))


def test_a_thousand_messages_make_a_hundred_batches(job, tmp_path, monkeypatch):
    notify(tmp_path, "e.json", *[event(*[(f"m{i}-{j}", notice()) for j in range(8)]) for i in range(125)])
    seen = {}

    def part(self, read, done):
        at = len(seen)
        seen[done] = [r.message_id for r in read.orderBy("place").collect()] if at in (0, 37, 99) else None

    monkeypatch.setattr(NotificationJob, "_part", part)
    run(job)
    names = [f"m{i}-{j}" for i in range(125) for j in range(8)]
    assert [d.rsplit("/", 1)[1] for d in seen] == [f"part={i}" for i in range(100)]
    got = list(seen.values())
    assert (got[0], got[37], got[99]) == (names[:10], names[370:380], names[990:])


def test_a_stopped_batch_goes_on_in_the_middle_of_its_file(job, tmp_path, monkeypatch):
    for i in range(9):
        upload(tmp_path, f"data/{i}.json", [{"card_id": f"k{i}", "amount": float(i)}, {"amount": float(i)}])
    notify(tmp_path, "e.json", event(*[(f"m{i}", notice(f"data/{i}.json")) for i in range(9)]))
    real, ran = NotificationJob._part, []

    def stops(self, read, done):
        if "part=2" in done and len(ran) == 2:
            raise RuntimeError("stopped")
        ran.append(done[-1])
        real(self, read, done)

    monkeypatch.setattr(NotificationJob, "_part", stops)
    query = job.start(wait=None, messages_per_batch=2)
    with pytest.raises(Exception):
        query.awaitTermination()
    assert ran == ["0", "1"] and job.table.count() == 2 + 8
    ran.append("again")
    run(job, messages_per_batch=2)
    assert ran == ["0", "1", "again", "2", "3", "4"]
    assert job.table.count() == 2 + 18 and len(outcomes(job)) == 9


def test_only_a_block_of_paths_comes_to_the_driver(spark, job, tmp_path, monkeypatch):
    """No messages, bodies or contents; paths in blocks of bounded size."""
    from pyspark.sql.classic.dataframe import DataFrame

    from tidemark.sources import objects

    for i in range(40):
        upload(tmp_path, f"data/{i}.json", {"card_id": f"a{i}", "amount": 1.0})
    notify(tmp_path, "e.json", event(*[(f"m{i}", notice(f"data/{i}.json")) for i in range(40)]))
    monkeypatch.setattr(objects.object_blocks, "__defaults__", ("path", 8))
    real, seen = DataFrame.collect, []

    def collect(self):
        got = real(self)
        seen.append((self.columns, len(got)))
        return got

    monkeypatch.setattr(DataFrame, "collect", collect)
    run(job, messages_per_batch=None)
    assert all(not {"message_id", "body", "place", "content"} & set(c) for c, _ in seen)
    sizes = [n for c, n in seen if "path" in c]
    assert sum(sizes) == 40 and len(sizes) == 5 and max(sizes) < 20
    assert job.table.count() == 42


@pytest.mark.parametrize("spelled", ["{}", "/{}", "file://{}", "{}/", "/.{}"])
def test_root_in_any_spelling(job, tmp_path, spelled):
    upload(tmp_path, "data/1.json", {"card_id": "a", "amount": 1.5})
    notify(tmp_path, "e.json", event(("m", notice("data/1.json"))))
    job.object_root = spelled.format(tmp_path / "objects")
    run(job)
    assert outcomes(job) == [("m", "ok", "")]
    assert ("a", 1.5) in rows(job.table.read())


def test_objects_of_a_scheme_that_only_the_session_knows(spark, job, tmp_path):
    upload(tmp_path, "data/1.json", {"card_id": "a", "amount": 1.5})
    upload(tmp_path, "data/e.json", "")
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.uploads.link./up", f"file://{tmp_path}/objects")
    notify(tmp_path, "e.json", event(("m", notice("data/1.json")), ("n", notice("data/2.json")), ("o", notice("data/e.json"))))
    job.object_root = "viewfs://uploads/up"
    run(job)
    lost = "missing or empty file"
    assert outcomes(job) == [("m", "ok", ""), ("n", "failed", lost), ("o", "failed", lost)]
    assert ("a", 1.5) in rows(job.table.read())
