"""Upload notifications to object references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import url_unquote

REFS = (
    "array<struct<s3 struct<bucket struct<name string>, object struct<key string>>>>"
)


def event_messages(events: DataFrame, event: str) -> DataFrame:
    """One row per message of each event: ``position``, ``message_id``, ``body``, ``bad_event``.

    An event without ``Records`` has no messages. One that cannot be read, or
    whose records are not messages, is one row with ``bad_event``, position -1
    and its text as the body, so that nothing is lost.
    """
    notice = F.from_json(
        event,
        "Records array<struct<messageId string, body string>>, _bad string",
        {"columnNameOfCorruptRecord": "_bad"},
    )
    others = [c for c in events.columns if c != event]
    read = events.select(*others, event, F.explode(F.array(notice)).alias("_n"))
    bad = F.col("_n").isNull() | F.col("_n._bad").isNotNull()
    shape = "struct<position:int,message_id:string,body:string,bad_event:boolean>"
    broken = F.array(
        F.struct(F.lit(-1), F.lit(None).cast("string"), F.col(event), F.lit(True)).cast(shape)
    )
    messages = F.transform(
        "_n.Records",
        lambda m, i: F.struct(i, m["messageId"], m["body"], F.lit(False)).cast(shape),
    )
    return read.select(*others, F.inline(F.when(bad, broken).otherwise(messages)))


def _notice(text: Column) -> Column:
    return F.from_json(
        text,
        f"Type string, Message string, Records {REFS}, _bad string",
        {"columnNameOfCorruptRecord": "_bad"},
    )


def body_refs(body: Column) -> Column:
    """``array<struct<bucket, key>>`` of one message body; null when unreadable.

    The body holds the records, or wraps them as text in a notification's
    ``Message``. A body without ``Records`` refers to nothing; one whose records
    are null, or lack a bucket or key, is unreadable.
    """

    def refs(text: Column, notice: Column) -> Column:
        found = F.transform(
            notice["Records"],
            lambda r: F.struct(
                r["s3"]["bucket"]["name"].alias("bucket"),
                url_unquote(r["s3"]["object"]["key"]).alias("key"),
            ),
        )
        absent = notice["Records"].isNull() & ~F.coalesce(
            F.is_variant_null(
                F.try_variant_get(F.try_parse_json(text), "$.Records", "variant")
            ),
            F.lit(False),
        )
        whole = F.forall(
            found, lambda r: r["bucket"].isNotNull() & r["key"].isNotNull()
        )
        none = F.array().cast("array<struct<bucket string, key string>>")
        return F.when(
            notice.isNotNull() & notice["_bad"].isNull(),
            F.when(absent, none).when(whole, found),
        )

    def read(outer: Column) -> Column:
        inner = F.transform(
            F.array(_notice(outer["Message"])), lambda n: refs(outer["Message"], n)
        )[0]
        wrapped = outer["Type"] == "Notification"
        return F.when(outer["_bad"].isNull() & wrapped, inner).otherwise(
            refs(body, outer)
        )

    return F.transform(F.array(_notice(body)), read)[0]


def message_refs(messages: DataFrame, body: str = "body", prefix: str = "") -> DataFrame:
    """Messages with ``readable`` and ``refs``, the references under ``prefix``."""
    others = [c for c in messages.columns]
    return (
        messages.select(*others, body_refs(F.col(body)).alias("_refs"))
        .withColumn("readable", F.col("_refs").isNotNull())
        .withColumn("refs", F.filter("_refs", lambda r: r["key"].startswith(prefix)))
        .drop("_refs")
    )


def object_refs(messages: DataFrame, body: str = "body", prefix: str = "") -> DataFrame:
    """One row per reference: ``ref_position``, ``bucket``, ``key``."""
    read = message_refs(messages, body, prefix)
    others = [c for c in messages.columns if c != body]
    return read.select(
        *others, F.posexplode("refs").alias("ref_position", "_r")
    ).select(*others, "ref_position", "_r.bucket", "_r.key")
