"""JSON records against a schema that is given, never inferred."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_TEXT = "_bad_text"

_STRING = re.compile(rb'"(?:[^"\\]|\\.)*+"|\'(?:[^\'\\]|\\.)*+\'', re.DOTALL)
_REST = {q: re.compile(rb"(?:[^%b\\]|\\.)*+%b" % (q, q), re.DOTALL) for q in (b'"', b"'")}
_STEP = np.zeros(256, np.int8)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1
#: Bytes between values, with those of a byte order mark.
_BLANK = np.isin(np.arange(256), list(b" \t\r\n\x00\xef\xbb\xbf"))


class Records(NamedTuple):
    good: DataFrame
    rejects: DataFrame


def as_struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | T.StructType,
    key: str | None = None,
    multiline: bool = True,
) -> Records:
    """Typed JSON read, with unreadable records and null keys set aside.

    With ``multiline=False`` every line is a record and files are split.
    ``multiline`` takes a file as one array or object, read as a stream by one
    task, whatever its size and compression. Either way a record with a value of
    the wrong type is rejected alone. A file that is not JSON from start to end
    of its value, or lists something other than objects, is rejected once, with
    its text. What follows the first value of a multiline file is not read, as
    by Spark's reader: JSON lines are for ``multiline=False``. A file that goes on
    after its first array or object, whatever its size and lines, is named in the
    rejects. Rejects carry ``file``, ``reason`` and the
    bad text.
    """
    fields = as_struct(schema)
    columns = fields.names
    # Nothing is of the wrong type for a variant, so one record cannot spoil its file.
    loose = [
        f if isinstance(f.dataType, T.StringType) else T.StructField(f.name, T.VariantType())
        for f in fields
    ]
    asked = loose if multiline else list(fields)
    raw = (
        spark.read.schema(T.StructType([*asked, T.StructField(BAD_TEXT, T.StringType())]))
        .option("columnNameOfCorruptRecord", BAD_TEXT)
        .option("multiLine", multiline)
        .json(path)
        .withColumn("file", F.col("_metadata.file_path"))
    )
    if multiline and loose != list(fields):
        text = F.to_json(F.struct(*columns))
        typed = F.from_json(
            text,
            T.StructType([*fields, T.StructField(BAD_TEXT, T.StringType())]),
            {"columnNameOfCorruptRecord": BAD_TEXT},
        )
        # Bound once: every use of a bare from_json column would parse again.
        raw = raw.select("file", BAD_TEXT, F.explode(F.array(typed)).alias("_r")).select(
            "file", F.coalesce(BAD_TEXT, F.col("_r")[BAD_TEXT]).alias(BAD_TEXT), *[F.col("_r")[c].alias(c) for c in columns]
        )
    rows = raw.where(F.col(BAD_TEXT).isNull()).select("file", *columns)
    broken = raw.where(F.col(BAD_TEXT).isNotNull()).select(
        "file", F.lit("malformed").alias("reason"), F.col(BAD_TEXT).alias("text"), *columns
    )
    if multiline:
        broken = broken.unionByName(_second_values(spark, path), allowMissingColumns=True)
    if key is None:
        return Records(rows.select(*columns), broken)
    no_key = F.col(key).isNull()
    keyless = rows.where(no_key).select(
        "file",
        F.lit("null key").alias("reason"),
        F.lit(None).cast("string").alias("text"),
        *columns,
    )
    return Records(rows.where(~no_key).select(*columns), broken.unionByName(keyless))


def _second_values(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file`` and ``reason`` of files that go on after their first array or object.

    Files are read in splits and cut at ``{``, so that no piece is longer than a
    record, and every split is summed up: see ``_walk``. What a split holds
    depends on the string it begins in, so later splits are summed up for each.
    """
    pieces = spark.read.option("lineSep", "{").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"),
    )
    names = ["file", "start", "before", "after", "depth", "least", "opened", "rest", "first"]
    schema = "file string, start long, before string, after string, depth long, least long, opened long, rest boolean, first string"

    def sum_up(batches):
        key, sums = None, {}

        def rows():
            if key is None:
                return
            listed = [(*key, before.decode(), s[0].decode(), *s[1:5], s[5].decode()) for before, s in sums.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*listed)], names)

        for batch in batches:
            files, starts, values = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(files):
                end = at + 1
                while end < len(files) and files[end] == files[at] and starts[end] == starts[at]:
                    end += 1
                if key != (files[at], starts[at]):
                    yield from rows()
                    key = files[at], starts[at]
                    sums = {q: (q, 0, 0, 0, False, b"") for q in ((b'"', b"'", b"") if starts[at] else (b"",))}
                    data = b"{" if starts[at] else b""
                else:
                    data = b"{"
                data += b"{".join(values[at:end])
                sums = {q: _joined(s, _walk(data, s[0])) for q, s in sums.items()}
                at = end
        yield from rows()

    @F.udf("boolean")
    def goes_on(splits):
        whole = (b"", 0, 0, 0, False, b"")
        by = {(s["start"], s["before"]): s for s in splits}
        for start in sorted({s["start"] for s in splits}):
            s = by[start, whole[0].decode()]
            whole = _joined(whole, (s["after"].encode(), *(s[n] for n in names[4:8]), s["first"].encode()))
        _, _, least, opened, rest, first = whole
        return first in (b"[", b"{") and (least < 0 or opened + rest > 1)

    splits = pieces.mapInArrow(sum_up, schema)
    files = splits.groupBy("file").agg(F.collect_list(F.struct(*names[1:])).alias("splits"))
    return files.where(goes_on("splits")).select("file", F.lit("more than one value").alias("reason"))


def _walk(data: bytes, quote: bytes) -> tuple:
    """A stretch of JSON that begins inside a string (``quote``) or outside (empty), summed up.

    The quote it ends in; how much deeper it ends; the least depth, from its
    beginning; the arrays and objects opened there; whether anything else stands
    there; the first byte that is not blank.
    """
    if quote:
        rest = _REST[quote].match(data)
        if not rest:
            return quote, 0, 0, 0, True, b"s"
        data = b"s" + data[rest.end() :]
    data = _STRING.sub(b"s", data)
    cut = min((at for q in _REST if (at := data.find(q)) >= 0), default=-1)
    quote = data[cut : cut + 1] if cut >= 0 else b""
    a = np.frombuffer(data[:cut] + b"s" if quote else data, np.uint8)
    a = a[~_BLANK[a]]
    if not len(a):
        return quote, 0, 0, 0, False, b""
    step = _STEP[a]
    depth = np.cumsum(step, dtype=np.int64)
    least = min(0, int(depth.min()))
    opened = int(np.count_nonzero((step == 1) & (depth == least + 1)))
    rest = bool(((step == 0) & (depth == least)).any())
    return quote, int(depth[-1]), least, opened, rest, bytes(a[:1]) if a[0] < 128 else b"s"


def _joined(a: tuple, b: tuple) -> tuple:
    """What ``_walk`` gives for a stretch and the one after it."""
    least = min(a[2], a[1] + b[2])
    low = [s for s, at in ((a, a[2]), (b, a[1] + b[2])) if at == least]
    return b[0], a[1] + b[1], least, sum(s[3] for s in low), any(s[4] for s in low), a[5] or b[5]


def parse_records(text: Column, schema: str | T.StructType) -> Column:
    """Strict parse of a JSON array, or one object, into ``array<struct>``.

    Unknown fields are dropped and absent ones are null. Null when the text is
    empty, is cut short, goes on after its end, or holds a value of the wrong
    type. The JSON reader stops at the end of the first value, so the text is
    put inside an object whose last field shows that all of it was read.
    """
    row = as_struct(schema).simpleString()
    body = F.regexp_replace(text, r"^\uFEFF?[ \t\r\n]*|[ \t\r\n]+$", "")
    listed = F.when(body.startswith("["), body).otherwise(
        F.concat(F.lit("["), body, F.lit("]"))
    )
    doc = F.concat(F.lit('{"records":'), listed, F.lit(',"whole":true}'))
    parsed = F.from_json(
        F.when(body != "", doc),
        f"records array<{row}>, whole boolean, {BAD_TEXT} string",
        {"columnNameOfCorruptRecord": BAD_TEXT},
    )
    # Bound once: every use of a bare from_json column would parse again.
    checked = F.transform(
        F.array(parsed),
        lambda p: F.when(
            p["whole"]
            & p[BAD_TEXT].isNull()
            & ~F.exists(p["records"], lambda r: r.isNull()),
            p["records"],
        ),
    )
    return checked[0]


def fit_schema(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Rows in the table's shape: extra columns dropped, absent ones null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in as_struct(schema)
        ]
    )
