"""Objects by path, through the session's own file systems."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources import storage
from tidemark.sources.documents import literal_path

#: Paths that are looked up and read together; so many come to the driver at once.
BLOCK = 1000
_SCHEMA = "path string, content binary"


def object_blocks(paths: DataFrame, path: str = "path", block: int = BLOCK) -> Iterator[DataFrame]:
    """``path`` and ``content`` (binary) of the distinct paths, in blocks of about ``block``.

    Spark reads the objects, so every scheme and credential of the session works.
    The paths of one block come to the driver, which asks the file system for
    their sizes; contents stay in the tasks. Content is null where there is no
    such object, or a folder, or a name that Spark hides (first character ``_``
    or ``.``), and empty for an empty object. Equal objects may have several paths.
    """
    spark = paths.sparkSession
    at = storage.scratch_path(spark, "paths")
    distinct = paths.select(F.col(path).cast("string").alias("path")).where("path IS NOT NULL").distinct()
    distinct.write.parquet(at)
    names = spark.read.parquet(at)
    blocks = -(-names.count() // block)
    part = F.pmod(F.xxhash64("path"), F.lit(max(blocks, 1)))
    for i in range(blocks):
        yield _read(spark, [r["path"] for r in names.where(part == i).collect()])


def _read(spark, names: list[str]) -> DataFrame:
    found = storage.file_sizes(spark, names)
    full = [(name, found[name][0]) for name in names if found[name] and found[name][1]]
    rest = [(name, b"" if found[name] else None) for name in names if not (found[name] and found[name][1])]
    done = spark.createDataFrame(rest, _SCHEMA)
    if not full:
        return done
    spelled = spark.createDataFrame(full, "path string, object string")
    read = spark.read.format("binaryFile").load(sorted({literal_path(q) for _, q in full}))
    read = read.select(F.col("path").alias("object"), "content")
    return read.join(F.broadcast(spelled), "object").select("path", "content").unionByName(done)


def read_objects(paths: DataFrame, path: str = "path", block: int = BLOCK) -> DataFrame:
    """``path`` and ``content`` of each distinct path, as ``object_blocks`` has them.

    Up to one block is read when the rows are used; more are written to the
    shared folder, block after block.
    """
    spark, at, first = paths.sparkSession, None, None
    for rows in object_blocks(paths, path, block):
        if first is None:
            first = rows
            continue
        if at is None:
            at = storage.scratch_path(spark, "objects")
            first.write.parquet(at)
        rows.write.mode("append").parquet(at)
    if at:
        return spark.read.schema(_SCHEMA).parquet(at)
    return spark.createDataFrame([], _SCHEMA) if first is None else first
