"""Text documents under a prefix."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import storage
from tidemark.sources.json_records import Records


def read_documents(spark: SparkSession, root: str, bucket: str, prefix: str = "") -> Records:
    """Every UTF-8 text object under ``root/bucket`` whose key starts with ``prefix``.

    Good rows are ``(source_bucket, source_key, text)``; the key is the path
    below the bucket, whatever way the root is spelled. A prefix with nothing
    under it gives no rows. Files that are not UTF-8 go to the rejects: the
    ``text`` source would replace their bad bytes without a word. Spark skips
    empty files and names that start with ``_`` or ``.``.
    """
    base, folder = _folder(spark, root, bucket, prefix)
    if storage.exists(spark, folder):
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(literal_path(folder))
        )
    else:
        files = spark.createDataFrame([], "path string, content binary")
    return split_text(named_files(files, base, bucket, prefix))


FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(
    spark: SparkSession,
    root: str,
    bucket: str,
    prefix: str = "",
    files_per_batch: int | None = None,
    max_age: str = "3650d",
) -> DataFrame:
    """``(source_bucket, source_key, text)`` of the objects under a prefix, as they arrive.

    The folder of the prefix must be there. Spark names an object once: one that
    is written over under its old name does not come again. It forgets names
    whose files are older than the newest by more than ``max_age``, and passes
    over files that arrive with such an age.
    """
    base, folder = _folder(spark, root, bucket, prefix)
    if not storage.exists(spark, folder):
        raise FileNotFoundError(f"nothing to watch at {folder}")
    read = (
        spark.readStream.format("binaryFile")
        .schema(FILE)
        .option("recursiveFileLookup", True)
        .option("maxFileAge", max_age)
    )
    if files_per_batch:
        read = read.option("maxFilesPerTrigger", files_per_batch)
    return named_files(read.load(literal_path(folder)), base, bucket, prefix)


def _folder(spark: SparkSession, root: str, bucket: str, prefix: str) -> tuple[str, str]:
    """The bucket's path as Spark spells it, and the folder that holds the prefix."""
    base = storage.qualified(spark, f"{root.rstrip('/')}/{bucket}")
    return base, f"{base}/{prefix}".rsplit("/", 1)[0]


def named_files(files: DataFrame, base: str, bucket: str, prefix: str) -> DataFrame:
    """Bucket, key and text of files below ``base``; bytes that are not UTF-8 stay in the text."""
    path = F.col("path")
    key = F.when(
        path.startswith(f"{base}/"), F.substring(path, F.lit(len(base) + 2), F.length(path))
    ).otherwise(F.raise_error(F.concat(path, F.lit(f" is not under {base}"))))
    return files.select(
        F.lit(bucket).alias("source_bucket"),
        key.alias("source_key"),
        F.col("content").cast("string").alias("text"),
    ).where(F.col("source_key").startswith(prefix))


def split_text(rows: DataFrame) -> Records:
    """The documents that are UTF-8, and the others with the reason."""
    valid = F.is_valid_utf8("text")
    return Records(
        rows.where(valid),
        rows.where(~valid).select(
            "source_bucket", "source_key", F.lit("not UTF-8").alias("reason")
        ),
    )


def literal_path(path: str) -> str:
    """The path with its glob characters escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
