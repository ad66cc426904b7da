"""Shared scratch space and small files through the cluster's file system."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster
    the executors would write to their own disks, so it must name one.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    context = spark.sparkContext
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[[^\]]*\])?$", context.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, in the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside leave no shuffle files.

    For one that is written and not run again. Spark else removes such files
    when the driver's garbage collector finds the plan, often after the job.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def _handle(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _handle(spark, path)
    return files.exists(target)


def is_file(spark: SparkSession, path: str) -> bool:
    files, target = _handle(spark, path)
    return files.exists(target) and files.getFileStatus(target).isFile()


def file_sizes(spark: SparkSession, paths: list[str], threads: int = 16) -> dict[str, tuple[str, int] | None]:
    """For each path of a bounded list, the file's qualified name and its bytes; None where there is no file.

    Names that Spark hides when it reads (first character ``_`` or ``.``) count as none.
    """

    def look(path: str) -> tuple[str, int] | None:
        if path.rstrip("/").rsplit("/", 1)[-1][:1] in ("_", "."):
            return None
        files, target = _handle(spark, re.sub("^/+", "/", path))
        try:
            status = files.getFileStatus(target)
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() == "FileNotFoundException":
                return None
            raise
        return (files.makeQualified(target).toString(), status.getLen()) if status.isFile() else None

    with ThreadPoolExecutor(threads) as pool:
        return dict(zip(paths, pool.map(look, paths)))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names under a folder; none when it is missing."""
    files, target = _handle(spark, path)
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target))


def read_small(spark: SparkSession, path: str) -> str:
    files, target = _handle(spark, path)
    stream = files.open(target)
    try:
        size = files.getFileStatus(target).getLen()
        return bytes(stream.readNBytes(int(size))).decode("utf-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file under a name that must be free.

    The check and the renaming are one step on HDFS and local disks, not on
    object stores: there two writers at once can both believe they were first.
    """
    files, target = _handle(spark, path)
    _, hidden = _handle(
        spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp"
    )
    stream = files.create(hidden, False)
    stream.write(text.encode("utf-8"))
    stream.close()
    if files.exists(target) or not files.rename(hidden, target):
        files.delete(hidden, False)
        raise FileExistsError(f"{path} was written by someone else")


def write_over(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of one that is there."""
    files, target = _handle(spark, path)
    stream = files.create(target, True)
    stream.write(text.encode("utf-8"))
    stream.close()


def tree_bytes(spark: SparkSession, path: str) -> int:
    files, target = _handle(spark, path)
    return files.getContentSummary(target).getLength() if files.exists(target) else 0


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark spells it in its results: with scheme, without ``//`` or ``/./``."""
    # Without a scheme, what follows two slashes would be taken for a host.
    files, target = _handle(spark, re.sub("^/+", "/", path))
    return files.makeQualified(target).toString()


def remove_tree(spark: SparkSession, path: str) -> None:
    files, target = _handle(spark, path)
    files.delete(target, True)
