"""Chunk tables: key, vector and metadata."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators.chunks import chunk_documents, keyed_chunks
from tidemark.operators.embed import embed, model_error
from tidemark.operators.keyed_join import keyed_join
from tidemark.sources.storage import scratch_path
from tidemark.sources.tables import Once, BucketTable

KEY = "key"


DOCUMENT = ("source_key", "source_bucket")


def put_chunks(
    chunks: DataFrame,
    table: BucketTable,
    replaced: DataFrame | None = None,
    n_buckets: int | None = None,
) -> int:
    """Upsert ``(key, vector, metadata)`` rows; gives the number of chunks stored.

    Of several chunks with one key, which two buckets with the same object name
    can give, one stays. No chunks leave the table alone. A document that became
    shorter, or blank, leaves its old tail behind unless ``replaced`` names it,
    by ``source_key`` and ``source_bucket``: its old chunks then go.
    """
    once = Once(True, F.struct("metadata.source_bucket", "metadata.text"))
    if not table.exists():
        return table.create(chunks, KEY, n_buckets, once, keep_empty=False)
    drop = None
    if replaced is not None:
        # Keys of the old chunks of these documents; reads three columns.
        held = table.read().select(KEY, *[F.col(f"metadata.{c}").alias(c) for c in DOCUMENT])
        named = replaced.select(*DOCUMENT).distinct()
        drop = keyed_join(held, named, DOCUMENT, "left_semi").select(KEY)
    return table.replace(chunks, KEY, drop, once=once)


class Ingested(NamedTuple):
    stored: int
    rejects: DataFrame


def ingest_documents(
    documents: DataFrame,
    table: BucketTable,
    dims: int = fixed.EMBED_DIMS,
    size: int = fixed.CHUNK_SIZE,
    overlap: int = fixed.CHUNK_OVERLAP,
    load=None,
    replace_document: bool = False,
) -> Ingested:
    """Chunk, embed and store ``(source_bucket, source_key, text)`` documents.

    Gives the number of chunks stored, and the documents that were set aside,
    with the ``reason``: a document is stored whole or, when the model fails on
    any of its chunks, not at all. With ``replace_document`` the old chunks of
    every document given go, but for those set aside. Files that cannot be read
    are set aside by the reader before.
    """
    spark = documents.sparkSession
    document = list(DOCUMENT)
    chunks = chunk_documents(documents, "text", size, overlap)
    keyed = keyed_chunks(chunks, F.col("source_bucket"), F.col("source_key"))
    embedded = embed(keyed, "metadata.text", "vector", dims, load, isolate=True).select(
        KEY, "vector", "metadata"
    )
    replaced = documents.select(document) if replace_document else None
    if load is None:
        none = spark.createDataFrame([], documents.select(document).schema)
        none = none.withColumn("reason", F.lit(None).cast("string"))
        return Ingested(put_chunks(embedded, table, replaced), none)
    # Written once: a model is too costly to run for the rejects and again.
    path = scratch_path(spark, "embedded")
    embedded.write.parquet(path)
    embedded = spark.read.parquet(path).select(
        "*", "metadata.source_key", "metadata.source_bucket"
    )
    failed = embedded.where("vector IS NULL")
    reason = model_error(F.col("metadata.text"), load, dims)
    path = scratch_path(spark, "rejects")
    failed.select(*document, reason.alias("reason")).groupBy(document).agg(
        F.coalesce(F.min("reason"), F.lit("failed once")).alias("reason")
    ).write.parquet(path)
    rejects = spark.read.parquet(path)
    named = rejects.select(document)
    good = keyed_join(embedded, named, document, "left_anti").drop(*document)
    if replaced is not None:
        replaced = keyed_join(replaced, named, document, "left_anti")
    return Ingested(put_chunks(good, table, replaced), rejects)


class Changes(NamedTuple):
    stored: int
    changed: int
    vanished: int
    rejects: DataFrame


DIGEST = "document string, source_bucket string, source_key string, digest string"


def ingest_changes(
    documents: DataFrame,
    table: BucketTable,
    digests: BucketTable,
    dims: int = fixed.EMBED_DIMS,
    size: int = fixed.CHUNK_SIZE,
    overlap: int = fixed.CHUNK_OVERLAP,
    load=None,
    model: str = "",
    n_buckets: int | None = None,
) -> Changes:
    """Bring the chunk table to the state of ``documents``, embedding only what is new or changed.

    ``digests`` keeps, by document, a digest of its text and of what else decides
    its chunks: the sizes, the dimensions and the ``model``'s name. Documents with
    another digest are cut, embedded and put in place of their old chunks; chunks
    of documents that are not given any more go. A document that the model fails
    on keeps its old chunks and digest, so it is tried again. The chunks are
    written before the digests: a run that stops in between is made good by the
    next one. Each document, named by ``source_bucket`` and ``source_key``, may be
    given once; of several with one name any text may count.
    """
    spark = documents.sparkSession
    names = list(DOCUMENT)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    made = F.concat_ws(":", F.lit(f"{dims}:{size}:{overlap}:{model}"), F.sha2(text, 256))
    document = F.to_json(F.struct("source_bucket", "source_key"))
    now = documents.select(document.alias("document"), "source_bucket", "source_key", made.alias("digest"))
    at = scratch_path(spark, "digests")
    now.dropDuplicates(["document"]).write.parquet(at)
    now = spark.read.parquet(at)
    held = digests.read() if digests.exists() else spark.createDataFrame([], DIGEST)
    old = held.select("document", F.col("digest").alias("_old"))
    changed = now.join(old, "document", "left").where(F.col("_old").isNull() | (F.col("_old") != F.col("digest")))
    at = scratch_path(spark, "changed")
    changed.drop("_old").write.parquet(at)
    changed = spark.read.parquet(at)
    gone = held.join(now.select("document"), "document", "left_anti")
    at = scratch_path(spark, "gone")
    gone.write.parquet(at)
    gone = spark.read.parquet(at)

    new = documents.withColumn("document", document)
    new = keyed_join(new, changed.select("document"), ["document"], "left_semi").drop("document")
    stored, rejects = ingest_documents(new, table, dims, size, overlap, load, replace_document=True)
    vanished = gone.count()
    if vanished and table.exists():
        put_chunks(table.read().where("false"), table, gone.select(*names))
    failed = rejects.select(F.to_json(F.struct("source_bucket", "source_key")).alias("document"))
    done = changed.join(failed, "document", "left_anti").select(held.columns)
    if digests.exists():
        digests.replace(done, "document", gone.select("document"))
    else:
        digests.create(done, "document", n_buckets)
    return Changes(stored, changed.count(), vanished, rejects)
