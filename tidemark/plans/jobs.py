"""Whole jobs: files to tables, files to chunks, responses to rankings."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tidemark import fixed
from tidemark.operators.offers import saved_payloads, tool_calls
from tidemark.operators.ranking import ranked_documents
from tidemark.sources.documents import read_documents
from tidemark.sources.json_records import read_json
from tidemark.sources.tables import BucketTable, save_table
from tidemark.sources.vector_table import Ingested, ingest_documents


class Loaded(NamedTuple):
    rows: int
    rejects: DataFrame


def load_records(
    spark: SparkSession,
    path: str,
    schema: str,
    key: str,
    namespace: str,
    table: str,
    catalog: str = "local",
    root: str | None = None,
    multiline: bool = True,
) -> Loaded:
    """JSON files into a table by key; gives the table's row count and the rejects."""
    good, rejects = read_json(spark, path, schema, key, multiline)
    return Loaded(save_table(good, namespace, table, key, catalog, root), rejects)


def load_cards(spark: SparkSession, path: str, namespace: str, **options) -> Loaded:
    return load_records(
        spark, path, fixed.CARD_SCHEMA, fixed.CARD_KEY, namespace, "credit_cards", **options
    )


def load_transactions(spark: SparkSession, path: str, namespace: str, **options) -> Loaded:
    return load_records(
        spark,
        path,
        fixed.TRANSACTION_SCHEMA,
        fixed.TRANSACTION_KEY,
        namespace,
        "credit_transactions",
        **options,
    )


def ingest_prefix(
    spark: SparkSession,
    root: str,
    bucket: str,
    prefix: str,
    table: BucketTable,
    **options,
) -> Ingested:
    """Every text object under a prefix into a chunk table.

    The rejects hold documents that are not UTF-8 and those the model failed on,
    with the reason.
    """
    good, unreadable = read_documents(spark, root, bucket, prefix)
    stored, failed = ingest_documents(good, table, **options)
    columns = ["source_bucket", "source_key", "reason"]
    return Ingested(stored, unreadable.select(columns).unionByName(failed.select(columns)))


def saved_rankings(responses: DataFrame, response: str, **options) -> DataFrame:
    """Ranked documents of the offers that stored responses ask to save.

    One row per saving call, with ``document``; null for an unreadable payload.
    """
    calls = saved_payloads(tool_calls(responses, response))
    return ranked_documents(calls, "payload", **options).drop("payload", "input")
