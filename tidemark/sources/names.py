"""Catalog names that end up in SQL text."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from tidemark import fixed


def check_names(**names: str) -> None:
    """Raise ``ValueError`` for any name that is not a plain identifier."""
    for label, value in names.items():
        if not isinstance(value, str) or not re.fullmatch(fixed.IDENTIFIER, value):
            raise ValueError(f"invalid identifier {label}={value!r}")


def ensure_namespace(spark: SparkSession, catalog: str, namespace: str) -> None:
    check_names(catalog=catalog, namespace=namespace)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {catalog}.{namespace}")


def table_exists(spark: SparkSession, catalog: str, namespace: str, table: str) -> bool:
    check_names(catalog=catalog, namespace=namespace, table=table)
    return spark.catalog.tableExists(f"{catalog}.{namespace}.{table}")
