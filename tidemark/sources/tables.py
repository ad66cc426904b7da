"""Keyed tables: the caller's own catalog, or Parquet partitioned by a hash of the key.

With a v2 catalog, ``writeTo`` and ``MERGE`` do the work. Without one, a table is
a folder of Parquet partitioned by a bucket of the key, and an upsert lets
Spark's dynamic partition overwrite replace the buckets that the batch touches.
That is for one writer at a time, and readers should not be under way meanwhile:
tables that are shared belong in a catalog.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import upsert
from tidemark.operators.keyed_join import keyed_join
from tidemark.sources import storage
from tidemark.sources.json_records import fit_schema
from tidemark.sources.names import check_names, ensure_namespace, table_exists

BUCKET = "_bucket"
#: Rows without a key match nothing; they are only ever appended, here.
NO_KEY = -1
BUCKET_BYTES = 1 << 30
LEAST_BUCKETS, MOST_BUCKETS = 16, 65_536


class TableExists(Exception):
    """The table was created in the meantime."""


class Once(NamedTuple):
    """Whether a batch may repeat a key, and which row then counts."""

    checked: bool
    ordinal: Column | None = None


ANY = Once(False)


class BucketTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # Layout: one small file says the key, the schema and the folder of the rows.

    def exists(self) -> bool:
        return storage.exists(self.spark, f"{self.path}/table.json")

    def _layout(self) -> dict:
        if not self.exists():
            raise FileNotFoundError(f"no table at {self.path}")
        return json.loads(storage.read_small(self.spark, f"{self.path}/table.json"))

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self._layout()["schema"])

    def read(self) -> DataFrame:
        layout = self._layout()
        return self._rows(layout, self._buckets(layout))

    def count(self) -> int:
        return self.read().count()

    def _folder(self, layout: dict) -> str:
        return f"{self.path}/rows-{layout['buckets']}"

    def _buckets(self, layout: dict) -> list[int]:
        """Buckets that have a folder."""
        names = storage.child_names(self.spark, self._folder(layout))
        return [int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")]

    def _rows(self, layout: dict, buckets: list[int]) -> DataFrame:
        schema = T.StructType.fromJson(layout["schema"])
        if not buckets:
            return self.spark.createDataFrame([], schema)
        folder = self._folder(layout)
        read = self.spark.read.schema(schema).option("basePath", folder)
        return read.parquet(*[f"{folder}/{BUCKET}={b}" for b in buckets]).select(schema.names)

    # Writing

    def _bucketed(self, df: DataFrame, layout: dict) -> DataFrame:
        key = F.col(layout["key"])
        place = F.pmod(F.xxhash64(key), F.lit(layout["buckets"])).cast("int")
        return df.withColumn(BUCKET, F.when(key.isNull(), NO_KEY).otherwise(place))

    def _write(self, df: DataFrame, layout: dict, mode: str = "overwrite") -> None:
        # Rebalanced: a bucket with one heavy key is split over several files,
        # small buckets share a task.
        self._bucketed(df, layout).hint("rebalance", BUCKET).write.mode(mode).option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(BUCKET).parquet(self._folder(layout))

    def _stage(self, df: DataFrame, schema: T.StructType, key: str, once: Once) -> DataFrame:
        """The batch, evaluated once and written to the shared folder; its keys checked or thinned out."""
        path = storage.scratch_path(self.spark, "batch")
        fit_schema(df, schema).write.parquet(path)
        rows = self.spark.read.schema(schema).parquet(path)
        if once.checked and once.ordinal is None:
            upsert.check_unique(rows, key)
        elif once.checked and not upsert.duplicate_keys(rows, key).isEmpty():
            rows = upsert.latest_per_key(rows, key, once.ordinal)
        return rows

    def create(
        self,
        df: DataFrame,
        key: str,
        n_buckets: int | None = None,
        once: Once = ANY,
        keep_empty: bool = True,
    ) -> int:
        """First rows; gives their count. Raises ``TableExists`` when there already is a table.

        The number of buckets is one per gigabyte as written, unless given.
        ``keep_empty=False`` makes no table out of no rows.
        """
        if self.exists():
            raise TableExists(self.path)
        schema = _nullable(df.schema)
        rows = self._stage(df, schema, key, once)
        count = rows.count()
        if not count and not keep_empty:
            return 0
        layout = {
            "key": key,
            "buckets": n_buckets or buckets_for(written_bytes(rows)),
            "schema": schema.jsonValue(),
        }
        try:
            storage.write_new(self.spark, f"{self.path}/table.json", json.dumps(layout))
        except FileExistsError as e:
            raise TableExists(self.path) from e
        self._write(rows, layout)
        return count

    def replace(
        self, batch: DataFrame, key: str, drop: DataFrame | None = None, once: Once = ANY
    ) -> int:
        """Replace the rows of the batch's keys; gives the batch's row count.

        Repeated keys of the batch stay unless ``once`` says otherwise, rows
        without a key are appended, and an empty batch leaves the table alone.
        ``drop`` names further keys to delete. Only buckets that hold a key of
        the batch or of ``drop`` are written again. Running a batch again changes
        nothing, except that its rows without a key are appended once more.
        """
        layout = self._layout()
        if key != layout["key"]:
            raise ValueError(f"table at {self.path} is keyed by {layout['key']}, not {key}")
        schema = _nullable(T.StructType.fromJson(layout["schema"]))
        rows = self._stage(batch, schema, key, once)
        count = rows.count()
        if not count and drop is None:
            return 0
        path = storage.scratch_path(self.spark, "keys")
        keys = rows.select(key)
        if drop is not None:
            keys = keys.unionByName(drop.select(key))
        # Written once: the keys are asked for their buckets and joined.
        self._bucketed(upsert.distinct_keys(keys, key), layout).write.parquet(path)
        keys = self.spark.read.parquet(path)
        # At most one small number per bucket.
        touched = {r[0] for r in keys.select(BUCKET).distinct().collect()}
        held = sorted(touched.intersection(self._buckets(layout)))
        left = keyed_join(self._rows(layout, held), keys.select(key), [key], "left_anti")
        emptied: set[int] = set()
        if drop is not None:
            keep = left.select(key).unionByName(rows.where(F.col(key).isNotNull()).select(key))
            full = self._bucketed(keep, layout).select(BUCKET).distinct().collect()
            emptied = set(held) - {r[0] for r in full}
        self._write(left.unionByName(rows.where(F.col(key).isNotNull())), layout)
        # Dynamic overwrite leaves a bucket without new rows as it was.
        for b in emptied:
            storage.remove_tree(self.spark, f"{self._folder(layout)}/{BUCKET}={b}")
        keyless = rows.where(F.col(key).isNull())
        if not keyless.isEmpty():
            self._write(keyless, layout, "append")
        self._grow(layout)
        return count

    def merge(self, source: DataFrame, key: str, n_buckets: int | None = None, ordinal=None) -> int:
        """Create the table or upsert into it; gives the total row count after.

        Update-all and insert-all by column name. Raises ``DuplicateKeys`` when
        the source repeats a key, on the first load too; with ``ordinal`` the
        row of the highest ordinal is taken instead.
        """
        once = Once(True, ordinal)
        if not self.exists():
            try:
                return self.create(source, key, n_buckets, once)
            except TableExists:
                pass  # lost the race to create it
        self.replace(source, key, once=once)
        return self.count()

    def _grow(self, layout: dict) -> None:
        """Deal the rows to more buckets once these hold more than twice what they should."""
        size = storage.tree_bytes(self.spark, self._folder(layout))
        if size > 2 * BUCKET_BYTES * layout["buckets"]:
            self.rebucket(max(buckets_for(size), layout["buckets"]))

    def rebucket(self, n_buckets: int) -> None:
        """Write all rows to that many buckets, then point the table at them."""
        layout = self._layout()
        if n_buckets == layout["buckets"]:
            return
        new = {**layout, "buckets": n_buckets}
        self._write(self.read(), new)
        storage.write_over(self.spark, f"{self.path}/table.json", json.dumps(new))
        storage.remove_tree(self.spark, self._folder(layout))


def buckets_for(size: int) -> int:
    """Buckets of about a gigabyte each."""
    return min(max(-(-size // BUCKET_BYTES), LEAST_BUCKETS), MOST_BUCKETS)


def written_bytes(rows: DataFrame) -> int:
    """Bytes of a table's files, as the optimizer has them from the listing."""
    return int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere, as files give it back."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType), True)
    return kind



# Catalog tables ---------------------------------------------------------------


def has_catalog(spark: SparkSession, catalog: str) -> bool:
    return bool(spark.conf.get(f"spark.sql.catalog.{catalog}", None))


def merge_sql(target: str, source: str, key: str) -> str:
    return (
        f"MERGE INTO {target} AS target USING {source} AS source "
        f"ON target.{key} = source.{key} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def save_table(
    df: DataFrame,
    namespace: str,
    table: str,
    key: str,
    catalog: str = "local",
    root: str | None = None,
    n_buckets: int | None = None,
) -> int:
    """Create the table or upsert into it by key; gives its row count after.

    With a v2 catalog of that name in the session, the catalog's own ``MERGE``
    does the work; otherwise a bucketed table under ``root``.
    """
    check_names(catalog=catalog, namespace=namespace, table=table, key=key)
    spark = df.sparkSession
    if not has_catalog(spark, catalog):
        return open_table(spark, namespace, table, catalog, root).merge(df, key, n_buckets)
    name = f"{catalog}.{namespace}.{table}"
    ensure_namespace(spark, catalog, namespace)
    created = False
    if not table_exists(spark, catalog, namespace, table):
        try:
            df.writeTo(name).create()
            created = True
        except AnalysisException as e:
            if e.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                raise
    if not created:
        view = f"source_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(view)
        try:
            spark.sql(merge_sql(name, view, key))
        finally:
            spark.catalog.dropTempView(view)
    return spark.table(name).count()


def open_table(
    spark: SparkSession,
    namespace: str,
    table: str,
    catalog: str = "local",
    root: str | None = None,
) -> BucketTable:
    """The bucketed table of that name, under ``root`` or the shared folder."""
    check_names(catalog=catalog, namespace=namespace, table=table)
    root = root or f"{storage.shared_dir(spark)}/tidemark/tables"
    return BucketTable(spark, f"{root}/{catalog}/{namespace}/{table}")


def read_table(
    spark: SparkSession,
    namespace: str,
    table: str,
    catalog: str = "local",
    root: str | None = None,
) -> DataFrame:
    check_names(catalog=catalog, namespace=namespace, table=table)
    if has_catalog(spark, catalog):
        return spark.table(f"{catalog}.{namespace}.{table}")
    return open_table(spark, namespace, table, catalog, root).read()
