"""Queries over the driver's tables, by name. Each takes a session and a folder."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import metadata, offers
from tidemark.functions import text as text_fns
from tidemark.operators import (
    chunks,
    codes,
    embed,
    knn,
    notifications,
    prompts,
    quality,
    ranking,
    upsert,
)
from tidemark.operators import offers as responses
from tidemark.operators.spread import spread
from tidemark.plans import jobs
from tidemark.sources import documents, json_records, storage, tables, vector_table
from tidemark.streaming.documents import DocumentJob
from tidemark.streaming.notifications import NotificationJob

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIMS = 64
BUCKET = "docs"
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Sources ----------------------------------------------------------------------


ORDERS = """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,
    o_totalprice DOUBLE, o_orderdate STRING, o_orderpriority STRING"""


def _orders_json(spark, sf) -> str:
    path = storage.scratch_path(spark, "orders-json")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    orders = table(spark, sf, "orders")
    orders.select(*[c for c in orders.columns if c != "o_orderdate"], day).write.json(path)
    return path


#: Rows to a file that holds them as one array: the number of files grows with the table.
FILE_ROWS = 50_000


def _file_of(rows, key, least):
    """The number of a row's file, by a hash of its key."""
    return F.pmod(F.xxhash64(key), F.lit(max(least, -(-rows.count() // FILE_ROWS))))


def _sliced(rows, key, *groups):
    """Rows with the ``slice`` of their group that they are in; a group has as many as its rows ask for."""
    sizes = rows.groupBy(*groups).agg(F.ceil(F.count("*") / FILE_ROWS).alias("_n"))
    rows = rows.join(F.broadcast(sizes), list(groups))
    return rows.withColumn("slice", F.pmod(F.xxhash64(key), F.col("_n"))).drop("_n")


@query
def json_typed_read(spark, sf):
    path = _orders_json(spark, sf)
    return json_records.read_json(spark, path, ORDERS, "o_orderkey", multiline=False).good


@query
def json_to_table(spark, sf):
    """JSON files loaded into a table by key, twice."""
    path, root = _orders_json(spark, sf), storage.scratch_path(spark, "tables")
    for _ in range(2):
        jobs.load_records(
            spark, path, ORDERS, "o_orderkey", "bank", "orders", root=root, multiline=False
        )
    return tables.read_table(spark, "bank", "orders", root=root)


@query
def json_rejects(spark, sf):
    """Error events are cut short, signup events lack their key."""
    path = storage.scratch_path(spark, "events-json")
    key = F.when(F.col("event_type") != "signup", F.col("event_id"))
    line = F.to_json(F.struct(key.alias("event_id"), "event_type", "user_id"))
    cut = F.substring(line, F.lit(1), F.length(line) - 1)
    events = table(spark, sf, "events")
    events.select(F.when(F.col("event_type") == "error", cut).otherwise(line)).write.text(path)
    schema = "event_id BIGINT, event_type STRING, user_id BIGINT"
    good, bad = json_records.read_json(spark, path, schema, "event_id", multiline=False)
    columns = ["reason", "event_id", "event_type", "user_id", "text"]
    marked = good.withColumn("reason", F.lit("good")).withColumn(
        "text", F.lit(None).cast("string")
    )
    return marked.select(columns).unionByName(bad.select(columns))


@query
def json_whole_files(spark, sf):
    """The accounts of a nation in files of their own, over several lines; those of every fourth are cut short.

    A nation whose files are cut short is listed once, however many they are.
    """
    path = storage.scratch_path(spark, "accounts-json")
    accounts = _supplier_accounts(spark, sf)
    record = F.replace(F.to_json(F.struct(*accounts.columns)), F.lit(","), F.lit(",\n"))
    files = _sliced(accounts, "account_id", "nation").groupBy("nation", "slice").agg(
        F.array_join(F.collect_list(record), ",").alias("all")
    )
    end = F.when(F.col("nation") % 4 != 0, "]").otherwise("")
    text = F.concat(F.lit("["), "all", end).alias("value")
    files.select(text, F.col("nation").alias("part"), "slice").write.partitionBy("part", "slice").text(path)
    schema = "account_id BIGINT, holder STRING, nation INT, balance DOUBLE"
    columns = ["account_id", "holder", "nation", "balance"]
    good, bad = json_records.read_json(spark, path, schema, "account_id")
    bad = bad.withColumn("_of", F.regexp_extract("file", r"/part=(\d+)/", 1))
    return _good_and_bad((good, bad.dropDuplicates(["_of", "reason", *columns])), *columns)


def _orders_array(spark, sf, bad, **options) -> str:
    """All orders of a group as one JSON array per file; some have a price of the wrong type."""
    path = storage.scratch_path(spark, "orders-array")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    price = F.col("o_totalprice")
    raw = F.when(bad, F.to_json(F.struct(F.lit("unknown").alias("o_totalprice")))).otherwise(
        F.to_json(F.struct(price))
    )
    rest = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus", day, "o_orderpriority"))
    record = F.concat(F.substring(rest, F.lit(1), F.length(rest) - 1), F.lit(","), F.substring(raw, F.lit(2), F.length(raw)))
    orders = table(spark, sf, "orders")
    orders = orders.select(_file_of(orders, "o_orderkey", 16).alias("part"), record.alias("r"))
    grouped = orders.groupBy("part").agg(F.array_join(F.collect_list("r"), ",\n").alias("all"))
    text = F.concat(F.lit("["), F.col("all"), F.lit("]"))
    grouped.select(text.alias("value"), "part").write.partitionBy("part").options(**options).text(path)
    return path


def _good_and_bad(records, *columns):
    good, bad = records
    return good.select(*columns, F.lit("good").alias("reason")).unionByName(
        bad.select(*columns, "reason")
    )


@query
def json_mixed_file(spark, sf):
    """Whole arrays in which every seventh record has a bad value: the others are kept."""
    path = _orders_array(spark, sf, F.col("o_orderkey") % 7 == 0)
    records = json_records.read_json(spark, path, ORDERS, "o_orderkey")
    return _good_and_bad(records, "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query
def json_compressed(spark, sf):
    """Whole arrays in compressed files."""
    path = _orders_array(spark, sf, F.lit(False), compression="gzip")
    return json_records.read_json(spark, path, ORDERS, "o_orderkey").good


def _card_files(spark, sf) -> str:
    """Customers as card accounts, many to a file; some statuses and limits break the checks."""
    path = storage.scratch_path(spark, "cards")
    customers = table(spark, sf, "customer")
    status = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "LOST")
        .when(F.col("c_mktsegment") == "BUILDING", "BLOCKED")
        .otherwise("ACTIVE")
    )
    card = F.to_json(
        F.struct(
            F.when(F.col("c_custkey") % 50 != 0, F.concat(F.lit("C"), F.col("c_custkey"))).alias("card_id"),
            F.col("c_name").alias("cardholder_name"),
            (F.col("c_nationkey") * 100.0).alias("credit_limit"),
            F.col("c_acctbal").alias("current_balance"),
            status.alias("card_status"),
            F.when(F.col("c_nationkey") != 3, "EUR").alias("currency"),
        )
    )
    listed = customers.select(_file_of(customers, "c_custkey", 8).alias("part"), card.alias("card"))
    grouped = listed.groupBy("part").agg(F.array_join(F.collect_list("card"), ",").alias("all"))
    text = F.concat(F.lit("["), F.col("all"), F.lit("]"))
    grouped.select(text.alias("value"), "part").write.partitionBy("part").text(path)
    return path


@query
def card_load(spark, sf):
    """Card files into a table, twice; cards without an identifier are set aside."""
    path, root = _card_files(spark, sf), storage.scratch_path(spark, "tables")
    for _ in range(2):
        rejects = jobs.load_cards(spark, path, "bank", root=root).rejects
    columns = ["cardholder_name", "credit_limit", "current_balance", "card_status", "currency"]
    stored = tables.read_table(spark, "bank", "credit_cards", root=root)
    return stored.select("card_id", *columns, F.lit("good").alias("reason")).unionByName(
        rejects.select("card_id", *columns, "reason")
    )


@query
def card_checks(spark, sf):
    """The checks of a card table over cards as they were read."""
    good = json_records.read_json(spark, _card_files(spark, sf), fixed.CARD_SCHEMA, fixed.CARD_KEY).good
    return quality.card_quality(good, min_rows=100_000)


@query
def record_payloads(spark, sf):
    """Payloads with one object, a list of two, or text cut short."""
    one = F.to_json(
        F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), "s_acctbal")
    )
    two = F.concat(F.lit("["), one, F.lit(', {"nation": 7} ]'))
    payload = (
        F.when(F.col("s_acctbal") < 0, F.substring(two, F.lit(1), F.length(two) - 1))
        .when(F.col("s_acctbal") > 5000, one)
        .otherwise(two)
    )
    parsed = json_records.parse_records(payload, "name STRING, nation INT, rating DOUBLE")
    return (
        table(spark, sf, "supplier")
        .select("s_suppkey", parsed.alias("records"))
        .select(
            "s_suppkey",
            F.col("records").isNotNull().alias("readable"),
            F.inline_outer("records"),
        )
    )


def _item_files(spark, sf, root=None, which="true") -> str:
    """Benchmark items written as one text object each, to those under ``root`` if given."""
    root = root or storage.scratch_path(spark, "objects")
    cores = spark.sparkContext.defaultParallelism
    items = table(spark, sf, "benchmark").select("item_id", "text").where(which).repartition(cores, "item_id")
    items.write.mode("append").partitionBy("item_id").text(f"{root}/{BUCKET}/raw")
    return root


def _odd_spelling(path: str) -> str:
    """The same folder, as ``/./`` in the middle and a slash too many at the end."""
    head, tail = path.rsplit("/", 1)
    return f"{head}/./{tail}/"


@query
def document_files(spark, sf):
    """Text objects read under a prefix, by a root spelled oddly, and none under another."""
    root = _odd_spelling(_item_files(spark, sf))
    good = documents.read_documents(spark, root, BUCKET, "raw/item_id=").good
    none = documents.read_documents(spark, root, BUCKET, "nothing/here/").good
    good = good.unionByName(none)
    item = F.regexp_extract("source_key", r"^raw/item_id=(\d+)/", 1).cast("bigint")
    return good.select(
        item.alias("item_id"),
        "source_bucket",
        F.sha1("text").alias("digest"),
        F.length("text").cast("bigint").alias("n_chars"),
    )


@query
def table_create_read(spark, sf):
    root = storage.scratch_path(spark, "tables")
    tables.save_table(table(spark, sf, "customer"), "bank", "customers", "c_custkey", root=root)
    return tables.read_table(spark, "bank", "customers", root=root)


# Upserts ----------------------------------------------------------------------


def _supplier_accounts(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("account_id"),
        F.col("s_name").alias("holder"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )


def _customer_accounts(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("holder"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )


def _event_entries(spark, sf, key):
    return table(spark, sf, "events").select(
        F.col(key).alias("entry_id"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("kind"),
    )


def _order_entries(spark, sf, key):
    return table(spark, sf, "orders").select(
        F.col(key).alias("entry_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("kind"),
    )


@query
def upsert_merge(spark, sf):
    return upsert.merge_by_key(
        _event_entries(spark, sf, "event_id"),
        _order_entries(spark, sf, "o_orderkey"),
        "entry_id",
    )


@query
def upsert_last_wins(spark, sf):
    target = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("entry_id"),
        F.lit(None).cast("bigint").alias("event_id"),
        F.col("c_acctbal").alias("amount"),
    )
    # Errors have no ordinal, and come after all that have one.
    ordinal = F.when(F.col("event_type") != "error", F.col("event_id")).alias("event_id")
    source = table(spark, sf, "events").select(
        F.col("user_id").alias("entry_id"), ordinal, F.col("value").alias("amount")
    )
    rows = upsert.merge_by_key(target, source, "entry_id", ordinal=F.col("event_id"))
    # Of several rows without an ordinal any may stay; those of the target never had one.
    return rows.select(
        "entry_id", "event_id", F.when(F.col("event_id").isNotNull(), F.col("amount")).alias("amount")
    )


@query
def upsert_replace_keys(spark, sf):
    return upsert.replace_by_keys(
        _order_entries(spark, sf, "o_custkey"),
        _event_entries(spark, sf, "user_id"),
        "entry_id",
    )


@query
def append_unkeyed(spark, sf):
    batch = table(spark, sf, "part").select(
        F.lit(None).cast("bigint").alias("entry_id"),
        F.col("p_retailprice").alias("amount"),
        F.col("p_type").alias("kind"),
    )
    return upsert.replace_by_keys(_order_entries(spark, sf, "o_custkey"), batch, "entry_id")


@query
def append_by_name(spark, sf):
    return upsert.append_rows(
        _supplier_accounts(spark, sf),
        _customer_accounts(spark, sf).select("balance", "nation", "holder", "account_id"),
    )


@query
def batch_keys(spark, sf):
    return upsert.distinct_keys(_event_entries(spark, sf, "user_id"), "entry_id")


@query
def upsert_table(spark, sf):
    """Two upserts into one stored table."""
    root = storage.scratch_path(spark, "tables")
    for accounts in (_supplier_accounts, _customer_accounts):
        tables.save_table(accounts(spark, sf), "bank", "accounts", "account_id", root=root)
    return tables.read_table(spark, "bank", "accounts", root=root)


@query
def replace_table(spark, sf):
    """Orders of a customer replaced by that customer's events, in a stored table."""
    path = storage.scratch_path(spark, "entries")
    stored = tables.BucketTable(spark, path)
    stored.create(_order_entries(spark, sf, "o_custkey"), "entry_id")
    stored.replace(_event_entries(spark, sf, "user_id"), "entry_id")
    return stored.read()


# Quality, counts, sorting -----------------------------------------------------


@query
def quality_report(spark, sf):
    customers = quality.quality_report(
        table(spark, sf, "customer"),
        {
            "segment": quality.outside(F.col("c_mktsegment"), SEGMENTS),
            "balance": F.col("c_acctbal") < 0,
            "nation": F.col("c_nationkey").isNull(),
        },
        key="c_custkey",
        min_rows=100_000,
    )
    orders = quality.quality_report(
        table(spark, sf, "orders"),
        {
            "status": quality.outside(F.col("o_orderstatus"), ("F", "O")),
            "price": F.col("o_totalprice") <= 0,
        },
        key="o_custkey",
        min_rows=1,
    )
    return (
        customers.withColumn("source", F.lit("customer"))
        .unionByName(orders.withColumn("source", F.lit("orders")))
        .select("source", "check", "violations")
    )


@query
def quality_by_load(spark, sf):
    """Orders loaded by priority, the last load twice; checks and distinct customers from the kept states."""
    orders = table(spark, sf, "orders")
    checks = {"status": quality.outside(F.col("o_orderstatus"), ("F", "O")), "price": F.col("o_totalprice") > 300_000}
    kept = quality.KeptQuality(spark, storage.scratch_path(spark, "quality"), checks, ["o_custkey", "o_orderstatus"])
    for name in ("1", "2", "3", "4", "5", "5"):
        kept.add(orders.where(F.col("o_orderpriority").startswith(name)), name)
    exact = orders.agg(*(F.count_distinct(c).alias(c) for c in kept.distinct))
    exact = exact.unpivot([], kept.distinct, "column", "exact")
    off = F.abs(F.col("estimate") - F.col("exact")) / F.col("exact")
    found = kept.distinct_values().join(exact, "column")
    near = found.select(F.concat(F.lit("distinct "), "column").alias("check"), (off > 0.06).cast("bigint").alias("violations"))
    return kept.report(min_rows=10_000_000).unionByName(near)


@query
def row_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("n"))


@query
def distinct_values(spark, sf):
    return table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query
def distinct_count(spark, sf):
    return (
        table(spark, sf, "lineitem").select("l_partkey").distinct().agg(F.count("*").alias("n"))
    )


@query
def filtered_rows(spark, sf):
    """Comparison, null and membership tests on a projection."""
    customers = table(spark, sf, "customer")
    return customers.where(
        (F.col("c_acctbal") < 0)
        & F.col("c_nationkey").isNotNull()
        & quality.outside(F.col("c_mktsegment"), SEGMENTS)
    ).select("c_custkey", "c_mktsegment")


@query
def top_by_value(spark, sf):
    return quality.top_rows(table(spark, sf, "orders"), "o_totalprice", "o_orderkey", 100).select(
        "o_orderkey", "o_totalprice"
    )


# Chunks and vectors -----------------------------------------------------------


def _documents(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def _document_chunks(spark, sf):
    return chunks.chunk_documents(_documents(spark, sf))


def _source_key():
    return F.concat(F.lit("doc/"), F.col("doc_id").cast("string"))


@query
def chunk_documents(spark, sf):
    return _document_chunks(spark, sf).withColumn("chunk_index", F.col("chunk_index").cast("bigint"))


@query
def chunk_wide_overlap(spark, sf):
    """Windows that share three quarters of their text."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return chunks.chunk_documents(turns, size=80, overlap=60).withColumn(
        "chunk_index", F.col("chunk_index").cast("bigint")
    )


@query
def chunk_keys(spark, sf):
    keyed = chunks.keyed_chunks(_document_chunks(spark, sf), F.lit(BUCKET), _source_key())
    m = F.col("metadata")
    return keyed.select(
        "key",
        m["source_bucket"].alias("source_bucket"),
        m["source_key"].alias("source_key"),
        m["chunk_index"].cast("bigint").alias("chunk_index"),
        F.length(m["text"]).cast("bigint").alias("n_chars"),
    )


def _weights(df, vector, *columns):
    """Non-zero components, one row each."""
    return (
        df.select(*columns, F.posexplode(vector).alias("dim", "w"))
        .where("w <> 0")
        .select(*columns, F.col("dim").cast("bigint").alias("dim"), F.round(F.col("w").cast("double"), 6).alias("weight"))
    )


@query
def embed_hash(spark, sf):
    docs = _documents(spark, sf)
    return _weights(embed.embed(docs, "text", dims=DIMS), "vector", "doc_id")


def text_shape():
    """A model as a caller would pass it: characters, spaces and lines of a text."""

    def model(texts: list[str]) -> np.ndarray:
        return np.array([[len(t), t.count(" "), t.count("\n")] for t in texts])

    return model


@query
def embed_model(spark, sf):
    docs = _documents(spark, sf)
    v = F.col("vector")
    return embed.embed(docs, "text", dims=3, load=text_shape).select(
        "doc_id", *[v[i].cast("bigint").alias(n) for i, n in enumerate(("chars", "spaces", "lines"))]
    )


@query
def ingest_documents(spark, sf):
    """Documents to a stored chunk table."""
    stored = tables.BucketTable(spark, storage.scratch_path(spark, "chunks"))
    docs = _documents(spark, sf).select(
        F.lit(BUCKET).alias("source_bucket"), _source_key().alias("source_key"), "text"
    )
    vector_table.ingest_documents(docs, stored, dims=DIMS)
    m = F.col("metadata")
    return stored.read().select(
        "key",
        m["source_key"].alias("source_key"),
        m["chunk_index"].cast("bigint").alias("chunk_index"),
        F.sha1(m["text"]).alias("digest"),
        F.size(F.filter("vector", lambda x: x != 0)).cast("bigint").alias("n_dims"),
    )


def _item_chunks(stored):
    m = F.col("metadata")
    return stored.read().select(
        F.regexp_extract(m["source_key"], r"item_id=(\d+)/", 1).cast("bigint").alias("item_id"),
        m["chunk_index"].cast("bigint").alias("chunk_index"),
        m["text"].alias("chunk"),
        (F.col("key") == text_fns.chunk_key(m["source_key"], m["chunk_index"])).alias("keyed"),
    )


@query
def ingest_prefix(spark, sf):
    """Text objects under a prefix to a stored chunk table."""
    stored = tables.BucketTable(spark, storage.scratch_path(spark, "chunks"))
    jobs.ingest_prefix(spark, _item_files(spark, sf), BUCKET, "raw/", stored, dims=DIMS)
    return _item_chunks(stored)


@query
def ingest_stream(spark, sf):
    """The same objects in two arrivals, which a stream takes in as they come."""
    at = storage.scratch_path(spark, "stream")
    stored = tables.BucketTable(spark, f"{at}/chunks")
    job = DocumentJob(spark, f"{at}/objects", BUCKET, "raw/", stored, f"{at}/state", {"dims": DIMS})
    for which in ("item_id % 3 = 0", "item_id % 3 <> 0"):
        _item_files(spark, sf, f"{at}/objects", which)
        job.start(wait=None).awaitTermination()
    return _item_chunks(stored)


def picky_model():
    """A model that fails on texts with a letter it does not know."""

    def model(texts: list[str]) -> np.ndarray:
        if any("ç" in t for t in texts):
            raise ValueError("unknown letter")
        return np.array([[len(t), 1] for t in texts])

    return model


@query
def ingest_rejects(spark, sf):
    """Conversation turns as documents, some of which the model cannot take."""
    stored = tables.BucketTable(spark, storage.scratch_path(spark, "chunks"))
    docs = table(spark, sf, "conversations").select(
        F.lit(BUCKET).alias("source_bucket"),
        F.concat_ws("/", "conv_id", "turn").alias("source_key"),
        "text",
    )
    rejects = vector_table.ingest_documents(docs, stored, 2, 200, 20, picky_model).rejects
    kept = stored.read().groupBy(F.col("metadata.source_key").alias("source_key")).agg(
        F.count("*").alias("n_chunks"),
        F.sum(F.col("vector")[0].cast("bigint")).alias("n_chars"),
    )
    return kept.withColumn("rejected", F.lit(False)).unionByName(
        rejects.select("source_key", F.lit(True).alias("rejected"), "reason"),
        allowMissingColumns=True,
    )


@query
def replaced_documents(spark, sf):
    """Documents stored twice; the second time some are shorter, and some blank."""
    stored = tables.BucketTable(spark, storage.scratch_path(spark, "chunks"))
    docs = table(spark, sf, "conversations").select(
        F.lit(BUCKET).alias("source_bucket"),
        F.concat_ws("/", "conv_id", "turn").alias("source_key"),
        F.col("turn"),
        "text",
    )
    vector_table.ingest_documents(docs.drop("turn"), stored, 4, 60, 10)
    short = F.when(F.col("turn") % 3 == 0, F.lit("  ")).otherwise(F.substring("text", 1, 70))
    again = docs.where(F.col("turn") % 3 < 2).withColumn("text", short).drop("turn")
    vector_table.ingest_documents(again, stored, 4, 60, 10, replace_document=True)
    m = F.col("metadata")
    return stored.read().select(
        m["source_key"].alias("source_key"),
        m["chunk_index"].cast("bigint").alias("chunk_index"),
        m["text"].alias("chunk"),
    )


@query
def ingest_changes(spark, sf):
    """Conversations stored twice; the second time some turns are shorter, some gone, some new."""
    root = storage.scratch_path(spark, "changes")
    stored, digests = (tables.BucketTable(spark, f"{root}/{name}") for name in ("chunks", "digests"))
    docs = table(spark, sf, "conversations").select(
        F.lit(BUCKET).alias("source_bucket"),
        F.concat_ws("/", "conv_id", "turn").alias("source_key"),
        F.col("turn"),
        F.when(F.col("turn") % 5 == 4, F.lit(" ")).otherwise(F.col("text")).alias("text"),
    )
    vector_table.ingest_changes(docs.where("turn % 4 < 3").drop("turn"), stored, digests, 4, 60, 10)
    short = F.when(F.col("turn") % 3 == 0, F.substring("text", 1, 70)).otherwise(F.col("text"))
    now = docs.where("turn % 4 > 0").withColumn("text", short).drop("turn")
    vector_table.ingest_changes(now, stored, digests, 4, 60, 10)
    m = F.col("metadata")
    return stored.read().select(
        m["source_key"].alias("source_key"),
        m["chunk_index"].cast("bigint").alias("chunk_index"),
        m["text"].alias("chunk"),
    )


@query
def vector_upsert(spark, sf):
    """Hashed documents put over the embeddings with the same number."""
    stored = tables.BucketTable(spark, storage.scratch_path(spark, "vectors"))

    def meta(source):
        return F.struct(
            F.lit(BUCKET).alias("source_bucket"),
            F.lit(source).alias("source_key"),
            F.lit(0).alias("chunk_index"),
            F.lit("").alias("text"),
        ).alias("metadata")

    base = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("key"), F.col("embedding").alias("vector"), meta("embeddings")
    )
    docs = embed.embed(_documents(spark, sf), "text", dims=DIMS).select(
        F.col("doc_id").alias("key"), "vector", meta("documents")
    )
    vector_table.put_chunks(base, stored)
    vector_table.put_chunks(docs, stored)
    rows = stored.read().withColumn("source", F.col("metadata.source_key"))
    return _weights(rows, "vector", "key", "source")


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("key"), F.col("embedding").alias("vector")
    )


def _as_queries(vectors):
    return vectors.withColumnRenamed("key", "query_id")


def _hits(found):
    return found.select(
        "query_id",
        "key",
        F.col("rank").cast("bigint").alias("rank"),
        F.round("score", 6).alias("score"),
    )


@query
def knn_exact(spark, sf):
    """Nearest to the mean of all vectors."""
    corpus = _vectors(spark, sf)
    mean = (
        corpus.select(F.posexplode("vector").alias("dim", "x"))
        .groupBy("dim")
        .agg(F.avg("x").alias("m"))
        .orderBy("dim")
        .collect()
    )
    found = knn.nearest_to(corpus, [r["m"] for r in mean], 10)
    return found.select("key", F.round("score", 6).alias("score"))


@query
def knn_batch(spark, sf):
    corpus = _vectors(spark, sf)
    return _hits(knn.nearest(_as_queries(corpus), corpus))


@query
def knn_l2(spark, sf):
    corpus = _vectors(spark, sf)
    return _hits(knn.nearest(_as_queries(corpus), corpus, metric="l2"))


@query
def knn_dot(spark, sf):
    corpus = _vectors(spark, sf)
    return _hits(knn.nearest(_as_queries(corpus), corpus, metric="dot"))


@query
def knn_blocks(spark, sf):
    corpus = _vectors(spark, sf)
    return _hits(knn.nearest_in_blocks(_as_queries(corpus), corpus, limit=128 << 10))


@query
def knn_cells(spark, sf):
    corpus = _vectors(spark, sf)
    index = knn.build_cells(corpus, 16)
    return _hits(knn.nearest_in_cells(_as_queries(corpus), index))


@query
def knn_cells_dot(spark, sf):
    corpus = _vectors(spark, sf)
    index = knn.build_cells(corpus, 16, "dot")
    return _hits(knn.nearest_in_cells(_as_queries(corpus), index))


@query
def knn_codes(spark, sf):
    """Neighbours of every fiftieth vector by codes, held against the exact ones."""
    corpus = _vectors(spark, sf)
    asked = _as_queries(corpus.where("key % 50 = 0"))
    index = codes.build_codes(corpus, n_cells=16, parts=16)
    found = codes.nearest_by_codes(asked, index, probes=14, rerank=128)
    exact = knn.nearest(asked, corpus).select("query_id", "key", F.col("score").alias("exact"))
    both = found.join(exact, ["query_id", "key"], "left")
    right = F.count_if(F.col("exact").isNotNull())
    same = F.round("score", 6) == F.round("exact", 6)
    return both.agg(
        F.count_distinct("query_id").alias("n_queries"),
        F.count("*").alias("n_hits"),
        (right >= 0.9 * F.count("*")).alias("recall_reached"),
        F.coalesce(F.every(F.coalesce(same, F.lit(True))), F.lit(True)).alias("scores_exact"),
    )


# Prompts and responses --------------------------------------------------------


def _questions(spark, sf):
    return (
        table(spark, sf, "conversations")
        .where("role = 'user'")
        .select(F.concat_ws("-", "conv_id", "turn").alias("question_id"), F.col("text").alias("question"))
    )


@query
def prompt_build(spark, sf):
    """Every user turn asked over the chunks of all documents."""
    return prompts.retrieve_prompts(
        _questions(spark, sf), _chunk_table(spark, sf), "question_id", "question", dims=DIMS
    ).select("question_id", "prompt")


def first_source():
    """A stand-in for a model: names the best source of its context, and its length."""

    def reply(bodies: list[str]) -> list[str]:
        said = []
        for body in bodies:
            context = json.loads(body)["messages"][0]["content"].rsplit("\n\nQuestion: ", 1)[0]
            context = context.removeprefix("Context:\n")
            line = context.split("\n", 1)[0] if context else "nothing found"
            said.append(f"{line} in {len(context)}")
        return [json.dumps({"content": [{"type": "text", "text": t}]}) for t in said]

    return reply


def _chunk_table(spark, sf):
    keyed = chunks.keyed_chunks(_document_chunks(spark, sf), F.lit(BUCKET), _source_key())
    return embed.embed(keyed, "metadata.text", dims=DIMS)


@query
def answer_questions(spark, sf):
    return prompts.answer_questions(
        _questions(spark, sf), _chunk_table(spark, sf), "question_id", "question", first_source,
        dims=DIMS,
    ).select("question_id", "answer")


@query
def query_chunks(spark, sf):
    """Chunks nearest to a vector that weighs all dimensions alike."""
    found = knn.query_chunks(_chunk_table(spark, sf), [1.0] * DIMS, 20)
    m = F.col("metadata")
    return found.select(
        "key",
        F.round("score", 6).alias("score"),
        m["source_key"].alias("source_key"),
        m["chunk_index"].cast("bigint").alias("chunk_index"),
    )


@query
def request_bodies(spark, sf):
    """Request JSON of every user turn over the chunks of all documents."""
    asked = prompts.retrieve_prompts(
        _questions(spark, sf), _chunk_table(spark, sf), "question_id", "question", dims=DIMS
    )
    body = asked.select("question_id", prompts.request_body(F.col("prompt")).alias("body"))
    return body.select(
        "question_id",
        F.get_json_object("body", "$.anthropic_version").alias("version"),
        F.get_json_object("body", "$.max_tokens").cast("bigint").alias("max_tokens"),
        F.get_json_object("body", "$.system").alias("system"),
        F.get_json_object("body", "$.messages[0].role").alias("role"),
        F.get_json_object("body", "$.messages[0].content").alias("content"),
    )


@query
def chat_bodies(spark, sf):
    """Every question as a chat request."""
    asked = _questions(spark, sf).withColumn(
        "body", prompts.chat_body(F.col("question"), F.lit("model-1"))
    )
    return asked.select(
        "question_id",
        F.get_json_object("body", "$.model").alias("model"),
        F.get_json_object("body", "$.messages[0].content").alias("system"),
        F.get_json_object("body", "$.messages[1].role").alias("role"),
        F.get_json_object("body", "$.messages[1].content").alias("content"),
    )


@query
def answer_decode(spark, sf):
    """Answers of assistant turns in one layout, of users in the other; none of systems."""
    block = F.struct(F.lit("text").alias("type"), "text")
    blocks = F.to_json(F.struct(F.array(block).alias("content")))
    message = F.struct(F.struct(F.col("text").alias("content")).alias("message"))
    choices = F.to_json(F.struct(F.array(message).alias("choices")))
    response = (
        F.when(F.col("role") == "assistant", blocks)
        .when(F.col("role") == "user", choices)
        .otherwise('{"content":[]}')
    )
    stored = table(spark, sf, "conversations").select(
        "conv_id", "turn", response.alias("response")
    )
    return prompts.decode_answers(stored, "response").select(
        "conv_id", "turn", "answer", F.col("answer").isNull().alias("rejected")
    )


@query
def vector_decode(spark, sf):
    stored = table(spark, sf, "embeddings").select(
        "vec_id", F.to_json(F.struct("embedding")).alias("response")
    )
    return embed.decode_vectors(stored, "response").select(
        "vec_id", F.posexplode("vector").alias("dim", "x")
    ).select("vec_id", F.col("dim").cast("bigint").alias("dim"), F.round(F.col("x").cast("double"), 6).alias("x"))


# Notifications ----------------------------------------------------------------


def _event_json(message_id, body):
    return F.to_json(
        F.struct(F.array(F.struct(message_id.alias("messageId"), body.alias("body"))).alias("Records"))
    )


def _body(*keys):
    """A message body for uploaded objects."""
    return _bodies(F.array(*keys))


def _bodies(keys):
    """A message body for a list of uploaded objects."""
    return F.to_json(
        F.struct(
            F.transform(
                keys,
                lambda key: F.struct(
                    F.struct(
                        F.struct(F.lit(BUCKET).alias("name")).alias("bucket"),
                        F.struct(key.alias("key")).alias("object"),
                    ).alias("s3")
                ),
            ).alias("Records")
        )
    )


def _wrapped(body):
    return F.to_json(F.struct(F.lit("Notification").alias("Type"), body.alias("Message")))


@query
def notification_refs(spark, sf):
    """Secure pages come wrapped, pages of blogs outside the prefix, spam cut short."""
    folder = F.when(F.col("url").contains("//blog."), "tmp/").otherwise(fixed.DATA_PREFIX)
    body = _body(F.url_encode(F.concat(folder, "url", F.lit(" v1"))))
    body = F.when(F.col("url").startswith("https"), _wrapped(body)).otherwise(body)
    body = F.when(
        F.col("url").contains("spam"), F.substring(body, F.lit(1), F.length(body) - 2)
    ).otherwise(body)
    events = table(spark, sf, "pages").select(
        _event_json(F.concat(F.lit("m-"), F.col("page_id").cast("string")), body).alias("event")
    )
    messages = notifications.event_messages(events, "event")
    read = notifications.message_refs(messages, prefix=fixed.DATA_PREFIX)
    return read.select(
        "message_id", "readable", F.explode_outer("refs").alias("ref")
    ).select("message_id", "readable", "ref.bucket", "ref.key")


def _run_notifications(spark, sf) -> NotificationJob:
    """Supplier accounts uploaded over a table of customer accounts.

    Suppliers are uploaded by nation and half of their numbers, one message for
    each, which names all its files. Every nation also has a message about a file that does not
    exist. Suppliers of the first nation come in a message without identifier,
    and each event has a copy that is cut short.
    """
    root = storage.scratch_path(spark, "uploads")
    accounts = _supplier_accounts(spark, sf)
    record = F.to_json(F.struct(*accounts.columns))
    part = F.concat_ws("-", "nation", F.col("account_id") % 2)
    sliced = _sliced(accounts.withColumn("part", part), "account_id", "part")
    files = sliced.groupBy("part", "slice").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]")).alias("value")
    )
    folder = f"{BUCKET}/{fixed.DATA_PREFIX}accounts"
    files.select("part", "slice", "value").write.partitionBy("part", "slice").text(f"{root}/{folder}")
    written = spark.read.text(f"{root}/{folder}").select("part", "slice", F.col("_metadata.file_name").alias("name"))
    prefix = F.lit(f"{fixed.DATA_PREFIX}accounts/part=")
    key = F.concat(prefix, "part", F.lit("/slice="), F.col("slice").cast("string"), F.lit("/"), "name")
    good = written.groupBy("part").agg(F.sort_array(F.collect_list(F.url_encode(key))).alias("keys")).select(
        F.when(~F.col("part").startswith("0-"), F.concat(F.lit("s-"), "part")).alias("message_id"),
        _bodies(F.col("keys")).alias("body"),
    )
    lost = table(spark, sf, "nation").select(
        F.concat(F.lit("n-"), F.col("n_nationkey").cast("string")).alias("message_id"),
        _wrapped(_body(F.concat(F.lit("data/lost/"), "n_name"))).alias("body"),
    )
    line = _event_json(F.col("message_id"), F.col("body"))
    events = good.unionByName(lost).select(line.alias("value"))
    cut = F.substring("value", F.lit(1), F.length("value") - 1)
    events.unionByName(events.select(cut.alias("value"))).repartition(4).write.text(f"{root}/events")
    accounts_table = tables.BucketTable(spark, f"{root}/table")
    accounts_table.create(_customer_accounts(spark, sf), "account_id")
    job = NotificationJob(
        spark,
        events=f"{root}/events",
        table=accounts_table,
        key="account_id",
        state=f"{root}/state",
        object_root=_odd_spelling(root),
    )
    job.start(files_per_batch=4, wait=None, messages_per_batch=60).awaitTermination()
    return job


@query
def notification_upsert(spark, sf):
    return _run_notifications(spark, sf).table.read()


@query
def notification_outcomes(spark, sf):
    outcomes = _run_notifications(spark, sf).outcomes()
    return outcomes.groupBy("message_id", "status", "reason").agg(F.count("*").alias("n"))


@query
def metadata_variant(spark, sf):
    """Event properties as free metadata; error events hold none that can be read."""
    text = F.concat(
        F.lit('{"type":"'), "event_type", F.lit('","user":'), F.col("user_id").cast("string"),
        F.lit(',"none":null,"nested":'), "props", F.lit("}"),
    )
    text = F.when(F.col("event_type") == "error", F.lit("[1]")).otherwise(text)
    doc = metadata.clean_metadata(text)
    return table(spark, sf, "events").select("event_id", doc.alias("m")).select(
        "event_id",
        F.size("m").cast("bigint").alias("n_fields"),
        F.try_variant_get(F.col("m")["type"], "$", "string").alias("type"),
        F.try_variant_get(F.col("m")["user"], "$", "bigint").alias("user"),
        F.try_variant_get(F.col("m")["nested"], "$", "string").alias("nested"),
    )


@query
def metadata_documents(spark, sf):
    """Event properties cleaned and put together as documents again."""
    text = F.concat(
        F.lit('{"value":'), F.col("value").cast("string"), F.lit(',"none":null,"at":['),
        F.col("user_id").cast("string"), F.lit(',"x"],"type":"'), "event_type", F.lit('"}'),
    )
    text = F.when(F.col("event_type") == "error", F.lit("cut {")).otherwise(text)
    doc = F.to_json(metadata.metadata_document(text))
    return table(spark, sf, "events").select("event_id", doc.alias("doc")).select(
        "event_id",
        F.coalesce(F.size(F.json_object_keys("doc")), F.lit(0)).cast("bigint").alias("n_fields"),
        F.get_json_object("doc", "$.type").alias("type"),
        F.get_json_object("doc", "$.at").alias("at"),
        F.get_json_object("doc", "$.value").cast("double").alias("value"),
    )


# Offers -----------------------------------------------------------------------


def _part_offers(spark, sf):
    """One offer per part, as JSON, with its brand as the batch."""
    apr = F.struct((F.col("p_size") / 2 + 5).alias("min"), F.col("p_size").alias("max"))
    offer = F.to_json(
        F.struct(
            F.col("p_name").alias("name"),
            apr.alias("apr"),
            ((F.col("p_retailprice") - 900) * 6).alias("annual_fee"),
            (F.col("p_size") * 0.7).alias("rewards_score"),
            F.length("p_type").alias("bonus_score"),
        )
    )
    return table(spark, sf, "part").select("p_partkey", "p_brand", F.parse_json(offer).alias("offer"))


@query
def offer_score(spark, sf):
    return _part_offers(spark, sf).select("p_partkey", offers.offer_score(F.col("offer")).alias("score"))


def _scored(spark, sf):
    return _part_offers(spark, sf).select(
        "p_partkey", "p_brand", offers.offer_score(F.col("offer")).alias("score")
    )


def _rank_columns(ranked):
    return ranked.select("p_brand", "p_partkey", "score", F.col("rank").cast("bigint").alias("rank"))


@query
def offer_rank(spark, sf):
    return _rank_columns(ranking.rank_rows(_scored(spark, sf), "p_brand", "score", "p_partkey"))


@query
def offer_rank_ranges(spark, sf):
    """The same ranks by way of sorted ranges, as for a batch too large for one task."""
    return _rank_columns(
        ranking.rank_rows(_scored(spark, sf), "p_brand", "score", "p_partkey", hot_rows=1)
    )


def _payloads(spark, sf):
    """Three offers per customer, in the shapes a payload can have."""
    nation, balance = F.col("c_nationkey"), F.col("c_acctbal")

    def named(part):
        return F.concat("c_name", F.lit(part)).alias("name")

    whole = F.to_json(
        F.struct(
            named("/a"),
            F.struct((nation + 5).alias("min"), (nation + 15).alias("max")).alias("apr"),
            (nation * 30).alias("annual_fee"),
            nation.alias("rewards_score"),
            (nation - 5).alias("bonus_score"),
        )
    )
    scalar = F.to_json(
        F.struct(
            named("/b"),
            (balance / 300).alias("apr"),
            (nation * 10).cast("string").alias("annual_fee"),
            F.lit(40).alias("rewards_score"),
        )
    )
    sparse = F.to_json(
        F.struct(named("/c"), F.lit("n/a").alias("annual_fee"), F.lit("12").alias("bonus_score"))
    )
    listed = F.concat(F.lit("["), F.concat_ws(",", whole, scalar, sparse), F.lit("]"))
    wrapped = F.concat(F.lit('{"cards":'), listed, F.lit("}"))
    payload = (
        F.when(F.col("c_mktsegment") == "BUILDING", wrapped)
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit('{"offers":[]}'))
        .otherwise(listed)
    )
    return table(spark, sf, "customer").select("c_custkey", payload.alias("payload"))


@query
def offer_payload(spark, sf):
    ranked = ranking.rank_payloads(_payloads(spark, sf), "payload")
    return ranked.select(
        "c_custkey",
        F.col("rank").cast("bigint").alias("rank"),
        F.col("pos").cast("bigint").alias("pos"),
        "score",
        offers.offer_field(F.col("offer"), "$.name", "string").alias("name"),
    )


DOCUMENT = """generated_at STRING, source STRING, total BIGINT,
    top_cards ARRAY<STRUCT<name: STRING, score: DOUBLE, rank: BIGINT>>"""


@query
def rank_envelope(spark, sf):
    documents_ = ranking.ranked_documents(_payloads(spark, sf), "payload")
    parsed = documents_.select("c_custkey", F.from_json("document", DOCUMENT).alias("d"))
    return parsed.select(
        "c_custkey", "d.source", "d.total", F.explode_outer("d.top_cards").alias("c")
    ).select("c_custkey", "source", "total", "c.name", "c.score", "c.rank")


@query
def brand_envelopes(spark, sf):
    """One document per brand, with its hundred best parts."""
    documents_ = ranking.ranked_batches(_part_offers(spark, sf), "p_brand", "offer", "p_partkey")
    parsed = documents_.select("p_brand", F.from_json("document", DOCUMENT).alias("d"))
    return parsed.select("p_brand", "d.source", "d.total", F.explode("d.top_cards").alias("c")).select(
        "p_brand", "source", "total", "c.name", "c.score", "c.rank"
    )


@query
def ranked_sink(spark, sf):
    """Payloads of one segment are cut short: they come back as rejects."""
    path = storage.scratch_path(spark, "ranked")
    cut = F.substring("payload", F.lit(1), F.length("payload") - 2)
    payloads = _payloads(spark, sf).join(
        table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey"
    )
    payload = F.when(F.col("c_mktsegment") == "FURNITURE", cut).otherwise(F.col("payload"))
    rejects = ranking.write_ranked_documents(payloads.withColumn("payload", payload), "payload", path)
    parsed = json_records.read_json(spark, path, DOCUMENT, multiline=False).good
    stored = parsed.select("source", "total", F.explode("top_cards").alias("c")).select(
        "source", "total", "c.name", "c.score", "c.rank"
    )
    return stored.unionByName(
        rejects.select(F.col("c_custkey").alias("rejected")), allowMissingColumns=True
    )


def _responses(spark, sf):
    """Stored responses: user turns as content blocks, others as choices."""
    call_id = F.concat_ws("-", F.lit("call"), "conv_id", "turn")
    given = F.struct(F.col("text").alias(fixed.SAVE_FIELD))
    blocks = F.to_json(
        F.struct(
            F.lit("tool_use").alias("stop_reason"),
            F.array(
                F.struct(
                    F.lit("text").alias("type"),
                    F.lit(None).cast("string").alias("id"),
                    F.lit(None).cast("string").alias("name"),
                    F.lit(None).cast(f"struct<{fixed.SAVE_FIELD} string>").alias("input"),
                ),
                F.struct(
                    F.lit("tool_use").alias("type"),
                    call_id.alias("id"),
                    F.lit(fixed.SAVE_CALL).alias("name"),
                    given.alias("input"),
                ),
            ).alias("content"),
        )
    )
    function = F.struct(F.lit(fixed.SAVE_CALL).alias("name"), F.to_json(given).alias("arguments"))
    choice = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.when(F.col("role") == "assistant", "tool_calls").otherwise("stop").alias("finish_reason"),
                    F.struct(
                        F.array(F.struct(call_id.alias("id"), function.alias("function"))).alias("tool_calls")
                    ).alias("message"),
                )
            ).alias("choices")
        )
    )
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") == "user", blocks).otherwise(choice).alias("response")
    )


@query
def tool_calls(spark, sf):
    calls = responses.saved_payloads(responses.tool_calls(_responses(spark, sf), "response"))
    return calls.select("conv_id", "turn", "stop_reason", "id", "name", "payload")


@query
def response_stops(spark, sf):
    return responses.response_calls(_responses(spark, sf), "response").select(
        "conv_id", "turn", "stop_reason", F.size("calls").cast("bigint").alias("n_calls")
    )


@query
def saved_rankings(spark, sf):
    """Payloads saved by calls in stored responses, ranked."""
    call = F.struct(
        F.lit("tool_use").alias("type"),
        F.col("c_custkey").cast("string").alias("id"),
        F.lit(fixed.SAVE_CALL).alias("name"),
        F.struct(F.col("payload").alias(fixed.SAVE_FIELD)).alias("input"),
    )
    stored = _payloads(spark, sf).select(
        "c_custkey",
        F.to_json(
            F.struct(F.lit("tool_use").alias("stop_reason"), F.array(call).alias("content"))
        ).alias("response"),
    )
    parsed = jobs.saved_rankings(stored, "response").select(
        "c_custkey", F.from_json("document", DOCUMENT).alias("d")
    )
    return parsed.select(
        "c_custkey", "d.source", "d.total", F.explode_outer("d.top_cards").alias("c")
    ).select("c_custkey", "source", "total", "c.name", "c.score", "c.rank")
