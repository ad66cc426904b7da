"""Documents to a training mix: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, mixing, secrets, simhash, toxicity
from tidemark.sources.storage import scratch_path, shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# The kept texts are rewritten by some stages, so SQL has no twin: see tests/llm.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below the threshold stay as they are."""
    held = langid.folds("doc_id", 2, 4)
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), train_rows=~held)
    return toxicity.reject(docs.select(*COLUMNS), model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays; of repeated rows, one."""
    docs = docs.select(*COLUMNS)
    found = simhash.near_duplicates(docs, shingle=3, distance=2)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(kept.hint("merge"), "doc_id", "left_semi")
    named = named.withColumn("_tag", F.xxhash64("text")).dropDuplicates(["doc_id", "_tag"])
    named = named.select(*COLUMNS)
    nameless = docs.where("doc_id IS NULL")
    if nameless.isEmpty():
        return named
    return named.unionByName(_without_ids(spark, docs, nameless))


def _without_ids(spark: SparkSession, docs: DataFrame, nameless: DataFrame) -> DataFrame:
    """Rows without an id stay if no row with one is near, one for each group of them."""
    tagged = nameless.withColumn("_tag", F.sha2(F.coalesce("text", F.lit("")), 256)).dropDuplicates(["_tag"])
    base = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)).alias("m")).first()["m"]
    # Stand-in ids past all others put every named row first; they are pinned before they are read twice.
    at = scratch_path(spark, "nameless")
    tagged.withColumn("_id", F.monotonically_increasing_id() + F.lit(base + 1)).write.parquet(at)
    pinned = spark.read.parquet(at)
    both = docs.where("doc_id IS NOT NULL").select("doc_id", "text").unionByName(
        pinned.select(F.col("_id").alias("doc_id"), "text")
    )
    kept = simhash.near_duplicates(both, shingle=3, distance=2)
    kept = kept.where((F.col("doc_id") == F.col("component_id")) & (F.col("doc_id") > base))
    kept = kept.select(F.col("doc_id").alias("_id"))
    return pinned.join(kept.hint("merge"), "_id", "left_semi").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no window with the benchmark stay as they are."""
    return decontaminate.clean(docs.select(*COLUMNS), _table(spark, sf_dir, "benchmark"))


def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay; secrets in their texts are replaced by a mark, and n_chars follows."""
    return secrets.redact(docs.select(*COLUMNS), length_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the mix takes, with how many copies and words of each."""
    return mixing.mixed(docs.select(*COLUMNS)).where("copies > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", cut_secrets),
    ("source_mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the Parquet output of the one before, in the session's shared folder."""
    shared_dir(spark)
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        at = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
