"""Sequential ranks over batches of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import offers
from tidemark.sources.storage import shared_dir

HOT_ROWS = 4_000_000


def rank_rows(
    df: DataFrame, batch: str, score: str, tie: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Adds ``rank`` (bigint): 1..n per batch, by score descending, then ``tie``.

    ``(batch, tie)`` must be unique. Batches up to ``hot_rows`` rows go through
    a window, which sorts a batch in one task. Larger ones are range-sorted over
    all tasks and numbered from the counts of the ranges before. There is one
    such batch per ``hot_rows`` rows at most, which bounds the list of them.
    """
    order = [F.col(score).desc_nulls_last(), F.col(tie)]
    sizes = df.groupBy(F.col(batch).alias("_hot")).agg(F.count("*").alias("_rows"))
    found = sizes.where(F.col("_rows") > hot_rows).select("_hot")
    hot = df.sparkSession.createDataFrame(found.collect(), found.schema)
    window = F.row_number().over(Window.partitionBy(batch).orderBy(*order)).cast("bigint")
    if hot.isEmpty():
        return df.withColumn("rank", window)
    same = F.col(batch).eqNullSafe(F.col("_hot"))
    small = df.join(F.broadcast(hot), same, "left_anti").withColumn("rank", window)
    large = df.join(F.broadcast(hot), same, "left_semi")
    return small.unionByName(_rank_by_range(large, batch, order))


def _rank_by_range(df: DataFrame, batch: str, order: list) -> DataFrame:
    spark = df.sparkSession
    shared_dir(spark)
    columns = df.columns
    # Row ids are ascending in the sorted task; the checkpoint pins them, so a
    # lost executor cannot bring other range bounds in between the two uses.
    rows = (
        df.repartitionByRange(F.col(batch), *order)
        .sortWithinPartitions(F.col(batch), *order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id())
        .checkpoint()
    )
    starts = rows.groupBy(F.col(batch).alias("_batch"), "_range").agg(
        F.min("_row").alias("_first"), F.count("*").alias("_rows")
    )
    # One row per range and hot batch: no larger than the number of tasks plus batches.
    before = Window.partitionBy("_batch").orderBy("_range")
    starts = starts.withColumn(
        "_before",
        F.sum("_rows").over(before) - F.col("_rows"),
    ).select("_batch", F.col("_range").alias("_at"), "_first", "_before")
    joined = rows.join(
        F.broadcast(starts),
        F.col(batch).eqNullSafe(F.col("_batch")) & (F.col("_range") == F.col("_at")),
    )
    rank = F.col("_row") - F.col("_first") + F.col("_before") + 1
    return joined.select(*columns, rank.alias("rank"))


def rank_payloads(df: DataFrame, payload: str) -> DataFrame:
    """One row per offer of each payload, with ``rank``, ``pos``, ``score``, ``offer``.

    A payload is one row, so its offers are ranked inside it without a shuffle.
    Payloads that hold no offers, or are not readable, give no rows.
    """
    ranked = offers.ranked_offers(offers.payload_offers(F.col(payload)))
    others = [c for c in df.columns if c != payload]
    return df.select(*others, F.inline(ranked))


def ranked_documents(
    df: DataFrame, payload: str, source: str = fixed.RANKING_SOURCE, at=None
) -> DataFrame:
    """Adds ``document``: the ranked JSON document of each payload.

    It holds ``generated_at``, ``source``, ``total`` and ``top_cards``, every
    offer with its score and rank. Unreadable payloads get null.
    """
    moment = F.to_utc_timestamp(
        F.current_timestamp() if at is None else at, F.current_timezone()
    )
    ranked = offers.ranked_offers(offers.payload_offers(F.col(payload)))

    def document(r):
        cards = F.transform(
            r, lambda o: offers.with_rank_fields(o["offer"], o["score"], o["rank"])
        )
        return F.when(r.isNotNull(), _envelope(moment, source, F.size(r), cards))

    return df.withColumn("document", offers.bind(ranked, document))


def _envelope(moment, source: str, total, cards):
    return F.concat(
        F.lit('{"generated_at":"'),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
        F.lit('","source":'),
        F.to_json(F.lit(source).cast("variant")),
        F.lit(',"total":'),
        total.cast("string"),
        F.lit(',"top_cards":['),
        F.array_join(cards, ","),
        F.lit("]}"),
    )


def ranked_batches(
    df: DataFrame, batch: str, offer: str, tie: str, n: int = 100, source: str = fixed.RANKING_SOURCE, at=None
) -> DataFrame:
    """``batch`` and ``document``: the ranked JSON document of every batch of a table of offers.

    ``offer`` holds one offer per row as VARIANT. ``total`` counts all offers of
    the batch, ``top_cards`` holds the ``n`` with the highest scores, ties by
    ``tie``. Tasks keep their own n best of each batch before anything is
    shuffled, so a batch of any size sends n rows a task, and its document is
    put together from n rows. ``n`` is a thousand at most, up to which Spark
    plans such a limit. A null batch is a batch of its own; a null offer scores
    nothing and is listed as ``{}`` with its rank.
    """
    if not 1 <= n <= 1000:
        raise ValueError(f"n must be 1 to 1000, not {n}")
    moment = F.to_utc_timestamp(
        F.current_timestamp() if at is None else at, F.current_timezone()
    )
    rows = df.select(F.col(batch).alias("_batch"), F.col(offer).alias("_offer"), F.col(tie).alias("_tie"))
    totals = rows.groupBy("_batch").agg(F.count("*").alias("_total"))
    scored = rows.withColumn("_score", offers.offer_score(F.col("_offer")))
    order = Window.partitionBy("_batch").orderBy(F.desc("_score"), "_tie")
    best = scored.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    given = F.coalesce("_offer", F.parse_json(F.lit("{}")))
    card = offers.with_rank_fields(given, F.col("_score"), F.col("_rank"))
    listed = best.groupBy("_batch").agg(F.array_sort(F.collect_list(F.struct("_rank", card.alias("card")))).alias("_cards"))
    joined = totals.alias("t").join(listed.alias("l"), F.col("t._batch").eqNullSafe(F.col("l._batch")))
    cards = F.transform("_cards", lambda c: c["card"])
    return joined.select(F.col("t._batch").alias(batch), _envelope(moment, source, F.col("_total"), cards).alias("document"))


def write_ranked_documents(df: DataFrame, payload: str, path: str, **options) -> DataFrame:
    """Write one ranked JSON document per line; gives the rows with an unreadable payload."""
    documents = ranked_documents(df, payload, **options)
    documents.where("document IS NOT NULL").select("document").write.text(path)
    return documents.where("document IS NULL").drop("document")
