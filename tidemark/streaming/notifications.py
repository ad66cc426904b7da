"""Upload notifications to table upserts, as a stream of micro-batches.

Each line of an event file holds ``{"Records": [{"messageId", "body"}, ...]}``. A
message names uploaded JSON files; all of their records go into the table by
key, or the message fails as a whole and the others go on. Outcomes say which
failed and why; delivering those again is the queue's business.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import fixed
from tidemark.operators import notifications, upsert
from tidemark.operators.keyed_join import fits_broadcast
from tidemark.operators.ranking import rank_rows
from tidemark.sources import storage
from tidemark.sources.json_records import parse_records
from tidemark.sources.objects import object_blocks
from tidemark.sources.tables import BucketTable

OUTCOME = "message_id string, body string, status string, reason string, batch bigint, part bigint"
PLACE = ("file", "block", "line", "position")


@dataclass
class NotificationJob:
    """Where one notification stream reads, writes and keeps its outcomes.

    ``object_root`` is put before ``/bucket/key`` to find a file; the state
    folder must be shared by the cluster.
    """

    spark: SparkSession
    events: str
    table: BucketTable
    key: str
    state: str
    object_root: str
    prefix: str = fixed.DATA_PREFIX
    name: str = "notifications"

    def outcomes(self) -> DataFrame:
        """Every delivery so far: message, body, status, reason, batch of files and part of it."""
        folder = f"{self.state}/outcomes"
        done = [b for b in storage.child_names(self.spark, folder) if storage.child_names(self.spark, f"{folder}/{b}")]
        if not done:
            return self.spark.createDataFrame([], OUTCOME)
        return self.spark.read.schema(OUTCOME).parquet(folder)

    def failures(self) -> DataFrame:
        """``(itemIdentifier, reason)`` of every failed delivery; a bad event has no identifier."""
        return self.outcomes().where("status = 'failed'").select(
            F.col("message_id").alias("itemIdentifier"), "reason"
        )

    def _path(self, bucket: Column, key: Column) -> Column:
        root = storage.qualified(self.spark, self.object_root).rstrip("/")
        return F.concat(F.lit(f"{root}/"), bucket, F.lit("/"), key)

    def process(self, new: DataFrame, batch: int, messages: int | None = None) -> None:
        """Run the messages of some event files, ``messages`` at a time, in the order of their places.

        The numbered messages are kept until all parts have their outcomes, so a
        batch that stopped goes on with the first part that has none, in the
        middle of a file if need be. That part may run again: the same rows
        replace themselves by key, while rows without a key are appended once
        more, as at-least-once delivery has it. Messages are told apart by their
        place; equal or missing identifiers do not matter.
        """
        outcomes, kept = (f"{self.state}/{n}/batch={batch}" for n in ("outcomes", "messages"))
        if storage.exists(self.spark, f"{outcomes}/_done"):
            return
        if not storage.exists(self.spark, f"{kept}/_SUCCESS"):
            # Pinned: places hold line numbers that must not change between uses.
            at = storage.scratch_path(self.spark, f"{self.name}-messages")
            read = notifications.message_refs(new, "body", self.prefix)
            read.withColumn("place", F.struct(*PLACE)).drop(*PLACE).write.parquet(at)
            read = self.spark.read.parquet(at).withColumns({"all": F.lit(0), "score": F.lit(0)})
            part = F.lit(0).cast("bigint")
            if messages and read.count() > messages:
                read = rank_rows(read, "all", "score", "place", hot_rows=0)
                part = F.floor((F.col("rank") - 1) / messages)
            read.withColumn("part", part).drop("all", "score", "rank").write.mode("overwrite").partitionBy(
                "part"
            ).parquet(kept)
        names = storage.child_names(self.spark, kept)
        for part in sorted(int(n.split("=")[1]) for n in names if n.startswith("part=")):
            done = f"{outcomes}/part={part}"
            if not storage.exists(self.spark, f"{done}/_SUCCESS"):
                self._part(self.spark.read.parquet(f"{kept}/part={part}"), done)
        storage.write_over(self.spark, f"{outcomes}/_done", "")
        storage.remove_tree(self.spark, kept)

    def _part(self, read: DataFrame, done: str) -> None:
        """One bounded batch of messages: objects, table, outcomes."""
        refs = read.where("NOT bad_event").select("*", F.posexplode("refs").alias("ref", "_r")).select(
            "place",
            F.struct("place", "ref").alias("ordinal"),
            self._path(F.col("_r.bucket"), F.col("_r.key")).alias("path"),
        )
        text = F.col("content").cast("string")
        records = parse_records(F.when(F.is_valid_utf8(text), text), self.table.schema())
        # Opened and parsed once; what became of each object goes with its records.
        state = F.when(F.coalesce(F.length("content"), F.lit(0)) == 0, "missing or empty file").when(
            F.col("records").isNull(), "bad file"
        )
        at = storage.scratch_path(self.spark, f"{self.name}-objects")
        shape = f"path string, records array<{self.table.schema().simpleString()}>, state string"
        self.spark.createDataFrame([], shape).write.parquet(at)
        for objects in object_blocks(refs.select("path")):
            objects.withColumn("records", records).select(
                "path", "records", F.coalesce(state, F.lit("")).alias("state")
            ).write.mode("append").parquet(at)
        files = self.spark.read.schema(shape).parquet(at)
        at = storage.scratch_path(self.spark, f"{self.name}-status")
        self._status(read, refs, files).write.parquet(at)
        status = self.spark.read.parquet(at)
        self.table.replace(self._rows(refs, status, files), self.key)
        status.drop("place").write.mode("overwrite").parquet(done)

    def _status(self, read: DataFrame, refs: DataFrame, files: DataFrame) -> DataFrame:
        """Outcome of every message: it fails when any of its files does."""
        per_message = (
            refs.join(files.select("path", "state"), "path", "left")
            .groupBy("place")
            .agg(F.max("state").alias("_reason"))
        )
        reason = (
            F.when(F.col("bad_event"), "bad event")
            .when(F.col("message_id").isNull(), "no message id")
            .when(~F.col("readable"), "bad message")
            .otherwise(F.coalesce(F.col("_reason"), F.lit("")))
        )
        return (
            read.join(per_message, "place", "left")
            .withColumn("reason", reason)
            .select(
                "place",
                "message_id",
                "body",
                F.when(F.col("reason") == "", "ok").otherwise("failed").alias("status"),
                "reason",
            )
        )

    def _rows(self, refs: DataFrame, status: DataFrame, files: DataFrame) -> DataFrame:
        """Records of the good messages; per key, those of the last file."""
        good = status.where("status = 'ok'").select("place")
        wanted = refs.join(good, "place", "left_semi").select("path", "ordinal")
        # Joined to the references, the contents of the files stay in place.
        if fits_broadcast(wanted):
            wanted = F.broadcast(wanted)
        rows = files.join(wanted, "path").select(
            F.col("ordinal").alias("_ordinal"), F.inline("records")
        )
        return upsert.rows_of_last(rows, self.key, "_ordinal").drop("_ordinal")

    def start(
        self,
        files_per_batch: int = fixed.MAX_MESSAGES,
        wait: str | None = fixed.BATCH_WAIT,
        messages_per_batch: int | None = fixed.MAX_MESSAGES,
    ) -> StreamingQuery:
        """Start the stream; ``wait=None`` takes what is there and stops.

        A trigger reads so many event files at most. Their messages go into the
        table ``messages_per_batch`` at a time, in order, however many a file
        holds; None takes all of a trigger's at once.
        """

        def batch(events: DataFrame, batch_id: int) -> None:
            # The line number grows within a block of a file, which one task reads.
            lines = events.withColumn("line", F.monotonically_increasing_id())
            self.process(notifications.event_messages(lines, "event"), batch_id, messages_per_batch)

        events = (
            self.spark.readStream.format("text")
            .option("maxFilesPerTrigger", files_per_batch)
            .load(self.events)
            .select(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.col("value").alias("event"),
            )
        )
        trigger = {"availableNow": True} if wait is None else {"processingTime": wait}
        return (
            events.writeStream.queryName(self.name)
            .option("checkpointLocation", f"{self.state}/checkpoint")
            .trigger(**trigger)
            .foreachBatch(batch)
            .start()
        )
