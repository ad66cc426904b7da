"""Text objects under a prefix to a chunk table, as they arrive."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark import fixed
from tidemark.sources import storage
from tidemark.sources.documents import split_text, stream_files
from tidemark.sources.tables import BucketTable
from tidemark.sources.vector_table import ingest_documents

REJECT = "source_bucket string, source_key string, reason string, batch bigint"


@dataclass
class DocumentJob:
    """Where one document stream reads, writes and keeps its rejects.

    ``options`` go to :func:`ingest_documents`: sizes, dimensions, the model. The
    state folder must be shared by the cluster. The chunk table has one writer.
    """

    spark: SparkSession
    root: str
    bucket: str
    prefix: str
    table: BucketTable
    state: str
    options: dict[str, Any] = field(default_factory=dict)
    name: str = "documents"

    def rejects(self) -> DataFrame:
        """Documents that were set aside so far, with the reason and the batch."""
        folder = f"{self.state}/rejects"
        if not storage.child_names(self.spark, folder):
            return self.spark.createDataFrame([], REJECT)
        return self.spark.read.schema(REJECT).parquet(folder)

    def process(self, new: DataFrame, batch: int) -> None:
        """Take in the documents of one batch; once its rejects are written, it is not taken in again.

        The chunks come before the rejects. A batch that stopped in between runs
        again and puts the same chunks in the place of its own.
        """
        done = f"{self.state}/rejects/batch={batch}"
        if storage.exists(self.spark, f"{done}/_SUCCESS"):
            return
        # Fetched once: the documents are read for their chunks, names and rejects.
        at = storage.scratch_path(self.spark, f"{self.name}-texts")
        new.write.parquet(at)
        good, unreadable = split_text(self.spark.read.parquet(at))
        failed = ingest_documents(good, self.table, replace_document=True, **self.options).rejects
        columns = ["source_bucket", "source_key", "reason"]
        unreadable.select(columns).unionByName(failed.select(columns)).write.mode("overwrite").parquet(done)

    def start(
        self, files_per_batch: int | None = None, wait: str | None = fixed.BATCH_WAIT, max_age: str = "3650d"
    ) -> StreamingQuery:
        """Start the stream; ``wait=None`` takes what is there and stops."""
        files = stream_files(self.spark, self.root, self.bucket, self.prefix, files_per_batch, max_age)
        trigger = {"availableNow": True} if wait is None else {"processingTime": wait}
        return (
            files.writeStream.queryName(self.name)
            .option("checkpointLocation", f"{self.state}/checkpoint")
            .trigger(**trigger)
            .foreachBatch(self.process)
            .start()
        )
