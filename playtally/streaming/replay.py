"""Replay a stored table as a stream, one stored batch per micro-batch.

The table is written once, partitioned by its batch column (one distributed
write). Then, for each batch in order, that batch's partition is appended to
an inbox folder (partition pruning reads only it) and the streaming query is
started with ``availableNow``: it processes exactly the new files as one
micro-batch and stops. Every start resumes from the query's checkpoint, so
the replay also exercises restart-from-committed-offsets. Stream batch ``i``
then holds stored batch number ``i`` (when stored batch ids are 0..n-1).

The driver loops over batch *ids* only (bounded by the number of batches);
rows never pass through it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playtally.session import partition_values

# A Parquet file of one row group is read by one task: files of this many rows, so that a large
# batch is decoded by all of them.
ROWS_PER_FILE = 100_000


class StagedReplay:
    def __init__(self, spark: SparkSession, table: DataFrame, root: str,
                 batch_col: str = "batch_id", fmt: str = "parquet",
                 to_files: Callable[[DataFrame], DataFrame] | None = None,
                 rows_per_file: int = ROWS_PER_FILE):
        self.spark = spark
        self.root = root.rstrip("/")
        self.source = f"{self.root}/source"
        self.inbox = f"{self.root}/inbox"
        self.batch_col = batch_col
        self.fmt = fmt
        self.rows_per_file = rows_per_file
        self.to_files = to_files or (lambda df: df)
        (table.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file)
         .partitionBy(batch_col).parquet(self.source))
        self._stored_schema = spark.read.parquet(self.source).schema   # inferred once
        self._schema = self.to_files(self._stored()).schema

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self._stored_schema).parquet(self.source)

    def batch_ids(self) -> list[int]:
        """Stored batch ids, from the partition folder names (no Spark job)."""
        return partition_values(self.spark, self.source, self.batch_col)

    def batch(self, batch_id: int) -> DataFrame:
        """Rows of one stored batch, in the shape the stream reads."""
        return self.to_files(self._stored().where(F.col(self.batch_col) == F.lit(batch_id)))

    def release(self, batch_id: int) -> None:
        (self.batch(batch_id).write.mode("append").option("maxRecordsPerFile", self.rows_per_file)
         .format(self.fmt).save(self.inbox))

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self._schema).format(self.fmt).load(self.inbox)

    def run(self, start: Callable[[DataFrame], StreamingQuery]) -> list[int]:
        """Release each batch and run ``start(stream)`` to completion; returns the ids."""
        ids = self.batch_ids()
        for b in ids:
            self.release(b)
            query = start(self.stream())
            query.awaitTermination()
        return ids
