"""A stream sink with a commit protocol: each row is delivered once.

A task writes its rows to one file of its own under ``data/`` and reports its name. When all
tasks of a micro-batch have, the driver commits them by one file ``commits/N.json`` that
lists the data files; readers take the listed files only. So a task that fails and runs
again, or runs twice, leaves at most a file that no commit names; a micro-batch that fails
has its files removed; and a micro-batch that runs again after its commit changes nothing.

    start_delivery(rows, folder, checkpoint)
    read_delivered(spark, folder, schema)

Files are written through pyarrow, in the folder that driver and tasks share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from playtally.session import share_package
from playtally.sources.topic_store import open_folder
from playtally.streaming.job import DEFAULT_TRIGGER, refuse_lost_checkpoint


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]
    rows: int


class CommittedWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = open_folder(self.path)
        name, writer, rows = f"{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if not len(batch):
                    continue
                if writer is None:   # a task without rows writes no file
                    fs.create_dir(f"{root}/data")
                    writer = pq.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=fs)
                writer.write_batch(batch)
                rows += len(batch)
        finally:
            if writer is not None:
                writer.close()
        return _Written([name] if rows else [], rows)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        fs, root = open_folder(self.path)
        target = f"{root}/commits/{batchId:012d}.json"
        if fs.get_file_info(target).type != pafs.FileType.NotFound:
            self.abort(messages, batchId)   # the batch ran again after its commit
            return
        fs.create_dir(f"{root}/commits")
        done = [m for m in messages if m is not None]
        aside = f"{root}/commits/.{uuid.uuid4().hex}"
        with fs.open_output_stream(aside) as out:
            out.write(json.dumps({"files": [f for m in done for f in m.files], "rows": sum(m.rows for m in done)}).encode())
        fs.move(aside, target)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        fs, root = open_folder(self.path)
        for message in messages:
            for name in message.files if message is not None else []:
                fs.delete_file(f"{root}/data/{name}")


class CommittedSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_files"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return CommittedWriter(self.options["path"])


def start_delivery(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                   sink: type[DataSource] = CommittedSink) -> StreamingQuery:
    """Deliver a stream's rows to ``path``."""
    spark = rows.sparkSession
    # A new checkpoint would number its micro-batches from 0 again, which are committed.
    refuse_lost_checkpoint(spark, f"{path.rstrip('/')}/commits", checkpoint)
    share_package(spark)
    spark.dataSource.register(sink)
    return (rows.writeStream.format(sink.name()).option("path", path).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER)).start())


def delivered_files(path: str) -> list[str]:
    """The data files that commits name."""
    fs, root = open_folder(path.rstrip("/"))
    names = []
    for info in sorted(fs.get_file_info(pafs.FileSelector(f"{root}/commits", allow_not_found=True)), key=lambda i: i.path):
        if info.path.endswith(".json"):
            names += json.loads(fs.open_input_stream(info.path).readall())["files"]
    return [f"{path.rstrip('/')}/data/{name}" for name in names]


def read_delivered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The delivered rows."""
    files = delivered_files(path)
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
