"""A stored topic as a stream with the topic's own offsets.

A topic kept as files (an archive, or a recorded test topic) is read as a stream whose
position is ``{topic: {partition: offset}}``, the form a live topic has: batches have offset
ranges, a batch may be bounded by offsets, a new query may start at given offsets, and a
range may hold no row (a topic whose old messages were removed keeps their offsets).

Layout: ``segments/topic=T/partition=P/segment=S`` (Parquet, Kafka's row columns; segment
``S`` holds offsets from ``S * segment_size`` on), and ``index/N.json``, one file an append,
with the end offset of every topic partition. An append is visible when its index file is.

    spark.dataSource.register(TopicStore)
    spark.readStream.format("topic_store").option("path", folder).load()

Options: ``path``, ``startingOffsets`` (``earliest`` or JSON as for a topic),
``maxOffsetsPerTrigger``, ``offsetsPerTask``. Tasks read the segments they need through
pyarrow, a range of offsets each, so a hot partition is split.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from playtally.session import share_package, write_text
from playtally.sources.kafka import KAFKA_ROW_SCHEMA

SEGMENT_SIZE = 100_000
OFFSETS_PER_TASK = 100_000
Offsets = dict[str, dict[str, int]]


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """A folder's file system and its path there (Hadoop writes local ones as ``file:/...``)."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:"):]
    return pafs.FileSystem.from_uri(path)


def append(spark: SparkSession, kafka_rows: DataFrame, path: str, number: int, ends: Offsets | None = None,
           segment_size: int = SEGMENT_SIZE) -> None:
    """Add rows (``KAFKA_ROW_SCHEMA``) as append ``number`` of a stored topic; the same number again
    replaces nothing and must not be used. ``ends``: end offsets where they go beyond the rows'."""
    root = path.rstrip("/")
    rows = kafka_rows.withColumn("segment", F.floor(F.col("offset") / segment_size).cast("bigint"))
    rows.write.mode("append").partitionBy("topic", "partition", "segment").parquet(f"{root}/segments")
    found: Offsets = {}
    # One row a topic partition.
    for r in kafka_rows.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("until")).collect():
        found.setdefault(r["topic"], {})[str(r["partition"])] = r["until"]
    for topic, partitions in (ends or {}).items():
        for p, until in partitions.items():
            held = found.setdefault(topic, {})
            held[p] = max(until, held.get(p, 0))
    write_text(spark, f"{root}/index/{number:012d}.json", json.dumps({"ends": found, "segment_size": segment_size}))


class _Range(InputPartition):
    def __init__(self, topic: str, partition: str, start: int, until: int):
        self.topic, self.partition, self.start, self.until = topic, partition, start, until


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        start = options.get("startingoffsets", "earliest")
        self.start: Offsets = {} if start == "earliest" else json.loads(start)
        self.most = int(options.get("maxoffsetspertrigger", 0))
        self.per_task = int(options.get("offsetspertask", OFFSETS_PER_TASK))
        self.given: Offsets | None = None

    def _index(self) -> tuple[Offsets, int]:
        """End offsets over all appends, and the segment size."""
        fs, root = open_folder(self.path)
        ends: Offsets = {}
        size = SEGMENT_SIZE
        for info in sorted(fs.get_file_info(pafs.FileSelector(f"{root}/index", allow_not_found=True)), key=lambda i: i.path):
            if not info.path.endswith(".json"):
                continue
            entry = json.loads(fs.open_input_stream(info.path).readall())
            size = entry["segment_size"]
            for topic, partitions in entry["ends"].items():
                for p, until in partitions.items():
                    held = ends.setdefault(topic, {})
                    held[p] = max(until, held.get(p, 0))
        return ends, size

    def initialOffset(self) -> dict:
        return self.start

    def latestOffset(self) -> dict:
        ends, _ = self._index()
        if not self.most:
            return ends
        # Each batch goes at most ``most`` offsets on, shared among the partitions that have more.
        at = self.given if self.given is not None else self.start
        left = {(t, p): until - at.get(t, {}).get(p, 0) for t, ps in ends.items() for p, until in ps.items()}
        total = sum(v for v in left.values() if v > 0)
        out: Offsets = {}
        for (t, p), n in left.items():
            step = n if total <= self.most else min(n, max(1, n * self.most // total))
            out.setdefault(t, {})[p] = at.get(t, {}).get(p, 0) + max(step, 0)
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.given = end
        out: list[InputPartition] = []
        for topic, ps in sorted(end.items()):
            for p, until in sorted(ps.items()):
                low = start.get(topic, {}).get(p, 0)
                out.extend(_Range(topic, p, at, min(at + self.per_task, until)) for at in range(low, until, self.per_task))
        return out

    def read(self, part: InputPartition) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(self.path)
        _, size = self._index()
        folder = f"{root}/segments/topic={part.topic}/partition={part.partition}"
        files = []
        for s in range(part.start // size, (part.until - 1) // size + 1):
            found = fs.get_file_info(pafs.FileSelector(f"{folder}/segment={s}", allow_not_found=True))
            files += [i.path for i in found if i.path.endswith(".parquet")]
        if not files:
            return
        table = ds.dataset(files, filesystem=fs, format="parquet")
        wanted = (ds.field("offset") >= part.start) & (ds.field("offset") < part.until)
        for batch in table.to_batches(columns=["key", "value", "offset", "timestamp", "timestampType"], filter=wanted):
            n = len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["value"], pa.array([part.topic] * n, pa.string()),
                 pa.array([int(part.partition)] * n, pa.int32()), batch["offset"],
                 batch["timestamp"].cast(pa.timestamp("us", "UTC")), batch["timestampType"]],
                names=[c.split()[0] for c in KAFKA_ROW_SCHEMA.split(", ")])

    def commit(self, end: dict) -> None:
        pass


class TopicStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_store"

    def schema(self) -> str:
        return KAFKA_ROW_SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_topic_store(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Kafka rows of a stored topic, as a stream."""
    share_package(spark)
    spark.dataSource.register(TopicStore)
    return spark.readStream.format("topic_store").options(path=path, **options).load()
