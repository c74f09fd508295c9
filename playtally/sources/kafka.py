"""Kafka source and sink adapters.

The counting job reads the message value only (key and metadata dropped) and
keeps ``topic, partition, offset`` for the offset ledger. The same adapter
accepts any DataFrame with Kafka's row shape, batch or streaming, so stored
Kafka-shaped rows replay through exactly the code a live topic uses.

This image has no Kafka connector jar: ``format("kafka")`` cannot be
resolved here, so only the options and the row adapters are tested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the reference job: topic and consumer group.
DEFAULT_TOPIC = "dmp"
DEFAULT_GROUP = "group-dmp"

KAFKA_ROW_SCHEMA = ("key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
                    "timestamp TIMESTAMP, timestampType INT")


def kafka_options(bootstrap_servers: str, topics: str | list[str] = DEFAULT_TOPIC,
                  starting_offsets: str | None = None, group_id: str | None = None,
                  max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None,
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")``.

    ``starting_offsets`` is ``"earliest"``, ``"latest"`` or the JSON made by
    :func:`playtally.operators.offsets.starting_offsets_json` (resume from a
    ledger). ``max_offsets_per_trigger`` bounds each micro-batch;
    ``min_partitions`` splits large topic partitions over more tasks.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": starting_offsets or "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    return opts


def read_kafka(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load()


def kafka_messages(kafka_rows: DataFrame) -> DataFrame:
    """Kafka rows -> ``topic, partition, offset, line`` (value as UTF-8 text, key dropped)."""
    return kafka_rows.select("topic", "partition", "offset",
                             F.col("value").cast("string").alias("line"))


def as_kafka_rows(messages: DataFrame, ts_col: str | None = None) -> DataFrame:
    """Message table -> Kafka's row shape (for replaying stored messages as a topic)."""
    ts = F.col(ts_col).cast("timestamp") if ts_col else F.lit(None).cast("timestamp")
    return messages.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("line").cast("binary").alias("value"),
        "topic", "partition", "offset",
        ts.alias("timestamp"),
        F.lit(0).alias("timestampType"))


def kafka_sink_rows(df: DataFrame, value: str = "value", topic: str | None = None,
                    partition: int | None = None) -> DataFrame:
    """Rows for ``write[Stream].format("kafka")``: ``value`` plus optional topic/partition."""
    cols = [F.col(value).cast("string").alias("value")]
    if topic is not None:
        cols.append(F.lit(topic).alias("topic"))
    if partition is not None:
        cols.append(F.lit(partition).cast("int").alias("partition"))
    return df.select(*cols)
