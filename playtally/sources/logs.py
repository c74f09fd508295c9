"""Log-folder ingest: text lines -> message stream (or a Kafka topic).

The reference tails one growing log file into a Kafka topic with an outside
agent. Spark's file source reads *new files* in a folder, not appends to one
file, so log writers should roll files into the folder. Each text line is one
message; CR and LF are line ends and never part of a message.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playtally.sources.kafka import DEFAULT_TOPIC, kafka_sink_rows


def log_text(messages: DataFrame) -> DataFrame:
    """Message lines as log text (``value``): CR and LF removed."""
    return messages.select(F.translate(F.col("line"), "\r\n", "").alias("value"))


def read_log_lines(spark: SparkSession, folder: str, stream: bool = True,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files in ``folder`` as a ``line`` column, with the path of their ``file``."""
    if stream:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        df = reader.load(folder)
    else:
        df = spark.read.text(folder)
    return df.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))


def start_log_to_topic(lines: DataFrame, checkpoint: str, options: dict[str, str], topic: str = DEFAULT_TOPIC,
                       partition: int | None = 0, fmt: str = "kafka", trigger: dict | None = None) -> StreamingQuery:
    """Stream log lines into the topic (the reference's log agent as a Spark job). ``options`` are
    the sink's, e.g. ``kafka.bootstrap.servers``; the checkpoint makes it start where it stopped."""
    return (log_to_topic(lines, topic, partition).writeStream.format(fmt).options(**options)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def log_to_topic(lines: DataFrame, topic: str = DEFAULT_TOPIC, partition: int | None = 0) -> DataFrame:
    """Lines as Kafka sink rows; the reference sends every line to partition 0."""
    return kafka_sink_rows(lines, value="line", topic=topic, partition=partition)
