"""Offset ledger, committed positions, resume positions and scans from them.

A ledger row records the half-open offset range ``[from_offset,
until_offset)`` of one topic partition in one batch; an empty batch writes no
row. Positions (one row per topic partition) are tiny and bounded by the
topic's partition count, so Spark broadcasts them in joins by their stored size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.plans.broadcast import stored_side

TP = ["topic", "partition"]


def topic_partitions(messages: DataFrame) -> DataFrame:
    return messages.select(*TP).distinct()


def offset_ledger(messages: DataFrame) -> DataFrame:
    """``batch_id, topic, partition, from_offset, until_offset`` per batch and partition."""
    return (messages.groupBy("batch_id", *TP)
            .agg(F.min("offset").alias("from_offset"),
                 (F.max("offset") + 1).alias("until_offset")))


def batch_ledger(messages: DataFrame, batch_id: int) -> DataFrame:
    """Ledger rows of one micro-batch (inside ``foreachBatch``)."""
    return offset_ledger(messages.withColumn("batch_id", F.lit(batch_id).cast("bigint")))


def committed_offsets(ledger: DataFrame) -> DataFrame:
    """``topic, partition, until_offset``: the committed position of each partition."""
    return ledger.groupBy(*TP).agg(F.max("until_offset").alias("until_offset"))


def resume_offsets(partitions: DataFrame, committed: DataFrame) -> DataFrame:
    """``topic, partition, from_offset``: committed position, or 0 on first use."""
    return (partitions.join(committed, TP, "left")
            .select(*TP, F.coalesce(F.col("until_offset"), F.lit(0).cast("bigint")).alias("from_offset")))


def scan_from_offsets(messages: DataFrame, positions: DataFrame) -> DataFrame:
    """Messages at or after the start position of their partition.

    The position table is stored, so Spark broadcasts it by its known size and the
    message side is not shuffled (a partition holding a third of all
    messages costs nothing extra); a side above Spark's threshold is shuffled.
    """
    pos = stored_side(positions.select(*TP, "from_offset"))
    return (messages.join(pos, TP)
            .filter(F.col("offset") >= F.col("from_offset"))
            .drop("from_offset"))


def starting_offsets_json(positions: DataFrame) -> DataFrame:
    """One row, one column ``starting_offsets``: ``{"topic":{"0":n,...}}`` for Kafka's
    ``startingOffsets`` option.

    The option is a single string, so the last step is one group; its input
    is one row per topic partition (bounded by the topics' partition counts,
    not by data volume).
    """
    per_topic = (positions.groupBy("topic")
                 .agg(F.map_from_entries(F.collect_list(
                     F.struct(F.col("partition").cast("string"), F.col("from_offset")))).alias("p")))
    return per_topic.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("topic", "p")))).alias("starting_offsets"))
