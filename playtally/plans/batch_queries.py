"""Registered batch queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

All of them start from the ``events`` table of the folder (through the message
table), so their work grows with the data. Column names equal those of the
SQL oracles in :mod:`playtally.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtally.functions import decode as dec
from playtally.functions.keys import counter_key, notice_key
from playtally.operators import counts, metrics, notices, offsets
from playtally.session import materialize
from playtally.sources.kafka import as_kafka_rows, kafka_messages
from playtally.sources.messages import read_messages

# Fixed parameters of the registered queries: the notice limit (totals per
# target average ~3,300 at every scale, so about two thirds pass), and the
# resume scenario (ledger of batches before 3, partition 3 never committed).
QUERY_LIMIT = 3000
RESUME_BEFORE_BATCH = 3
RESUME_MISSING_PARTITION = 3
# Batches per block of the registered running sums: the table has six batches, so both
# levels of the sum have work.
QUERY_BLOCK = 2


def _decoded(spark: SparkSession, sf_dir: str, strip: bool = True) -> DataFrame:
    return dec.decode_messages(read_messages(spark, sf_dir), strip=strip)


def message_value(spark, sf_dir):
    """Messages as Kafka rows (key and value bytes) and back through the Kafka adapter."""
    return kafka_messages(as_kafka_rows(read_messages(spark, sf_dir))).select("topic", "partition", "offset", "line")


def topic_partitions(spark, sf_dir):
    return offsets.topic_partitions(read_messages(spark, sf_dir))


def strip_prefix(spark, sf_dir):
    return read_messages(spark, sf_dir).select("event_id", dec.strip_prefix("line").alias("body"))


def trim_control(spark, sf_dir):
    return read_messages(spark, sf_dir).select(
        "event_id", dec.trim_control(dec.strip_prefix("line")).alias("json"))


def parse_json(spark, sf_dir):
    p = dec.parse_payload(dec.payload_text("line"))
    return (read_messages(spark, sf_dir)
            .select("event_id", p.alias("p"))
            .select("event_id", F.col("p.targetId").alias("target_text"),
                    F.col("p.count").alias("count_text")))


def decode_messages(spark, sf_dir):
    return dec.accepted(_decoded(spark, sf_dir)).select("event_id", "target_id", "count")


def rejected_messages(spark, sf_dir):
    return dec.rejected(_decoded(spark, sf_dir)).select("event_id", "line")


def format_keys(spark, sf_dir):
    targets = dec.accepted(_decoded(spark, sf_dir)).select("target_id").distinct()
    return targets.select("target_id", counter_key().alias("counter_key"),
                          notice_key().alias("notice_key"))


def batch_counts(spark, sf_dir):
    return counts.batch_counts(_decoded(spark, sf_dir))


def batch_counts_nostrip(spark, sf_dir):
    return counts.batch_counts(_decoded(spark, sf_dir, strip=False))


def _stored_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch sums written once: the running sum reads them at two levels."""
    return materialize(counts.batch_counts(_decoded(spark, sf_dir)), "deltas")


def running_counts(spark, sf_dir):
    return counts.running_counts(_stored_deltas(spark, sf_dir), block=QUERY_BLOCK)


def total_counts(spark, sf_dir):
    return counts.total_counts(_decoded(spark, sf_dir))


def over_threshold(spark, sf_dir):
    return notices.over_threshold(running_counts(spark, sf_dir), QUERY_LIMIT)


def threshold_notices(spark, sf_dir):
    return notices.threshold_notices(running_counts(spark, sf_dir), QUERY_LIMIT)


def unnotified(spark, sf_dir):
    """Targets to notify in the last batch: over the limit there, no earlier notice."""
    # Stored once, read on both sides of the anti join; its largest batch id is one scalar.
    running = materialize(running_counts(spark, sf_dir), "running")
    last = running.agg(F.max("batch_id")).first()[0]
    earlier = notices.threshold_notices(running.filter(F.col("batch_id") < last), QUERY_LIMIT)
    return notices.unnotified(running.filter(F.col("batch_id") == last), earlier, QUERY_LIMIT)


def notice_payload(spark, sf_dir):
    return notices.notice_payload(threshold_notices(spark, sf_dir))


def offset_ledger(spark, sf_dir):
    return offsets.offset_ledger(read_messages(spark, sf_dir))


def committed_offsets(spark, sf_dir):
    return offsets.committed_offsets(offset_ledger(spark, sf_dir))


def resume_offsets(spark, sf_dir):
    """Positions from a stored ledger (as the job keeps it): every partition of
    the ledger, at its committed offset before batch 3, partition 3 never committed."""
    ledger = materialize(offset_ledger(spark, sf_dir), "ledger")
    committed = offsets.committed_offsets(
        ledger.filter((F.col("batch_id") < RESUME_BEFORE_BATCH)
                      & (F.col("partition") != RESUME_MISSING_PARTITION)))
    return offsets.resume_offsets(offsets.topic_partitions(ledger), committed)


def scan_from_offsets(spark, sf_dir):
    positions = resume_offsets(spark, sf_dir)
    return (offsets.scan_from_offsets(read_messages(spark, sf_dir), positions)
            .select("event_id", "partition", "offset"))


def batch_metrics(spark, sf_dir):
    return metrics.batch_metrics(_decoded(spark, sf_dir))


BATCH_QUERIES = {
    "message_value": message_value,
    "topic_partitions": topic_partitions,
    "strip_prefix": strip_prefix,
    "trim_control": trim_control,
    "parse_json": parse_json,
    "decode_messages": decode_messages,
    "rejected_messages": rejected_messages,
    "format_keys": format_keys,
    "batch_counts": batch_counts,
    "batch_counts_nostrip": batch_counts_nostrip,
    "running_counts": running_counts,
    "total_counts": total_counts,
    "over_threshold": over_threshold,
    "threshold_notices": threshold_notices,
    "unnotified": unnotified,
    "notice_payload": notice_payload,
    "offset_ledger": offset_ledger,
    "committed_offsets": committed_offsets,
    "resume_offsets": resume_offsets,
    "scan_from_offsets": scan_from_offsets,
    "batch_metrics": batch_metrics,
}
