"""Threshold notices: one notice per target, the first time its total passes the limit.

The notice flag is never cleared, so a total that falls back and rises again
does not produce a second notice. In batch form "first batch over the limit"
is a ``min(struct(batch_id, view_count))`` aggregate per target: a hash
aggregate with a partial step, no window and no per-target row buffer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.functions.keys import notice_key, notice_value

# The notice limit of the reference job (strictly greater than)
# and the queue its notices go to.
DEFAULT_LIMIT = 10
NOTICE_QUEUE = "mq.message"


def over_threshold(running: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Rows whose running total is strictly above ``limit``."""
    return running.filter(F.col("view_count") > F.lit(limit))


def threshold_notices(running: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """``batch_id, target_id, notice_key, view_count`` of each target's first crossing."""
    first = (over_threshold(running, limit)
             .groupBy("target_id")
             .agg(F.min(F.struct("batch_id", "view_count")).alias("_first")))
    return first.select(F.col("_first.batch_id").alias("batch_id"), "target_id",
                        notice_key().alias("notice_key"),
                        F.col("_first.view_count").alias("view_count"))


def unnotified(totals: DataFrame, notices: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Targets over ``limit`` in ``totals`` that have no notice yet (left anti join).

    ``notices`` must hold only notices of earlier batches, so that replaying a
    batch does not suppress its own notices. The join strategy is left to
    Spark/AQE: the notice table grows with notified targets.
    """
    return (over_threshold(totals, limit)
            .join(notices.select("target_id"), "target_id", "left_anti")
            .select("target_id", "view_count"))


def notice_payload(notices: DataFrame) -> DataFrame:
    """``target_id, value``: the message sent for each notice (JSON ``{"targetId": n}``)."""
    return notices.select("target_id", notice_value().alias("value"))


def notice_sink_rows(notices: DataFrame, topic: str = NOTICE_QUEUE) -> DataFrame:
    """Notices as Kafka sink rows: ``key`` = notice key, ``value`` = notice body, ``topic``."""
    return notices.select(F.col("notice_key").alias("key"), notice_value().alias("value"),
                          F.lit(topic).alias("topic"))
