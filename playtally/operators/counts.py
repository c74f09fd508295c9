"""Keyed sums: per micro-batch, running across batches, and all-time totals.

Every sum is a hash aggregate with a map-side partial step, so a target that
holds a third of all messages is collapsed to one row per input partition
before the shuffle; no raw-message group is ever gathered into one task.
Sums are BIGINT (the reference adds 32-bit ints and wraps; we do not).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtally.functions.decode import accepted
from playtally.functions.keys import counter_key

# Batches per block of the two-level running sum (see running_counts).
RUNNING_BLOCK = 1024


def batch_counts(decoded: DataFrame) -> DataFrame:
    """``batch_id, target_id, batch_count``: the per-batch keyed sum."""
    return (accepted(decoded)
            .groupBy("batch_id", "target_id")
            .agg(F.sum("count").cast("bigint").alias("batch_count")))


def total_counts(decoded: DataFrame) -> DataFrame:
    """``target_id, counter_key, view_count``: all-time total per target."""
    return (accepted(decoded)
            .groupBy("target_id")
            .agg(F.sum("count").cast("bigint").alias("view_count"))
            .select("target_id", counter_key().alias("counter_key"), "view_count"))


def totals_from_deltas(deltas: DataFrame) -> DataFrame:
    """Counter table from per-batch deltas (the durable form of the counters)."""
    return (deltas.groupBy("target_id")
            .agg(F.sum("batch_count").cast("bigint").alias("view_count"))
            .select("target_id", counter_key().alias("counter_key"), "view_count"))


def running_counts(deltas: DataFrame, block: int = RUNNING_BLOCK) -> DataFrame:
    """``batch_id, target_id, view_count``: new total of each target after each batch.

    ``deltas`` has one row per ``(batch_id, target_id)``. A plain window over
    ``partitionBy(target_id)`` would put every batch of a hot target in one
    task, and batches grow without bound on a long-lived stream. The sum is
    therefore taken in two levels: a running sum inside blocks of ``block``
    batches (at most ``block`` rows per window group), plus the sum of all
    earlier blocks of the same target (a window over per-block totals, i.e.
    ``block`` times fewer rows), joined back on ``(target_id, block)``.

    ``deltas`` is read by both levels, so pass a stored table (see
    :func:`playtally.session.materialize`) rather than a plan over raw
    messages, or the messages are scanned and decoded twice.
    """
    d = deltas.withColumn("_blk", F.expr(f"batch_id div {int(block)}"))
    in_block = (Window.partitionBy("target_id", "_blk").orderBy("batch_id")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = d.withColumn("_within", F.sum("batch_count").over(in_block))
    earlier_blocks = (Window.partitionBy("target_id").orderBy("_blk")
                      .rowsBetween(Window.unboundedPreceding, -1))
    before = (d.groupBy("target_id", "_blk")
              .agg(F.sum("batch_count").alias("_blk_total"))
              .withColumn("_before", F.coalesce(F.sum("_blk_total").over(earlier_blocks), F.lit(0)))
              .select("target_id", "_blk", "_before"))
    return (within.join(before, ["target_id", "_blk"])
            .select("batch_id", "target_id",
                    (F.col("_within") + F.col("_before")).cast("bigint").alias("view_count")))
