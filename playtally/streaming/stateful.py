"""Pure-state forms: running totals and notices kept in Spark's state store.

``running_totals`` is a streaming ``groupBy(target_id).sum`` in update mode:
each micro-batch emits exactly the targets it touched, with their new
totals (the counter increment's return value). State holds one entry per
target for ever, as the reference's counters never expire; sessions built by
:func:`playtally.build_session` keep it in RocksDB.

Notices need total and flag of a target together. One stateful operator
(:func:`threshold_state`) keeps both; what it takes in is summed before it, so a
hot target costs it one row a batch. It runs on a decoded stream
(:func:`start_threshold_notices`) or on the sums that a job has written
(:func:`start_delta_notices`).
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from playtally.functions.decode import accepted
from playtally.functions.keys import notice_key
from playtally.operators.notices import DEFAULT_LIMIT
from playtally.session import make_folder, share_package
from playtally.streaming.job import DEFAULT_TRIGGER, refuse_lost_checkpoint

TOTALS_SCHEMA = "target_id BIGINT, view_count BIGINT, batch_id BIGINT"
SUMS_SCHEMA = "target_id BIGINT, batch_id BIGINT, batch_count BIGINT"
NOTICES_SCHEMA = "target_id BIGINT, notice_key STRING, view_count BIGINT, batch_id BIGINT"

# Groups of targets, one state entry each (see threshold_state).
STATE_GROUPS = 1 << 12


def running_totals(decoded: DataFrame) -> DataFrame:
    return (accepted(decoded).groupBy("target_id")
            .agg(F.sum("count").cast("bigint").alias("view_count")))


def _write_batch(out_dir: str):
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={int(batch_id)}")
    return write


def start_running_totals(decoded: DataFrame, out_dir: str, checkpoint: str,
                         trigger: dict | None = None) -> StreamingQuery:
    """Write each batch's updated totals to ``out_dir/batch_id=N``."""
    refuse_lost_checkpoint(decoded.sparkSession, out_dir, checkpoint)
    return (running_totals(decoded).writeStream.outputMode("update")
            .foreachBatch(_write_batch(out_dir))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DEFAULT_TRIGGER)).start())


def read_state_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``target_id, view_count`` read straight from the aggregate's state store
    (Spark's state data source): one row per target, the counter lookup of
    the reference, without scanning the update history."""
    state = spark.read.format("statestore").load(checkpoint)
    total_field = state.schema["value"].dataType.fieldNames()[0]   # the sum buffer
    return state.select(F.col("key.target_id").alias("target_id"),
                        F.col(f"value.{total_field}").cast("bigint").alias("view_count"))


def latest_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    """``target_id, view_count``: the last update of every target."""
    return (spark.read.schema(TOTALS_SCHEMA).parquet(out_dir).groupBy("target_id")
            .agg(F.max_by("view_count", "batch_id").alias("view_count")))


# One target's state, packed: a group's targets stand end to end in one binary value.
_ENTRY = np.dtype([("target", "<i8"), ("total", "<i8"), ("last", "<i8"), ("told", "?")])


def _advance(limit: int):
    """The notice operator's step for a group of targets: their new sums (``target_id, batch_id,
    batch_count``), each target's oldest batch first, on the packed state of the group."""

    def step(key, frames, state):
        sums: dict[tuple[int, int], int] = {}
        for frame in frames:
            for target, batch, count in zip(frame["target_id"].tolist(), frame["batch_id"].tolist(),
                                            frame["batch_count"].tolist(), strict=True):
                sums[target, batch] = sums.get((target, batch), 0) + count
        held = np.frombuffer(bytes(state.get[0]), _ENTRY) if state.exists else np.zeros(0, _ENTRY)
        at = dict(zip(held["target"].tolist(), range(len(held)), strict=True))
        fresh = sorted({target for target, _ in sums} - at.keys())
        at.update(zip(fresh, range(len(held), len(held) + len(fresh)), strict=True))
        entries = np.zeros(len(at), _ENTRY)
        entries[:len(held)] = held
        entries["target"][len(held):], entries["last"][len(held):] = fresh, -1
        crossed = []
        for target, batch in sorted(sums):
            _, total, last, told = entries[at[target]].item()
            if 0 <= batch <= last:      # a batch that failed before its mark and was written again
                continue
            total += sums[target, batch]
            if not told and total > limit:
                told = True
                crossed.append((target, total, batch))
            entries[at[target]] = (target, total, max(last, batch), told)
        state.update((entries.tobytes(),))
        if crossed:
            yield pd.DataFrame(crossed, columns=["target_id", "view_count", "batch_id"])

    return step


def threshold_state(sums: DataFrame, limit: int = DEFAULT_LIMIT, groups: int = STATE_GROUPS) -> DataFrame:
    """``target_id, view_count, batch_id`` of each target's first crossing, from a stream of
    ``target_id, batch_id, batch_count``: one stateful operator holds total, notice flag and the
    last batch of a target. ``batch_id`` -1 stands for the micro-batch itself.

    Targets are dealt by hash over ``groups`` groups, the operator's keys: a call into Python costs
    the same for one target and for a hundred, so a micro-batch costs ``groups`` calls at most. The
    checkpoint fixes the number; a group's state (25 bytes a target) is rewritten when one of its
    targets has a sum, so give more of them for hundreds of millions of targets."""
    share_package(sums.sparkSession)
    group = F.pmod(F.xxhash64("target_id"), F.lit(groups)).cast("int")
    return sums.select(group.alias("target_group"), "target_id", "batch_id", "batch_count").groupBy(
        "target_group").applyInPandasWithState(
        _advance(limit), "target_id BIGINT, view_count BIGINT, batch_id BIGINT",
        "targets BINARY", "update", GroupStateTimeout.NoTimeout)


def _partial_sums(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        sums = pa.table({"target_id": batch["target_id"], "n": batch["count"].cast(pa.int64())}).group_by("target_id").aggregate(
            [("n", "sum")])
        yield from pa.table({"target_id": sums["target_id"], "batch_id": pa.array([-1] * len(sums), pa.int64()),
                             "batch_count": sums["n_sum"]}).to_batches()


def start_threshold_notices(decoded: DataFrame, out_dir: str, checkpoint: str,
                            limit: int = DEFAULT_LIMIT, trigger: dict | None = None, groups: int = STATE_GROUPS) -> StreamingQuery:
    """Write each micro-batch's new notices to ``out_dir/batch_id=N``. Counts are summed before the
    shuffle (a hot target sends one row an Arrow batch); no earlier notice is read."""
    refuse_lost_checkpoint(decoded.sparkSession, out_dir, checkpoint)
    share_package(decoded.sparkSession)
    sums = accepted(decoded).select("target_id", "count").mapInArrow(_partial_sums, SUMS_SCHEMA)

    def write(found: DataFrame, batch_id: int) -> None:
        (found.select("target_id", notice_key().alias("notice_key"), "view_count")
         .write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={int(batch_id)}"))

    return (threshold_state(sums, limit, groups).writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER)).start())


def start_delta_notices(spark: SparkSession, out_dir: str, checkpoint: str, limit: int = DEFAULT_LIMIT,
                        trigger: dict | None = None, groups: int = STATE_GROUPS) -> StreamingQuery:
    """Notices of a running job (started with ``notify=False``) from its stored per-batch sums: the
    job decodes once, and a notice carries the job's own batch id, whichever micro-batch of this
    query finds it. Written to the job's ``notices/batch_id=N``, a folder for each micro-batch.

    The job writes batches one after another and a batch's sums are the same when it runs again,
    so the state takes each batch of a target once. ``keep_batches`` must leave this query the
    batches it has not read yet.
    """
    from playtally.streaming.store import SCHEMAS, JobLayout

    lay = JobLayout(out_dir)
    refuse_lost_checkpoint(spark, lay.table("notices"), checkpoint)
    make_folder(spark, lay.table("deltas"))
    deltas = (spark.readStream.schema(SCHEMAS["deltas"] + ", batch_id BIGINT").parquet(lay.table("deltas"))
              .select("target_id", F.col("batch_id").cast("bigint").alias("batch_id"), "batch_count"))

    def write(found: DataFrame, epoch: int) -> None:
        (found.select("target_id", notice_key().alias("notice_key"), "view_count", "batch_id",
                      F.lit(int(epoch)).cast("bigint").alias("epoch"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "epoch").parquet(lay.table("notices")))

    return (threshold_state(deltas, limit, groups).writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER)).start())


def start_split_job(messages: DataFrame, out_dir: str, checkpoint: str, limit: int = DEFAULT_LIMIT,
                    trigger: dict | None = None, strip: bool = True,
                    groups: int = STATE_GROUPS) -> list[StreamingQuery]:
    """The job for very large key spaces: the stateless job writes deltas, rejected rows, metrics
    and the ledger; a stateful query over its deltas keeps totals and notice flags in the state
    store, so that a batch never reads other targets' history. Notices carry the job's batch ids.
    With an ``availableNow`` trigger the second starts when the first has ended.
    """
    from playtally.streaming.job import start_job

    ck = checkpoint.rstrip("/")
    first = start_job(messages, out_dir, f"{ck}/job", limit=limit, trigger=trigger, strip=strip, notify=False)
    if trigger and ("availableNow" in trigger or "once" in trigger):
        first.awaitTermination()
    return [first, start_delta_notices(messages.sparkSession, out_dir, f"{ck}/notices", limit, trigger, groups)]
