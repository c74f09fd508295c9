"""The play-count streaming job: decode, count, notify, record offsets.

One stateless decoded stream feeds ``foreachBatch``; for micro-batch ``N``
the handler, in order:

1. returns at once when batch ``N`` is marked complete;
2. persists the decoded batch; one aggregate fills the cache and gives the
   row metrics and the snapshot buckets its targets fall in; an empty batch
   writes no output (but its offset ranges, if the source had any);
3. writes the per-target sums of the batch to ``deltas/batch_id=N``
   (the counter increment, one row per touched target);
4. computes the new totals of the touched targets only: this batch's deltas
   plus earlier history of those targets (their buckets of the latest snapshot
   + later deltas, ``left_semi`` on the touched targets);
5. writes ``notices/batch_id=N``: totals over the limit, ``left_anti`` on the
   targets notified before ``N`` (never cleared);
6. writes rejected rows and row metrics (steps 3-6 run as concurrent Spark
   jobs over the cached batch), the offset ledger where rows have offsets, and
   the log files read where rows have a ``file``;
7. delivers the batch's notices if a sender is given. With ``notice_client``
   each task sends its rows and stores those it has sent (see
   :func:`playtally.streaming.delivery.send_acknowledged`): the notices are the
   acknowledged rows, one by one. With ``on_notices`` the whole batch is sent by
   one call and stored after it. What was not sent is sent when its target next
   appears;
8. when ``compact_every`` batches have passed since the last one, writes
   snapshots, and removes the batch folders that ``keep_batches`` lets go;
9. marks the batch last, for every kind of source.

The stored state and its readers are in :mod:`playtally.streaming.store`:
readers (and the handler's own history) use marked batches and snapshots of
marked batches only, so an unfinished or half-rewritten folder is never read.

Every output is an overwrite of its own ``batch_id=N`` folder and reads only
batches before ``N``, so re-running a batch after a failure (Spark re-runs
the last uncommitted batch on restart) leaves all outputs unchanged: the
counts are exactly-once even though the reference's increments were not.

*Offset ranges* are the source's own: the batch's entry in the checkpoint's
offset log, less the entry before it, so a partition whose rows did not decode,
or that had none left, is in the ledger, too. Sources whose offsets are not
``{topic: {partition: offset}}`` get their ranges from the rows.

*Log folders.* A new checkpoint would read all files again. A resumed job leaves
out, before decoding, the files that its complete batches have read.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playtally.functions.decode import accepted, decode_messages, is_accepted
from playtally.functions.keys import notice_key
from playtally.operators.notices import DEFAULT_LIMIT
from playtally.operators.offsets import batch_ledger
from playtally.plans.broadcast import stored_side
from playtally.session import partition_values, path_exists, read_text, remove_folder, touch
from playtally.streaming.delivery import send_acknowledged
from playtally.streaming.store import (BUCKET_BYTES, SCHEMAS, JobLayout, Marks, bucket_of, committed_positions, consumed_files,
                                       expire_batches, history, is_done, last_snapshot, mark_done, notified,
                                       read_batches, read_counters, read_output, snapshot_buckets, write_snapshots)

__all__ = ["DEFAULT_COMPACT_EVERY", "DEFAULT_TRIGGER", "SCHEMAS", "JobLayout", "PlayCountBatch", "committed_positions",
           "expire_batches", "history", "is_done", "read_counters", "read_output", "refuse_lost_checkpoint",
           "source_ranges", "start_job"]

LOG = logging.getLogger(__name__)

# Fixed value of the reference job: a 10 s processing-time micro-batch.
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}
DEFAULT_COMPACT_EVERY = 64


def _topic_offsets(log: str | None) -> dict[tuple[str, int], int] | None:
    """``{(topic, partition): offset}`` of an offset-log file's sources; None if it is absent or some
    source counts otherwise."""
    if log is None:
        return None
    found: dict[tuple[str, int], int] = {}
    # An initial-offsets file starts with a zero byte; the lines are a version, metadata and one a source.
    lines = [line for line in log.lstrip("\0").splitlines()[1:] if line and line != "-"]
    sources = [json.loads(line) for line in lines]
    for offsets in (s for s in sources if not (isinstance(s, dict) and "batchWatermarkMs" in s)):
        if not isinstance(offsets, dict):
            return None
        for topic, partitions in offsets.items():
            if not isinstance(partitions, dict) or not all(isinstance(v, int) for v in partitions.values()):
                return None
            found.update({(topic, int(p)): v for p, v in partitions.items()})
    return found


def source_ranges(spark: SparkSession, checkpoint: str, epoch: int) -> dict[tuple[str, int], tuple[int | None, int]] | None:
    """``{(topic, partition): (from, until)}`` of a checkpoint's micro-batch, from its offset log; None
    if the source does not count by topic and partition. ``from`` is None where the log cannot know it
    (a first batch whose source stored no start). Metadata only, one entry a topic partition."""
    root = checkpoint.rstrip("/")
    until = _topic_offsets(read_text(spark, f"{root}/offsets/{epoch}"))
    if not until:
        return None
    start = _topic_offsets(read_text(spark, f"{root}/offsets/{epoch - 1}") if epoch
                           else read_text(spark, f"{root}/sources/0/0")) or {}
    # A partition that appears later starts at 0.
    return {tp: (start.get(tp, 0 if epoch else None), end) for tp, end in until.items()}


class PlayCountBatch:
    """``foreachBatch`` handler of the play-count job (see module docstring)."""

    def __init__(self, out_dir: str, limit: int = DEFAULT_LIMIT, strip: bool = True,
                 notify: bool = True, fail_fast: bool = False,
                 compact_every: int | None = DEFAULT_COMPACT_EVERY,
                 on_notices: Callable[[DataFrame, int], None] | None = None,
                 first_batch: int = 0, keep_batches: int | None = None, checkpoint: str | None = None,
                 notice_client: tuple[Callable[[], Any], Callable[[Any, list[Row]], None]] | None = None,
                 bucket_bytes: int = BUCKET_BYTES):
        if on_notices is not None and notice_client is not None:
            raise ValueError("give on_notices or notice_client, not both")
        self.first_batch = first_batch  # of this checkpoint: batch ids go on after a resume
        self.checkpoint = checkpoint    # where the source's offset log is, if the ledger is to come from it
        self.layout = JobLayout(out_dir)
        self.on_notices = on_notices
        self.notice_client = notice_client
        self.limit = limit
        self.strip = strip
        self.notify = notify
        self.fail_fast = fail_fast
        self.compact_every = compact_every
        self.keep_batches = keep_batches
        self.bucket_bytes = bucket_bytes

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        lay = self.layout
        n = int(batch_id) + self.first_batch
        if is_done(spark, lay, n):
            return
        messages = self._unread(spark, messages)
        # The micro-batch id is the batch id of every output; a stored
        # ``batch_id`` column of replayed messages would clash with it.
        decoded = decode_messages(messages.drop("batch_id"), strip=self.strip, fail_fast=self.fail_fast)
        decoded = decoded.persist(StorageLevel.MEMORY_AND_DISK)
        deltas = None
        try:
            buckets = snapshot_buckets(spark, lay, last_snapshot(spark, lay, n))
            # One aggregate fills the cache and gives the row metrics and touched buckets (one row).
            stats = decoded.agg(F.count(F.lit(1)).alias("n_rows"),
                                F.count_if(~is_accepted()).alias("n_rejected"),
                                F.collect_set(F.when(is_accepted(), bucket_of(buckets))).alias("touched")).first()
            if stats["n_rows"] > 0:
                deltas = (accepted(decoded).groupBy("target_id")
                          .agg(F.sum("count").cast("bigint").alias("batch_count"))
                          .persist(StorageLevel.MEMORY_AND_DISK))
                self._write(spark, decoded, deltas, stats, n)
            else:
                self._write_ledger(spark, decoded, n)
            if self.compact_every:
                last = last_snapshot(spark, lay, n)
                if n - (-1 if last is None else last) >= self.compact_every:
                    write_snapshots(spark, lay, n, self.bucket_bytes)
            mark_done(spark, lay, n)
            if self.keep_batches is not None and self.compact_every and path_exists(spark, lay.part("snapshots", n)):
                expire_batches(spark, lay.root, self.keep_batches)
        finally:
            if deltas is not None:
                deltas.unpersist()
            decoded.unpersist()

    def _unread(self, spark: SparkSession, messages: DataFrame) -> DataFrame:
        """Lines of files that no batch before this checkpoint's first has read."""
        if not self.first_batch or "file" not in messages.columns:
            return messages
        earlier = consumed_files(spark, self.layout, self.first_batch)
        if earlier is None:
            return messages
        # File names first: the lines of a large file meet one short row, and are not shuffled.
        new = stored_side(messages.select("file").distinct().join(earlier, "file", "left_anti"))
        return messages.join(new, "file", "left_semi")

    def _write(self, spark: SparkSession, decoded: DataFrame, deltas: DataFrame, stats: Row, n: int) -> None:
        lay = self.layout
        writes = [
            lambda: deltas.write.mode("overwrite").parquet(lay.part("deltas", n)),
            lambda: (decoded.filter(~is_accepted()).drop("target_id", "count")
                     .write.mode("overwrite").parquet(lay.part("rejected", n))),
            lambda: (spark.createDataFrame([(stats["n_rows"], stats["n_rejected"])], SCHEMAS["metrics"])
                     .write.mode("overwrite").parquet(lay.part("metrics", n))),
            lambda: self._write_ledger(spark, decoded, n),
        ]
        # With a sender the new notices wait in ``pending``: the flag is set after the send.
        sends = self.on_notices is not None or self.notice_client is not None
        if self.notify:
            writes.append(lambda: self._notices(spark, deltas, n, stats["touched"])
                          .write.mode("overwrite").parquet(lay.part("pending" if sends else "notices", n)))
        if "file" in decoded.columns:
            writes.append(lambda: (decoded.select("file").distinct()
                                   .write.mode("overwrite").parquet(lay.part("files", n))))
        # Independent outputs of one cached batch: run them as concurrent Spark jobs. The threads
        # inherit the query's job group, so stopping the query cancels them; leaving the pool
        # waits for all of them, also after an error.
        with ThreadPoolExecutor(max_workers=len(writes)) as pool:
            futures = [pool.submit(inheritable_thread_target(spark)(w)) for w in writes]
        for f in futures:
            f.result()
        if self.notify and self.notice_client is not None:
            self._send_each(spark, n)
        elif self.notify and self.on_notices is not None:
            self._send(spark, n)

    def _write_ledger(self, spark: SparkSession, decoded: DataFrame, n: int) -> None:
        """Offset ranges of the batch: the source's where it counts by topic and partition (rows
        outside them are an error), else those of the rows."""
        if not {"topic", "partition", "offset"} <= set(decoded.columns):  # log lines have no offsets
            return
        ranges = source_ranges(spark, self.checkpoint, n - self.first_batch) if self.checkpoint else None
        rows = batch_ledger(decoded, n).drop("batch_id")
        if ranges is None:
            rows = rows.persist()
            try:
                if not rows.isEmpty():
                    rows.write.mode("overwrite").parquet(self.layout.part("ledger", n))
            finally:
                rows.unpersist()
            return
        seen = {(r["topic"], r["partition"]): (r["from_offset"], r["until_offset"]) for r in rows.collect()}
        ledger = []
        for tp, (start, until) in sorted(ranges.items()):
            low, high = seen.pop(tp, (until, until))
            start = low if start is None else start
            if low < start or high > until:
                raise RuntimeError(f"batch {n}: rows {low}..{high} of {tp} outside the source's range {start}..{until}")
            if until > start:
                ledger.append((*tp, start, until))
        if seen:
            raise RuntimeError(f"batch {n}: rows of {sorted(seen)}, which the source's offsets do not name")
        if ledger:
            (spark.createDataFrame(ledger, SCHEMAS["ledger"]).coalesce(1)
             .write.mode("overwrite").parquet(self.layout.part("ledger", n)))

    def _send(self, spark: SparkSession, n: int) -> None:
        """Send the batch's pending notices by one call, then store them as notices (the flag). A
        failed send is logged and sets no flag: its targets are over the limit still, so each is sent
        when it next appears. A batch that runs again after its send sends again."""
        lay = self.layout
        pending = spark.read.schema(SCHEMAS["notices"]).parquet(lay.part("pending", n)).persist()
        try:
            pending.count()   # what fails from here on is the sender
            try:
                self.on_notices(pending.withColumn("batch_id", F.lit(n).cast("bigint")), n)
            except Exception:
                LOG.exception("notices of batch %d were not sent; their targets stay unnotified", n)
                remove_folder(spark, lay.part("notices", n))
                return
            pending.write.mode("overwrite").parquet(lay.part("notices", n))
        finally:
            pending.unpersist()

    def _send_each(self, spark: SparkSession, n: int) -> None:
        """Each task sends its pending notices and stores the acknowledged ones. A batch that runs
        again sends only those that are not stored yet."""
        lay = self.layout
        pending = spark.read.schema(SCHEMAS["notices"]).parquet(lay.part("pending", n))
        stored = read_batches(spark, lay, "notices", [n])
        if stored is not None:
            pending = pending.join(stored.select("target_id"), "target_id", "left_anti").select(*pending.columns)
        send_acknowledged(pending, *self.notice_client).write.mode("append").parquet(lay.part("notices", n))

    def _notices(self, spark: SparkSession, deltas: DataFrame, n: int, touched: list[int]) -> DataFrame:
        earlier = history(spark, self.layout, n, touched)
        rows = deltas
        if earlier is not None:
            rows = rows.unionByName(earlier.join(deltas.select("target_id"), "target_id", "left_semi"))
        totals = rows.groupBy("target_id").agg(F.sum("batch_count").cast("bigint").alias("view_count"))
        new = totals.filter(F.col("view_count") > F.lit(self.limit))
        told = notified(spark, self.layout, n, touched)
        if told is not None:
            new = new.join(told.select("target_id"), "target_id", "left_anti")
        return new.select("target_id", notice_key().alias("notice_key"), "view_count")


def refuse_lost_checkpoint(spark: SparkSession, table: str, checkpoint: str) -> None:
    """Old output with a checkpoint that has no commit log: batch ids would restart at 0 and
    overwrite it."""
    if path_exists(spark, table) and not path_exists(spark, f"{checkpoint.rstrip('/')}/commits"):
        raise RuntimeError(f"{table} holds job output but {checkpoint} has no commit log")


def _first_batch(spark: SparkSession, layout: JobLayout, checkpoint: str) -> int:
    """Batch id at which this checkpoint's batch 0 stands, kept beside the checkpoint."""
    folder = f"{checkpoint.rstrip('/')}-resume"
    known = partition_values(spark, folder, "first_batch")
    if known:
        return known[-1]
    first = Marks.load(spark, layout).last() + 1
    if first:
        touch(spark, f"{folder}/first_batch={first}/mark")
    return first


def start_job(messages: DataFrame, out_dir: str, checkpoint: str, limit: int = DEFAULT_LIMIT,
              trigger: dict | None = None, strip: bool = True, notify: bool = True,
              fail_fast: bool = False, compact_every: int | None = DEFAULT_COMPACT_EVERY,
              query_name: str | None = None,
              on_notices: Callable[[DataFrame, int], None] | None = None,
              resume: bool = False, keep_batches: int | None = None,
              notice_client: tuple[Callable[[], Any], Callable[[Any, list[Row]], None]] | None = None) -> StreamingQuery:
    """Start the job on a streaming message DataFrame (``topic, partition, offset, line``).

    Refuses to start when the output folder holds results but the checkpoint
    has no commit log: batch ids would restart at 0 and overwrite them. With
    ``resume`` such a start is wanted (the checkpoint was lost): batch ids go on
    after the last complete batch. Messages of a topic must start at the committed
    positions (:func:`committed_positions` with ``scan_from_offsets``, or the
    topic's ``startingOffsets`` made from them); of log lines with their ``file``
    the job itself leaves out what was read. Lines without it cannot be resumed.
    """
    spark = messages.sparkSession
    layout = JobLayout(out_dir)
    if not resume and not partition_values(spark, f"{checkpoint.rstrip('/')}-resume", "first_batch"):
        refuse_lost_checkpoint(spark, layout.table("done"), checkpoint)
    if resume and not {"offset", "file"} & set(messages.columns):
        raise ValueError("a resume needs messages with offsets, or log lines with their file")
    first = _first_batch(spark, layout, checkpoint) if resume or \
        partition_values(spark, f"{checkpoint.rstrip('/')}-resume", "first_batch") else 0
    handler = PlayCountBatch(out_dir, limit=limit, strip=strip, notify=notify,
                             fail_fast=fail_fast, compact_every=compact_every,
                             on_notices=on_notices, first_batch=first, keep_batches=keep_batches,
                             checkpoint=checkpoint, notice_client=notice_client)
    writer = (messages.writeStream.foreachBatch(handler)
              .option("checkpointLocation", checkpoint)
              .trigger(**(trigger or DEFAULT_TRIGGER)))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()
