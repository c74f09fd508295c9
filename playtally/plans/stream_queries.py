"""Registered streaming queries.

Each one replays the message table of ``sf_dir`` (derived from ``events``)
as a stream, one stored batch per micro-batch, runs a Structured Streaming
query over it to completion, and returns the query's output table read
back from the scratch folder below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from playtally.functions.decode import accepted as dec_accepted
from playtally.functions.decode import decode_messages
from playtally.operators import counts, offsets
from playtally.plans.batch_queries import QUERY_LIMIT
from playtally.session import materialize, remove_folder, scratch_dir
from playtally.sources.kafka import as_kafka_rows, kafka_messages
from playtally.sources.logs import log_text, read_log_lines
from playtally.sources.messages import TOPIC, read_messages, spread_messages
from playtally.sources.topic_store import append, read_topic_store
from playtally.streaming import job, stateful
from playtally.streaming.committed_sink import read_delivered, start_delivery
from playtally.streaming.replay import StagedReplay

RUN_ONCE = {"availableNow": True}


def _setup(spark: SparkSession, sf_dir: str, name: str, **replay_kwargs):
    root = scratch_dir(spark, name)
    replay = StagedReplay(spark, spread_messages(spark, sf_dir), f"{root}/stage", **replay_kwargs)
    return root, replay


def stream_scan(spark, sf_dir):
    """Kafka-shaped rows -> message stream -> parquet file sink."""
    root, replay = _setup(spark, sf_dir, "stream_scan", to_files=as_kafka_rows)
    out, ck = f"{root}/out", f"{root}/checkpoint"
    replay.run(lambda rows: kafka_messages(rows).writeStream.format("parquet")
               .option("path", out).option("checkpointLocation", ck)
               .trigger(**RUN_ONCE).start())
    return spark.read.parquet(out).select("topic", "partition", "offset", "line")


def log_ingest(spark, sf_dir):
    """Rolled log files in a folder -> message lines (parquet file sink)."""
    root, replay = _setup(spark, sf_dir, "log_ingest", fmt="text", to_files=log_text)
    out, ck = f"{root}/out", f"{root}/checkpoint"
    replay.run(lambda _: read_log_lines(spark, replay.inbox).writeStream.format("parquet")
               .option("path", out).option("checkpointLocation", ck)
               .trigger(**RUN_ONCE).start())
    return spark.read.parquet(out).select("line")


def stream_running_counts(spark, sf_dir):
    root, replay = _setup(spark, sf_dir, "stream_running_counts")
    out, ck = f"{root}/out", f"{root}/checkpoint"
    replay.run(lambda s: stateful.start_running_totals(decode_messages(s), out, ck, RUN_ONCE))
    # What each batch emitted (the increments' return values), and the counters as the state
    # store itself holds them (one row per target, batch -1).
    updates = spark.read.schema(stateful.TOTALS_SCHEMA).parquet(out).select("batch_id", "target_id", "view_count")
    return updates.union(stateful.read_state_totals(spark, ck).selectExpr("-1L", "target_id", "view_count"))


def stream_threshold_notices(spark, sf_dir):
    root, replay = _setup(spark, sf_dir, "stream_threshold_notices")
    out, ck = f"{root}/out", f"{root}/checkpoint"
    replay.run(lambda s: stateful.start_threshold_notices(decode_messages(s), out, ck,
                                                          QUERY_LIMIT, RUN_ONCE))
    return spark.read.schema(stateful.NOTICES_SCHEMA).parquet(out).select(
        "batch_id", "target_id", "notice_key", "view_count")


def run_job(spark: SparkSession, sf_dir: str, name: str, replay_last: bool = False,
            compact_every: int | None = job.DEFAULT_COMPACT_EVERY):
    """Run the full job over the replayed messages; returns the output folder."""
    root, replay = _setup(spark, sf_dir, name)
    out, ck = f"{root}/out", f"{root}/checkpoint"
    ids = replay.run(lambda s: job.start_job(s, out, ck, limit=QUERY_LIMIT, trigger=RUN_ONCE,
                                             compact_every=compact_every))
    if replay_last and ids:
        # What Spark does when the handler failed before its mark: the same rows are
        # handed to it again under the same id.
        last = len(ids) - 1
        remove_folder(spark, job.JobLayout(out).part("done", last))
        job.PlayCountBatch(out, limit=QUERY_LIMIT, compact_every=compact_every)(replay.batch(ids[last]), last)
    return out


def stream_job(spark, sf_dir):
    out = run_job(spark, sf_dir, "stream_job")
    return job.read_counters(spark, out).select("target_id", "view_count")


def stream_job_notices(spark, sf_dir):
    out = run_job(spark, sf_dir, "stream_job_notices")
    return job.read_output(spark, out, "notices").select("batch_id", "target_id", "notice_key", "view_count")


def stream_job_ledger(spark, sf_dir):
    out = run_job(spark, sf_dir, "stream_job_ledger")
    return job.read_output(spark, out, "ledger").select(
        "batch_id", "topic", "partition", "from_offset", "until_offset")


def stream_job_metrics(spark, sf_dir):
    out = run_job(spark, sf_dir, "stream_job_metrics")
    return job.read_output(spark, out, "metrics").select("batch_id", "n_rows", "n_rejected")


def stream_job_deltas(spark, sf_dir):
    out = run_job(spark, sf_dir, "stream_job_deltas")
    return job.read_output(spark, out, "deltas").select("batch_id", "target_id", "batch_count")


def stream_job_rejected(spark, sf_dir):
    out = run_job(spark, sf_dir, "stream_job_rejected")
    return job.read_output(spark, out, "rejected").select("batch_id", "event_id", "line")


def _whole_state(spark, out):
    """Totals, notices and ledger of a job in one frame, so that a doubled row of any shows."""
    totals = job.read_counters(spark, out).selectExpr("'total' as kind", "-1L as batch_id", "target_id as k", "view_count as v")
    told = job.read_output(spark, out, "notices").selectExpr("'notice' as kind", "batch_id", "target_id as k", "view_count as v")
    ledger = job.read_output(spark, out, "ledger").selectExpr(
        "'ledger' as kind", "batch_id", "cast(partition as bigint) as k", "until_offset as v")
    return totals.union(told).union(ledger)


def stream_replay(spark, sf_dir):
    """The last batch fails before its mark and runs again, with a snapshot every two batches,
    so it also rewrites a snapshot."""
    return _whole_state(spark, run_job(spark, sf_dir, "stream_replay", replay_last=True, compact_every=2))


def stream_resume(spark, sf_dir):
    """The checkpoint is lost after three batches: a new one goes on from the ledger's positions.
    The messages are cut into six batches by event_id, so that offsets rise from batch to batch
    as they do in a topic."""
    messages = read_messages(spark, sf_dir)
    last = messages.agg(F.max("event_id")).first()[0]
    root = scratch_dir(spark, "stream_resume")
    replay = StagedReplay(spark, spread_messages(spark, sf_dir).withColumn("batch_id", F.expr(f"event_id * 6 div {last + 1}")),
                          f"{root}/stage")
    out, ids = f"{root}/out", replay.batch_ids()
    for b in ids[:3]:
        replay.release(b)
        job.start_job(replay.stream(), out, f"{root}/lost", limit=QUERY_LIMIT, trigger=RUN_ONCE).awaitTermination()
    every = offsets.topic_partitions(messages)
    positions = materialize(offsets.resume_offsets(every, job.committed_positions(spark, out)), "positions")
    for b in ids[3:]:
        replay.release(b)
        job.start_job(offsets.scan_from_offsets(replay.stream(), positions), out, f"{root}/new", limit=QUERY_LIMIT,
                      trigger=RUN_ONCE, resume=True).awaitTermination()
    return _whole_state(spark, out)


def stream_log_resume(spark, sf_dir):
    """Log lines as rolled files; the checkpoint is lost after three batches, and the new one, which
    sees all files again, counts only those that were not read."""
    root, replay = _setup(spark, sf_dir, "stream_log_resume", fmt="text", to_files=log_text)
    out, ids = f"{root}/out", replay.batch_ids()
    for b in ids:
        resumed = b in ids[3:]
        replay.release(b)
        job.start_job(read_log_lines(spark, replay.inbox), out, f"{root}/{'new' if resumed else 'lost'}", limit=QUERY_LIMIT,
                      trigger=RUN_ONCE, compact_every=2, resume=resumed).awaitTermination()
    totals = job.read_counters(spark, out).selectExpr("'total' as kind", "-1L as batch_id", "target_id as k", "view_count as v")
    told = job.read_output(spark, out, "notices").selectExpr("'notice' as kind", "batch_id", "target_id as k", "view_count as v")
    return totals.union(told)


def stream_topic_ranges(spark, sf_dir):
    """The job on a stored topic, whose ledger is the source's own ranges. The messages of partition
    3 in batch 4 are gone from the topic (their offsets are not): no rows, but a range."""
    messages = read_messages(spark, sf_dir)
    last = messages.agg(F.max("event_id")).first()[0]
    root = scratch_dir(spark, "stream_topic_ranges")
    cut = materialize(spread_messages(spark, sf_dir).withColumn("batch_id", F.expr(f"event_id * 6 div {last + 1}")), "topic-batches")
    ends = {(r["batch_id"], str(r["partition"])): r["until"] for r in
            cut.groupBy("batch_id", "partition").agg((F.max("offset") + 1).alias("until")).collect()}
    out, topic = f"{root}/out", f"{root}/topic"
    for b in sorted({b for b, _ in ends}):
        kept = cut.filter((F.col("batch_id") == b) & ~((F.lit(b) == 4) & (F.col("partition") == 3)))
        append(spark, as_kafka_rows(kept), topic, b, {TOPIC: {p: v for (n, p), v in ends.items() if n == b}})
        job.start_job(kafka_messages(read_topic_store(spark, topic)), out, f"{root}/checkpoint", limit=QUERY_LIMIT,
                      trigger=RUN_ONCE).awaitTermination()
    return _whole_state(spark, out)


def stream_empty_batch(spark, sf_dir):
    """A micro-batch without rows (batch 2): it is marked complete and writes no output."""
    root, replay = _setup(spark, sf_dir, "stream_empty_batch", to_files=lambda df: df.filter("batch_id <> 2"))
    out = f"{root}/out"
    replay.run(lambda s: job.start_job(s, out, f"{root}/checkpoint", limit=QUERY_LIMIT, trigger=RUN_ONCE))
    return job.read_output(spark, out, "metrics").select("batch_id", "n_rows", "n_rejected")


def stream_split_job(spark, sf_dir):
    """Large-key-space form: stateless outputs, and notices by a stateful query over the stored sums."""
    root, replay = _setup(spark, sf_dir, "stream_split_job")
    out, ck = f"{root}/out", f"{root}/checkpoint"
    for b in replay.batch_ids():
        replay.release(b)
        for q in stateful.start_split_job(replay.stream(), out, ck, limit=QUERY_LIMIT, trigger=RUN_ONCE):
            q.awaitTermination()
    return job.read_output(spark, out, "notices").select("batch_id", "target_id", "notice_key", "view_count")


def stream_delivery(spark, sf_dir):
    """Accepted messages through the committing stream sink, six micro-batches."""
    root, replay = _setup(spark, sf_dir, "stream_delivery")
    out = f"{root}/delivered"
    replay.run(lambda s: start_delivery(dec_accepted(decode_messages(s)).select("event_id", "target_id", "count"), out,
                                        f"{root}/checkpoint", trigger=RUN_ONCE))
    return read_delivered(spark, out, "event_id BIGINT, target_id BIGINT, count INT")


def counter_table(spark, sf_dir):
    """Batch form of the counter sink: per-batch deltas written with dynamic
    partition overwrite (idempotent per batch), counters = sum of deltas."""
    path = f"{scratch_dir(spark, 'counter_table')}/deltas"
    deltas = counts.batch_counts(decode_messages(read_messages(spark, sf_dir)))
    (deltas.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))
    return counts.totals_from_deltas(spark.read.parquet(path).withColumn(
        "batch_id", F.col("batch_id").cast("bigint")))


STREAM_QUERIES = {
    "stream_scan": stream_scan,
    "log_ingest": log_ingest,
    "stream_running_counts": stream_running_counts,
    "stream_threshold_notices": stream_threshold_notices,
    "stream_job": stream_job,
    "stream_job_notices": stream_job_notices,
    "stream_job_ledger": stream_job_ledger,
    "stream_job_metrics": stream_job_metrics,
    "stream_job_deltas": stream_job_deltas,
    "stream_job_rejected": stream_job_rejected,
    "stream_replay": stream_replay,
    "stream_resume": stream_resume,
    "stream_log_resume": stream_log_resume,
    "stream_topic_ranges": stream_topic_ranges,
    "stream_empty_batch": stream_empty_batch,
    "stream_split_job": stream_split_job,
    "stream_delivery": stream_delivery,
    "counter_table": counter_table,
}
