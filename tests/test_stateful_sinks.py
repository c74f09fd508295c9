"""The stateful notice operator, the stored topic as a source, the committing sink, several topics."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from playtally.functions.decode import decode_messages
from playtally.session import remove_folder
from playtally.sources.kafka import as_kafka_rows, kafka_messages
from playtally.sources.topic_store import append, read_topic_store
from playtally.streaming import cli, job, stateful
from playtally.streaming.committed_sink import CommittedWriter, delivered_files, read_delivered, start_delivery
from playtally.streaming.replay import StagedReplay

ONCE = {"availableNow": True}
SCHEMA = "event_id BIGINT, batch_id BIGINT, topic STRING, partition INT, offset BIGINT, line STRING"


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _messages(spark, rows):
    return spark.createDataFrame([(i, b, "dmp", i % 2, i // 2, f'{{"targetId":{t},"count":{c}}}')
                                  for i, (b, t, c) in enumerate(rows)], SCHEMA)


ROWS = [(0, 1, 4), (1, 1, 6), (2, 1, 1), (0, 2, 50), (0, 3, 12), (1, 3, -5), (2, 3, 9), (0, 4, 0), (2, 4, 6), (2, 4, 5)]
NOTICES = [(0, 2, 50), (0, 3, 12), (2, 1, 11), (2, 4, 11)]


def test_delta_notices_carry_the_jobs_batch_ids(spark, scratch):
    """The stateful query starts late and reads all batches at once: same ids; a batch that is
    written again changes nothing, and later batches go on from the state."""
    msgs = _messages(spark, ROWS)
    out = f"{scratch}/out"
    handler = job.PlayCountBatch(out, limit=10, notify=False)
    for b in (0, 1):
        handler(msgs.filter(F.col("batch_id") == b), b)

    def run():
        stateful.start_delta_notices(spark, out, f"{scratch}/ck", 10, ONCE).awaitTermination()

    run()
    assert _rows(job.read_output(spark, out, "notices"), "batch_id", "target_id", "view_count") == NOTICES[:2]
    remove_folder(spark, f"{out}/done/batch_id=1")
    handler(msgs.filter(F.col("batch_id") == 1), 1)      # new files of a batch that was read
    handler(msgs.filter(F.col("batch_id") == 2), 2)
    run()
    assert _rows(job.read_output(spark, out, "notices"), "batch_id", "target_id", "view_count") == NOTICES
    assert _rows(job.read_output(spark, out, "notices"), "notice_key")[0] == ("view:flag:1",)


def test_notice_operator_on_a_decoded_stream(spark, scratch):
    replay = StagedReplay(spark, _messages(spark, ROWS), f"{scratch}/stage")
    replay.run(lambda s: stateful.start_threshold_notices(decode_messages(s), f"{scratch}/nt", f"{scratch}/ck", 10, ONCE))
    got = spark.read.schema(stateful.NOTICES_SCHEMA).parquet(f"{scratch}/nt")
    assert _rows(got, "batch_id", "target_id", "view_count") == NOTICES


def test_partial_sums_before_the_state(spark):
    df = spark.range(0, 30_000, 1, 2).selectExpr("id % 3 as target_id", "cast(1 as int) as count")
    sums = df.mapInArrow(stateful._partial_sums, stateful.SUMS_SCHEMA)
    assert sums.count() < 40
    assert _rows(sums.groupBy("target_id").agg(F.sum("batch_count").alias("n")), "target_id", "n") == [
        (0, 10_000), (1, 10_000), (2, 10_000)]


def _topic(spark, rows, path, number, **kw):
    append(spark, as_kafka_rows(spark.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT, line STRING")),
           path, number, **kw)


def test_stored_topic_batches_ranges_and_restart(spark, scratch):
    path = f"{scratch}/topic"
    _topic(spark, [("a", 0, o, f"a0-{o}") for o in range(25)] + [("b", 3, o, f"b3-{o}") for o in range(5)], path, 0,
           segment_size=10)
    out, ck = f"{scratch}/out", f"{scratch}/ck"

    def run(**options):
        (kafka_messages(read_topic_store(spark, path, **options)).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ck).trigger(**ONCE).start().awaitTermination())
        return _rows(spark.read.parquet(out), "topic", "partition", "offset", "line")

    first = run(offsetsPerTask="7")
    assert first == [("a", 0, o, f"a0-{o}") for o in range(25)] + [("b", 3, o, f"b3-{o}") for o in range(5)]
    assert job.source_ranges(spark, ck, 0) == {("a", 0): (None, 25), ("b", 3): (None, 5)}
    # A gap at the end of partition 0, a new partition 1.
    _topic(spark, [("a", 0, 26, "x"), ("a", 1, 0, "y")], path, 1, ends={"a": {"0": 40}}, segment_size=10)
    assert run() == sorted([*first, ("a", 0, 26, "x"), ("a", 1, 0, "y")])
    assert job.source_ranges(spark, ck, 1) == {("a", 0): (25, 40), ("a", 1): (0, 1), ("b", 3): (5, 5)}


def test_stored_topic_from_given_offsets(spark, scratch):
    path = f"{scratch}/topic"
    _topic(spark, [("a", p, o, f"{p}-{o}") for p in (0, 1) for o in range(6)], path, 0)
    start = json.dumps({"a": {"0": 4, "1": 6}})
    (kafka_messages(read_topic_store(spark, path, startingOffsets=start)).writeStream.format("parquet")
     .option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck").trigger(**ONCE).start().awaitTermination())
    assert _rows(spark.read.parquet(f"{scratch}/out"), "partition", "offset") == [(0, 4), (0, 5)]


def test_job_over_two_topics_and_resume_positions(spark, scratch):
    path, out = f"{scratch}/topic", f"{scratch}/out"
    line = '{"targetId":%d,"count":6}'
    _topic(spark, [("a", 0, o, line % 1) for o in range(2)] + [("b", 0, 0, line % 2), ("b", 1, 0, "bad")], path, 0)
    job.start_job(kafka_messages(read_topic_store(spark, path)), out, f"{scratch}/ck", limit=10, trigger=ONCE).awaitTermination()
    assert _rows(job.read_output(spark, out, "ledger"), "topic", "partition", "from_offset", "until_offset") == [
        ("a", 0, 0, 2), ("b", 0, 0, 1), ("b", 1, 0, 1)]
    start = cli.resume_offsets_json(spark, out, "a,b", "1,3")
    assert json.loads(start) == {"a": {"0": 2}, "b": {"0": 1, "1": 1, "2": 0}}
    _topic(spark, [("a", 0, 2, line % 1), ("b", 2, 0, line % 2)], path, 1)
    job.start_job(kafka_messages(read_topic_store(spark, path, startingOffsets=start)), out, f"{scratch}/new", limit=10,
                  trigger=ONCE, resume=True).awaitTermination()
    assert _rows(job.read_counters(spark, out), "target_id", "view_count") == [(1, 18), (2, 12)]
    assert _rows(job.read_output(spark, out, "notices"), "batch_id", "target_id") == [(0, 1), (1, 2)]


def test_cli_takes_several_topics():
    a = cli.parse_args(["--bootstrap", "h", "--out", "o", "--checkpoint", "c", "--topic", "a,b", "--topic-partitions", "4"])
    assert cli.topic_sizes(a.topic, a.topic_partitions) == {"a": 4, "b": 4}
    assert cli.topic_sizes("a,b", "2,3") == {"a": 2, "b": 3}
    with pytest.raises(SystemExit):
        cli.parse_args(["--bootstrap", "h", "--out", "o", "--checkpoint", "c", "--topic", "a,b", "--topic-partitions", "1,2,3"])


def test_commits_name_each_row_once(spark, scratch):
    import pyarrow as pa

    writer = CommittedWriter(f"{scratch}/out")
    rows = pa.RecordBatch.from_pydict({"id": pa.array([1, 2], pa.int64())})
    lost, kept = writer.write(iter([rows])), writer.write(iter([rows]))     # a task that ran twice
    none = writer.write(iter([rows.slice(0, 0)]))
    writer.commit([kept, none, None], 0)
    assert lost.files[0] not in str(delivered_files(f"{scratch}/out"))
    writer.commit([writer.write(iter([rows]))], 0)                          # the batch again after its commit
    failed = writer.write(iter([rows]))
    writer.abort([failed, None], 1)
    assert _rows(read_delivered(spark, f"{scratch}/out", "id BIGINT"), "id") == [(1,), (2,)]
    assert read_delivered(spark, f"{scratch}/none", "id BIGINT").collect() == []


FAILING = '''
import os, sys
sys.path.insert(0, {root!r})
from playtally.session import build_session
from playtally.streaming import committed_sink as sink

class Failing(sink.CommittedWriter):
    def write(self, iterator):
        done = super().write(iterator)
        mark = {folder!r} + "/failed-once"
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise OSError("lost after writing")
        return done

class FailingSink(sink.CommittedSink):
    @classmethod
    def name(cls):
        return "failing"
    def streamWriter(self, schema, overwrite):
        return Failing(self.options["path"])

spark = build_session("local[2,3]", conf={{"spark.checkpoint.dir": {folder!r}}})
spark.sparkContext.setLogLevel("OFF")
spark.range(100).repartition(2).write.parquet({folder!r} + "/in")
rows = spark.readStream.schema("id BIGINT").parquet({folder!r} + "/in")
sink.start_delivery(rows, {folder!r} + "/out", {folder!r} + "/ck", {{"availableNow": True}}, sink=FailingSink).awaitTermination()
print("rows", sorted(r.id for r in sink.read_delivered(spark, {folder!r} + "/out", "id BIGINT").collect()) == list(range(100)))
print("files", len(os.listdir({folder!r} + "/out/data")), len(sink.delivered_files({folder!r} + "/out")))
'''


def test_a_failed_task_leaves_no_doubled_row(tmp_path):
    """In a session of its own, whose tasks may fail and run again."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "run.py"
    script.write_text(FAILING.format(root=root, folder=str(tmp_path)))
    said = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=300)
    assert "rows True" in said.stdout, said.stdout + said.stderr[-2000:]
    written, committed = map(int, said.stdout.split("files ")[1].split())
    assert written > committed     # the failed task's file is there, and no commit names it


def test_delivery_refuses_a_lost_checkpoint(spark, scratch):
    spark.range(3).write.parquet(f"{scratch}/in")
    rows = spark.readStream.schema("id BIGINT").parquet(f"{scratch}/in")
    start_delivery(rows, f"{scratch}/out", f"{scratch}/ck", ONCE).awaitTermination()
    with pytest.raises(RuntimeError, match="no commit log"):
        start_delivery(rows, f"{scratch}/out", f"{scratch}/other", ONCE)
    assert _rows(read_delivered(spark, f"{scratch}/out", "id BIGINT"), "id") == [(0,), (1,), (2,)]


def test_targets_share_state_entries(spark, scratch):
    """Many targets in few groups: one state entry (and one call into Python) a group, and every
    target still has its own total, flag and first crossing."""
    rows = [(b, t, (t * 7 + b * 5) % 13 - 3) for b in range(3) for t in range(-100, 100)] + [(1, 5, 2**40 % 97)] * 3
    expected, totals, told = [], {}, set()
    for b in range(3):
        for t in {t for n, t, _ in rows if n == b}:
            totals[t] = totals.get(t, 0) + sum(c for n, k, c in rows if n == b and k == t)
            if t not in told and totals[t] > 10:
                told.add(t)
                expected.append((b, t, totals[t]))
    replay = StagedReplay(spark, _messages(spark, rows), f"{scratch}/stage")
    entries = []

    def start(s):
        query = stateful.start_threshold_notices(decode_messages(s), f"{scratch}/nt", f"{scratch}/ck", 10, ONCE, groups=4)
        query.awaitTermination()
        entries.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        return query

    replay.run(start)
    got = spark.read.schema(stateful.NOTICES_SCHEMA).parquet(f"{scratch}/nt")
    assert _rows(got, "batch_id", "target_id", "view_count") == sorted(expected)
    assert entries == [4, 4, 4]
