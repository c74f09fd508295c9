"""The job's stored state: buckets, marks and retention, positions, files, source ranges, notices one by one."""

import pytest
from pyspark.sql import functions as F

from playtally.session import partition_values
from playtally.streaming import job, store
from playtally.streaming.replay import StagedReplay

ONCE = {"availableNow": True}
SCHEMA = "event_id BIGINT, batch_id BIGINT, topic STRING, partition INT, offset BIGINT, line STRING"


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _messages(spark, rows):
    """``(batch, target, count)`` as messages, in one topic partition."""
    return spark.createDataFrame([(i, b, "dmp", 0, i, f'{{"targetId":{t},"count":{c}}}')
                                  for i, (b, t, c) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("targets, least", [(1_000, 2), (8_000, 16)])
def test_a_small_batch_opens_only_its_buckets(spark, scratch, targets, least):
    """Files read for a batch of ten targets stay as many when there are ten times the targets."""
    out = f"{scratch}/out"
    handler = job.PlayCountBatch(out, limit=5, compact_every=1, bucket_bytes=1024)
    every = spark.range(targets).select(
        F.col("id").alias("event_id"), F.lit("dmp").alias("topic"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.format_string('{"targetId":%d,"count":1}', "id").alias("line"))
    for n in range(2):   # the second snapshot has its buckets by the size of the first
        handler(every, n)
    lay = store.JobLayout(out)
    buckets = store.snapshot_buckets(spark, lay, 1)
    assert buckets >= least
    ten = every.filter("event_id < 10")
    touched = {r.b for r in ten.select(F.col("event_id").alias("target_id"))
               .select(store.bucket_of(buckets).alias("b")).collect()}
    opened = store.read_snapshot(spark, lay, "snapshots", 1, touched).inputFiles()
    assert len(opened) <= 10
    handler(ten, 2)
    counters = {r.target_id: r.view_count for r in job.read_counters(spark, out).collect()}
    assert len(counters) == targets and {counters[t] for t in range(10)} == {3} and counters[targets - 1] == 2


def test_marks_and_folders_stay_few_over_many_batches(spark, scratch):
    """300 complete batches: marks are folded, the history behind the snapshots is removed."""
    out = f"{scratch}/out"
    lay = store.JobLayout(out)
    for n in range(300):
        store.mark_done(spark, lay, n)
        if n % 25 == 0:
            assert n in store.Marks.load(spark, lay) and n + 1 not in store.Marks.load(spark, lay)
    assert len(partition_values(spark, lay.table("done"), "batch_id")) <= store.MARKS_KEPT + 1
    assert len(partition_values(spark, lay.table("manifest"), "upto")) == 1
    assert store.Marks.load(spark, lay).last() == 299
    assert store.Marks.load(spark, lay).between(-1) == range(300)
    msgs = _messages(spark, [(b, b % 3, 4) for b in range(14)])
    handler = job.PlayCountBatch(f"{scratch}/kept", limit=10, compact_every=2, keep_batches=3)
    for b in range(14):
        handler(msgs.filter(F.col("batch_id") == b), b)
    kept = store.JobLayout(f"{scratch}/kept")
    for name in ("deltas", "metrics", "ledger", "notices", "rejected"):
        assert len(partition_values(spark, kept.table(name), "batch_id")) <= 5
    assert _rows(job.read_counters(spark, kept.root), "target_id", "view_count") == [(0, 20), (1, 20), (2, 16)]
    assert _rows(job.read_output(spark, kept.root, "notices"), "batch_id", "target_id", "view_count") == [
        (6, 0, 12), (7, 1, 12), (8, 2, 12)]
    assert _rows(job.committed_positions(spark, kept.root), "topic", "partition", "until_offset") == [("dmp", 0, 14)]


def test_readers_leave_out_unmarked_batches(spark, scratch):
    out = f"{scratch}/out"
    job.PlayCountBatch(out, limit=1)(_messages(spark, [(0, 1, 4)]), 0)
    stray = spark.createDataFrame([(1, 1000)], store.SCHEMAS["deltas"])
    stray.write.parquet(f"{out}/deltas/batch_id=77")
    assert _rows(job.read_output(spark, out, "deltas"), "batch_id", "target_id", "batch_count") == [(0, 1, 4)]
    assert job.read_output(spark, f"{scratch}/none", "ledger").columns == [
        "topic", "partition", "from_offset", "until_offset", "batch_id"]


def test_a_resume_opens_one_snapshot_and_few_ledgers(spark, scratch):
    out = f"{scratch}/out"
    handler = job.PlayCountBatch(out, limit=100, compact_every=4)
    msgs = _messages(spark, [(b, 1, 1) for b in range(11)])
    for b in range(11):
        handler(msgs.filter(F.col("batch_id") == b), b)
    at = store.positions(spark, store.JobLayout(out))
    assert _rows(at, "until_offset") == [(11,)]
    ledgers = [f for f in at.inputFiles() if "/ledger/" in f]
    assert {f.split("batch_id=")[1].split("/")[0] for f in ledgers} <= {"8", "9", "10"}
    assert len({f.split("batch_id=")[1].split("/")[0] for f in at.inputFiles() if "/positions/" in f}) == 1


LOG = "v1\n{\"batchWatermarkMs\":0,\"batchTimestampMs\":1,\"conf\":{}}\n"


def _offset_log(spark, scratch, **files):
    for name, text in files.items():
        sc = spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{scratch}/ck/{name.replace('_', '/')}")
        stream = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
        stream.write(text.encode())
        stream.close()
    return f"{scratch}/ck"


def test_ledger_has_the_sources_own_ranges(spark, scratch):
    """Partition 1 has a range and only a bad row, partition 2 a range without any row."""
    ck = _offset_log(spark, scratch, offsets_0=LOG + '{"dmp":{"0":2,"1":3,"2":4}}', offsets_1=LOG + '{"dmp":{"0":2,"1":5,"2":9,"3":1}}',
                     sources_0_0='\0v1\n{"dmp":{"0":0,"1":2,"2":4}}')
    out = f"{scratch}/out"
    handler = job.PlayCountBatch(out, limit=1, checkpoint=ck)
    rows = [(0, 0, "dmp", 0, 1, '{"targetId":1,"count":4}'), (1, 0, "dmp", 1, 2, "not json"), (2, 1, "dmp", 1, 4, "bad")]
    msgs = spark.createDataFrame(rows, SCHEMA)
    for b in (0, 1):
        handler(msgs.filter(F.col("batch_id") == b), b)
    assert _rows(job.read_output(spark, out, "ledger"), "batch_id", "partition", "from_offset", "until_offset") == [
        (0, 0, 0, 2), (0, 1, 2, 3), (1, 1, 3, 5), (1, 2, 4, 9), (1, 3, 0, 1)]
    stray = spark.createDataFrame([(3, 2, "dmp", 0, 7, "x")], SCHEMA)
    ck = _offset_log(spark, scratch, offsets_2=LOG + '{"dmp":{"0":3,"1":5,"2":9,"3":1}}')
    with pytest.raises(RuntimeError, match="outside the source's range"):
        handler(stray, 2)


@pytest.mark.parametrize("log", [None, LOG + '{"logOffset":3}', LOG + "7", LOG + "-"], ids=["none", "file", "rate", "empty"])
def test_other_sources_have_ranges_of_their_rows(spark, scratch, log):
    ck = _offset_log(spark, scratch, **({"offsets_0": log} if log else {}))
    assert not job.source_ranges(spark, ck, 0)
    out = f"{scratch}/out"
    job.PlayCountBatch(out, limit=1, checkpoint=ck)(_messages(spark, [(0, 1, 4), (0, 1, 4)]), 0)
    assert _rows(job.read_output(spark, out, "ledger"), "partition", "from_offset", "until_offset") == [(0, 0, 2)]


def test_log_folder_resume_reads_each_file_once(spark, scratch):
    from playtally.sources.logs import read_log_lines

    lines = spark.createDataFrame([(b, f'{{"targetId":{t},"count":{c}}}') for b, t, c in
                                   [(0, 1, 5), (1, 2, 7), (2, 1, 1), (3, 2, 2)]], "batch_id BIGINT, line STRING")
    replay = StagedReplay(spark, lines, f"{scratch}/stage", fmt="text",
                          to_files=lambda df: df.select(F.col("line").alias("value")))
    out = f"{scratch}/out"
    for b in (0, 1):
        replay.release(b)
        job.start_job(read_log_lines(spark, replay.inbox), out, f"{scratch}/lost", limit=100, trigger=ONCE,
                      compact_every=2).awaitTermination()
    for b in (2, 3):
        replay.release(b)
        job.start_job(read_log_lines(spark, replay.inbox), out, f"{scratch}/new", limit=100, trigger=ONCE, resume=True,
                      compact_every=2).awaitTermination()
    assert _rows(job.read_counters(spark, out), "target_id", "view_count") == [(1, 6), (2, 9)]
    assert len(_rows(store.consumed_files(spark, store.JobLayout(out)), "file")) == 4
    with pytest.raises(ValueError, match="resume needs"):
        job.start_job(read_log_lines(spark, replay.inbox).select("line"), out, f"{scratch}/third", resume=True, trigger=ONCE)


def test_half_a_batch_sent_flags_just_that_half(spark, scratch, tmp_path):
    out, folder = f"{scratch}/out", str(tmp_path / "queue")

    def client(refuse):
        """Keeps what it got in a file of its own, and refuses some targets."""
        def make():
            import os
            import uuid

            os.makedirs(folder, exist_ok=True)
            return f"{folder}/{uuid.uuid4().hex}"

        def send(path, rows):
            for r in rows:
                if r["target_id"] in refuse:
                    raise OSError(f"refused {r['target_id']}")
                with open(path, "a") as f:
                    f.write(f"{r['target_id']}\n")

        return make, send

    import os

    from playtally.streaming import delivery

    odd = {t for t in range(40) if t % 2}
    msgs = _messages(spark, [(0, t, 20) for t in range(40)])

    def run(n, refuse, chunk=1):
        handler = job.PlayCountBatch(out, limit=10, notice_client=client(refuse))
        job.send_acknowledged, kept = (lambda df, m, s: delivery.send_acknowledged(df, m, s, chunk=chunk)), job.send_acknowledged
        try:
            handler(msgs, n)
        finally:
            job.send_acknowledged = kept

    def sent():
        return sorted(int(x) for name in os.listdir(folder) for x in open(f"{folder}/{name}").read().split())

    run(0, odd)
    assert sent() == [t for t in range(40) if t % 2 == 0]
    assert [r[0] for r in _rows(job.read_output(spark, out, "notices"), "target_id")] == sent()
    run(1, set())      # the other half is over the limit still, and goes when it next appears
    assert sent() == list(range(40))
    assert _rows(job.read_output(spark, out, "notices").groupBy("batch_id").count(), "batch_id", "count") == [(0, 20), (1, 20)]
    # The same batch again after a failure before its mark: what was sent is not sent twice.
    from playtally.session import remove_folder
    remove_folder(spark, f"{out}/done/batch_id=1")
    run(1, set())
    assert sent() == list(range(40))


def test_an_error_of_the_rows_is_not_an_unsent_notice(spark, scratch):
    """A failing read of the pending notices fails the batch; only the sender's errors are caught."""
    out = f"{scratch}/out"
    handler = job.PlayCountBatch(out, limit=1, on_notices=lambda df, n: None)
    broken = handler._notices
    handler._notices = lambda *a: broken(*a).withColumn("view_count", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        handler(_messages(spark, [(0, 1, 4)]), 0)
    assert not store.is_done(spark, store.JobLayout(out), 0)
