"""Per-partition delivery adapters and the job's command line."""

import glob
import json
import os
import sys
import uuid

from pyspark import cloudpickle

from playtally.functions.decode import decode_messages
from playtally.streaming import cli, stateful
from playtally.streaming.delivery import PartitionWriter, deliver_partitions
from playtally.streaming.job import read_counters, start_job
from playtally.streaming.replay import StagedReplay

from test_streaming import ONCE, _fixture_messages


# Python workers cannot import this test module: ship its classes by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FileClient:
    """Stand-in for a service client: appends JSON lines to its own file."""

    def __init__(self, folder):
        os.makedirs(folder, exist_ok=True)
        self.f = open(os.path.join(folder, f"{uuid.uuid4().hex}.jsonl"), "a")
        self.calls = 0

    def close(self):
        self.f.close()


def _send(client, rows):
    client.calls += 1
    for r in rows:
        client.f.write(json.dumps(r.asDict()) + "\n")


def _received(folder):
    out = []
    for path in glob.glob(os.path.join(folder, "*.jsonl")):
        with open(path) as f:
            out += [json.loads(line) for line in f]
    return out


def test_deliver_partitions(spark, scratch):
    folder = scratch.replace("file:", "") + "-sent"
    df = spark.range(0, 1000, numPartitions=4).selectExpr("id AS target_id", "id * 2 AS view_count")
    deliver_partitions(df, lambda: FileClient(folder), _send, chunk=64)
    got = _received(folder)
    assert sorted(r["target_id"] for r in got) == list(range(1000))
    assert len(glob.glob(os.path.join(folder, "*.jsonl"))) == 4   # one client per partition


def test_partition_writer_stream(spark, scratch):
    folder = scratch.replace("file:", "") + "-sent"
    replay = StagedReplay(spark, _fixture_messages(spark), f"{scratch}/stage")
    replay.run(lambda s: stateful.running_totals(decode_messages(s)).writeStream.outputMode("update")
               .foreach(PartitionWriter(lambda: FileClient(folder), _send, chunk=2))
               .option("checkpointLocation", f"{scratch}/ck").trigger(**ONCE).start())
    got = _received(folder)
    assert sorted((r["target_id"], r["view_count"]) for r in got) == [
        (1, 4), (1, 10), (1, 11), (2, 50), (3, 7), (3, 12), (3, 16), (4, 0)]
    assert len(got) == 8   # touched targets per batch: 4 + 2 + 2
    assert {r["target_id"] for r in got} == {1, 2, 3, 4}


def test_job_on_log_lines(spark, scratch):
    """Log lines carry no offsets: the job counts them and writes no ledger."""
    replay = StagedReplay(spark, _fixture_messages(spark), f"{scratch}/stage", fmt="text",
                          to_files=lambda df: df.selectExpr("line AS value"))
    from playtally.sources.logs import read_log_lines
    replay.run(lambda _: start_job(read_log_lines(spark, replay.inbox), f"{scratch}/out",
                                   f"{scratch}/ck", limit=10, trigger=ONCE))
    got = sorted(tuple(r) for r in read_counters(spark, f"{scratch}/out").select("target_id", "view_count").collect())
    assert got == [(1, 11), (2, 50), (3, 16), (4, 0)]
    from playtally.session import path_exists
    assert not path_exists(spark, f"{scratch}/out/ledger")


def test_cli_args():
    a = cli.parse_args(["--bootstrap", "h:9092", "--out", "o", "--checkpoint", "c", "--min-partitions", "64"])
    assert a.topic == "dmp" and a.limit == 10 and a.trigger == "10 seconds" and a.min_partitions == 64
    b = cli.parse_args(["--log-dir", "d", "--out", "o", "--checkpoint", "c", "--no-strip"])
    assert b.log_dir == "d" and b.no_strip


def test_cli_main_runs_until_stopped(spark, scratch):
    """main() starts the job on a log folder and blocks until the query stops."""
    import threading
    import time

    from playtally.session import path_exists

    logs = f"{scratch}/logs"
    _fixture_messages(spark).selectExpr("line AS value").where("value IS NOT NULL").write.text(logs)
    out, ck = f"{scratch}/out", f"{scratch}/ck"
    runner = threading.Thread(target=cli.main, args=(["--log-dir", logs, "--out", out, "--checkpoint", ck,
                                                      "--trigger", "1 second"],), daemon=True)
    runner.start()
    deadline = time.time() + 120
    while time.time() < deadline and not path_exists(spark, f"{out}/metrics"):
        time.sleep(1)
    for q in spark.streams.active:
        q.processAllAvailable()
        q.stop()
    runner.join(60)
    assert not runner.is_alive()
    got = sorted(tuple(r) for r in read_counters(spark, out).select("target_id", "view_count").collect())
    assert got == [(1, 11), (2, 50), (3, 16), (4, 0)]


def test_cli_resume_positions_and_checks(spark, scratch):
    import pytest

    replay = StagedReplay(spark, _fixture_messages(spark), f"{scratch}/stage")
    out = f"{scratch}/out"
    replay.run(lambda s: start_job(s, out, f"{scratch}/ck", limit=10, trigger=ONCE))
    got = json.loads(cli.resume_offsets_json(spark, out, "dmp", 3))
    assert got == {"dmp": {"0": 4, "1": 51, "2": 0}}   # partition 2 holds no message yet
    for bad in (["--bootstrap", "h", "--checkpoint", "c"], ["--bootstrap", "h", "--out", "o", "--checkpoint", "c", "--resume"],
                ["--bootstrap", "h", "--checkpoint", "c", "--forward-to", "h"]):
        with pytest.raises(SystemExit):
            cli.parse_args(bad)
    assert cli.parse_args(["--log-dir", "d", "--checkpoint", "c", "--forward-to", "h"]).forward_to == "h"


def test_launcher_file_parses():
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = subprocess.run([sys.executable, os.path.join(root, "play_count_job.py"), "--help"], capture_output=True, text=True)
    assert said.returncode == 0 and "--resume" in said.stdout
