"""Ledger, committed and resume positions, scans from positions."""

import json

from pyspark.sql import functions as F

from playtally.operators import offsets
from playtally.plans.broadcast import stored_side

MSG = "batch_id BIGINT, topic STRING, partition INT, offset BIGINT, line STRING"


def _messages(spark):
    rows = []
    for p in range(4):
        for o in range(10):
            rows.append((o // 4, "dmp", p, o, f"m{p}-{o}"))
    return spark.createDataFrame(rows, MSG)


def test_ledger_half_open_ranges(spark):
    led = {(r.batch_id, r.partition): (r.from_offset, r.until_offset)
           for r in offsets.offset_ledger(_messages(spark)).collect()}
    assert led[(0, 0)] == (0, 4) and led[(1, 2)] == (4, 8) and led[(2, 3)] == (8, 10)
    assert len(led) == 12


def test_empty_batch_no_ledger_row(spark):
    empty = spark.createDataFrame([], MSG)
    assert offsets.batch_ledger(empty, 7).count() == 0


def test_resume_fixture(spark):
    msgs = _messages(spark)
    ledger = offsets.offset_ledger(msgs).filter("batch_id < 2 AND partition != 3")
    pos = offsets.resume_offsets(offsets.topic_partitions(msgs), offsets.committed_offsets(ledger))
    got = {r.partition: r.from_offset for r in pos.collect()}
    assert got == {0: 8, 1: 8, 2: 8, 3: 0}


def test_resume_no_ledger_all_zero(spark):
    msgs = _messages(spark)
    none = offsets.offset_ledger(msgs).filter("false")
    got = {r.partition: r.from_offset for r in
           offsets.resume_offsets(offsets.topic_partitions(msgs), offsets.committed_offsets(none)).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0}


def test_scan_from_offsets_broadcasts(spark):
    msgs = _messages(spark)
    pos = spark.createDataFrame([("dmp", 0, 5), ("dmp", 1, 0), ("dmp", 2, 10), ("dmp", 3, 9)],
                                "topic STRING, partition INT, from_offset BIGINT")
    out = offsets.scan_from_offsets(msgs, pos)
    got = sorted((r.partition, r.offset) for r in out.collect())
    assert got == [(0, o) for o in range(5, 10)] + [(1, o) for o in range(10)] + [(3, 9)]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_stored_side_is_not_hinted(spark):
    """Spark decides by the stored size: no broadcast when its threshold is off."""
    pos = spark.createDataFrame([("dmp", p, 0) for p in range(4)], "topic STRING, partition INT, from_offset BIGINT")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = offsets.scan_from_offsets(_messages(spark), pos)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert "hint" not in str(stored_side(pos)._jdf.queryExecution().logical()).lower()


def test_starting_offsets_json(spark):
    pos = spark.createDataFrame([("dmp", 0, 5), ("dmp", 1, 0), ("x", 0, 3)],
                                "topic STRING, partition INT, from_offset BIGINT")
    js = json.loads(offsets.starting_offsets_json(pos).first()[0])
    assert js == {"dmp": {"0": 5, "1": 0}, "x": {"0": 3}}
