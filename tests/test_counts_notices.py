"""Batch sums, running sums and threshold notices (limit 10, strict >)."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from playtally.operators import counts, notices

DELTA_SCHEMA = "batch_id BIGINT, target_id BIGINT, count INT"

# FIXTURES.md "Threshold": (batch_id, target_id, count)
THRESHOLD_ROWS = [
    (0, 1, 4), (1, 1, 6), (2, 1, 1),      # 4, 10 (no notice), 11 (notice at batch 2)
    (0, 2, 50),                           # notice at 50 in batch 0
    (0, 3, 12), (1, 3, -5), (2, 3, 9),    # 12 (notice), 7, 16 (no second notice)
    (0, 4, 0),                            # never
]


def _decoded(spark, rows):
    return spark.createDataFrame(rows, DELTA_SCHEMA)


def _running(spark, rows, block=counts.RUNNING_BLOCK):
    return counts.running_counts(counts.batch_counts(_decoded(spark, rows)), block=block)


def test_threshold_fixture(spark):
    got = sorted(tuple(r) for r in notices.threshold_notices(_running(spark, THRESHOLD_ROWS), 10).collect())
    assert got == [(0, 2, "view:flag:2", 50), (0, 3, "view:flag:3", 12), (2, 1, "view:flag:1", 11)]


def test_over_threshold_is_strict(spark):
    got = {(r.batch_id, r.target_id) for r in notices.over_threshold(_running(spark, THRESHOLD_ROWS), 10).collect()}
    assert (1, 1) not in got and (2, 1) in got


def test_unnotified_uses_earlier_notices_only(spark):
    running = _running(spark, THRESHOLD_ROWS)
    earlier = notices.threshold_notices(running.filter("batch_id < 2"), 10)
    got = sorted(tuple(r) for r in notices.unnotified(running.filter("batch_id = 2"), earlier, 10).collect())
    assert got == [(1, 11)]   # target 3 (16) was notified in batch 0


def test_batch_and_total_counts(spark):
    rows = THRESHOLD_ROWS + [(2, 1, None), (2, None, 5)]
    df = _decoded(spark, rows)
    bc = {(r.batch_id, r.target_id): r.batch_count for r in counts.batch_counts(df).collect()}
    assert bc[(2, 1)] == 1 and (2, None) not in bc
    tot = {r.target_id: (r.counter_key, r.view_count) for r in counts.total_counts(df).collect()}
    assert tot == {1: ("view:count:1", 11), 2: ("view:count:2", 50), 3: ("view:count:3", 16),
                   4: ("view:count:4", 0)}


def test_notice_payload(spark):
    n = spark.createDataFrame([(0, 7, "view:flag:7", 12)], "batch_id BIGINT, target_id BIGINT, notice_key STRING, view_count BIGINT")
    assert notices.notice_payload(n).collect()[0]["value"] == '{"targetId":7}'


def _plain_running(deltas):
    w = Window.partitionBy("target_id").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return deltas.select("batch_id", "target_id", F.sum("batch_count").over(w).alias("view_count"))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 5), st.integers(-20, 50)), min_size=1, max_size=60),
       st.sampled_from([1, 2, 3, 7, 1024]))
def test_two_level_running_sum_equals_window(spark, rows, block):
    deltas = counts.batch_counts(_decoded(spark, rows))
    got = sorted(tuple(r) for r in counts.running_counts(deltas, block=block).collect())
    want = sorted(tuple(r) for r in _plain_running(deltas).collect())
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(0, 9)), min_size=1, max_size=80),
       st.integers(1, 6), st.randoms(use_true_random=False))
def test_split_invariance(spark, events, n_batches, rnd):
    """Any split into batches gives the same totals; with non-negative counts
    the notified set is exactly {total > limit}."""
    rows = [(rnd.randrange(n_batches), t, c) for t, c in events]
    running = _running(spark, rows, block=2)
    final = running.groupBy("target_id").agg(F.max_by("view_count", "batch_id").alias("v"))
    totals = {}
    for t, c in events:
        totals[t] = totals.get(t, 0) + c
    assert {r.target_id: r.v for r in final.collect()} == totals
    notified = {r.target_id for r in notices.threshold_notices(running, 10).collect()}
    assert notified == {t for t, v in totals.items() if v > 10}


def test_hot_key_running_sum(spark):
    """One target in every batch (a hot key) still sums right across many blocks."""
    rows = [(b, 1, 1) for b in range(300)] + [(b, 2, 2) for b in range(0, 300, 7)]
    running = _running(spark, rows, block=16)
    got = {(r.batch_id, r.target_id): r.view_count for r in running.collect()}
    assert got[(299, 1)] == 300 and got[(15, 1)] == 16 and got[(16, 1)] == 17
    assert got[(294, 2)] == 2 * 43


def test_one_block_equals_many(spark):
    rows = [(b, t, b * t) for b in range(20) for t in range(1, 4)]
    deltas = counts.batch_counts(_decoded(spark, rows))
    one, many = (counts.running_counts(deltas, block=k) for k in (64, 4))
    assert sorted(tuple(r) for r in one.collect()) == sorted(tuple(r) for r in many.collect())
    assert all("Join" in x._jdf.queryExecution().optimizedPlan().toString() for x in (one, many))
