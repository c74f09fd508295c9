"""Hot keys and the scratch-folder rule."""

import pytest
from pyspark.sql import functions as F

from playtally.functions.decode import accepted, decode_messages
from playtally.operators import counts, notices
from playtally.session import materialize, work_root
from playtally.sources.messages import message_lines, read_table

from conftest import SF_SMOKE


def test_hot_target_holds_a_third_of_messages(spark):
    """A third of all events remapped to one target: sums and notices stay
    exact (checked against plain Python) and every sum has a partial step."""
    events = read_table(spark, SF_SMOKE, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(999)).otherwise(F.col("user_id")))
    decoded = decode_messages(message_lines(events))
    rows = accepted(decoded).select("batch_id", "target_id", "count").collect()
    want = {}
    for r in rows:
        want[(r.batch_id, r.target_id)] = want.get((r.batch_id, r.target_id), 0) + r["count"]
    bc = counts.batch_counts(decoded)
    assert {(r.batch_id, r.target_id): r.batch_count for r in bc.collect()} == want
    hot_share = sum(v for (b, t), v in want.items() if t == 999) / sum(want.values())
    assert hot_share > 0.3
    plan = bc._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    running = counts.running_counts(materialize(bc, "skew-deltas"))
    first = {r.target_id: r.batch_id for r in notices.threshold_notices(running, 3000).collect()}
    total = 0
    for b in sorted({b for b, t in want if t == 999}):
        total += want[(b, 999)]
        if total > 3000:
            assert first[999] == b
            break


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, values):
        self.conf = _Conf(values)
        self.sparkContext = _Context()


def test_no_local_scratch_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_root(_Session({"spark.master": "yarn"}))
