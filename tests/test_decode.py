"""Decode contract: prefix strip, control trim, JSON fields, accept/reject."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playtally.functions import decode as dec

# (line, expected with strip=True, expected with strip=False); None = rejected
TRUTH = [
    ('{"targetId":7,"count":3}', (7, 3), (7, 3)),
    ('{"targetId":7,"count":3,"other":{"a":[1]}}', (7, 3), (7, 3)),
    ('{"targetId":"7","count":"3"}', (7, 3), (7, 3)),
    ("{'targetId':7,'count':3}", (7, 3), (7, 3)),
    ("{targetId:7,count:3}", (7, 3), (7, 3)),
    ('{"targetId":7,"targetId":8,"count":3}', (8, 3), (8, 3)),
    ('{"targetId":7.9,"count":3}', (7, 3), (7, 3)),
    ('{"targetId":7,"count":1e2}', (7, 100), (7, 100)),
    ('{"targetId":-7.9,"count":-3.9}', (-7, -3), (-7, -3)),
    ('{"targetId":"7.9","count":3}', None, None),
    ("{'targetId':7,'count':'1e2'}", None, None),
    ("{targetId:7,count:3.5}", (7, 3), (7, 3)),
    ('{"targetId":7,"count":"x","count":2.5}', (7, 2), (7, 2)),
    ('{"targetId":7,"count":2.5,"count":"2.5"}', None, None),
    ('{"targetId":7,"count":3.9,"meta":{"count":"1"}}', (7, 3), (7, 3)),
    ('{"targetId":7,"count":4294967299,"note":"see count: \'x\'"}', (7, 3), (7, 3)),
    ('{"targetId":7,"count":"3.9","meta":{"count":1}}', None, None),
    ('{"meta":{"targetId":"1"},"targetId":7.5,"count":3,"note":"targetId:\\"8\\""}', (7, 3), (7, 3)),
    ('{"targetId":7,"count":2.5,"count":{"count":1}}', None, None),
    ('{"targetId":7,"count":NaN}', None, None),
    ('{"targetId":18446744073709551623,"count":-4294967299}', (7, -3), (7, -3)),
    ('{"targetId":" 7","count":"3"}', (7, 3), (7, 3)),
    ('{"targetId":7,"count":4294967299}', (7, 3), (7, 3)),
    ('{"targetId":[7],"count":3}', None, None),
    ('{"targetId":7,"count":3} x', (7, 3), (7, 3)),
    ('{"targetId":7}', None, None),
    ('{"targetId":null,"count":3}', None, None),
    ('{"targetId":true,"count":3}', None, None),
    ("[1,2]", None, None),
    ("not json", None, None),
    ("", None, None),
    (None, None, None),
    ('message: {"targetId":7,"count":3}', (7, 3), None),
    ('message: \t{"targetId":7,"count":3} \r\n', (7, 3), None),
    ('message: message: {"targetId":7,"count":3}', None, None),
    (' message: {"targetId":7,"count":3}', None, None),
    ('\x00\x1f {"targetId":7,"count":3}\x0b', (7, 3), None),
    ('{"targetId":7,"count":-5}', (7, -5), (7, -5)),
    ('{"TargetId":7,"count":3}', None, None),
]


def _decode(spark, strip):
    rows = [(i, line) for i, (line, _, _) in enumerate(TRUTH)]
    df = spark.createDataFrame(rows, "event_id BIGINT, line STRING")
    out = dec.decode_messages(df, strip=strip).orderBy("event_id").collect()
    return [(r["target_id"], r["count"]) if r["target_id"] is not None and r["count"] is not None else None
            for r in out]


@pytest.mark.parametrize("strip", [True, False])
def test_truth_table(spark, strip):
    got = _decode(spark, strip)
    want = [s if strip else n for (_, s, n) in TRUTH]
    assert len(got) == len(TRUTH)
    for (line, _, _), g, w in zip(TRUTH, got, want):
        assert g == w, f"line={line!r} strip={strip}: got {g}, want {w}"


def test_accepted_rejected_partition_rows(spark):
    rows = [(i, line) for i, (line, _, _) in enumerate(TRUTH)]
    df = dec.decode_messages(spark.createDataFrame(rows, "event_id BIGINT, line STRING"))
    n_acc, n_rej = dec.accepted(df).count(), dec.rejected(df).count()
    assert n_acc + n_rej == len(TRUTH)
    assert n_acc == sum(1 for _, s, _ in TRUTH if s is not None)


def test_fail_fast_raises(spark):
    df = spark.createDataFrame([(1, "not json")], "event_id BIGINT, line STRING")
    with pytest.raises(Exception, match="undecodable message"):
        dec.decode_messages(df, fail_fast=True).collect()
    ok = spark.createDataFrame([(1, '{"targetId":1,"count":2}')], "event_id BIGINT, line STRING")
    assert dec.decode_messages(ok, fail_fast=True).count() == 1


def test_parse_once_plan(spark):
    """The JSON parse sits in one generator and filters stay above it; the typed parse of each
    field, for unusual numbers only, sits in the generator after it."""
    df = spark.createDataFrame([(1, '{"targetId":1,"count":2}')], "event_id BIGINT, line STRING")
    plan = dec.accepted(dec.decode_messages(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(targetId,StringType,true), StructField(count,StringType,true)") == 1
    assert plan.count("from_json") == 3
    assert not any("from_json" in line for line in plan.splitlines() if "Filter" in line or "Project" in line)


_text = st.text(alphabet=st.sampled_from(list("ab {}:\"\t\r\n\x00\x0b\x1f\x20\x21é")), max_size=12)


@settings(max_examples=40, deadline=None)
@given(st.lists(_text, min_size=1, max_size=8))
def test_trim_matches_java_rule(spark, texts):
    """trim_control == strip every char <= U+0020 at both ends (Java String.trim)."""
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [r[0] for r in df.select(dec.trim_control("t")).collect()]
    want = [re.sub(r"^[\x00-\x20]+|[\x00-\x20]+$", "", t) for t in texts]
    assert got == want


def test_strip_prefix_only_first(spark):
    df = spark.createDataFrame([("message: message: x",), ("xmessage: y",), ("message: ",)], "l STRING")
    got = [r[0] for r in df.select(dec.strip_prefix("l")).collect()]
    assert got == ["message: x", "xmessage: y", ""]


def test_decode_twice_and_existing_count_column(spark):
    df = spark.createDataFrame([(1, '{"targetId":7,"count":3}', 99)], "event_id BIGINT, line STRING, count INT")
    once = dec.decode_messages(df)
    twice = dec.decode_messages(once)
    for d in (once, twice):
        assert d.columns == ["event_id", "line", "target_id", "count"]
        assert tuple(d.first()) == (1, '{"targetId":7,"count":3}', 7, 3)
