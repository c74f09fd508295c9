"""Physical-plan properties of the registered batch queries (scale guards)."""

import pytest

from playtally.plans.batch_queries import BATCH_QUERIES

from conftest import SF_SMOKE

# Scans of events over all jobs of a query, eager writes and scalars included. scan_from_offsets
# reads them for the ledger and for the messages.
MAX_EVENT_SCANS = {"scan_from_offsets": 2}


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_plan_properties(spark, name):
    plan = _final_plan(BATCH_QUERIES[name](spark, SF_SMOKE))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in plan, f"{name}: {bad}"
    # aggregates run with a map-side partial step before their shuffle
    if "functions=[sum(" in plan or "functions=[min(" in plan:
        assert "partial_" in plan, f"{name}: aggregate without a partial step"


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_events_are_scanned_once(spark, name, monkeypatch):
    """Counted over every plan that a write of the query runs, not only the last one."""
    from pyspark.sql import DataFrameWriter

    plans = []
    kind = type(spark.range(0))
    first, parquet = kind.first, DataFrameWriter.parquet

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: (noted(w._df), parquet(w, *a, **k))[1])
    monkeypatch.setattr(kind, "first", lambda df: (noted(df), first(df))[1])
    noted(BATCH_QUERIES[name](spark, SF_SMOKE))
    scans = sum(p.count("user_id#") > 0 or "event_id#" in p for p in plans)
    assert scans <= MAX_EVENT_SCANS.get(name, 1), f"{name}: {scans} scans of events"


def test_message_scan_prunes_columns(spark):
    plan = _final_plan(BATCH_QUERIES["offset_ledger"](spark, SF_SMOKE))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_decode_parses_once(spark):
    plan = _final_plan(BATCH_QUERIES["batch_counts"](spark, SF_SMOKE))
    # One parse of both fields as text; the typed ones are for unusual numbers only.
    assert plan.count("from_json(StructField(targetId,StringType,true), StructField(count,StringType,true)") == 1
    assert not any("from_json" in line for line in plan.splitlines() if "Filter" in line)
