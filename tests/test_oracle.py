"""Every registered query against its DuckDB oracle, and the driver smoke entry."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

from conftest import SF_SMOKE

from playtally.plans.batch_queries import BATCH_QUERIES
from playtally.plans.oracle import oracle_sql
from playtally.plans.stream_queries import STREAM_QUERIES

QUERIES = {**BATCH_QUERIES, **STREAM_QUERIES}
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, n, _, detail = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMOKE)
    assert ok, detail
    assert n > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["batch_id", "target_id", "notice_key", "view_count"]
    assert df.count() > 0
