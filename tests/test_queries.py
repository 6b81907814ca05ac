"""Every named query against its SQL counterpart, over whole tables."""

import os

import pytest

import __spark_entry__ as contract
import compare
from framelake.plans import catalogue, oracles
from conftest import SF

# Queries of the optional subpackage have tests of their own.
QUERIES = {name: fn for name, fn in contract.queries().items() if name in catalogue.QUERIES}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(oracles.ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF), con, contract.oracle_sql()[name]) == ""


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["stream_id", "win_start", "packets", "kb", "gbps"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", ["stream_blocks", "stream_hook", "stream_recording"])
def test_streams_over_a_table_that_is_not_in_time_order(spark, tmp_path, monkeypatch, name):
    con = compare.connect(SF)
    for table in compare.TABLES:
        if table != "events":
            os.symlink(f"{SF}/{table}.parquet", tmp_path / f"{table}.parquet")
    con.execute(f"COPY (SELECT * FROM events ORDER BY event_id % 7, ts DESC) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    monkeypatch.setitem(catalogue.FEED_LIMITS, "max_bytes", 4 << 10)
    found = contract.queries()[name](spark, str(tmp_path))
    assert compare.differences(found, compare.connect(str(tmp_path)), contract.oracle_sql()[name]) == ""
