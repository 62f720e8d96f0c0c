"""A few registered queries against DuckDB; ``python tests/oracle.py <sf_dir>`` checks all of them."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = ("ingestion_report", "dedup_exact", "daily_series", "densify_calendar", "target_next_30d", "price_stats", "stream_event_log")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables absent")
@pytest.mark.parametrize("key", SAMPLE)
def test_query_matches_sql(spark, key):
    assert compare(spark, duck(SF_DIR), key, entry.queries()[key], entry.oracle_sql()[key], SF_DIR) is None


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
