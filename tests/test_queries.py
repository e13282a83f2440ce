"""Each registered query against its DuckDB statement, and the scale properties of its plan."""

import os

import harness
import pytest

import __spark_entry__ as entry_point
import oracles
from sparkmarts import query_catalog

SF_DIR = os.path.join(harness.TESTDATA, os.environ.get("ORACLE_SF", "sf0.001"))
QUERIES = query_catalog.queries()
ORACLES = oracles.oracle_sql()
WITHOUT_ORACLE = {"layer_snapshot"}  # a hash of Spark's own

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return harness.duck(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_ORACLE
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, duck, name):
    assert harness.differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == ""


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_layer_snapshot(spark):
    rows = QUERIES["layer_snapshot"](spark, SF_DIR).collect()
    assert [r["relation"] for r in rows] == ["user_event_tracking", "silver_user_event_tracking", "gold_daily_site_kpis"]


def test_available_period_has_every_day(spark):
    days = QUERIES["serve_period_available"](spark, SF_DIR).select("event_date")
    daily = QUERIES["gold_daily_site_kpis"](spark, SF_DIR).select("event_date")
    assert sorted(days.collect()) == sorted(daily.collect())


def test_conflict_batch_is_whole(spark):
    events = query_catalog.marts(spark, SF_DIR)[query_catalog.EVENTS]
    batch = query_catalog.blank_clicks(events)
    assert batch.count() == events.count()
    assert batch.select("id", "event_name").exceptAll(events.select("id", "event_name")).isEmpty()
