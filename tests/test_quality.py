"""Every data test on clean input and on input with one seeded defect; reconciliation; freshness bands."""

from datetime import datetime, timedelta, timezone

import pytest
from fixture_data import FIRST_OF_MARCH, catalog, event, frame, raw_frames
from pyspark.sql import functions as F

from sparkmarts.operators import checks
from sparkmarts.operators.versions import prepare_batch
from sparkmarts.plans import pipeline, quality, reconcile  # noqa: F401
from sparkmarts.plans.registry import Marts
from sparkmarts.schemas import EVENT_TS, EVENTS, GOLD_NAMES, RAW_SCHEMAS, SILVER_NAMES


@pytest.fixture(scope="module")
def clean(spark):
    """All relations of the fixture, held as plain tables so that single ones can be damaged."""
    frames = raw_frames(spark)
    frames[EVENTS] = prepare_batch(frames[EVENTS])
    marts = Marts(frames)
    return {name: marts[name].cache() for name in (*RAW_SCHEMAS, *SILVER_NAMES, *GOLD_NAMES)}


TESTS = {test.name: test for test in quality.declared_tests()}


def failing(tables, name):
    return TESTS[name].violations(tables).count()


def null(column):
    return lambda df: df.withColumn(column, F.lit(None).cast(df.schema[column].dataType))


def twice(df):
    return df.unionByName(df)


def put(column, value):
    return lambda df: df.withColumn(column, F.lit(value).cast(df.schema[column].dataType))


def defects():
    for layer, keys in quality.KEYS.items():
        for table, column in keys:
            yield f"unique_{table}_{column}", table, twice
            yield f"not_null_{table}_{column}", table, null(column)
    for columns in quality.REQUIRED.values():
        for table, column in columns:
            yield f"not_null_{table}_{column}", table, null(column)
    for table, column, _ in quality.RELATED:
        yield f"relationships_{table}_{column}", table, put(column, 77)
    yield "dq_daily_event_counts", "gold_daily_site_kpis", put("total_events", 3)
    yield "dq_daily_rates", "gold_daily_site_kpis", put("detail_rate_pct", 101)
    yield "dq_daily_rates", "gold_daily_site_kpis", null("detail_rate_pct")
    yield "dq_daily_rates", "gold_daily_site_kpis", put("total_sessions", 99)
    yield "dq_gold_definitions", "gold_brand_interest", put("comparison_rate_pct", 101)
    yield "dq_gold_definitions", "gold_brand_comparison", put("brand_b_id", 0)
    yield "dq_gold_definitions", "gold_behavior_funnel_daily", twice
    yield "dq_gold_definitions", "silver_session_day", lambda df: df.withColumn("event_date", F.date_add("event_date", 1))
    for table in ("gold_daily_site_kpis", "gold_behavior_funnel_daily", "gold_user_os", "gold_search_analytics",
                  "gold_cpu_trend", "gold_gpu_trend", "gold_brand_interest", "gold_spec_popularity"):
        yield "dq_gold_totals", table, twice
    silver = "silver_user_event_tracking"
    for column, value in (("event_name", "x"), ("session_id", "x"), ("event_data", "{}"), ("device", None)):
        yield "dq_raw_to_silver", silver, put(column, value)
    yield "dq_raw_to_silver", silver, lambda df: df.filter("id <> 1")
    yield "dq_raw_to_silver", EVENTS, lambda df: df.filter("id <> 1")
    yield "dq_raw_to_silver", silver, lambda df: df.withColumn("server_timestamp", F.expr("server_timestamp + interval 1 second"))
    yield "dq_source_taxonomy", silver, put("user_os", "BeOS")
    yield "dq_source_taxonomy", "gold_behavior_funnel_daily", put("step_3_select_compare", 9)
    yield "dq_source_taxonomy", "silver_comparison_event_device", twice


def test_there_are_48_tests_and_all_pass(clean):
    assert len(TESTS) == 48
    for layer in ("raw", "silver", "gold"):
        assert set(quality.run_tests(clean, layer).values()) == {0}


@pytest.mark.parametrize("name, table, damage", list(defects()))
def test_seeded_defect_is_found(clean, name, table, damage):
    assert failing({**clean, table: damage(clean[table])}, name) > 0


def test_accepted_values(spark):
    flags = spark.createDataFrame([("y",), ("n",), ("maybe",), (None,), ("maybe",)], "flag string")
    assert [tuple(r) for r in checks.dq_accepted_values(flags, "flag", ["y", "n"]).collect()] == [("maybe", 2)]


def test_a_failing_test_names_its_layer(clean):
    with pytest.raises(quality.DataTestsFailed) as failed:
        quality.run_tests({**clean, "silver_brand": twice(clean["silver_brand"])}, "silver")
    assert (failed.value.layer, set(failed.value.failures)) == ("silver", {"unique_silver_brand_brand_id"})


def test_failed_gate_stops_the_build(spark, store):
    from sparkmarts.plans import ingest
    from sparkmarts.sources import scan

    rows = catalog()
    rows["laptop_model"] = [(*r[:2], 77, *r[3:]) for r in rows["laptop_model"]]  # a brand nobody knows
    source = {name: frame(spark, name, r) for name, r in rows.items()}
    source[EVENTS] = frame(spark, EVENTS, [event(1, "s", "pageview", FIRST_OF_MARCH, page_name="Home")])
    ingest.run_ingest(store, scan.FrameSource(source), lookback_seconds=0)
    with pytest.raises(quality.DataTestsFailed, match="relationships_silver_laptop_model_brand_id"):
        pipeline.build(store, full_refresh=True)
    assert store.exists(pipeline.SILVER_EVENTS)
    assert pipeline.missing_gold(store) == list(GOLD_NAMES)


def test_json_valid(spark):
    rows = [event(1, "s", "e", 1.0), (2, "s", "e", 1.0, 1.0, '{"a":', "{}"), (3, "s", "e", 1.0, 1.0, None, "nope")]
    assert sorted(r["id"] for r in quality.json_valid({EVENTS: frame(spark, EVENTS, rows)}).collect()) == [2, 3]


@pytest.mark.parametrize(
    "hours, status", [(0, "pass"), (24, "pass"), (24.01, "warn"), (48, "warn"), (48.01, "error")]
)
def test_freshness_bands(spark, hours, status):
    at = datetime(2026, 10, 1, tzinfo=timezone.utc)
    df = spark.createDataFrame([(at.timestamp(),), (at.timestamp() - 999,)], f"{EVENT_TS} double")
    row = checks.dq_freshness(df, F.timestamp_seconds(EVENT_TS), at + timedelta(hours=hours)).first()
    assert row["status"] == status and abs(row["age_hours"] - hours) < 1e-6


def test_freshness_of_nothing_is_an_error(spark):
    df = spark.createDataFrame([], f"{EVENT_TS} double")
    assert checks.dq_freshness(df, F.timestamp_seconds(EVENT_TS), datetime.now(timezone.utc)).first()["status"] == "error"


def test_reconciliation(clean):
    inventory = {"raw": 6, "bronze": 6, "silver": 13, "gold": 12}
    tables = {**clean, "bronze_user_event_tracking": clean[EVENTS]}
    report = reconcile.reconcile(tables, inventory)
    assert (report["raw_events"], report["gold_daily_events"], report["daily_metric_mismatches"]) == (13, 12, 0)
    assert report["relations"] == inventory and report["rows"][EVENTS] == 13 and len(report["rows"]) == 19
    with pytest.raises(reconcile.ReconciliationFailed, match="per layer"):
        reconcile.reconcile(tables, {**inventory, "gold": 11})
    for table in (EVENTS, "gold_daily_site_kpis", "silver_user_event_tracking"):
        with pytest.raises(reconcile.ReconciliationFailed):
            reconcile.reconcile({**tables, table: twice(tables[table])}, inventory)


def test_replay_equal(spark):
    before = spark.createDataFrame([("a", 1), ("b", 2)], "relation string, n_rows bigint")
    after = spark.createDataFrame([("a", 1), ("b", 3), ("c", 0)], "relation string, n_rows bigint")
    assert reconcile.replay_equal(before, before).isEmpty()
    assert sorted(r["relation"] for r in reconcile.replay_equal(before, after).collect()) == ["b", "c"]


def test_layer_snapshot_sees_values_that_trade_places(spark, clean):
    swapped = clean[EVENTS].withColumns({"session_id": F.col("event_data"), "event_data": F.col("session_id")})
    prints = [reconcile.layer_snapshot({**clean, EVENTS: df}).first()["fingerprint"] for df in (clean[EVENTS], swapped)]
    assert prints[0] != prints[1]
