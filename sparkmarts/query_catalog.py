"""Every operator and relation as a query over a directory of test tables."""

from __future__ import annotations

import tempfile
import uuid
from collections import ChainMap
from collections.abc import Callable, Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import epoch_to_timestamp
from .operators import checks, versions
from .plans import incremental, ingest, pipeline, quality, reconcile, serve, silver
from .plans.registry import Marts
from .schemas import BRONZE_NAMES, EVENT_TS, EVENTS, GOLD_NAMES, RAW_SCHEMAS, SILVER_NAMES
from .session import pin_utc
from .sources import scan
from .sources.driver_tables import RawTables
from .sources.store import TableStore

Query = Callable[[SparkSession, str], DataFrame]

# The clock and the ranges of the registered queries; the test events cover January 2024.
AS_OF = datetime(2024, 1, 31, 12, 0, 0)
TODAY = date(2024, 1, 28)
MID_MONTH = 1705363200.0  # 2024-01-16T00:00:00Z
RANGE = (MID_MONTH, MID_MONTH + 3 * 86400.0)
LOOKBACK = 7200
CORRECTED, UNNAMED, LATE = 1705017600.0, 1705190400.0, 1706140800.0  # 12, 14 and 25 January 2024, 00:00 UTC
WHOLE_MONTH = 31 * 86400


def marts(spark: SparkSession, sf_dir: str) -> Marts:
    pin_utc(spark)
    return Marts(RawTables(spark, sf_dir))


def present(df: DataFrame) -> DataFrame:
    """Portable result types: exact decimals as doubles, instants as zone-less UTC timestamps."""

    def shown(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select(*(shown(field) for field in df.schema.fields))


def scratch_store(spark: SparkSession) -> TableStore:
    """A store in the cluster's shared folder; a temporary one only where everything runs on one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        shared = tempfile.gettempdir()
    store = TableStore(spark, f"{shared.rstrip('/')}/sparkmarts-store-{uuid.uuid4().hex}")
    store.drop_at_exit()
    return store


# ---------------------------------------------------------------- versioned inputs


def changed(df: DataFrame, shift: float = 0.0, blank: bool = False) -> DataFrame:
    df = df.withColumn(EVENT_TS, F.col(EVENT_TS) + shift)
    return df.withColumn("event_data", F.lit("{}")) if blank else df


def named(df: DataFrame, event: str) -> DataFrame:
    return df.filter(F.col("event_name") == event)


def versions_batch(events: DataFrame) -> DataFrame:
    """All events, stale versions of the clicks, and replays of the chart sorts."""
    stale = changed(named(events, "click"), shift=-3600, blank=True)
    return events.unionByName(stale).unionByName(named(events, "comparison_chart_sort_selection"))


def versions_target(events: DataFrame) -> DataFrame:
    """The events of the first half month as stored: pageviews an hour older, searches an hour newer."""
    shift = (
        F.when(F.col("event_name") == "pageview", -3600.0)
        .when(F.col("event_name") == "search_for_device", 3600.0)
        .otherwise(0.0)
    )
    return events.filter(F.col(EVENT_TS) < MID_MONTH).withColumn(EVENT_TS, F.col(EVENT_TS) + shift)


def blank_clicks(events: DataFrame) -> DataFrame:
    """All events once, the clicks with another payload at the same instant."""
    return events.withColumn("event_data", F.when(F.col("event_name") == "click", "{}").otherwise(F.col("event_data")))


def contested(events: DataFrame) -> DataFrame:
    """All events, and the searches a second time with another payload at the same instant."""
    return events.unionByName(changed(named(events, "search_for_device"), blank=True))


def damaged(events: DataFrame) -> DataFrame:
    """Ids lost where the session is unknown, endless timestamps where the name is unknown."""
    return events.withColumns(
        {
            "id": F.when(F.col("session_id").isNotNull(), F.col("id")),
            EVENT_TS: F.when(F.col("event_name").isNotNull(), F.col(EVENT_TS)).otherwise(float("inf")),
        }
    )


def cut_short(events: DataFrame) -> DataFrame:
    """Payloads of session-less events without their last character."""
    text = F.col("event_data")
    return events.withColumn(
        "event_data", F.when(F.col("session_id").isNull(), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    )


def with_table(m: Mapping[str, DataFrame], name: str, **columns) -> Mapping[str, DataFrame]:
    """The relations, one of them with other values in some columns: a check has to find them."""
    return ChainMap({name: m[name].withColumns(columns)}, m)


SEEDED = {
    "dq_daily_event_counts": lambda m: with_table(
        m, "gold_daily_site_kpis", total_events=F.col("total_events") + F.dayofmonth("event_date") % 2
    ),
    "dq_daily_rates": lambda m: with_table(
        m,
        "gold_daily_site_kpis",
        total_sessions=F.when(F.dayofmonth("event_date") % 2 == 1, F.col("total_events") + 1).otherwise(F.col("total_sessions")),
    ),
    "dq_gold_definitions": lambda m: with_table(
        m, "gold_brand_comparison", brand_a_id=F.col("brand_b_id"), brand_b_id=F.col("brand_a_id")
    ),
    "dq_gold_totals": lambda m: with_table(m, "gold_user_os", sessions=F.col("sessions") * 2),
    "dq_source_taxonomy": lambda m: with_table(
        m, "silver_user_event_tracking", user_os=F.when(F.col("user_os") != "Windows", F.col("user_os"))
    ),
}


def first_delivery(events: DataFrame) -> DataFrame:
    """The events up to 24 January as they came first: pageviews of two days half a day earlier and without payload,
    and events of a third day with a session that a later version takes away."""
    at = F.col(EVENT_TS)
    moved = (F.col("event_name") == "pageview") & (at >= CORRECTED) & (at < UNNAMED)
    lost = F.col("session_id").isNull() & (at >= UNNAMED) & (at < UNNAMED + 86400)
    return events.filter(at < LATE).withColumns(
        {
            "event_data": F.when(moved, "{}").otherwise(F.col("event_data")),
            "session_id": F.when(lost, "ghost").otherwise(F.col("session_id")),
            EVENT_TS: F.when(moved, at - 43200).when(lost, at - 60).otherwise(at),
        }
    )


# ---------------------------------------------------------------- registration


def _over_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(build(marts(spark, sf_dir)[EVENTS]))


def _over_marts(build: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(build(marts(spark, sf_dir)))


def _relation(name: str) -> Query:
    return _over_marts(lambda m: m[name])


def _ingested(spark: SparkSession, sf_dir: str) -> TableStore:
    """Two ingestion runs into an empty store: the first half month, then everything past the watermark."""
    pin_utc(spark)
    store = scratch_store(spark)
    raw = RawTables(spark, sf_dir)
    first = {name: raw[name] for name in RAW_SCHEMAS}
    first[EVENTS] = first[EVENTS].filter(F.col(EVENT_TS) < MID_MONTH)
    ingest.run_ingest(store, scan.FrameSource(first), lookback_seconds=LOOKBACK)
    ingest.run_ingest(store, scan.FrameSource({name: raw[name] for name in RAW_SCHEMAS}), lookback_seconds=LOOKBACK)
    return store


def _stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_ingested(spark, sf_dir).read(EVENTS))


def _built_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(pipeline.build(_ingested(spark, sf_dir), full_refresh=True)["gold_daily_site_kpis"])


_KEPT_UP: dict[tuple[str, str], tuple[TableStore, list[str]]] = {}


def kept_up(spark: SparkSession, sf_dir: str) -> tuple[TableStore, list[str]]:
    """A store after a full build of the first delivery and an incremental one of everything that came later, and the
    days that the second replaced. Made once a session and directory."""
    made = (spark.sparkContext.applicationId, sf_dir)
    if made not in _KEPT_UP:
        pin_utc(spark)
        store, raw = scratch_store(spark), RawTables(spark, sf_dir)
        tables = {name: raw[name] for name in RAW_SCHEMAS}
        ingest.run_ingest(store, scan.FrameSource({**tables, EVENTS: first_delivery(tables[EVENTS])}))
        pipeline.build(store, test=False)
        before = store.days("silver_session_day")
        ingest.run_ingest(store, scan.FrameSource(tables), lookback_seconds=WHOLE_MONTH)
        pipeline.build(store, lookback_seconds=WHOLE_MONTH, test=False, invalidate=True)
        after = store.days("silver_session_day")
        changed = sorted(day for day in before.keys() | after.keys() if before.get(day) != after.get(day))
        _KEPT_UP[made] = store, changed
    return _KEPT_UP[made]


def _kept_up(name: str) -> Query:
    return lambda spark, sf_dir: present(pipeline.StoredTables(kept_up(spark, sf_dir)[0])[name])


def _changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = kept_up(spark, sf_dir)[1]
    return spark.createDataFrame([(day,) for day in days], "day string").select(F.to_date("day").alias("event_date"))


# What is kept up to date from changed days: relations by day, and marts over counts.
KEPT_UP = (
    *incremental.DAILY_SILVER, *incremental.DAILY_GOLD, "gold_brand_interest", "gold_brand_comparison", "gold_cpu_trend",
    "gold_gpu_trend", "gold_spec_popularity", "gold_battery_vs_interest", "gold_search_analytics", "gold_user_os",
)


def _incremental() -> dict[str, Query]:
    return {f"incremental_{name}": _kept_up(name) for name in KEPT_UP} | {"incremental_changed_days": _changed_days}


def _ingestion() -> dict[str, Query]:
    start, end = RANGE
    return {
        "scan_snapshot": lambda spark, sf: present(scan.scan_snapshot(scan.FrameSource(RawTables(spark, sf)), "laptop_model")),
        "scan_range": _over_events(lambda e: scan.scan_range(e, scan.Period(start, end))),
        "scan_incremental": _over_events(lambda e: scan.scan_incremental(e, versions_target(e), LOOKBACK)),
        "watermark": _over_events(scan.watermark),
        "batch_violations": _over_events(lambda e: versions.batch_violations(damaged(e))),
        "batch_latest": _over_events(lambda e: versions.batch_latest(versions_batch(e))),
        "batch_conflicts": _over_events(lambda e: versions.batch_conflicts(contested(e))),
        "upsert_versions": _over_events(
            lambda e: versions.upsert_versions(versions.batch_latest(versions_batch(e)), versions_target(e))
        ),
        "upsert_counts": _over_events(lambda e: versions.upsert_counts(versions_batch(e), versions_target(e))),
        "upsert_conflicts": _over_events(
            lambda e: versions.upsert_conflicts(blank_clicks(e), versions_target(e))
        ),
        "silver_incremental": _over_events(
            lambda e: pipeline.silver_incremental(
                versions.batch_latest(versions_batch(e)), silver.silver_event_table(versions_target(e)), LOOKBACK
            )
        ),
        "stored_events": _stored_events,
        "built_daily_kpis": _built_daily,
    }


def _quality() -> dict[str, Query]:
    generic = {
        "dq_unique": _over_events(lambda e: checks.dq_unique(versions_batch(e), "id")),
        "dq_not_null": _over_events(lambda e: checks.dq_not_null(e, "session_id")),
        "dq_relationships": _over_marts(
            lambda m: checks.dq_relationships(
                m["silver_laptop_model"], "laptop_model_id", m["silver_laptop_benchmark_result"], "laptop_model_id"
            )
        ),
        "dq_accepted_values": _over_events(lambda e: checks.dq_accepted_values(e, "event_name", ["pageview", "click"])),
        "dq_freshness": _over_events(lambda e: checks.dq_freshness(e, epoch_to_timestamp(F.col(EVENT_TS)), AS_OF)),
        "json_valid": _over_events(lambda e: quality.json_valid({EVENTS: cut_short(e)})),
        # Stored half a month ago: everything later is missing, pageviews and searches carry other instants.
        "dq_raw_to_silver_stale": _over_events(
            lambda e: quality.dq_raw_to_silver(
                {EVENTS: e, "silver_user_event_tracking": silver.silver_event_table(versions_target(e))}
            )
        ),
    }
    relation_checks = (
        quality.dq_daily_event_counts, quality.dq_daily_rates, quality.dq_gold_definitions, quality.gold_totals,
        quality.dq_gold_totals, quality.dq_raw_to_silver, quality.dq_source_taxonomy,
    )
    plain = {check.__name__: _over_marts(check) for check in relation_checks}
    seeded = {f"{name}_seeded": _seeded(name) for name in SEEDED}
    return {**generic, **plain, **seeded}


def _seeded(name: str) -> Query:
    check = getattr(quality, name)
    return _over_marts(lambda m: check(SEEDED[name](m)))


def _reconciliation() -> dict[str, Query]:
    everything = (*RAW_SCHEMAS, *BRONZE_NAMES, *SILVER_NAMES, *GOLD_NAMES)
    return {
        "row_counts": _over_marts(lambda m: reconcile.row_counts(m, everything)),
        "reconcile_duplicates": _over_events(lambda e: reconcile.reconcile_duplicates({EVENTS: versions_batch(e)})),
        "reconcile_raw_silver": _over_marts(reconcile.reconcile_raw_silver),
        "reconcile_daily": _over_marts(reconcile.reconcile_daily),
        "reconcile_totals": _over_marts(reconcile.reconcile_totals),
        "reconcile_report": _over_marts(reconcile.reconcile_report),
        "independent_daily": _over_marts(reconcile.independent_daily),
        "raw_range_snapshot": _over_marts(lambda m: reconcile.raw_range_snapshot(m, *RANGE)),
        "replay_equal": _over_marts(
            lambda m: reconcile.replay_equal(
                reconcile.row_counts(m, (EVENTS, "brand")),
                reconcile.row_counts(ChainMap({EVENTS: versions_batch(m[EVENTS])}, m), (EVENTS, "brand")),
            )
        ),
        "layer_snapshot": _over_marts(reconcile.layer_snapshot),
    }


def _period(name: str, **known) -> Query:
    return _over_marts(lambda m: serve.serve_filter_days(m["gold_daily_site_kpis"], *serve.serve_period(name, TODAY, **known)))


def available_days(daily: DataFrame) -> DataFrame:
    """The period "All available" over the days that there are."""
    first, last = daily.agg(F.min("event_date"), F.max("event_date")).first()
    return serve.serve_filter_days(daily, *serve.serve_period("All available", TODAY, first_day=first, last_day=last))


def _serving() -> dict[str, Query]:
    week = serve.serve_period("Last 7 days", TODAY)
    return {
        "serve_period": _period("Today"),
        "serve_period_all": _period("All available", first_day=date(2024, 1, 10), last_day=date(2024, 1, 20)),
        "serve_period_available": _over_marts(lambda m: available_days(m["gold_daily_site_kpis"])),
        "serve_period_custom": _period("Custom", custom=(date(2024, 1, 3), date(2024, 1, 6))),
        "serve_filter_days": _over_marts(lambda m: serve.serve_filter_days(m["gold_daily_site_kpis"], *week)),
        "serve_summarize_daily": _over_marts(
            lambda m: serve.serve_summarize_daily(serve.serve_filter_days(m["gold_daily_site_kpis"], *week))
        ),
        "serve_recency": _over_marts(lambda m: serve.serve_recency(m["gold_daily_site_kpis"], AS_OF)),
        "top_brands": _over_marts(lambda m: serve.top_brands(m["gold_brand_interest"])),
        "brand_share": _over_marts(lambda m: serve.brand_share(m["gold_brand_interest"])),
        "top_component_trend": _over_marts(lambda m: serve.top_component_trend(m["gold_gpu_trend"], "gpu_name")),
        "serve_pairs": _over_marts(lambda m: serve.serve_pairs(m["gold_brand_comparison"])),
        "serve_specs": _over_marts(lambda m: serve.serve_specs(m["gold_spec_popularity"])),
        "serve_funnel_totals": _over_marts(lambda m: serve.serve_funnel_totals(m["gold_behavior_funnel_daily"])),
        "top_searches": _over_marts(lambda m: serve.top_searches(m["gold_search_analytics"])),
        "serve_os_totals": _over_marts(lambda m: serve.serve_os_totals(m["gold_user_os"])),
        "serve_benchmark_coverage": _over_marts(lambda m: serve.serve_benchmark_coverage(m["gold_performance_ranking"])),
        "serve_measured": _over_marts(lambda m: serve.serve_measured(m["gold_performance_ranking"])),
        "top_perf_per_kg": _over_marts(lambda m: serve.top_perf_per_kg(m["gold_performance_efficiency"])),
        "serve_interest_points": _over_marts(lambda m: serve.serve_interest_points(m["gold_battery_vs_interest"])),
        "serve_catalog": _over_marts(
            lambda m: serve.serve_catalog(
                m["gold_performance_ranking"], m["gold_battery_vs_interest"], brand="Brand#7", query="RING"
            )
        ),
        "serve_catalog_all": _over_marts(
            lambda m: serve.serve_catalog(m["gold_performance_ranking"], m["gold_battery_vs_interest"])
        ),
        "serve_brand_options": _over_marts(lambda m: serve.serve_brand_options(m["gold_performance_ranking"])),
    }


def queries() -> dict[str, Query]:
    relations = {name: _relation(name) for name in (*BRONZE_NAMES, *SILVER_NAMES, *GOLD_NAMES)}
    return {**relations, **_ingestion(), **_incremental(), **_quality(), **_reconciliation(), **_serving()}
