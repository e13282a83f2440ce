"""Reconciliation of the layers: counts and daily totals compared across raw, silver and gold."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import business_date, fingerprint
from ..schemas import EVENT_TS, LAYERS

Tables = Mapping[str, DataFrame]


class ReconciliationFailed(RuntimeError):
    pass


def row_counts(t: Tables, names: tuple[str, ...]) -> DataFrame:
    """relation, n_rows for the given relations, in one job."""
    counts = (t[name].agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("relation"), "n_rows") for name in names)
    return reduce(DataFrame.unionByName, counts)


def raw_event_counts(t: Tables) -> DataFrame:
    """One row over the raw events: all rows, rows beyond the first per id, rows fit for silver."""
    # A count per id, not a distinct count next to plain ones: each id crosses the shuffle once per task.
    fit = F.col("event_name").isNotNull() & F.col("session_id").isNotNull()
    per_id = t["user_event_tracking"].groupBy("id").agg(F.count("*").alias("n"), F.count_if(fit).alias("fit"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_events"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("id")).alias("duplicate_raw_ids"),
        F.coalesce(F.sum("fit"), F.lit(0)).alias("expected_silver"),
    )


def reconcile_duplicates(t: Tables) -> DataFrame:
    return raw_event_counts(t).select("duplicate_raw_ids")


def reconcile_raw_silver(t: Tables) -> DataFrame:
    silver = t["silver_user_event_tracking"].agg(F.count("*").alias("silver_events"))
    return raw_event_counts(t).select("expected_silver", silver.scalar().alias("silver_events"))


def daily_mismatches(t: Tables) -> DataFrame:
    """Days on which the event table and the daily mart differ in events or sessions."""
    counted = (
        t["silver_user_event_tracking"]
        .groupBy(business_date(F.col("server_timestamp")).alias("event_date"))
        .agg(F.count("*").alias("events"), F.count_distinct("session_id").alias("sessions"))
    )
    reported = t["gold_daily_site_kpis"].select("event_date", "total_events", "total_sessions")
    same = F.col("events").eqNullSafe(F.col("total_events")) & F.col("sessions").eqNullSafe(F.col("total_sessions"))
    return counted.join(reported, "event_date", "full").filter(~same)


def reconcile_daily(t: Tables) -> DataFrame:
    return daily_mismatches(t).agg(F.count("*").alias("daily_metric_mismatches"))


def reconcile_totals(t: Tables) -> DataFrame:
    """One row: raw against bronze, silver against gold."""
    count = lambda name: t[name].agg(F.count("*").alias("n")).scalar()
    gold = t["gold_daily_site_kpis"].agg(F.coalesce(F.sum("total_events"), F.lit(0)).alias("gold_daily_events"))
    return gold.select(
        count("user_event_tracking").alias("raw_events"),
        count("bronze_user_event_tracking").alias("bronze_events"),
        count("silver_user_event_tracking").alias("silver_events"),
        "gold_daily_events",
    )


def reconcile_report(t: Tables) -> DataFrame:
    """One summary row with a verdict."""
    scalar = lambda df: df.scalar()
    report = reconcile_totals(t).select(
        "*",
        scalar(reconcile_duplicates(t)).alias("duplicate_raw_ids"),
        scalar(raw_event_counts(t).select("expected_silver")).alias("expected_silver"),
        scalar(reconcile_daily(t)).alias("daily_metric_mismatches"),
    )
    sound = (
        (F.col("duplicate_raw_ids") == 0)
        & (F.col("daily_metric_mismatches") == 0)
        & (F.col("expected_silver") == F.col("silver_events"))
        & (F.col("raw_events") == F.col("bronze_events"))
        & (F.col("gold_daily_events") == F.col("silver_events"))
    )
    return report.withColumn("reconciled", sound)


EXPECTED_INVENTORY = {layer: len(names) for layer, names in LAYERS.items()}


def reconcile(t: Tables, inventory: Mapping[str, int]) -> dict:
    """The summary as a dict; raises when the inventory or any total is off."""
    if dict(inventory) != EXPECTED_INVENTORY:
        raise ReconciliationFailed(f"relations per layer: {dict(inventory)}, expected {EXPECTED_INVENTORY}")
    report = reconcile_report(t).first().asDict()
    if not report.pop("reconciled"):
        raise ReconciliationFailed(f"layers disagree: {report}")
    # The stored relations' counts come from their files' footers.
    stored = row_counts(t, (*LAYERS["raw"], "silver_user_event_tracking", *LAYERS["gold"]))
    return {**report, "relations": dict(inventory), "rows": {r["relation"]: r["n_rows"] for r in stored.collect()}}


def independent_daily(t: Tables) -> DataFrame:
    """Events and sessions per business day straight from the raw epochs, by another route than the marts:
    the zone conversion is done on the shifted instant instead of through the shared date helper."""
    fit = t["user_event_tracking"].filter("event_name is not null and session_id is not null")
    local = F.convert_timezone(
        F.lit("UTC"), F.lit("Asia/Ho_Chi_Minh"), F.timestamp_micros(F.rint(F.col(EVENT_TS) * 1_000_000).cast("bigint")).cast("timestamp_ntz")
    )
    return (
        fit.select(F.date_format(local, "yyyy-MM-dd").cast("date").alias("event_date"), "session_id", "id")
        .groupBy("event_date")
        .agg(F.count_distinct("id").alias("total_events"), F.count_distinct("session_id").alias("total_sessions"))
    )


def raw_range_snapshot(t: Tables, start: float, end: float) -> DataFrame:
    """One row: raw events, watermark, and events within [start, end)."""
    at = F.col(EVENT_TS)
    return t["user_event_tracking"].agg(
        F.count("*").alias("events"),
        F.max(at).alias("watermark"),
        F.count_if((at >= start) & (at < end)).alias("events_in_range"),
    )


# Columns of the layer fingerprint.
FINGERPRINT = {
    "user_event_tracking": ("id", EVENT_TS, "session_id", "event_data"),
    "silver_user_event_tracking": ("id", "server_timestamp", "session_id", "event_data"),
    "gold_daily_site_kpis": ("event_date", "total_events", "total_sessions"),
}


def layer_snapshot(t: Tables) -> DataFrame:
    """relation, n_rows and an order-free fingerprint, equal before and after a replay."""
    # The hashes are added as 38-digit decimals, so that no number of rows overflows.
    prints = (
        t[name]
        .select(fingerprint(*(F.col(c) for c in columns)).cast("decimal(38,0)").alias("h"))
        .agg(F.count("*").alias("n_rows"), F.sum("h").alias("total"))
        .select(F.lit(name).alias("relation"), "n_rows", F.col("total").cast("string").alias("fingerprint"))
        for name, columns in FINGERPRINT.items()
    )
    return reduce(DataFrame.unionByName, prints)


def replay_equal(before: DataFrame, after: DataFrame) -> DataFrame:
    """Relations whose count changed between two `row_counts` results; empty after a clean replay."""
    left = before.select("relation", F.col("n_rows").alias("rows_before"))
    right = after.select("relation", F.col("n_rows").alias("rows_after"))
    return left.join(right, "relation", "full").filter(~F.col("rows_before").eqNullSafe(F.col("rows_after")))
