"""Signed counts: what the all-time marts need of the events, as keys with a number that can be added and taken back.

Every count is additive over business days: the counts of two sets of days are those of either set, added. So a day
whose rows changed is taken in by subtracting what its old rows count and adding what its new rows do, and a distinct
number of sessions is the number of keys with a count above zero.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null, business_date, business_month, laptop_id_number
from . import taxonomy as tx
from .registry import relation
from .silver import arrival_order, compared_laptops

EVENTS_TABLE, BRIDGE = "silver_user_event_tracking", "silver_comparison_event_device"


@dataclass(frozen=True)
class Count:
    source: str  # the table by day that it counts
    keys: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame]  # the keys of the source's rows, each with n

    def of(self, source: DataFrame) -> DataFrame:
        return added(self.rows(source), self.keys)


def added(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys with the sum of n; those that cancel out are gone."""
    return rows.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0")


def _one() -> Column:
    return F.lit(1).cast("bigint").alias("n")


def detail_views(events: DataFrame) -> DataFrame:
    return events.filter(tx.is_detail_view() & F.col("device_id").isNotNull()).select(
        "session_id", "server_timestamp", laptop_id_number(F.col("device_id")).alias("laptop_model_id")
    )


def _views(events: DataFrame) -> DataFrame:
    month = business_month(F.col("server_timestamp")).alias("month")
    return detail_views(events).select(month, "laptop_model_id", "session_id", _one())


def _searches(events: DataFrame) -> DataFrame:
    keyword = F.lower(blank_to_null(F.col("search_keyword"))).alias("search_keyword")
    return events.filter(F.col("event_name") == tx.SEARCH).select(keyword, "session_id", _one()).filter("search_keyword is not null")


def _comparisons(events: DataFrame) -> DataFrame:
    """Events by their session and the laptops they compare."""
    laptops = F.sort_array("laptops").alias("laptops")
    return compared_laptops(events).filter(F.size("laptops") > 0).select("session_id", laptops, _one())


def _compared_days(bridge: DataFrame) -> DataFrame:
    """Session-days by their session and the laptops compared on the day (at most the catalog's)."""
    return (
        bridge.groupBy("session_id", "event_date")
        .agg(F.sort_array(F.collect_set("laptop_model_id")).alias("laptops"))
        .select("session_id", "laptops", _one())
    )


PLATFORM = ("user_os", "user_device_type")


def _platforms(events: DataFrame) -> DataFrame:
    """Session-days by the first OS and device type they give and when; the first of a session is the first of these."""
    given = [blank_to_null(F.col(c)).alias(c) for c in PLATFORM]
    # Fixed-width states first: few combinations of a session-day are left for the string-valued minimum.
    combinations = events.groupBy("session_id", business_date(F.col("server_timestamp")).alias("event_date"), *given).agg(
        F.min(arrival_order()).alias("arrival")
    )
    at = lambda c: F.when(F.col(c).isNotNull(), F.col("arrival"))
    days = combinations.groupBy("session_id", "event_date").agg(
        *(F.min_by(c, at(c)).alias(c) for c in PLATFORM), *(F.min(at(c)).alias(f"{c}_at") for c in PLATFORM)
    )
    return days.select("session_id", *PLATFORM, *(f"{c}_at" for c in PLATFORM), _one())


COUNTS: dict[str, Count] = {
    "view_counts": Count(EVENTS_TABLE, ("month", "laptop_model_id", "session_id"), _views),
    "search_counts": Count(EVENTS_TABLE, ("search_keyword", "session_id"), _searches),
    "comparison_counts": Count(EVENTS_TABLE, ("session_id", "laptops"), _comparisons),
    "compared_day_counts": Count(BRIDGE, ("session_id", "laptops"), _compared_days),
    "platform_counts": Count(EVENTS_TABLE, ("session_id", *PLATFORM, *(f"{c}_at" for c in PLATFORM)), _platforms),
}


# Over events that are not kept by day the same counts are ordinary relations.


@relation
def view_counts(silver_user_event_tracking: DataFrame) -> DataFrame:
    return COUNTS["view_counts"].of(silver_user_event_tracking)


@relation
def search_counts(silver_user_event_tracking: DataFrame) -> DataFrame:
    return COUNTS["search_counts"].of(silver_user_event_tracking)


@relation
def comparison_counts(silver_user_event_tracking: DataFrame) -> DataFrame:
    return COUNTS["comparison_counts"].of(silver_user_event_tracking)


@relation
def compared_day_counts(silver_comparison_session_device: DataFrame) -> DataFrame:
    return COUNTS["compared_day_counts"].of(silver_comparison_session_device)


@relation
def platform_counts(silver_user_event_tracking: DataFrame) -> DataFrame:
    return COUNTS["platform_counts"].of(silver_user_event_tracking)
