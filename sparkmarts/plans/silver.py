"""Silver: typed, cleaned and deduplicated relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    blank_to_null,
    business_date,
    clean_text,
    epoch_to_timestamp,
    json_fields,
    laptop_id_number,
    safe_divide,
    valid_laptop_id,
)
from ..operators.versions import newest_per_key
from ..schemas import EVENT_KEY, EVENT_TS
from . import taxonomy as tx
from .registry import relation


# ---------------------------------------------------------------- catalog


@relation
def silver_brand(bronze_brand: DataFrame) -> DataFrame:
    return bronze_brand.filter("id is not null").select(
        F.col("id").cast("int").alias("brand_id"), clean_text(F.col("name")).alias("brand_name")
    )


@relation
def silver_cpu_model(bronze_cpu_model: DataFrame) -> DataFrame:
    return bronze_cpu_model.filter("id is not null").select(
        F.col("id").cast("int").alias("cpu_id"), clean_text(F.col("name")).alias("cpu_name")
    )


@relation
def silver_gpu_model(bronze_gpu_model: DataFrame) -> DataFrame:
    # GPU names keep their inner white space; only the ends are trimmed.
    return bronze_gpu_model.filter("id is not null").select(
        F.col("id").cast("int").alias("gpu_id"), F.trim("name").alias("gpu_name")
    )


@relation
def silver_laptop_model(
    bronze_laptop_model: DataFrame, silver_brand: DataFrame, silver_cpu_model: DataFrame, silver_gpu_model: DataFrame
) -> DataFrame:
    amount = "decimal(18,4)"
    laptops = bronze_laptop_model.filter("id is not null").select(
        F.col("id").cast("int").alias("laptop_model_id"),
        clean_text(F.col("name")).alias("laptop_name"),
        F.col("brand_id").cast("int").alias("brand_id"),
        F.col("cpu_model_id").cast("int").alias("cpu_id"),
        F.col("gpu_model_id").cast("int").alias("gpu_id"),
        F.col("screen_size").cast(amount).alias("screen_size"),
        F.col("laptop_weight").cast(amount).alias("laptop_weight_kg"),
        F.col("battery_capacity_whr").cast(amount).alias("battery_capacity_whr"),
        F.col("is_visible").cast("boolean").alias("is_visible"),
        F.col("is_active").cast("boolean").alias("is_active"),
    )
    # No broadcast hints: Spark broadcasts a dimension only while its size is under the threshold.
    return (
        laptops.join(silver_brand, "brand_id", "left")
        .join(silver_cpu_model, "cpu_id", "left")
        .join(silver_gpu_model, "gpu_id", "left")
        .select(
            "laptop_model_id", "laptop_name", "brand_id", "brand_name", "cpu_id", "cpu_name", "gpu_id", "gpu_name",
            "screen_size", "laptop_weight_kg", "battery_capacity_whr", "is_visible", "is_active",
        )
    )


@relation
def silver_laptop_benchmark_result(bronze_laptop_benchmark_result: DataFrame) -> DataFrame:
    """The benchmark with the highest id stands for its laptop."""
    amount = "decimal(18,4)"
    sixty = F.lit(60)
    typed = bronze_laptop_benchmark_result.filter("laptop_model_id is not null").select(
        F.col("id").cast("bigint").alias("id"),
        F.col("laptop_model_id").cast("int").alias("laptop_model_id"),
        F.col("office_battery_result_minutes").cast(amount).alias("office_battery_minutes"),
        F.col("gaming_battery_result_minutes").cast(amount).alias("gaming_battery_minutes"),
        F.col("geekbench_6_cpu_single_core_plugged_in").cast("int").alias("geekbench6_single"),
        F.col("geekbench_6_cpu_multi_core_plugged_in").cast("int").alias("geekbench6_multi"),
        F.col("geekbench_6_cpu_multi_core_battery").cast("int").alias("geekbench6_multi_battery"),
    )
    # NULL ids sort first, as in the source dialect, so that the not-null check can see them.
    chosen = newest_per_key(typed, ["laptop_model_id"], [F.col("id").desc_nulls_first()])
    return chosen.select(
        F.col("id").cast("int").alias("benchmark_id"),
        "laptop_model_id",
        "office_battery_minutes",
        "gaming_battery_minutes",
        "geekbench6_single",
        "geekbench6_multi",
        "geekbench6_multi_battery",
        safe_divide(F.col("office_battery_minutes"), sixty, 1).alias("office_battery_hours"),
        safe_divide(F.col("gaming_battery_minutes"), sixty, 1).alias("gaming_battery_hours"),
    )


# ---------------------------------------------------------------- events

EVENT_COLUMNS = (
    "id", "event_name", "session_id", "event_timestamp", "server_timestamp", "device_id", "page_name",
    "source_page_name", "search_keyword", "sort_by", "sort_direction", "device_ids_raw", "user_os",
    "user_os_version", "user_browser", "user_device_type", "event_data", "device",
)


def eligible_events(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("event_name").isNotNull() & F.col("session_id").isNotNull())


def newest_events(events: DataFrame) -> DataFrame:
    payload_order = F.xxhash64("event_data", "device", "event_local_timestamp", "session_id", "event_name")
    return newest_per_key(events, [EVENT_KEY], [F.col(EVENT_TS).desc_nulls_first(), payload_order.desc()])


def parse_events(raw: DataFrame) -> DataFrame:
    """Adds the typed columns; each JSON text is parsed once, in one pass over its keys."""
    data, agent = F.col("_data"), F.col("_agent")
    source_page = data["page_name"]
    compares = F.col("event_name").isin(*tx.CHART_EVENTS) | source_page.isin(*tx.COMPARE_PAGE_ALIASES)
    return (
        raw.withColumn("_data", json_fields(F.col("event_data"), tx.EVENT_DATA_KEYS))
        .withColumn("_agent", json_fields(F.col("device"), tx.DEVICE_KEYS))
        .select(
            *raw.columns,
            epoch_to_timestamp(F.col("event_local_timestamp")).alias("event_timestamp"),
            epoch_to_timestamp(F.col(EVENT_TS)).alias("server_timestamp"),
            valid_laptop_id(data["device_id"]).alias("device_id"),
            F.when(compares, tx.COMPARE_PAGE).otherwise(source_page).alias("page_name"),
            source_page.alias("source_page_name"),
            data["keyword"].alias("search_keyword"),
            data["sort_by"].alias("sort_by"),
            data["sort_direction"].alias("sort_direction"),
            data["device_ids"].alias("device_ids_raw"),
            F.coalesce(agent["os"], agent["os_name"]).alias("user_os"),
            agent["os_version"].alias("user_os_version"),
            agent["browser"].alias("user_browser"),
            agent["device_type"].alias("user_device_type"),
        )
    )


@relation
def silver_user_event_tracking(bronze_user_event_tracking: DataFrame) -> DataFrame:
    """Newest version per event id, parsed.

    Parsing comes before the shuffle on id: a reader of a few columns then moves those alone, not the
    JSON texts. Use `silver_event_table` where all columns are written out.
    """
    return newest_events(parse_events(eligible_events(bronze_user_event_tracking))).select(*EVENT_COLUMNS)


def silver_event_table(raw: DataFrame) -> DataFrame:
    """Same rows, deduplicated first: the shuffle moves the raw columns only, not the parsed copies."""
    return parse_events(newest_events(eligible_events(raw))).select(*EVENT_COLUMNS)


# ---------------------------------------------------------------- sessions


@relation
def silver_session_day(silver_user_event_tracking: DataFrame) -> DataFrame:
    return silver_user_event_tracking.groupBy(
        business_date(F.col("server_timestamp")).alias("event_date"), "session_id"
    ).agg(
        F.count("*").alias("event_count"),
        F.max("server_timestamp").alias("latest_event_at"),
        F.count_if(tx.is_pageview()).alias("pageview_count"),
        F.count_if(tx.is_detail_view()).alias("detail_pageview_count"),
        F.count_if(tx.is_compare_view()).alias("comparison_pageview_count"),
        F.bool_or(tx.is_pageview()).alias("has_pageview"),
        F.bool_or(tx.is_detail_view()).alias("has_detail"),
        F.bool_or(tx.is_selection()).alias("has_select_compare"),
        F.bool_or(tx.is_compare_view()).alias("has_comparison"),
        F.bool_or(tx.is_sort_action()).alias("has_sort"),
    )


@relation
def silver_session_funnel(silver_session_day: DataFrame) -> DataFrame:
    return silver_session_day.select(
        "session_id",
        "event_date",
        F.col("has_pageview").alias("reached_pageview"),
        F.col("has_detail").alias("reached_product_detail"),
        F.col("has_select_compare").alias("reached_select_for_comparison"),
        F.col("has_comparison").alias("reached_comparison_page"),
        F.col("has_sort").alias("reached_sort_in_comparison"),
    )


def arrival_order() -> Column:
    """Order of (server time, id) in one fixed-width number: micros first, then room for any 64-bit id."""
    micros = F.unix_micros("server_timestamp").cast("decimal(17,0)")
    return micros * F.lit("1" + "0" * 20).cast("decimal(21,0)") + F.col("id").cast("decimal(19,0)")


@relation
def silver_session_activity(silver_user_event_tracking: DataFrame) -> DataFrame:
    """One row per session over all time, with its first non-blank OS and device type.

    Events are first reduced to the few combinations of event name, OS and device type of a session, in a
    hash aggregation with fixed-width states; the string-valued "first by arrival" then sees those alone.
    """

    def ever(condition):
        return F.max(F.when(condition, 1).otherwise(0))

    compared = tx.is_compare_view() | F.col("event_name").isin(*tx.SELECT_EVENTS, tx.CHART_SORT)
    flags = {
        "has_pageview": tx.is_pageview(),
        "has_product_detail_view": tx.is_detail_view(),
        "has_comparison": compared,
    }
    arrival = arrival_order()
    first_given = ("user_os", "user_device_type")
    combinations = silver_user_event_tracking.groupBy(
        "session_id", "event_name", *(blank_to_null(F.col(c)).alias(c) for c in first_given)
    ).agg(
        F.min("server_timestamp").alias("started"),
        F.max("server_timestamp").alias("ended"),
        F.count("*").alias("n"),
        F.min(arrival).alias("arrival"),
        *(ever(condition).alias(flag) for flag, condition in flags.items()),
    )
    # min_by ignores rows whose ordering is NULL: combinations without a value take no part.
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("arrival")))
    return combinations.groupBy("session_id").agg(
        F.min("started").alias("session_start"),
        business_date(F.min("started")).alias("session_start_date"),
        F.max("ended").alias("session_end"),
        F.sum("n").alias("event_count"),
        F.count_distinct("event_name").alias("distinct_event_types"),
        *(F.max(flag).cast("boolean").alias(flag) for flag in flags),
        *(F.coalesce(first(c), F.lit(tx.UNKNOWN)).alias(c) for c in first_given),
    )


# ---------------------------------------------------------------- comparison


def compared_laptops(events: DataFrame) -> DataFrame:
    """Comparison events with the distinct laptops they name: the event's own device and its device list."""
    eligible = events.filter(F.col("event_name").isin(*tx.SELECT_EVENTS, *tx.CHART_EVENTS) | tx.is_compare_view())
    # NULL for anything but a JSON array.
    listed = F.coalesce(F.from_json("device_ids_raw", "array<string>"), F.array().cast("array<string>"))
    candidates = F.concat(F.array("device_id"), listed)
    laptop_ids = F.array_distinct(
        F.transform(candidates, lambda text: laptop_id_number(valid_laptop_id(text)))
    )
    return eligible.select(
        F.col("id").alias("event_id"),
        "session_id",
        business_date(F.col("server_timestamp")).alias("event_date"),
        "server_timestamp",
        F.array_compact(laptop_ids).alias("laptops"),
    )


@relation
def silver_comparison_event_device(silver_user_event_tracking: DataFrame) -> DataFrame:
    """One row per comparison event and laptop.

    Event ids are unique in the event table, so a pair can only repeat inside one row; removing
    repeats from that row's array makes the result distinct without a shuffle.
    """
    return compared_laptops(silver_user_event_tracking).select(
        "event_id", "session_id", "event_date", "server_timestamp", F.explode("laptops").alias("laptop_model_id")
    )


@relation
def silver_comparison_session_device(silver_comparison_event_device: DataFrame) -> DataFrame:
    return (
        silver_comparison_event_device.groupBy("session_id", "laptop_model_id", "event_date")
        .agg(F.min("server_timestamp").alias("first_seen_at"), F.count("*").alias("interaction_count"))
        .select("session_id", "laptop_model_id", "first_seen_at", "event_date", "interaction_count")
    )


@relation
def silver_comparison_sort_event(silver_user_event_tracking: DataFrame) -> DataFrame:
    return silver_user_event_tracking.filter(tx.on_page(tx.COMPARE_PAGE) & (F.col("sort_by") != "")).select(
        "session_id",
        "sort_by",
        "sort_direction",
        "server_timestamp",
        business_date(F.col("server_timestamp")).alias("event_date"),
    )


@relation
def silver_device_traffic_event(silver_user_event_tracking: DataFrame) -> DataFrame:
    known = lambda column, name: F.coalesce(F.col(column), F.lit(tx.UNKNOWN)).alias(name)
    return silver_user_event_tracking.filter(tx.is_pageview()).select(
        "session_id",
        business_date(F.col("server_timestamp")).alias("event_date"),
        known("user_os", "user_os"),
        known("user_device_type", "device_type"),
        known("user_browser", "browser"),
        laptop_id_number(F.col("device_id")).alias("laptop_model_id"),
    )
