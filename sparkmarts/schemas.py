"""Raw table contracts and the relation inventory."""

from __future__ import annotations

from pyspark.sql import types as T

_AMOUNT = T.DecimalType(18, 4)


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in pairs])


_NAMED = _fields(("id", T.IntegerType()), ("name", T.StringType()))

RAW_SCHEMAS: dict[str, T.StructType] = {
    "brand": _NAMED,
    "cpu_model": _NAMED,
    "gpu_model": _NAMED,
    "laptop_model": _fields(
        ("id", T.IntegerType()),
        ("name", T.StringType()),
        ("brand_id", T.IntegerType()),
        ("cpu_model_id", T.IntegerType()),
        ("gpu_model_id", T.IntegerType()),
        ("screen_size", _AMOUNT),
        ("laptop_weight", _AMOUNT),
        ("battery_capacity_whr", _AMOUNT),
        ("is_visible", T.BooleanType()),
        ("is_active", T.BooleanType()),
    ),
    "laptop_benchmark_result": _fields(
        ("id", T.LongType()),
        ("laptop_model_id", T.IntegerType()),
        ("office_battery_result_minutes", _AMOUNT),
        ("gaming_battery_result_minutes", _AMOUNT),
        ("geekbench_6_cpu_single_core_plugged_in", T.IntegerType()),
        ("geekbench_6_cpu_multi_core_plugged_in", T.IntegerType()),
        ("geekbench_6_cpu_multi_core_battery", T.IntegerType()),
    ),
    "user_event_tracking": _fields(
        ("id", T.LongType()),
        ("session_id", T.StringType()),
        ("event_name", T.StringType()),
        ("event_local_timestamp", T.DoubleType()),
        ("event_received_on_server_timestamp", T.DoubleType()),
        ("event_data", T.StringType()),
        ("device", T.StringType()),
    ),
}

EVENTS = "user_event_tracking"
EVENT_KEY = "id"
EVENT_TS = "event_received_on_server_timestamp"
SNAPSHOT_TABLES = tuple(name for name in RAW_SCHEMAS if name != EVENTS)

BRONZE_NAMES = tuple(f"bronze_{name}" for name in RAW_SCHEMAS)
SILVER_NAMES = (
    "silver_brand",
    "silver_cpu_model",
    "silver_gpu_model",
    "silver_laptop_model",
    "silver_laptop_benchmark_result",
    "silver_user_event_tracking",
    "silver_session_day",
    "silver_session_funnel",
    "silver_session_activity",
    "silver_comparison_event_device",
    "silver_comparison_session_device",
    "silver_comparison_sort_event",
    "silver_device_traffic_event",
)
GOLD_NAMES = (
    "gold_daily_site_kpis",
    "gold_behavior_funnel_daily",
    "gold_brand_interest",
    "gold_brand_comparison",
    "gold_cpu_trend",
    "gold_gpu_trend",
    "gold_spec_popularity",
    "gold_performance_ranking",
    "gold_performance_efficiency",
    "gold_battery_vs_interest",
    "gold_search_analytics",
    "gold_user_os",
)
LAYERS = {"raw": tuple(RAW_SCHEMAS), "bronze": BRONZE_NAMES, "silver": SILVER_NAMES, "gold": GOLD_NAMES}
