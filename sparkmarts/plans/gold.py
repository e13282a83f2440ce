"""Gold: the marts read by reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import percent, safe_divide
from ..operators.ranking import add_ranks
from . import counts  # noqa: F401  (registers the counts)
from . import taxonomy as tx
from .registry import relation

# Tier names and their lower bounds.
PERFORMANCE_TIERS = ((12000, "High Performance"), (8000, "Mid-Range"), (4000, "Entry Level"))
PERFORMANCE_FLOOR, PERFORMANCE_MISSING = "Budget", "No Benchmark"
BATTERY_TIERS = ((8, "8h+ (Excellent)"), (6, "6-8h (Good)"), (4, "4-6h (Average)"))
BATTERY_FLOOR, BATTERY_MISSING = "<4h (Poor)", "No Data"


def _tier(value: Column, bounds, floor: str, missing: str) -> Column:
    tier = F.when(value.isNull(), missing)
    for lowest, name in bounds:
        tier = tier.when(value >= lowest, name)
    return tier.otherwise(floor)


def _performance_tier() -> Column:
    return _tier(F.col("geekbench6_multi"), PERFORMANCE_TIERS, PERFORMANCE_FLOOR, PERFORMANCE_MISSING)


# ---------------------------------------------------------------- traffic


@relation
def gold_daily_site_kpis(silver_session_day: DataFrame) -> DataFrame:
    """Business day; co-reach rates count sessions that did both on that day, in any order."""
    daily = silver_session_day.groupBy("event_date").agg(
        F.count("*").alias("total_sessions"),
        F.sum("event_count").alias("total_events"),
        F.sum("pageview_count").alias("total_pageviews"),
        F.sum("detail_pageview_count").alias("detail_pageviews"),
        F.sum("comparison_pageview_count").alias("comparison_pageviews"),
        F.max("latest_event_at").alias("latest_event_at"),
        F.count_if("has_pageview").alias("sessions_with_pageview"),
        F.count_if("has_detail").alias("sessions_with_detail_view"),
        F.count_if("has_comparison").alias("sessions_with_comparison"),
        F.count_if("has_sort").alias("sessions_with_sort"),
        F.count_if(F.col("has_pageview") & F.col("has_detail")).alias("pageview_and_detail"),
        F.count_if(F.col("has_detail") & F.col("has_comparison")).alias("detail_and_comparison"),
    )
    return daily.withColumns(
        {
            "detail_rate_pct": percent(F.col("pageview_and_detail"), F.col("sessions_with_pageview")),
            "comparison_rate_pct": percent(F.col("detail_and_comparison"), F.col("sessions_with_detail_view")),
        }
    )


FUNNEL_STEPS = {
    "step_1_pageview": "reached_pageview",
    "step_2_product_detail": "reached_product_detail",
    "step_3_select_compare": "reached_select_for_comparison",
    "step_4_comparison_page": "reached_comparison_page",
    "step_5_sort_action": "reached_sort_in_comparison",
}


@relation
def gold_behavior_funnel_daily(silver_session_funnel: DataFrame) -> DataFrame:
    # sum, not count_if: a day on which a step is unknown for every session reports NULL.
    return silver_session_funnel.groupBy("event_date").agg(
        F.count("*").alias("total_sessions"),
        *(F.sum(F.col(reached).cast("bigint")).alias(step) for step, reached in FUNNEL_STEPS.items()),
    )


@relation
def gold_search_analytics(search_counts: DataFrame) -> DataFrame:
    return search_counts.groupBy("search_keyword").agg(
        F.sum("n").alias("search_volume"), F.count("*").alias("unique_sessions")
    )


@relation
def gold_user_os(platform_counts: DataFrame) -> DataFrame:
    """Sessions by the first OS and device type that they give at all."""
    # min_by ignores rows whose ordering is NULL: days without a value take no part.
    first = lambda c: F.coalesce(F.min_by(c, f"{c}_at"), F.lit(tx.UNKNOWN)).alias(c)
    sessions = platform_counts.groupBy("session_id").agg(first("user_os"), first("user_device_type"))
    platforms = sessions.groupBy("user_os", F.col("user_device_type").alias("device_type")).agg(
        F.count("*").alias("sessions")
    )
    everyone = platforms.agg(F.sum("sessions")).scalar()
    return platforms.withColumn("session_pct", percent(F.col("sessions"), everyone, 1))


# ---------------------------------------------------------------- product interest


def _laptop_brands(bronze_laptop_model: DataFrame) -> DataFrame:
    """Brand per laptop without the dimension joins of `silver_laptop_model`, which add nothing to it."""
    return bronze_laptop_model.filter("id is not null").select(
        F.col("id").cast("int").alias("laptop_model_id"),
        F.col("brand_id").cast("int").alias("brand_id"),
        F.col("is_active").cast("boolean").alias("is_active"),
    )


def _brands_of_sets(counts: DataFrame, brand_of: DataFrame) -> DataFrame:
    """Brands of each set of laptops, with their number of laptops in it; of a set once, however many sessions have it."""
    sets = counts.select("laptops").distinct()
    return (
        sets.select("laptops", F.explode("laptops").alias("laptop_model_id"))
        .join(brand_of, "laptop_model_id")
        .groupBy("laptops", "brand_id")
        .agg(F.count("*").alias("n_laptops"))
    )


def _component_trend(views: DataFrame, laptops: DataFrame, component: str) -> DataFrame:
    """Views, sessions and products of a month, component and brand.

    A distinct number is a number of rows: sessions after one aggregation to sessions, products after one to
    laptops. Both are stacked, so no row is multiplied for the sake of a distinct count.
    """
    catalog = laptops.filter(F.col(component) != "").select("laptop_model_id", component, "brand_name")
    group, none, one = ["month", component, "brand_name"], F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    sessions = (
        views.join(catalog, "laptop_model_id")
        .groupBy(*group, "session_id")
        .agg(F.sum("n").alias("views"))
        .select(*group, "views", one.alias("sessions"), none.alias("products"))
    )
    products = (
        views.select("month", "laptop_model_id")
        .distinct()
        .join(catalog, "laptop_model_id")
        .select(*group, none.alias("views"), none.alias("sessions"), one.alias("products"))
    )
    return (
        sessions.unionByName(products)
        .groupBy(*group)
        .agg(
            F.sum("views").alias("total_views"),
            F.sum("sessions").alias("unique_sessions"),
            F.sum("products").alias("products_viewed"),
        )
    )


@relation
def gold_cpu_trend(view_counts: DataFrame, silver_laptop_model: DataFrame) -> DataFrame:
    return _component_trend(view_counts, silver_laptop_model, "cpu_name")


@relation
def gold_gpu_trend(view_counts: DataFrame, silver_laptop_model: DataFrame) -> DataFrame:
    return _component_trend(view_counts, silver_laptop_model, "gpu_name")


def spec_totals(laptops: DataFrame, views: DataFrame) -> DataFrame:
    """Products, views and views per product of each configuration; `views` has a row per viewed laptop."""
    specs = ["cpu_name", "gpu_name", "screen_size", "battery_capacity_whr"]
    # Half up in whole numbers: a decimal average is itself rounded before it could be rounded again.
    average = F.expr("cast((2 * sum(views) + count(*)) div (2 * count(*)) as decimal(19,0))")
    return (
        laptops.filter("cpu_name <> ''")
        .select("laptop_model_id", *specs)
        .join(views, "laptop_model_id")
        .groupBy(*specs)
        .agg(
            F.count("*").alias("product_count"),
            F.sum("views").alias("total_views"),
            average.alias("avg_views_per_product"),
        )
    )


@relation
def gold_spec_popularity(view_counts: DataFrame, silver_laptop_model: DataFrame) -> DataFrame:
    # Views are counted per laptop before the join, so the join sees one row per laptop.
    return spec_totals(silver_laptop_model, view_counts.groupBy("laptop_model_id").agg(F.sum("n").alias("views")))


@relation
def gold_brand_interest(
    view_counts: DataFrame, comparison_counts: DataFrame, bronze_laptop_model: DataFrame, silver_brand: DataFrame
) -> DataFrame:
    """Brands with at least one product; session counts are distinct over all time."""
    laptops = _laptop_brands(bronze_laptop_model)
    brand_of = laptops.select("laptop_model_id", "brand_id")
    views = view_counts.join(brand_of, "laptop_model_id").select(
        "brand_id", "session_id", F.col("n").alias("views"), F.lit(0).cast("bigint").alias("comparisons")
    )
    # An event with several laptops of one brand counts once for it.
    comparisons = comparison_counts.join(_brands_of_sets(comparison_counts, brand_of), "laptops").select(
        "brand_id", "session_id", F.lit(0).cast("bigint").alias("views"), F.col("n").alias("comparisons")
    )
    per_session = (
        views.unionByName(comparisons)
        .groupBy("brand_id", "session_id")
        .agg(F.sum("views").alias("views"), F.sum("comparisons").alias("comparisons"))
    )
    viewed, compared = F.col("views") > 0, F.col("comparisons") > 0
    interest = per_session.groupBy("brand_id").agg(
        F.count_if(viewed).alias("view_sessions"),
        F.sum("views").alias("total_views"),
        F.count_if(compared).alias("comparison_sessions"),
        F.sum("comparisons").alias("total_comparisons"),
        F.count_if(viewed & compared).alias("detail_and_comparison_sessions"),
    )
    products = laptops.groupBy("brand_id").agg(
        F.count("*").alias("total_products"), F.count_if("is_active").alias("active_products")
    )
    measures = [c for c in interest.columns if c != "brand_id"]
    brands = (
        silver_brand.join(products, "brand_id")
        .join(interest, "brand_id", "left")
        .select(
            "brand_id", "brand_name", "total_products", "active_products",
            *(F.coalesce(c, F.lit(0)).alias(c) for c in measures),
        )
    )
    # The maximum reads the same columns as the rows do, so both share the shuffles below them.
    top = brands.agg(F.max(F.struct(F.col("total_views").alias("top"), *brands.columns))).scalar()["top"]
    return brands.select(
        "brand_id", "brand_name", "total_products", "active_products", "view_sessions", "total_views",
        "comparison_sessions", "total_comparisons", "detail_and_comparison_sessions",
        safe_divide(F.col("total_views"), top, 3).alias("view_interest_score"),
        percent(F.col("detail_and_comparison_sessions"), F.col("view_sessions")).alias("comparison_rate_pct"),
        safe_divide(F.col("total_views"), F.col("active_products"), 0).alias("views_per_product"),
    )


@relation
def gold_brand_comparison(compared_day_counts: DataFrame, bronze_laptop_model: DataFrame, silver_brand: DataFrame) -> DataFrame:
    """Unordered brand pairs whose laptops were compared in the same session-day.

    Laptop pairs are never listed. Days on which a session compared the same laptops are one row with their
    number; the laptops of a set are counted by brand, once for all sessions that have it. Two brands with m and n
    laptops make m*n pairs a day, one brand with n laptops makes n*(n-1)/2. A laptop without a brand pairs with a
    branded one under that brand.
    """
    brand_of = _laptop_brands(bronze_laptop_model).select("laptop_model_id", "brand_id")
    per_brand = _brands_of_sets(compared_day_counts, brand_of)
    # The window and the join below it share one partitioning and sort by laptops.
    unbranded = F.sum(F.when(F.col("brand_id").isNull(), F.col("n_laptops"))).over(Window.partitionBy("laptops"))
    branded = per_brand.withColumn("n_unbranded", F.coalesce(unbranded, F.lit(0))).filter("brand_id is not null")
    side = lambda s: branded.select(
        "laptops", F.col("brand_id").alias(f"brand_{s}_id"), F.col("n_laptops").alias(f"n_{s}"),
        F.col("n_unbranded").alias(f"n0_{s}"),
    )
    a, b = F.col("brand_a_id"), F.col("brand_b_id")
    # Both sides read the same columns, so the shuffles below the join are done once for the two.
    pairs = F.when(a == b, F.expr("(n_a * (n_b - 1) + n_a * n0_b + n_b * n0_a) div 2")).otherwise(F.expr("n_a * n_b"))
    set_pairs = (
        side("a")
        .join(side("b"), "laptops")
        .filter(a <= b)
        .select("laptops", "brand_a_id", "brand_b_id", pairs.alias("pairs"))
        .filter("pairs > 0")
    )
    counted = (
        compared_day_counts.withColumnRenamed("n", "days")
        .join(set_pairs, "laptops")
        .groupBy("brand_a_id", "brand_b_id", "session_id")
        .agg(F.sum("days").alias("days"), F.sum(F.col("pairs") * F.col("days")).alias("pairs"))
        .groupBy("brand_a_id", "brand_b_id")
        .agg(
            F.count("*").alias("comparison_sessions"),
            F.sum("days").alias("comparison_session_days"),
            F.sum("pairs").alias("comparison_count"),
        )
    )
    names = lambda side: silver_brand.select(
        F.col("brand_id").alias(f"brand_{side}_id"), F.col("brand_name").alias(f"brand_{side}")
    )
    return (
        counted.join(names("a"), "brand_a_id")
        .join(names("b"), "brand_b_id")
        .select(
            "brand_a_id", "brand_b_id", "brand_a", "brand_b", "comparison_sessions", "comparison_session_days",
            "comparison_count", F.when(a == b, "Same Brand").otherwise("Cross Brand").alias("comparison_type"),
        )
    )


# ---------------------------------------------------------------- hardware


@relation
def gold_performance_ranking(
    silver_laptop_model: DataFrame, silver_laptop_benchmark_result: DataFrame
) -> DataFrame:
    active = silver_laptop_model.filter("is_active").join(silver_laptop_benchmark_result, "laptop_model_id", "left")
    columns = [
        "laptop_model_id", "laptop_name", "brand_name", "cpu_name", "gpu_name", "screen_size",
        "battery_capacity_whr", "laptop_weight_kg", "office_battery_minutes", "office_battery_hours",
        "gaming_battery_minutes", "gaming_battery_hours", "geekbench6_single", "geekbench6_multi",
    ]
    ranked = add_ranks(
        active.select(*columns),
        within="brand_name",
        measures={
            "geekbench6_multi": ("geekbench_rank_in_brand", "geekbench_rank_overall"),
            "office_battery_minutes": ("battery_rank_in_brand", "battery_rank_overall"),
        },
    )
    return ranked.select(
        *columns,
        "geekbench_rank_in_brand", "battery_rank_in_brand", "geekbench_rank_overall", "battery_rank_overall",
        _performance_tier().alias("performance_tier"),
    )


@relation
def gold_performance_efficiency(
    silver_laptop_model: DataFrame, silver_laptop_benchmark_result: DataFrame
) -> DataFrame:
    multi, on_battery = F.col("geekbench6_multi"), F.col("geekbench6_multi_battery")
    battery, weight = F.col("battery_capacity_whr"), F.col("laptop_weight_kg")
    # The kept share is rounded to four places before it becomes a percentage.
    drop = F.round((F.lit(1) - safe_divide(on_battery, multi, 4)) * 100, 2)
    return (
        silver_laptop_model.filter("is_active and is_visible")
        .join(silver_laptop_benchmark_result.filter("geekbench6_multi is not null"), "laptop_model_id")
        .select(
            "laptop_model_id", "laptop_name", "brand_name", "laptop_weight_kg", "battery_capacity_whr",
            "office_battery_hours", "office_battery_minutes", "geekbench6_multi", "geekbench6_multi_battery",
            safe_divide(multi, battery).alias("performance_per_wh"),
            safe_divide(multi, weight).alias("performance_per_kg"),
            safe_divide(F.col("office_battery_minutes"), battery).alias("battery_efficiency_mins_per_wh"),
            F.when(multi > 0, drop).alias("performance_drop_pct"),
        )
    )


@relation
def gold_battery_vs_interest(
    silver_laptop_model: DataFrame,
    silver_laptop_benchmark_result: DataFrame,
    view_counts: DataFrame,
    comparison_counts: DataFrame,
) -> DataFrame:
    none = F.lit(0).cast("bigint")
    views = (
        view_counts.groupBy("laptop_model_id", "session_id")
        .agg(F.sum("n").alias("views"))
        .select("laptop_model_id", "views", F.lit(1).cast("bigint").alias("sessions"), none.alias("comparisons"))
    )
    comparisons = comparison_counts.select(
        F.explode("laptops").alias("laptop_model_id"), none.alias("views"), none.alias("sessions"), F.col("n").alias("comparisons")
    )
    interest = (
        views.unionByName(comparisons)
        .groupBy("laptop_model_id")
        .agg(
            F.sum("views").alias("total_views"),
            F.sum("sessions").alias("view_sessions"),
            F.sum("comparisons").alias("comparison_events"),
        )
    )
    hours = F.col("office_battery_hours")
    return (
        silver_laptop_model.filter("is_active")
        .join(silver_laptop_benchmark_result, "laptop_model_id", "left")
        .join(interest, "laptop_model_id", "left")
        .select(
            "laptop_model_id", "laptop_name", "brand_name", "cpu_name", "gpu_name",
            "office_battery_hours", "gaming_battery_hours", "geekbench6_single", "geekbench6_multi",
            *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total_views", "view_sessions", "comparison_events")),
            _tier(hours, BATTERY_TIERS, BATTERY_FLOOR, BATTERY_MISSING).alias("battery_tier"),
            _performance_tier().alias("performance_tier"),
        )
    )
