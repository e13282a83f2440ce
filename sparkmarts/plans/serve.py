"""Report queries over the gold marts. Sorting happens here, not in the marts."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import contains_literal, numeric_label
from ..operators.checks import dq_freshness
from .gold import FUNNEL_STEPS

# The counts that a summary adds up.
SUMMED = (
    "total_events", "total_sessions", "total_pageviews", "detail_pageviews", "comparison_pageviews",
    "sessions_with_pageview", "sessions_with_detail_view", "pageview_and_detail", "detail_and_comparison",
)
# Report labels.
REST_OF_BRANDS = "Other brands (remaining)"
STEP_LABELS = ("Pageview", "Product detail", "Select for comparison", "Comparison page", "Sort action")
PERIODS = ("Today", "Last 7 days", "All available", "Custom")


def serve_period(
    period: str, today: date, first_day: date | None = None, last_day: date | None = None, custom=None
) -> tuple[date, date]:
    """Inclusive day bounds of a report period; "Today" never moves back to the latest day with data."""
    if period == "Today":
        return today, today
    if period == "Last 7 days":
        return today - timedelta(days=6), today
    if period == "All available":
        if first_day is None:
            return today, today
        return first_day, max(today, last_day)
    if period == "Custom":
        return tuple(custom) if custom else (today, today)
    raise ValueError(f"unknown period: {period}")


def serve_filter_days(df: DataFrame, start: date, end: date) -> DataFrame:
    return df.filter(F.col("event_date").between(F.lit(start), F.lit(end)))


def serve_summarize_daily(df: DataFrame) -> DataFrame:
    """One row: nine sums and two rates of summed counts; no days give zeros and NULL rates."""
    sums = df.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMMED))
    rate = lambda part, whole: 100 * F.col(part).cast("double") / F.nullif(F.col(whole), F.lit(0)).cast("double")
    return sums.select(
        *SUMMED,
        rate("pageview_and_detail", "sessions_with_pageview").alias("detail_reach_pct"),
        rate("detail_and_comparison", "sessions_with_detail_view").alias("comparison_reach_pct"),
    )


def serve_recency(daily: DataFrame, as_of: datetime) -> DataFrame:
    """Age of the latest event at `as_of`, banded at 24 and 48 hours."""
    return dq_freshness(daily, F.col("latest_event_at"), as_of)


def top_brands(interest: DataFrame, n: int = 10) -> DataFrame:
    return interest.orderBy(F.desc("total_views"), "brand_name").limit(n)


def brand_share(interest: DataFrame, n: int = 6) -> DataFrame:
    """Views of the top n brands and of all others together; the total is kept."""
    brands = interest.select("brand_name", "total_views", "brand_id")
    top = brands.orderBy(F.desc("total_views"), "brand_name", "brand_id").limit(n)
    others = brands.join(top.select("brand_id"), "brand_id", "left_anti").agg(
        F.lit(REST_OF_BRANDS).alias("brand_name"), F.sum("total_views").alias("total_views"), F.count("*").alias("n")
    )
    return top.drop("brand_id").unionByName(others.filter("n > 0").drop("n"))


def top_component_trend(trend: DataFrame, component: str, n: int = 5) -> DataFrame:
    """Views per month for the n components with most views overall (ties by name)."""
    monthly = trend.groupBy("month", component).agg(F.sum("total_views").alias("total_views"))
    leaders = (
        trend.groupBy(component)
        .agg(F.sum("total_views").alias("all_views"))
        .orderBy(F.desc("all_views"), component)
        .limit(n)
    )
    return monthly.join(leaders.select(component), component, "left_semi").select("month", component, "total_views")


def serve_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.orderBy(F.desc("comparison_session_days"))


def serve_specs(specs: DataFrame) -> DataFrame:
    return specs.orderBy(F.desc("total_views"))


def serve_funnel_totals(funnel: DataFrame) -> DataFrame:
    """step, session_days: each step summed over all days."""
    sums = funnel.agg(
        *(F.coalesce(F.sum(step), F.lit(0)).alias(label) for step, label in zip(FUNNEL_STEPS, STEP_LABELS))
    )
    return sums.unpivot([], list(STEP_LABELS), "step", "session_days")


def top_searches(searches: DataFrame, n: int = 25) -> DataFrame:
    return searches.orderBy(F.desc("search_volume"), "search_keyword").limit(n)


def serve_os_totals(platforms: DataFrame) -> DataFrame:
    return platforms.groupBy("user_os").agg(F.sum("sessions").alias("sessions"))


def serve_benchmark_coverage(ranking: DataFrame) -> DataFrame:
    """One row: models, measured batteries, their mean hours (missing ones ignored), models with both measures."""
    hours = F.col("office_battery_hours")
    mean = F.avg(hours)
    return ranking.agg(
        F.count("*").alias("models"),
        F.count(hours).alias("battery_measurements"),
        F.round(mean, 4).alias("mean_battery_hours"),
        numeric_label(mean, " h").alias("mean_battery_label"),
        F.count_if(hours.isNotNull() & F.col("geekbench6_multi").isNotNull()).alias("measured_models"),
    )


def serve_measured(ranking: DataFrame) -> DataFrame:
    """Models with both a battery and a multi-core measurement."""
    return ranking.dropna(subset=["office_battery_hours", "geekbench6_multi"]).select(
        "laptop_name", "brand_name", "office_battery_hours", "geekbench6_multi"
    )


def top_perf_per_kg(efficiency: DataFrame, n: int = 10) -> DataFrame:
    return (
        efficiency.dropna(subset=["performance_per_kg"])
        .orderBy(F.desc("performance_per_kg"), "laptop_model_id")
        .limit(n)
    )


def serve_interest_points(battery: DataFrame) -> DataFrame:
    return battery.dropna(subset=["office_battery_hours"]).select(
        "laptop_name", "brand_name", "office_battery_hours", "total_views"
    )


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key unique on both sides; a repeated key fails the query when it runs.

    Rows per key are counted over the partitioning and order that the join needs anyway.
    """

    def checked(df: DataFrame) -> DataFrame:
        n = F.count("*").over(Window.partitionBy(key))
        repeats = F.raise_error(F.concat(F.lit(f"{key} repeats: "), F.col(key).cast("string")))
        counted = df.withColumn("_n", n)
        return counted.withColumn(key, F.when(F.col("_n") == 1, F.col(key)).otherwise(repeats)).drop("_n")

    return checked(left).join(checked(right), key, "left")


def serve_catalog(
    ranking: DataFrame, interest: DataFrame, brand: str | None = None, query: str | None = None
) -> DataFrame:
    """Active models with their views, by brand and by a literal name search, most viewed first."""
    models = one_to_one(ranking, interest.select("laptop_model_id", "total_views"), "laptop_model_id")
    if brand is not None:
        models = models.filter(F.col("brand_name") == brand)
    if query:
        models = models.filter(contains_literal(F.col("laptop_name"), query))
    return (
        models.withColumn("total_views", F.coalesce("total_views", F.lit(0)))
        .orderBy(F.desc("total_views"), "laptop_name")
        .select(
            "laptop_name", "brand_name", "cpu_name", "gpu_name", "screen_size", "office_battery_hours",
            "geekbench6_multi", "total_views",
        )
    )


def serve_brand_options(ranking: DataFrame) -> DataFrame:
    return ranking.select("brand_name").filter("brand_name is not null").distinct().orderBy("brand_name")
