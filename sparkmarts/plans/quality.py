"""The data tests: relation-specific checks, the declared generic tests, and a layer-by-layer runner."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    blank_to_null,
    business_date,
    epoch_to_timestamp,
    fingerprint,
    is_json,
    json_fields,
    laptop_id_number,
)
from ..operators import checks
from ..schemas import EVENT_TS
from . import taxonomy as tx

Tables = Mapping[str, DataFrame]


def _stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------------- checks over relations


def dq_daily_event_counts(t: Tables) -> DataFrame:
    """Days whose event count in the event table and in the daily mart disagree."""
    counted = (
        t["silver_user_event_tracking"]
        .groupBy(business_date(F.col("server_timestamp")).alias("event_date"))
        .agg(F.count("*").alias("counted"))
    )
    reported = t["gold_daily_site_kpis"].select("event_date", "total_events")
    return (
        counted.join(reported, "event_date", "full")
        .filter(~F.col("counted").eqNullSafe(F.col("total_events")))
        .select("event_date")
    )


def dq_daily_rates(t: Tables) -> DataFrame:
    """Days with fewer events than sessions, a rate out of bounds, or a rate missing though it has a base."""
    out_of_bounds = lambda rate: ~F.col(rate).between(0, 100)
    return t["gold_daily_site_kpis"].filter(
        (F.col("total_events") < F.col("total_sessions"))
        | out_of_bounds("detail_rate_pct")
        | out_of_bounds("comparison_rate_pct")
        | ((F.col("sessions_with_pageview") > 0) & F.col("detail_rate_pct").isNull())
        | ((F.col("sessions_with_detail_view") > 0) & F.col("comparison_rate_pct").isNull())
    )


def dq_gold_definitions(t: Tables) -> DataFrame:
    """Broken mart definitions: brand rates, pair direction, funnel grain, session-day time zone."""
    label = lambda df, name: df.select(F.lit(name).alias("failure"))
    brands = t["gold_brand_interest"].filter(
        ~F.col("comparison_rate_pct").between(0, 100)
        | (F.col("detail_and_comparison_sessions") > F.col("view_sessions"))
    )
    pairs = t["gold_brand_comparison"].filter("brand_a_id > brand_b_id")
    funnel = checks.dq_unique(t["gold_behavior_funnel_daily"], "event_date")
    # The days are reduced to distinct session-days before they meet the session-day table.
    seen = (
        t["silver_user_event_tracking"]
        .select("session_id", business_date(F.col("server_timestamp")).alias("event_date"))
        .distinct()
    )
    strays = t["silver_session_day"].join(seen, ["session_id", "event_date"], "left_anti")
    return _stack(
        [
            label(brands, "brand_rate"),
            label(pairs, "brand_pair_direction"),
            label(funnel, "funnel_daily_grain"),
            label(strays, "daily_timezone"),
        ]
    )


def _as_rows(one_row: DataFrame, value: str) -> DataFrame:
    """A one-row frame of measures turned into (metric, value) rows."""
    return one_row.unpivot([], one_row.columns, "metric", value)


def _total(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(name))


def gold_totals(t: Tables) -> DataFrame:
    """metric, expected, actual for nine totals that gold has to preserve.

    The event table is read once for all its expected totals, the session-day table once for its two.
    """
    events, laptops = t["silver_user_event_tracking"], t["silver_laptop_model"]
    searched = (F.col("event_name") == tx.SEARCH) & blank_to_null(F.col("search_keyword")).isNotNull()
    from_events = events.agg(
        F.count("*").alias("daily_events"),
        F.count_distinct("session_id").alias("os_sessions"),
        F.count_if(searched).alias("search_events"),
    )
    views_per_laptop = (
        events.filter(tx.is_detail_view() & F.col("device_id").isNotNull())
        .groupBy(laptop_id_number(F.col("device_id")).alias("laptop_model_id"))
        .agg(F.count("*").alias("views"))
    )
    seen = views_per_laptop.join(laptops.select("laptop_model_id", "cpu_name", "gpu_name"), "laptop_model_id")
    named = lambda column: F.when(F.col(column) != "", F.col("views"))
    whole = lambda column: F.coalesce(F.sum(column), F.lit(0))
    from_views = seen.agg(
        whole(named("cpu_name")).alias("cpu_detail_views"),
        whole(named("gpu_name")).alias("gpu_detail_views"),
        whole("views").alias("brand_detail_views"),
        whole(named("cpu_name")).alias("spec_detail_views"),
    )
    from_days = t["silver_session_day"].agg(
        F.count("*").alias("session_days"), F.count("*").alias("funnel_session_days")
    )
    expected = _stack(_as_rows(frame, "expected") for frame in (from_events, from_views, from_days))
    actual = _stack(
        _as_rows(_total(t[table], column, metric), "actual")
        for metric, table, column in (
            ("daily_events", "gold_daily_site_kpis", "total_events"),
            ("session_days", "gold_daily_site_kpis", "total_sessions"),
            ("funnel_session_days", "gold_behavior_funnel_daily", "total_sessions"),
            ("os_sessions", "gold_user_os", "sessions"),
            ("search_events", "gold_search_analytics", "search_volume"),
            ("cpu_detail_views", "gold_cpu_trend", "total_views"),
            ("gpu_detail_views", "gold_gpu_trend", "total_views"),
            ("brand_detail_views", "gold_brand_interest", "total_views"),
            ("spec_detail_views", "gold_spec_popularity", "total_views"),
        )
    )
    return expected.join(actual, "metric")


def dq_gold_totals(t: Tables) -> DataFrame:
    return gold_totals(t).filter(~F.col("expected").eqNullSafe(F.col("actual")))


def _compare_by_id(left: DataFrame, right: DataFrame, values: Sequence[str]) -> DataFrame:
    """Per id: rows on either side, and whether all of them carry the same values.

    Both sides are stacked and grouped, so ids and 8-byte fingerprints are all that moves, once, and the
    rows of a repeated id collapse before they do.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("id", F.lit(name).alias("side"), fingerprint(*(F.col(v) for v in values)).alias("mark"))

    return (
        side(left, "left")
        .unionByName(side(right, "right"))
        .groupBy("id")
        .agg(
            F.count_if(F.col("side") == "left").alias("n_left"),
            F.count_if(F.col("side") == "right").alias("n_right"),
            (F.min("mark") == F.max("mark")).alias("same"),
        )
    )


def dq_raw_to_silver(t: Tables) -> DataFrame:
    """Ids missing on either side, or stored in silver with another instant, name, session or payload."""
    values = ["at", "event_name", "session_id", "event_data", "device"]
    sent = t["user_event_tracking"].filter("event_name is not null and session_id is not null")
    compared = _compare_by_id(
        sent.withColumn("at", epoch_to_timestamp(F.col(EVENT_TS))),
        t["silver_user_event_tracking"].withColumn("at", F.col("server_timestamp")),
        values,
    )
    return compared.filter("n_left = 0 or n_right = 0 or not same").select("id")


def dq_source_taxonomy(t: Tables) -> DataFrame:
    """OS mapping, selection reach against the funnel, and repeats in the comparison bridge."""
    events = t["silver_user_event_tracking"]
    # Read again from the raw text, by the rule for repeated keys that silver uses.
    sent = json_fields(F.col("device"), ("os", "os_name"))
    sent_os = F.coalesce(sent["os"], sent["os_name"])
    compared = _compare_by_id(
        t["user_event_tracking"].withColumn("os", sent_os), events.withColumn("os", F.col("user_os")), ["os"]
    )
    os_mapping = compared.filter("n_left > 0 and n_right > 0 and not same").select(
        F.lit("source_os_mapping").alias("failure")
    )
    reached = (
        events.filter(tx.is_selection())
        .select("session_id", business_date(F.col("server_timestamp")).alias("event_date"))
        .distinct()
        .agg(F.count("*").alias("reached"))
    )
    step = t["gold_behavior_funnel_daily"].agg(
        F.coalesce(F.sum("step_3_select_compare"), F.lit(0)).alias("reported")
    )
    selection = (
        reached.select("reached", step.scalar().alias("reported"))
        .filter(~F.col("reached").eqNullSafe(F.col("reported")))
        .select(F.lit("selection_reach").alias("failure"))
    )
    repeats = (
        t["silver_comparison_event_device"]
        .groupBy("event_id", "laptop_model_id")
        .agg(F.count("*").alias("n_rows"))
        .filter("n_rows > 1")
        .select(F.lit("comparison_bridge_duplicate").alias("failure"))
    )
    return _stack([os_mapping, selection, repeats])


def json_valid(t: Tables) -> DataFrame:
    """Event ids whose payload or device text is not one JSON value.

    The source dialect fails on such a text; Spark reads NULL fields from it, so it is a raw test: the build
    stops before silver.
    """
    return t["user_event_tracking"].filter(~is_json(F.col("event_data")) | ~is_json(F.col("device"))).select("id")


# ---------------------------------------------------------------- the declared tests


@dataclass(frozen=True)
class DataTest:
    name: str
    layer: str  # the test runs once this layer is built
    violations: Callable[[Tables], DataFrame]
    # Tests of single rows name their table and a bad-row condition: one scan then serves all of a table.
    table: str | None = None
    bad_row: str | None = None


def _unique(layer: str, table: str, column: str) -> DataTest:
    return DataTest(f"unique_{table}_{column}", layer, lambda t: checks.dq_unique(t[table], column))


def _not_null(layer: str, table: str, column: str) -> DataTest:
    return DataTest(
        f"not_null_{table}_{column}",
        layer,
        lambda t: checks.dq_not_null(t[table], column),
        table,
        f"{column} is null",
    )


def _related(table: str, column: str, parent: str) -> DataTest:
    return DataTest(
        f"relationships_{table}_{column}",
        "silver",
        lambda t: checks.dq_relationships(t[table], column, t[parent], column),
    )


def _boolean(table: str, column: str) -> DataTest:
    return DataTest(
        f"accepted_values_{table}_{column}",
        "silver",
        lambda t: checks.dq_accepted_values(t[table], column, [True, False]),
        table,
        f"{column} not in (true, false)",
    )


# Which column of which relation carries which generic test.
KEYS = {
    "raw": [("user_event_tracking", "id")],
    "silver": [
        ("silver_brand", "brand_id"),
        ("silver_cpu_model", "cpu_id"),
        ("silver_gpu_model", "gpu_id"),
        ("silver_laptop_model", "laptop_model_id"),
        ("silver_laptop_benchmark_result", "benchmark_id"),
        ("silver_laptop_benchmark_result", "laptop_model_id"),
        ("silver_user_event_tracking", "id"),
    ],
    "gold": [
        ("gold_brand_interest", "brand_id"),
        ("gold_performance_ranking", "laptop_model_id"),
        ("gold_daily_site_kpis", "event_date"),
        ("gold_battery_vs_interest", "laptop_model_id"),
        ("gold_performance_efficiency", "laptop_model_id"),
        ("gold_behavior_funnel_daily", "event_date"),
        ("gold_search_analytics", "search_keyword"),
    ],
}
REQUIRED = {
    "raw": [("user_event_tracking", EVENT_TS)],
    "silver": [
        ("silver_laptop_model", "brand_id"),
        ("silver_user_event_tracking", "server_timestamp"),
        ("silver_user_event_tracking", "session_id"),
        ("silver_user_event_tracking", "event_name"),
    ],
}
RELATED = [
    ("silver_laptop_model", "brand_id", "silver_brand"),
    ("silver_laptop_model", "cpu_id", "silver_cpu_model"),
    ("silver_laptop_model", "gpu_id", "silver_gpu_model"),
    ("silver_laptop_benchmark_result", "laptop_model_id", "silver_laptop_model"),
]
BOOLEANS = [("silver_laptop_model", "is_visible"), ("silver_laptop_model", "is_active")]
RELATION_CHECKS = {
    "raw": [json_valid],
    "silver": [dq_raw_to_silver],
    "gold": [
        dq_daily_event_counts, dq_daily_rates, dq_gold_definitions, dq_gold_totals, dq_source_taxonomy,
    ],
}


def declared_tests() -> list[DataTest]:
    tests = [
        make(layer, table, column) for layer, keys in KEYS.items() for table, column in keys for make in (_unique, _not_null)
    ]
    tests += [_not_null(layer, table, column) for layer, columns in REQUIRED.items() for table, column in columns]
    tests += [_related(*entry) for entry in RELATED]
    tests += [_boolean(*entry) for entry in BOOLEANS]
    tests += [DataTest(check.__name__, layer, check) for layer, group in RELATION_CHECKS.items() for check in group]
    return tests


class DataTestsFailed(RuntimeError):
    def __init__(self, layer: str, failures: Mapping[str, int]):
        self.layer, self.failures = layer, dict(failures)
        super().__init__(f"{layer}: {self.failures}")


def run_tests(t: Tables, layer: str, extra: Iterable[DataTest] = ()) -> dict[str, int]:
    """Violations per test of a layer, all counted in one job; raises when any test has some."""
    chosen = [test for test in (*declared_tests(), *extra) if test.layer == layer]
    by_table: dict[str, list[DataTest]] = {}
    for test in chosen:
        if test.bad_row is not None:
            by_table.setdefault(test.table, []).append(test)
    counts = [
        _as_rows(t[table].agg(*(F.count_if(F.expr(test.bad_row)).alias(test.name) for test in group)), "violations")
        for table, group in by_table.items()
    ]
    counts += [
        test.violations(t).agg(F.count("*").alias("violations")).select(F.lit(test.name).alias("metric"), "violations")
        for test in chosen
        if test.bad_row is None
    ]
    found = {row["metric"]: row["violations"] for row in _stack(counts).collect()}  # one row per declared test
    failures = {name: n for name, n in found.items() if n}
    if failures:
        raise DataTestsFailed(layer, failures)
    return found
