"""Hand-derived results of the small fixture."""

from datetime import date
from decimal import Decimal

import pytest
from fixture_data import raw_frames
from pyspark.sql import functions as F

from sparkmarts.operators.versions import prepare_batch
from sparkmarts.plans import gold, quality, reconcile, silver
from sparkmarts.plans.registry import Marts


@pytest.fixture(scope="module")
def marts(spark):
    from sparkmarts.plans import bronze  # noqa: F401

    frames = raw_frames(spark)
    frames["user_event_tracking"] = prepare_batch(frames["user_event_tracking"])
    return Marts({name: df.cache() for name, df in frames.items()})


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def one(df, **where):
    for column, value in where.items():
        df = df.filter(F.col(column) == value)
    (row,) = df.collect()
    return row.asDict()


FEB, MARCH, LATER = date(2025, 2, 28), date(2025, 3, 1), date(2025, 3, 3)


def test_raw_and_silver_counts(marts):
    assert marts["user_event_tracking"].count() == 13
    assert marts["silver_user_event_tracking"].count() == 12  # id 11 has no session


def test_session_days(marts):
    days = [(FEB, "alpha"), (MARCH, "alpha"), (MARCH, "beta"), (MARCH, "gamma"), (LATER, "delta")]
    assert rows(marts["silver_session_day"], "event_date", "session_id") == sorted(days, key=str)


def test_comparison_bridge(marts):
    """Id 6 repeats a device and has one that is none; id 13 names one beyond 32 bits."""
    pairs = [(4, 12), (5, 21), (6, 11), (6, 21)]
    assert rows(marts["silver_comparison_event_device"], "event_id", "laptop_model_id") == sorted(pairs, key=str)
    sessions = marts["silver_comparison_session_device"].select("session_id", "laptop_model_id", "interaction_count")
    assert rows(sessions) == sorted([("alpha", 12, 1), ("alpha", 21, 1), ("beta", 11, 1), ("beta", 21, 1)], key=str)


def test_daily_kpis(marts):
    names = [
        "total_sessions", "total_events", "total_pageviews", "detail_pageviews", "comparison_pageviews",
        "sessions_with_pageview", "sessions_with_detail_view", "sessions_with_comparison", "sessions_with_sort",
        "pageview_and_detail", "detail_and_comparison",
    ]
    found = {r["event_date"]: r for r in marts["gold_daily_site_kpis"].collect()}
    counts = {day: [r[name] for name in names] for day, r in found.items()}
    assert counts == {
        FEB: [1, 2, 2, 1, 0, 1, 1, 0, 0, 1, 0],
        MARCH: [3, 9, 5, 3, 2, 3, 3, 2, 1, 3, 2],
        LATER: [1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0],
    }
    rates = {day: (r["detail_rate_pct"], r["comparison_rate_pct"]) for day, r in found.items()}
    d = Decimal
    assert rates == {FEB: (d("100.00"), d("0.00")), MARCH: (d("100.00"), d("66.67")), LATER: (None, None)}
    assert found[MARCH]["latest_event_at"].microsecond == 250_000


def test_funnel(marts):
    found = {r["event_date"]: [r[step] for step in gold.FUNNEL_STEPS] for r in marts["gold_behavior_funnel_daily"].collect()}
    assert found == {FEB: [1, 1, 0, 0, 0], MARCH: [3, 3, 1, 2, 1], LATER: [0, 0, None, 0, 0]}


def test_brand_interest(marts):
    found = {r["brand_name"]: tuple(r)[2:] for r in marts["gold_brand_interest"].collect()}
    d = Decimal
    assert found == {
        "Cedar": (2, 2, 2, 3, 2, 2, 1, d("1.000"), d("50.00"), d("2")),
        "Dune": (1, 1, 1, 1, 2, 2, 1, d("0.333"), d("100.00"), d("1")),
    }


def test_brand_pairs(marts):
    assert rows(marts["gold_brand_comparison"]) == [(10, 20, "Cedar", "Dune", 2, 2, 2, "Cross Brand")]


def test_trends_and_specs(marts):
    february, march = date(2025, 2, 1), date(2025, 3, 1)
    parts = [(february, "Quark 5", "Cedar", 1, 1, 1), (march, "Quark 5", "Dune", 1, 1, 1), (march, "Quark 9", "Cedar", 2, 2, 1)]
    assert rows(marts["gold_cpu_trend"]) == sorted(parts, key=str)
    gpu = {"Quark 5": "Prism", "Quark 9": "Volt"}
    assert rows(marts["gold_gpu_trend"]) == sorted([(m, gpu[c], *rest) for m, c, *rest in parts], key=str)
    specs = {r["cpu_name"]: tuple(r)[4:] for r in marts["gold_spec_popularity"].collect()}
    assert specs == {"Quark 5": (2, 2, 1), "Quark 9": (1, 2, 2)}


def test_average_views_are_rounded_once(spark):
    """5,000 views of 10,001 laptops are just under a half each; an average cut to four places would say a half."""
    laptops = spark.range(1, 10_002).selectExpr(
        "cast(id as int) as laptop_model_id", "'c' as cpu_name", "'g' as gpu_name",
        "cast(1 as decimal(18,4)) as screen_size", "cast(1 as decimal(18,4)) as battery_capacity_whr",
    )
    views = spark.range(1, 10_002).selectExpr("cast(id as int) as laptop_model_id", "if(id <= 5000, 1L, 0L) as views")
    for more, expected in ((0, 0), (1, 1)):
        counted = views.withColumn("views", F.col("views") + F.when(F.col("laptop_model_id") == 1, more).otherwise(0))
        row = gold.spec_totals(laptops, counted).first()
        assert (row["product_count"], row["total_views"], row["avg_views_per_product"]) == (10_001, 5_000 + more, expected)


def test_ranking(marts):
    ranks = ["geekbench_rank_in_brand", "battery_rank_in_brand", "geekbench_rank_overall", "battery_rank_overall"]
    assert rows(marts["gold_performance_ranking"], "laptop_model_id", *ranks, "performance_tier") == [
        (11, 2, 2, 2, 2, "Entry Level"),
        (12, 1, 1, 1, 1, "Mid-Range"),
        (21, 1, 1, 3, 3, "No Benchmark"),
    ]


def test_efficiency(marts):
    measures = ["performance_per_wh", "performance_per_kg", "battery_efficiency_mins_per_wh", "performance_drop_pct"]
    picked = marts["gold_performance_efficiency"].select("laptop_model_id", *measures).collect()
    assert {r[0]: [str(v) for v in r[1:]] for r in picked} == {
        11: ["80.00", "3200.00", "6.00", "10.00"],
        12: ["118.75", "4750.00", "5.25", "47.37"],
    }


def test_battery_vs_interest(marts):
    columns = ["laptop_model_id", "total_views", "view_sessions", "comparison_events", "battery_tier"]
    assert rows(marts["gold_battery_vs_interest"], *columns) == [
        (11, 1, 1, 1, "4-6h (Average)"),
        (12, 2, 2, 1, "6-8h (Good)"),
        (21, 1, 1, 2, "No Data"),
    ]


def test_search_and_os(marts):
    assert rows(marts["gold_search_analytics"]) == [("thin {14}", 1, 1)]
    assert rows(marts["gold_user_os"]) == [("Haiku", "Desktop", 3, Decimal("75.0")), ("Plan 9", "Mobile", 1, Decimal("25.0"))]


def test_every_data_test_passes_and_layers_reconcile(marts):
    for layer in ("raw", "silver", "gold"):
        assert not any(quality.run_tests(marts, layer).values())
    report = reconcile.reconcile_report(marts).first()
    assert report["reconciled"] and report["raw_events"] == 13 and report["silver_events"] == 12


def test_half_microseconds_round_like_the_source(spark):
    """Half to even from the year 2000 on, as exact rational arithmetic over the doubles says."""
    from fractions import Fraction

    from sparkmarts.functions import epoch_to_timestamp

    epochs = [1_740_000_000 + k / 2**22 for k in range(-2000, 2000, 7)] + [946_684_799.9999995, 0.1, -1.0000005, 253_370_764_800.0]
    df = spark.createDataFrame([(e,) for e in epochs], "e double").select("e", F.unix_micros(epoch_to_timestamp(F.col("e"))).alias("us"))
    for r in df.collect():
        since = (r["e"] - 946_684_800.0) * 1e6  # the source dialect's own double arithmetic
        assert r["us"] == round(Fraction(since)) + 946_684_800_000_000
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,)], "e double")
    assert [r[0] for r in odd.select(epoch_to_timestamp(F.col("e"))).collect()] == [None, None, None]


def test_json_is_read_by_one_strict_rule(spark):
    from sparkmarts.functions import is_json, json_fields

    texts = ['{"os":"A"}', '{"os":"A","os":"B"}', '{"os":"C"} tail', "{'os':'D'}", "", "1], [2", '1}, {"v":2', "[]", None, '{"os":"E"', "1,2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    valid = {r["i"]: r["v"] for r in df.select("i", is_json(F.col("t")).alias("v")).collect()}
    assert [valid[i] for i in range(len(texts))] == [True, True, False, False, False, False, False, True, None, False, False]
    fields = {r["i"]: r["os"] for r in df.select("i", json_fields(F.col("t"), ("os",))["os"].alias("os")).collect()}
    assert fields[0] == "A" and fields[1] == "B" and fields[3] is None


def test_repeated_keys_are_no_alarm_and_broken_json_stops_raw(spark):
    from fixture_data import FIRST_OF_MARCH, frame

    def tested(device):
        event = (1, "s", "pageview", FIRST_OF_MARCH, FIRST_OF_MARCH, '{"page_name":"Home"}', device)
        return Marts({**raw_frames(spark), "user_event_tracking": frame(spark, "user_event_tracking", [event])})

    assert quality.dq_source_taxonomy(tested('{"os":"A","os":"B"}')).isEmpty()
    assert not any(quality.run_tests(tested('{"os":"A"}'), "raw").values())
    for broken in ('{"os":"C"} tail', "{'os':'D'}", "{"):
        with pytest.raises(quality.DataTestsFailed) as failed:
            quality.run_tests(tested(broken), "raw")
        assert failed.value.failures == {"json_valid": 1}


def test_daily_kpis_split_at_local_midnight(spark):
    """Two sessions on one UTC day, on either side of midnight in the business zone."""
    times = ["2025-06-30 16:59:59.999999", "2025-06-30 17:00:00", "2025-06-30 20:00:00", "2025-06-30 20:00:01"]
    pages = [("a", "DeviceDetail"), ("a", "DeviceDetail"), ("b", "Home"), ("b", "CompareDevice")]
    tracked = spark.createDataFrame(
        [(i, t, s, "pageview", p, None) for i, (t, (s, p)) in enumerate(zip(times, pages, strict=True))],
        "id bigint, at string, session_id string, event_name string, page_name string, sort_by string",
    ).withColumn("server_timestamp", F.col("at").cast("timestamp"))
    daily = Marts({"silver_user_event_tracking": tracked})["gold_daily_site_kpis"]
    june, july = one(daily, event_date=date(2025, 6, 30)), one(daily, event_date=date(2025, 7, 1))
    assert (june["total_events"], june["total_sessions"], june["detail_rate_pct"]) == (1, 1, Decimal("100.00"))
    assert (july["total_events"], july["total_sessions"], july["detail_rate_pct"]) == (3, 2, Decimal("50.00"))
    assert july["comparison_rate_pct"] == Decimal("0.00")


def test_unknown_pages_make_null_flags_and_null_funnel_sums(spark):
    """A session whose pageviews name no page has unknown, not false, reach."""
    from fixture_data import event, frame

    raw = frame(spark, "user_event_tracking", [event(1, "a", "pageview", 1_700_000_000), event(2, "b", "pageview", 1_700_000_100)])
    marts = Marts({"user_event_tracking": raw})
    (flags,) = {tuple(r) for r in marts["silver_session_day"].select("has_detail", "has_comparison").collect()}
    assert flags == (None, None)
    funnel = marts["gold_behavior_funnel_daily"].first()
    assert (funnel["step_1_pageview"], funnel["step_2_product_detail"]) == (2, None)
    assert marts["gold_daily_site_kpis"].first()["sessions_with_detail_view"] == 0
    assert silver.EVENT_COLUMNS == tuple(marts["silver_user_event_tracking"].columns)


def test_relations_can_be_queried_with_sql(spark, marts, store):
    from sparkmarts.plans import pipeline

    assert len(pipeline.publish_views(marts)) == 6 + 6 + 13 + 12
    rows = spark.sql("select brand_name, total_views from gold_brand_interest order by total_views").collect()
    assert [tuple(r) for r in rows] == [("Dune", 1), ("Cedar", 3)]
    pipeline.materialize(store, "gold_user_os", marts["gold_user_os"])
    pipeline.materialize(store, "silver_brand", marts["silver_brand"])
    assert store.names() == ["gold_user_os"] and pipeline.load_gold(store, "gold_user_os").count() == 2
    assert spark.table("silver_brand").count() == 3
