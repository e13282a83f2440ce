"""Report queries: periods, sums, top lists, catalog search."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from sparkmarts.functions import clean_text, contains_literal, numeric_label, percent, safe_divide, valid_laptop_id
from sparkmarts.plans import serve
from sparkmarts.plans.pipeline import load_gold

TODAY = date(2025, 8, 14)  # a Thursday


def daily(spark, counts):
    """A row per day; `counts` gives single columns, the rest are 0."""
    columns = ", ".join(f"{c} bigint" for c in serve.SUMMED)
    rows = [(day, *(given.get(c, 0) for c in serve.SUMMED)) for day, given in counts.items()]
    return spark.createDataFrame(rows, "event_date date, " + columns)


def test_periods():
    oldest, newest = date(2024, 12, 30), date(2025, 8, 11)
    assert serve.serve_period("Today", TODAY, oldest, newest) == (TODAY, TODAY)
    assert serve.serve_period("Last 7 days", TODAY) == (date(2025, 8, 8), TODAY)
    assert serve.serve_period("All available", TODAY, oldest, newest) == (oldest, TODAY)
    assert serve.serve_period("All available", TODAY) == (TODAY, TODAY)
    chosen = (date(2025, 1, 31), date(2025, 4, 30))
    assert serve.serve_period("Custom", TODAY, oldest, newest, custom=chosen) == chosen
    with pytest.raises(ValueError):
        serve.serve_period("This quarter", TODAY)


def test_period_without_data(spark):
    days = daily(spark, {date(2025, 8, 11): {c: 4 for c in serve.SUMMED}})
    window = serve.serve_filter_days(days, TODAY, TODAY)
    summary = serve.serve_summarize_daily(window).first()
    assert window.isEmpty() and summary["total_events"] == 0 and summary["detail_reach_pct"] is None


def test_rates_come_from_summed_counts(spark):
    """A quiet day with all reach and a busy one with little: the mean of the daily rates would say 56."""
    days = daily(spark, {
        date(2025, 8, 12): {"total_sessions": 3, "sessions_with_pageview": 3, "pageview_and_detail": 3, "sessions_with_detail_view": 3},
        date(2025, 8, 13): {"total_sessions": 77, "sessions_with_pageview": 77, "pageview_and_detail": 9, "sessions_with_detail_view": 9},
    })
    summary = serve.serve_summarize_daily(days).first()
    assert summary["total_sessions"] == 80 and summary["detail_reach_pct"] == pytest.approx(15.0)


def test_brand_share_keeps_the_total(spark):
    rows = [(i, f"brand {i}", 2**i) for i in range(10)]
    brands = spark.createDataFrame(rows, "brand_id int, brand_name string, total_views bigint")
    share = {r["brand_name"]: r["total_views"] for r in serve.brand_share(brands).collect()}
    assert len(share) == 7 and sum(share.values()) == 1023
    assert share["Other brands (remaining)"] == 15 and share["brand 9"] == 512
    assert serve.brand_share(brands, n=10).filter("brand_name like 'Other%'").isEmpty()


def test_labels(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (-0.04,), (9876543.21,)], "x double")
    assert [r[0] for r in df.select(numeric_label(F.col("x"))).collect()] == ["N/A", "N/A", "-0.0", "9,876,543.2"]
    assert df.select(numeric_label(F.col("x"), " h")).collect()[3][0] == "9,876,543.2 h"


def test_literal_search(spark):
    df = spark.createDataFrame([("Cedar Two {15}",), ("Dune",), (None,), ("5* (a|b)",)], "n string")
    hits = lambda q: [r[0] for r in df.filter(contains_literal(F.col("n"), q)).collect()]
    assert hits("{15") == hits("cEDAR") == ["Cedar Two {15}"] and hits("* (A|") == ["5* (a|b)"]
    assert hits("%") == hits("D.ne") == []


def catalog(spark, ids):
    schema = ("laptop_model_id int, laptop_name string, brand_name string, cpu_name string, gpu_name string, "
              "screen_size int, office_battery_hours int, geekbench6_multi int")
    return spark.createDataFrame([(i, f"L{i}", "B", "c", "g", 1, 1, 1) for i in ids], schema)


def test_catalog_joins_one_to_one(spark):
    views = lambda rows: spark.createDataFrame(rows, "laptop_model_id int, total_views bigint")
    found = serve.serve_catalog(catalog(spark, [1, 2]), views([(2, 5)])).collect()
    assert [(r["laptop_name"], r["total_views"]) for r in found] == [("L2", 5), ("L1", 0)]
    for ranking, interest in ((catalog(spark, [1, 1]), views([(1, 5)])), (catalog(spark, [1]), views([(1, 5), (1, 6)]))):
        with pytest.raises(Exception, match="repeats"):
            serve.serve_catalog(ranking, interest).collect()
    assert serve.serve_catalog(catalog(spark, [1, 2]), views([]), brand="B", query="l2").count() == 1
    assert serve.serve_catalog(catalog(spark, [1, 2]), views([]), brand="other").count() == 0


def test_recency(spark):
    days = spark.createDataFrame([(datetime(2025, 8, 11, 23),)], "latest_event_at timestamp_ntz").select(
        F.col("latest_event_at").cast("timestamp")
    )
    assert serve.serve_recency(days, datetime(2025, 8, 14, tzinfo=timezone.utc)).first()["status"] == "error"


def test_top_component_trend_breaks_ties_by_name(spark):
    rows = [(date(2026, m, 1), c, "b", v) for m in (1, 2) for c, v in (("z", 1), ("y", 1), ("x", 9))]
    trend = spark.createDataFrame(rows, "month date, cpu_name string, brand_name string, total_views bigint")
    got = serve.top_component_trend(trend, "cpu_name", 2)
    assert {r["cpu_name"] for r in got.collect()} == {"x", "y"} and got.count() == 4


def test_load_gold_allows_gold_names_only(store):
    with pytest.raises(ValueError):
        load_gold(store, "user_event_tracking")


def test_scalar_rules(spark):
    one = spark.range(1)
    value = lambda column: one.select(column).first()[0]
    assert value(clean_text(F.lit(" a \t\n b c  "))) == "a b c"
    assert str(value(safe_divide(F.lit(1), F.lit(3)))) == "0.33"
    assert value(safe_divide(F.lit(1), F.lit(0))) is None and value(safe_divide(F.lit(1), F.lit(None).cast("int"))) is None
    assert str(value(safe_divide(F.lit(5), F.lit(2), 0))) == "3" and str(value(safe_divide(F.lit(-5), F.lit(2), 0))) == "-3"
    assert str(value(percent(F.lit(1), F.lit(3)))) == "33.33" and value(percent(F.lit(1), F.lit(0))) is None
    ids = ["1", "2147483647", "2147483648", "0", "00012", "12\n", "-1", "1.0", "", "99999999999", "٣"]
    df = spark.createDataFrame([(i,) for i in ids], "t string")
    kept = [r[0] for r in df.select(valid_laptop_id(F.col("t"))).collect()]
    assert kept == ["1", "2147483647", None, None, "00012", None, None, None, None, None, None]
