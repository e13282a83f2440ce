"""Rewrites that keep work per key bounded, against the plain formulation; and what the plans may not contain."""

import os
import re
from datetime import date
from itertools import combinations

import harness
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from sparkmarts.operators.ranking import add_ranks
from sparkmarts.operators.versions import newest_per_key
from sparkmarts.plans import pipeline, silver
from sparkmarts.plans.registry import Marts
from sparkmarts.session import BROADCAST

SF_DIR = os.path.join(harness.TESTDATA, "sf0.001")
QUIET = dict(deadline=None, suppress_health_check=list(HealthCheck))

RANK_ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1), st.integers(0, 5)),
        st.one_of(st.none(), st.integers(-(10**11), 10**11), st.integers(0, 5)),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=10, **QUIET)
@given(rows=RANK_ROWS)
def test_ranks_equal_the_window_function(spark, rows):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "id int, grp string, score int, m bigint")
    df = df.withColumn("minutes", (F.col("m") / 1000).cast("decimal(18,4)")).drop("m")
    ranked = add_ranks(df, "grp", {"score": ("s_in", "s_all"), "minutes": ("m_in", "m_all")})
    plain = df.select(
        "*",
        F.rank().over(Window.partitionBy("grp").orderBy(F.desc_nulls_last("score"))).alias("s_in"),
        F.rank().over(Window.orderBy(F.desc_nulls_last("score"))).alias("s_all"),
        F.rank().over(Window.partitionBy("grp").orderBy(F.desc_nulls_last("minutes"))).alias("m_in"),
        F.rank().over(Window.orderBy(F.desc_nulls_last("minutes"))).alias("m_all"),
    )
    columns = ["id", "s_in", "s_all", "m_in", "m_all"]
    assert sorted(map(tuple, ranked.select(*columns).collect())) == sorted(map(tuple, plain.select(*columns).collect()))


def test_ranks_refuse_types_they_cannot_order(spark):
    with pytest.raises(TypeError):
        add_ranks(spark.createDataFrame([(1, "a", 1.5)], "id int, grp string, x double"), "grp", {"x": ("i", "o")})


PAIR_ROWS = st.lists(
    st.tuples(st.sampled_from(["s1", "s2"]), st.integers(1, 2), st.integers(1, 8)), min_size=1, max_size=30, unique=True
)
BRANDS = {1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3, 7: None, 8: 9}  # 7 has no brand, 9 is not in the dimension


@settings(max_examples=10, **QUIET)
@given(rows=PAIR_ROWS)
def test_brand_pairs_equal_listing_every_laptop_pair(spark, rows):
    found = {}
    for day in {(s, d) for s, d, _ in rows}:
        for x, y in combinations(sorted(l for s, d, l in rows if (s, d) == day), 2):
            given_brands = [b for b in (BRANDS[x], BRANDS[y]) if b is not None]
            if given_brands:
                found.setdefault((min(given_brands), max(given_brands)), []).append(day)
    expected = {
        pair: (len({s for s, _ in days}), len(set(days)), len(days), "Same Brand" if pair[0] == pair[1] else "Cross Brand")
        for pair, days in found.items()
        if 9 not in pair
    }
    seen = spark.createDataFrame(
        [(s, l, day_of(d), 1) for s, d, l in rows], "session_id string, laptop_model_id int, event_date date, n bigint"
    )
    laptops = spark.createDataFrame([(l, b, True) for l, b in BRANDS.items()], "id int, brand_id int, is_active boolean")
    brands = spark.createDataFrame([(b, f"B{b}") for b in (1, 2, 3)], "brand_id int, brand_name string")
    marts = Marts({"silver_comparison_session_device": seen, "bronze_laptop_model": laptops, "silver_brand": brands})
    got = {(r[0], r[1]): tuple(r)[4:] for r in marts["gold_brand_comparison"].collect()}
    assert got == expected


def day_of(number):
    return date(2026, 1, number)


COUNT_ROWS = st.dictionaries(
    st.tuples(st.sampled_from(["s1", "s2", "s3"]), st.sets(st.integers(1, 9), min_size=1, max_size=5).map(lambda s: tuple(sorted(s)))),
    st.integers(1, 3),
    min_size=1,
    max_size=12,
)


@settings(max_examples=10, **QUIET)
@given(counts=COUNT_ROWS)
def test_brands_of_compared_sets_equal_counting_every_session(spark, counts):
    """Laptop 8 is in the catalog twice with one brand, 9 is not in it, 7 has no brand."""
    catalog = [(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 3), (7, None), (8, 3), (8, 3)]
    totals, sessions = {}, {}
    for (session, laptops), n in counts.items():
        for brand in {b for l, b in catalog if l in laptops and b}:
            totals[brand] = totals.get(brand, 0) + n
            sessions.setdefault(brand, set()).add(session)
    pairs = {}
    for (session, laptops), n in counts.items():
        places = [b for l, b in catalog if l in laptops]
        for x, y in combinations(places, 2):
            if given := [b for b in (x, y) if b]:
                pairs.setdefault((min(given), max(given)), []).append((session, laptops, n))
    expected = {
        pair: (len({s for s, _, _ in found}), sum(n for _, _, n in set(found)), sum(n for _, _, n in found))
        for pair, found in pairs.items()
    }
    keyed = "session_id string, laptops array<int>, n bigint"
    compared = spark.createDataFrame([(s, list(laptops), n) for (s, laptops), n in counts.items()], keyed)
    given_tables = {
        "view_counts": spark.createDataFrame([], "month date, laptop_model_id int, session_id string, n bigint"),
        "comparison_counts": compared,
        "compared_day_counts": compared,
        "bronze_laptop_model": spark.createDataFrame([(l, b, True) for l, b in catalog], "id int, brand_id int, is_active boolean"),
        "silver_brand": spark.createDataFrame([(b, f"B{b}") for b in (1, 2, 3)], "brand_id int, brand_name string"),
    }
    marts = Marts(given_tables)
    interest = {r["brand_id"]: (r["total_comparisons"], r["comparison_sessions"]) for r in marts["gold_brand_interest"].collect()}
    assert interest == {b: (totals.get(b, 0), len(sessions.get(b, ()))) for b in (1, 2, 3)}
    got = {(r[0], r[1]): tuple(r)[4:7] for r in marts["gold_brand_comparison"].collect()}
    assert got == expected


def test_sets_of_laptops_are_listed_without_their_sessions(spark):
    """What is exploded to find the brands of a set is the set, not every session that has it."""
    compared = spark.createDataFrame([("s", [1, 2], 1)], "session_id string, laptops array<int>, n bigint")
    marts = Marts(
        {
            "view_counts": spark.createDataFrame([("s", 1, day_of(1), 1)], "session_id string, laptop_model_id int, month date, n bigint"),
            "comparison_counts": compared,
            "compared_day_counts": compared,
            "bronze_laptop_model": spark.createDataFrame([(1, 1, True)], "id int, brand_id int, is_active boolean"),
            "silver_brand": spark.createDataFrame([(1, "B1")], "brand_id int, brand_name string"),
        }
    )
    for name in ("gold_brand_interest", "gold_brand_comparison"):
        generates = [line for line in harness.plan_text(marts[name]).splitlines() if line.startswith("Arguments: explode(")]
        assert generates and not any("session_id" in line for line in generates), name


def test_news_are_found_without_shuffling_parsed_rows(spark):
    """The event table comes dealt by id from its window: beside that, only ids and marks of the stored rows move."""
    before = [(i, f"s{i}", "pageview", 0.0, 1_700_000_000.0 + i, '{"page_name":"Home"}', "{}") for i in range(6)]
    columns = (
        "id bigint, session_id string, event_name string, event_local_timestamp double, "
        "event_received_on_server_timestamp double, event_data string, device string"
    )
    later = [*before[:4], (*before[4][:5], '{"page_name":"DeviceDetail"}', "{}"), (*before[5][:6], '{"os":"X"}'), (6, *before[0][1:])]
    stored = silver.silver_event_table(spark.createDataFrame(before, columns)).cache()
    fresh = silver.silver_event_table(spark.createDataFrame(later, columns))
    threshold = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, "-1")
    try:
        news = pipeline.unlike_stored(fresh, stored)
        moved = re.findall(r"^Arguments: hashpartitioning\((.*?), \d+\)", harness.plan_text(news), re.M)
        assert sorted(row["id"] for row in news.collect()) == [4, 5, 6]
    finally:
        spark.conf.set(BROADCAST, threshold)
        stored.unpersist()
    assert len([keys for keys in moved if "_key" in keys]) == 1 and not any("_own_mark" in keys for keys in moved)
    assert news.columns == fresh.columns


def test_newest_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    newest = newest_per_key(df, ["k"], [F.desc("v")])
    plan = harness.plan_text(newest)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted(map(tuple, newest.collect())) == [(0, 999), (1, 997), (2, 998)]


# Marts over the raw tables, and what their plans have to show.
RELATIONS = [name for name in entry_point.queries() if name.startswith(("silver_", "gold_", "serve_", "dq_"))]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
@pytest.mark.parametrize("name", RELATIONS)
def test_plan(spark, name):
    plan = harness.plan_text(entry_point.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    scans = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    # No relation reads a column it does not need: of the events only the five the adapter uses.
    assert all("value:double" not in line for line in scans)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_unpartitioned_windows_are_not_used(spark):
    """A window without partition keys would pull all rows into one task."""
    for name in ("gold_performance_ranking", "gold_brand_interest", "gold_brand_comparison", "gold_user_os", "serve_catalog"):
        lines = harness.plan_text(entry_point.queries()[name](spark, SF_DIR)).splitlines()
        windows = [
            next(text for text in lines[i:] if text.startswith("Arguments:"))
            for i, line in enumerate(lines)
            if re.match(r"\(\d+\) Window$", line.strip())
        ]
        assert windows or name == "gold_user_os"
        for arguments in windows:
            partition = re.search(r"\], \[([^\]]*)\](, \[[^\]]*\])?$", arguments)
            assert partition and partition[1], arguments


def test_the_bridge_is_distinct_without_a_shuffle(spark):
    """Over stored events the bridge is a projection: repeats are removed inside each row."""
    events = spark.createDataFrame(
        [(1, "s", "add_to_comparison", "Home", "7", '["7","8","8","x",null,"0","2147483648","12\\n"]'),
         (2, "s", "click", "Home", "7", None), (3, "s", "pageview", "CompareDevice", None, "not json"),
         (4, "s", "add_to_comparison", None, None, '{"a": "7"}'), (5, "s", "add_to_comparison", None, "9", "7"),
         (6, "s", "add_to_comparison", None, None, '"7"'), (7, "s", "add_to_comparison", None, None, "[5, [6], {}]"),
         (8, "s", "add_to_comparison", None, "5", '["005", "5"]')],
        "id bigint, session_id string, event_name string, page_name string, device_id string, device_ids_raw string",
    ).withColumn("server_timestamp", F.timestamp_seconds(F.lit(1_700_000_000)))
    bridge = Marts({"silver_user_event_tracking": events})["silver_comparison_event_device"]
    assert "Exchange" not in harness.plan_text(bridge)
    assert sorted((r["event_id"], r["laptop_model_id"]) for r in bridge.collect()) == [
        (1, 7), (1, 8), (5, 9), (7, 5), (8, 5),
    ]
