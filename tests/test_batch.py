"""Batch contract: newest version wins in any order, replays collapse, conflicts and bad rows are refused."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkmarts.functions import canonical_json
from sparkmarts.operators import versions
from sparkmarts.operators.versions import BatchError
from sparkmarts.schemas import EVENT_TS

SCHEMA = f"id string, {EVENT_TS} double, payload string"


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def values(df):
    return sorted(tuple(r) for r in df.select("id", EVENT_TS, "payload").collect())


CASES = {
    "newest of three, given out of order": ([("k", 5.5, "b"), ("k", 7.25, "c"), ("k", -1.0, "a")], [("k", 7.25, "c")]),
    "replays of one version": ([("k", 5.5, "b"), ("m", 0.0, "z")] * 4, [("k", 5.5, "b"), ("m", 0.0, "z")]),
    "a missing payload is a payload": ([("k", 5.5, None), ("k", 5.5, None), ("k", 5.0, "x")], [("k", 5.5, None)]),
    "old versions may differ": ([("k", 5.0, "x"), ("k", 5.0, "y"), ("k", 5.0, None), ("k", 5.5, "b")], [("k", 5.5, "b")]),
    "versions a float apart": ([("k", 1e9, "a"), ("k", 1e9 + 2**-22, "b")], [("k", 1e9 + 2**-22, "b")]),
}


@pytest.mark.parametrize("name", CASES)
def test_one_version_is_left(spark, name):
    given, left = CASES[name]
    for rows in (given, given[::-1]):
        assert values(versions.prepare_batch(batch(spark, rows))) == left


def test_clashes_of_the_newest_version_are_listed(spark):
    rows = [("m", 0.0, "z"), ("k", 5.5, "b"), ("n", 2.0, None), ("k", 5.5, "B"), ("n", 2.0, ""), ("k", 1.0, "a")]
    assert sorted(r["id"] for r in versions.batch_conflicts(batch(spark, rows)).collect()) == ["k", "n"]
    with pytest.raises(BatchError, match="payload"):
        versions.prepare_batch(batch(spark, rows))


@pytest.mark.parametrize(
    "row",
    [
        (None, 200.0, "x"), ("", 200.0, "x"), ("  ", 200.0, "x"), ("\t\n", 200.0, "x"),
        ("1", None, "x"), ("1", float("inf"), "x"), ("1", float("-inf"), "x"), ("1", float("nan"), "x"),
    ],
)
def test_invalid_ids_and_timestamps_fail(spark, row):
    with pytest.raises(BatchError):
        versions.prepare_batch(batch(spark, [("9", 1.0, "ok"), row]))


def test_text_timestamps_must_be_numbers(spark):
    good = spark.createDataFrame([("1", "10000.5")], f"id string, {EVENT_TS} string")
    assert versions.prepare_batch(good).count() == 1
    bad = spark.createDataFrame([("1", "bad")], f"id string, {EVENT_TS} string")
    with pytest.raises(BatchError):
        versions.prepare_batch(bad)


def test_columns_are_checked(spark):
    with pytest.raises(BatchError):
        versions.prepare_batch(spark.createDataFrame([("1",)], "id string"))
    twice = spark.createDataFrame([("1", 1.0, "a")], SCHEMA).select("*", F.lit(1).alias("payload"))
    with pytest.raises(BatchError):
        versions.prepare_batch(twice)
    with pytest.raises(BatchError, match=r"missing=\['a'\], extra=\['c'\]"):
        versions.assert_same_columns(["a", "b"], ["b", "c"])
    versions.assert_same_columns(["a", "b"], ["b", "a"])


def test_empty_batch(spark):
    assert versions.prepare_batch(batch(spark, [])).count() == 0


def test_nested_payloads_become_canonical_json(spark):
    schema = f"id int, {EVENT_TS} double, event_data struct<b:int, a:int>, device map<string,array<string>>"
    rows = [(1, 1.0, (2, 1), {"z": ["q\"uote"], "k": []})] * 2
    (row,) = versions.prepare_batch(spark.createDataFrame(rows, schema)).collect()
    assert row["event_data"] == '{"a": 1, "b": 2}'
    assert row["device"] == '{"k": [], "z": ["q\\"uote"]}'


def test_canonical_json_of_nulls_and_nesting(spark):
    df = spark.createDataFrame([((None, [1, None], (True,)),), (None,)], "v struct<s:string,l:array<int>,n:struct<x:boolean>>")
    text = [r[0] for r in df.select(canonical_json(F.col("v"), df.schema["v"].dataType)).collect()]
    assert text == ['{"l": [1, null], "n": {"x": true}, "s": null}', None]


VERSIONS = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 3), st.sampled_from("xy")), max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=VERSIONS, seed=st.integers(0, 99), parts=st.integers(1, 5))
def test_outcome_does_not_depend_on_order_or_partitioning(spark, rows, seed, parts):
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    newest = {}
    for id, ts, payload in rows:
        newest.setdefault(id, []).append((ts, payload))
    expected, clashing = [], []
    for id, found in newest.items():
        top = max(ts for ts, _ in found)
        payloads = {p for ts, p in found if ts == top}
        (clashing if len(payloads) > 1 else expected).append((id, float(top), *payloads) if len(payloads) == 1 else id)
    df = batch(spark, [(id, float(ts), p) for id, ts, p in shuffled]).repartition(parts)
    resolved = versions.resolve_versions(df).collect()
    assert sorted(r["id"] for r in resolved if r["_conflict"]) == sorted(clashing)
    assert sorted((r["id"], r[EVENT_TS], r["payload"]) for r in resolved if not r["_conflict"]) == sorted(expected)
    assert sum(r["_rows"] for r in resolved) == len(rows)


def test_upsert_counts_and_rows(spark):
    target = batch(spark, [("same", 5.0, "s"), ("old", 5.0, "o"), ("new", 9.0, "kept"), ("alone", 1.0, "t")])
    incoming = batch(spark, [("same", 5.0, "s"), ("old", 7.0, "O"), ("new", 8.0, "late"), ("first", 1.0, "f")] * 2)
    latest = versions.prepare_batch(incoming)
    assert values(versions.upsert_versions(latest, target)) == sorted(
        [("same", 5.0, "s"), ("old", 7.0, "O"), ("new", 9.0, "kept"), ("alone", 1.0, "t"), ("first", 1.0, "f")]
    )
    assert versions.upsert_counts(incoming, target).first().asDict() == {
        "source_rows": 8, "source_ids": 4, "older_ids_skipped": 1, "written_ids": 3,
    }
    clash = batch(spark, [("old", 5.0, "different")])
    assert [r["id"] for r in versions.upsert_conflicts(clash, target).collect()] == ["old"]
