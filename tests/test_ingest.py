"""Loading into the store: replacement, upsert, rollback, concurrency, ranges and lookback."""

import math
import threading
from datetime import date, datetime, timedelta, timezone
from concurrent.futures import ThreadPoolExecutor

import pytest
from fixture_data import catalog, clickstream, frame, page, raw_frames
from harness import plan_text
from pyspark.sql import functions as F

from sparkmarts.config import Settings
from sparkmarts.operators.versions import BatchError
from sparkmarts.plans import ingest, pipeline
from sparkmarts.schemas import EVENT_TS, EVENTS, SNAPSHOT_TABLES
from sparkmarts.session import BROADCAST, MEASURED_BROADCAST
from sparkmarts.sources import scan
from sparkmarts.sources.store import CommitConflict, MissingTable, TableStore

BASE = 1_790_000_000.0


def names(df):
    return sorted(tuple(r) for r in df.collect())


def brand(spark, rows, schema="id int, name string"):
    return spark.createDataFrame(rows, schema)


def stored(store):
    return sorted((r["id"], r[EVENT_TS], r["event_data"]) for r in store.read(EVENTS).collect())


def events(spark, *rows):
    return frame(spark, EVENTS, list(rows))


def view(id, ts, name="Home", **more):
    return page(id, f"s{id}", name, ts, **more)


def test_snapshot_replacement(spark, store):
    ingest.replace_snapshot(store, "brand", brand(spark, [(1, "old")]))
    before = store.read("brand")
    for bad in (brand(spark, []), brand(spark, [(2, "new")], "id int, renamed string")):
        with pytest.raises(BatchError):
            ingest.replace_snapshot(store, "brand", bad)
        assert names(store.read("brand")) == [(1, "old")]
    ingest.replace_snapshot(store, "brand", brand(spark, [("new", 2)], "name string, id int"))
    assert names(store.read("brand")) == [(2, "new")]
    assert names(before) == [(1, "old")]  # a reader keeps the version it opened
    with pytest.raises(ValueError):
        ingest.replace_snapshot(store, "customer", brand(spark, [(1, "x")]))


def test_failed_write_keeps_the_old_rows(spark, store):
    ingest.replace_snapshot(store, "brand", brand(spark, [(1, "old")]))
    bad = spark.createDataFrame([("not a number", "new")], "id string, name string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ingest.replace_snapshot(store, "brand", bad)
    assert names(store.read("brand")) == [(1, "old")]


def test_replay_older_newer_and_reordered_columns(spark, store):
    first = view(1, BASE + 200)
    counts = ingest.upsert_events(store, events(spark, first))
    assert counts == {"source_rows": 1, "source_ids": 1, "older_ids_skipped": 0, "written_ids": 1}
    original = stored(store)
    ingest.upsert_events(store, events(spark, first))
    counts = ingest.upsert_events(store, events(spark, view(1, BASE + 100, "Old")))
    assert (counts["older_ids_skipped"], counts["written_ids"]) == (1, 0)
    assert stored(store) == original
    newest = events(spark, view(1, BASE + 300, "Newest"))
    ingest.upsert_events(store, newest.select(*reversed(newest.columns)))
    assert [(id, ts) for id, ts, _ in stored(store)] == [(1, BASE + 300)]


def test_same_timestamp_conflict_changes_nothing(spark, store):
    ingest.upsert_events(store, events(spark, view(1, BASE), view(2, BASE)))
    original, version = stored(store), store.version(EVENTS)
    with pytest.raises(BatchError, match="payload"):
        ingest.upsert_events(store, events(spark, view(1, BASE, "Other"), view(2, BASE + 50), view(3, BASE)))
    assert (stored(store), store.version(EVENTS)) == (original, version)
    assert not store._names("_staging")


def test_a_new_version_can_move_to_another_day(spark, store):
    ingest.upsert_events(store, events(spark, view(1, BASE), view(2, BASE), view(3, BASE + 86400 * 3)))
    ingest.upsert_events(store, events(spark, view(1, BASE + 86400 * 2)))
    assert [(id, ts) for id, ts, _ in stored(store)] == [(1, BASE + 172800), (2, BASE), (3, BASE + 259200)]


def test_merge_rewrites_touched_days_only(spark, store):
    ingest.upsert_events(store, events(spark, *(view(i, BASE + 86400 * i) for i in range(4))))
    before = store._latest(EVENTS).days
    ingest.upsert_events(store, events(spark, view(2, BASE + 86400 * 2 + 5)))
    after = store._latest(EVENTS).days
    changed = {day for day in before if before[day] != after[day]}
    assert len(before) == len(after) == 4 and len(changed) == 1


def test_incremental_runs_open_only_the_days_in_reach(spark, store):
    ingest.upsert_events(store, events(spark, *(view(i, BASE + 86400 * i) for i in range(5))))
    pipeline.build_events(store, full_refresh=True)
    assert store.last_day(EVENTS) == pipeline.business_day(pipeline.EPOCH + timedelta(seconds=BASE + 86400 * 4))
    near = store.read(EVENTS, from_day=store.last_day(EVENTS))
    assert len(near.inputFiles()) == 1 and scan.read_watermark(near) == BASE + 86400 * 4
    assert scan.read_watermark(store.read(EVENTS)) == BASE + 86400 * 4
    ingest.upsert_events(store, events(spark, view(9, BASE + 86400 * 4 - 7200), view(8, BASE + 86400 * 4 - 7201)))
    pipeline.build_events(store, lookback_seconds=7200)
    assert sorted(r["id"] for r in store.read(pipeline.SILVER_EVENTS).collect()) == [0, 1, 2, 3, 4, 9]


def test_recent_events_keep_fractions_of_a_second(spark):
    raw = spark.createDataFrame([(1, BASE + 0.25), (2, BASE + 0.250001), (3, BASE + 0.249999)], f"id int, {EVENT_TS} double")
    newest = pipeline.EPOCH + timedelta(seconds=BASE + 10, microseconds=250_000)
    assert sorted(r["id"] for r in pipeline.recent_events(raw, newest, 10).collect()) == [1, 2]


def test_expired_versions_leave_the_kept_ones_readable(spark, store):
    for shift in range(4):
        ingest.upsert_events(store, events(spark, view(1, BASE + shift), view(2, BASE + 86400 * (shift + 1))))
        ingest.replace_snapshot(store, "brand", brand(spark, [(shift, "x")]))
    current, previous = stored(store), store._version(EVENTS, store._commits(EVENTS)[-2])
    assert store.expire(EVENTS, keep=2) == 2 and store.expire(EVENTS, keep=2) == 0
    assert store.expire("brand", keep=1) == 3
    assert stored(store) == current and names(store.read("brand")) == [(3, "x")]
    assert store._frame(EVENTS, previous).count() == 2
    assert len([n for n in store._names("brand", "data")]) == 1
    ingest.upsert_events(store, events(spark, view(3, BASE)))
    assert store.read(EVENTS).count() == 3


def test_merge_follows_the_columns_of_the_new_rows(spark, store):
    day = F.col("d")
    old = spark.createDataFrame([(1, date(2026, 1, 1), "a"), (2, date(2026, 1, 2), "b")], "id int, d date, gone string")
    new = spark.createDataFrame([(2, date(2026, 1, 2), 7.0)], "id int, d date, fresh double")
    store.overwrite("t", old, day=day)
    store.merge("t", new, "id", day)
    assert store.read("t").columns == ["id", "d", "fresh"]
    assert sorted((r["id"], r["fresh"]) for r in store.read("t").collect()) == [(1, None), (2, 7.0)]


def test_empty_batch_writes_nothing(spark, store):
    counts = ingest.upsert_events(store, events(spark))
    assert counts == {"source_rows": 0, "source_ids": 0, "older_ids_skipped": 0, "written_ids": 0}
    assert not store.exists(EVENTS)


def test_schema_guard(spark, store):
    ingest.upsert_events(store, events(spark, view(1, BASE)))
    with pytest.raises(BatchError, match="missing=.*device"):
        ingest.upsert_events(store, events(spark, view(1, BASE + 1)).drop("device"))


def test_concurrent_writers_keep_the_newest_version(spark, store):
    ingest.upsert_events(store, events(spark, view(1, BASE)))
    barrier = threading.Barrier(2)

    def load(shift):
        barrier.wait(timeout=30)
        ingest.upsert_events(TableStore(spark, store.root), events(spark, view(1, BASE + shift, str(shift))))

    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(load, shift) for shift in (200, 300)]:
            done.result(timeout=120)
    assert [(id, ts) for id, ts, _ in stored(store)] == [(1, BASE + 300)]


def test_two_writers_creating_the_table(spark, store):
    class Late(TableStore):
        """Learns of the table only when it commits."""

        def exists(self, name):
            return False

    ingest.upsert_events(store, events(spark, view(1, BASE), view(2, BASE + 5)))
    ingest.upsert_events(Late(spark, store.root), events(spark, view(2, BASE), view(3, BASE)))
    assert [(id, ts) for id, ts, _ in stored(store)] == [(1, BASE), (2, BASE + 5), (3, BASE)]


def test_commit_is_refused_when_somebody_was_first(spark, store):
    store.overwrite("brand", brand(spark, [(1, "a")]))
    with pytest.raises(CommitConflict):
        store._create("brand", f"{1:012d}.json", "{}")
    with pytest.raises(MissingTable):
        store.read("nothing")


def test_scan_since_watermark_is_inclusive_and_pushed_down(spark, tmp_path):
    source = events(spark, view(1, BASE - 7201), view(2, BASE - 7200), view(3, BASE))
    source.write.parquet(str(tmp_path / "src" / EVENTS))
    opened = scan.ParquetSource(spark, str(tmp_path / "src"))
    target = events(spark, view(9, BASE))
    recent = scan.scan_events(opened, target, 7200)
    assert sorted(r["id"] for r in recent.collect()) == [2, 3]
    pushed = [line for line in plan_text(recent).splitlines() if line.startswith("PushedFilters")]
    assert "GreaterThanOrEqual(event_received_on_server_timestamp" in pushed[0]
    assert scan.scan_events(opened, None, 7200).count() == 3
    assert scan.scan_events(opened, target.limit(0), 7200).count() == 3
    ranged = scan.scan_events(opened, target, 7200, scan.Period(BASE - 7201, BASE - 7200))
    assert [r["id"] for r in ranged.collect()] == [1]


def test_fractional_watermark(spark):
    target = spark.createDataFrame([(1, 10000.5)], f"id int, {EVENT_TS} double")
    assert scan.read_watermark(target) - 7200 == 2800.5


def test_watermark_errors_surface(spark):
    source = events(spark, view(1, BASE))
    with pytest.raises(Exception, match=EVENT_TS):
        scan.scan_incremental(source, source.drop(EVENT_TS), 7200)
    endless = spark.createDataFrame([(1, float("inf"))], f"id int, {EVENT_TS} double")
    with pytest.raises(ValueError):
        scan.scan_incremental(source, endless, 7200)


def test_periods():
    """Any two bounds make a period exactly when both are finite and in order."""
    bounds = [-math.inf, -5.5, 0.0, 1e9, math.inf, math.nan]
    for start in bounds:
        for end in bounds:
            if -math.inf < start < end < math.inf:
                assert scan.Period(start, end).end == end
            else:
                with pytest.raises(ValueError):
                    scan.Period(start, end)
    midnight = scan.Period.between("2025-06-01T02:30:00+02:30", datetime(2025, 6, 1, 1, tzinfo=timezone.utc))
    assert (midnight.start, midnight.end - midnight.start) == (1_748_736_000.0, 3600.0)
    for pair in (("2025-06-01", "2025-06-02T00:00:00Z"), (datetime(2025, 6, 1), datetime(2025, 6, 2)), ("soon", "later")):
        with pytest.raises(ValueError):
            scan.Period.between(*pair)


def test_jdbc_options_of_single_tables(spark):
    parts = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    source = scan.JdbcSource(spark, {EVENTS: parts}, url="jdbc:x")
    assert source.options(EVENTS) == {"dbtable": EVENTS, "url": "jdbc:x", **parts}
    assert source.options("brand") == {"dbtable": "brand", "url": "jdbc:x"}
    with pytest.raises(ValueError):
        scan.JdbcSource(spark, {"nothing": parts})


def test_settings():
    assert Settings.of({}) == Settings(7200)
    for seconds in (0, 1, 86_400, 2**31 - 1):
        assert Settings.of({"INGESTION_LOOKBACK_SECONDS": f"{seconds}\n"}).lookback_seconds == seconds
    for text in ("2h", "7_200", "+7200", "-7200", "7200.0", "\u0667", " ", str(2**31)):
        with pytest.raises(ValueError):
            Settings.of({"INGESTION_LOOKBACK_SECONDS": text})


def test_failed_and_lost_writes_leave_no_files(spark, store):
    store.overwrite("brand", brand(spark, [(1, "a")]))
    kept = store._names("brand", "data")
    with pytest.raises(Exception, match="boom"):
        store.overwrite("brand", brand(spark, [(2, "b")]).withColumn("name", F.raise_error(F.lit("boom"))))
    with pytest.raises(CommitConflict):
        store.overwrite("brand", brand(spark, [(2, "b")]), new=True)
    assert store._names("brand", "data") == kept
    with pytest.raises(Exception, match="boom"):
        store.stage(brand(spark, [(2, "b")]).withColumn("name", F.raise_error(F.lit("boom"))))
    assert not store._names("_staging")


def test_commits_need_a_file_system_that_refuses_an_existing_target(spark, store, monkeypatch):
    monkeypatch.setattr("sparkmarts.sources.store.EXCLUSIVE_COMMITS", ("hdfs",))
    with pytest.raises(RuntimeError, match="could be lost"):
        store.overwrite("brand", brand(spark, [(1, "a")]))


def test_snapshot_names():
    with pytest.raises(ValueError):
        scan.scan_snapshot(scan.FrameSource({}), EVENTS)


def test_run_ingest(spark, store):
    source = scan.FrameSource(raw_frames(spark))
    report = ingest.run_ingest(store, source, lookback_seconds=7200)
    assert report["events"][EVENTS] == {
        "source_rows": 14, "source_ids": 13, "older_ids_skipped": 0, "written_ids": 13,
    }
    sizes = {n: len(r) for n, r in catalog().items()}
    assert {name: store.read(name).count() for name in SNAPSHOT_TABLES} == sizes
    assert report["rows"] == {**sizes, EVENTS: 13}
    again = ingest.run_ingest(store, source, lookback_seconds=0)
    assert again["events"][EVENTS]["source_ids"] == 1  # the newest event alone
    assert store.read(EVENTS).count() == len({row[0] for row in clickstream()})
    assert store.read(EVENTS).filter(F.col("session_id").isNull()).count() == 1


def test_loads_and_builds_broadcast_only_what_was_measured(spark, store, monkeypatch):
    """Many keys are few bytes in a compressed file: its size must not decide for a broadcast, in a load or in a build."""
    store.overwrite("keys", spark.range(400_000).select(F.col("id"), (F.col("id") % 3).alias("other")))
    joins, take = [], []
    original = ingest.compare_versions, pipeline.unlike_stored

    def seen(function):
        def run(*args):
            keys = store.read("keys").select("id")
            joined = store.read("keys").join(keys, "id", "left_semi")
            joined.write.format("noop").mode("overwrite").save()
            joins.append(plan_text(joined))
            take.append(joined.count())
            return function(*args)

        return run

    monkeypatch.setattr(ingest, "compare_versions", seen(original[0]))
    monkeypatch.setattr(pipeline, "unlike_stored", seen(original[1]))
    before = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, str(4 << 20))  # above the file's column, below its rows
    try:
        for shift in (0, 10):
            ingest.upsert_events(store, events(spark, *(view(i, BASE + i + shift) for i in range(3))))
            pipeline.build_events(store, lookback_seconds=7200)
        assert spark.conf.get(BROADCAST) == str(4 << 20) and spark.conf.get(MEASURED_BROADCAST, None) is None
    finally:
        spark.conf.set(BROADCAST, before)
    assert len(joins) == 2 and take == [400_000] * 2
    assert not any("Broadcast" in plan for plan in joins)


def test_replays_and_older_rows_are_compared_but_not_staged(spark, store, monkeypatch):
    """Of a batch that repeats what is stored only the news are written out a second time."""
    ingest.upsert_events(store, events(spark, *(view(i, BASE + i) for i in range(5))))
    staged, stage = [], store.stage

    def counted(df):
        made = stage(df)
        staged.append(made.frame.count())
        return made

    monkeypatch.setattr(store, "stage", counted)
    batch = [*(view(i, BASE + i) for i in range(3)), view(3, BASE + 1), view(4, BASE + 50), view(5, BASE + 60)]
    counts = ingest.upsert_events(store, events(spark, *batch))
    assert counts == {"source_rows": 6, "source_ids": 6, "older_ids_skipped": 1, "written_ids": 5}
    assert staged == [6, 2]
    assert [(row[0], row[1]) for row in stored(store)] == [(0, BASE), (1, BASE + 1), (2, BASE + 2), (3, BASE + 3), (4, BASE + 50), (5, BASE + 60)]
