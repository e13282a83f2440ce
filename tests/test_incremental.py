"""What an incremental run leaves, against everything made anew; and how little it does when little is new."""

import os
import shutil
from collections import Counter
from functools import partial

import harness
import pytest
from pyspark.sql import functions as F

from sparkmarts import query_catalog as catalog
from sparkmarts.operators.versions import BatchError
from sparkmarts.plans import incremental, ingest, pipeline
from sparkmarts.plans.counts import COUNTS, EVENTS_TABLE
from sparkmarts.plans.registry import RELATIONS, Marts
from sparkmarts.schemas import EVENT_TS, EVENTS, GOLD_NAMES, RAW_SCHEMAS, SILVER_NAMES
from sparkmarts.session import in_threads
from sparkmarts.sources import scan
from sparkmarts.sources.driver_tables import RawTables
from sparkmarts.sources.store import TableStore

SF_DIR = os.path.join(harness.TESTDATA, "sf0.001")
DERIVED = (*incremental.DAILY_SILVER, *incremental.DAILY_GOLD, *COUNTS)
MARTS = tuple(name for name in GOLD_NAMES if name not in incremental.DAILY_GOLD)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The raw tables as stored files, so that every step reads the same rows quickly."""
    folder = tmp_path_factory.mktemp("raw")
    tables = RawTables(spark, SF_DIR)
    for name in RAW_SCHEMAS:
        tables[name].write.parquet(str(folder / name))
    return {name: spark.read.schema(tables[name].schema).parquet(str(folder / name)) for name in RAW_SCHEMAS}


class Site:
    def __init__(self, spark, root, raw):
        self.store, self.raw = TableStore(spark, root), raw

    def load(self, events, period=None):
        ingest.run_ingest(self.store, scan.FrameSource({**self.raw, EVENTS: events}), period, catalog.WHOLE_MONTH)

    def build(self, reach=catalog.WHOLE_MONTH, **options):
        pipeline.build(self.store, lookback_seconds=reach, test=False, **options)

    def versions(self, names=(*DERIVED, *MARTS)):
        return {name: self.store.version(name) for name in names}

    def extend(self, reach=catalog.WHOLE_MONTH):
        """The event table and what is derived from its days, without the marts."""
        pipeline.build_events(self.store, lookback_seconds=reach)

    def check(self, hide=()):
        """Every silver and gold relation as the store has it, against the relation over the stored event table."""
        stored = pipeline.Marts(pipeline.StoredTables(self.store, hide))
        anew = Marts({name: self.store.read(name) for name in (*RAW_SCHEMAS, EVENTS_TABLE)})
        names = (*SILVER_NAMES, *GOLD_NAMES, *COUNTS)
        same = lambda name: plain(stored[name]) == plain(anew[name])
        found = in_threads(self.store.spark, 6, [partial(same, name) for name in names])
        assert [name for name, equal in zip(names, found, strict=True) if not equal] == []


def plain(df):
    rows = df.select(*sorted(df.columns)).collect()
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in rows)


@pytest.fixture(scope="module")
def first_site(spark, tmp_path_factory, raw):
    site = Site(spark, str(tmp_path_factory.mktemp("first") / "store"), raw)
    site.load(catalog.first_delivery(raw[EVENTS]))
    site.build(full_refresh=True)
    return site


@pytest.fixture
def site(spark, tmp_path, first_site):
    """A copy of its own of the store after the first delivery."""
    shutil.copytree(first_site.store.root, tmp_path / "store")
    return Site(spark, str(tmp_path / "store"), first_site.raw)


def test_corrections_moves_and_deletions(site, raw):
    """Half a day's move, a lost session and new days: only their days are replaced, and all is as if made anew."""
    before = {name: site.store.days(name) for name in DERIVED}
    site.load(raw[EVENTS])
    site.build(invalidate=True)
    days = site.store.days("silver_session_day")
    kept = {day for day, write in days.items() if before["silver_session_day"].get(day) == write}
    assert {f"2024-01-{d:02d}" for d in (3, 4, 5, 8, 9, 17, 18, 22, 23)} <= kept and not kept & {"2024-01-12", "2024-01-28"}
    for name in COUNTS:  # the first segment is as it was, a second has the difference
        segments = site.store.days(name)
        assert len(segments) == 2 and before[name].items() <= segments.items()
    assert site.store.read("platform_counts").filter("n < 0").count() > 0
    site.check()
    assert site.store.read(EVENTS_TABLE).filter("session_id = 'ghost'").isEmpty()


def test_a_run_without_news_opens_no_day(spark, site):
    before, events = site.versions(), site.store.version(EVENTS_TABLE)
    snapshots = {name: site.store.version(name) for name in RAW_SCHEMAS if name != EVENTS}
    site.load(catalog.first_delivery(site.raw[EVENTS]))
    site.build()
    assert site.versions() == before and site.store.version(EVENTS_TABLE) == events
    assert {name: site.store.version(name) for name in snapshots} == snapshots
    spark.sparkContext.setJobGroup("refresh", "nothing to do")
    assert not any(incremental.refresh(site.store, threads=1).values())
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("refresh")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


def test_a_changed_catalog_makes_its_marts_anew(site):
    before = site.versions()
    brands = site.raw["brand"].withColumn("name", F.concat("name", F.lit(" (new)")))
    site.raw = {**site.raw, "brand": brands}
    site.load(catalog.first_delivery(site.raw[EVENTS]))
    site.build()
    changed = {name for name, version in site.versions().items() if version != before[name]}
    assert changed == {
        "gold_brand_interest", "gold_brand_comparison", "gold_cpu_trend", "gold_gpu_trend", "gold_performance_ranking",
        "gold_performance_efficiency", "gold_battery_vs_interest", "gold_spec_popularity",
    }
    site.check()


def test_a_backfill_comes_with_the_full_build(site, raw):
    middle = scan.Period(catalog.UNNAMED + 86400 * 3, catalog.UNNAMED + 86400 * 5)
    corrected = raw[EVENTS].withColumn("event_data", F.lit("{}")).withColumn(EVENT_TS, F.col(EVENT_TS) + 1)
    site.load(corrected, middle)
    site.extend(reach=7200)
    assert site.store.read(EVENTS_TABLE).filter("event_data = '{}'").count() < site.store.read(EVENTS).filter("event_data = '{}'").count()
    site.build(full_refresh=True)
    site.check()
    assert all(len(site.store.days(name)) == 1 for name in COUNTS)


def test_small_runs_merge_their_segments(site, raw, monkeypatch):
    monkeypatch.setattr(incremental, "MOST_SEGMENTS", 2)
    seen = []
    for day in range(3):
        site.load(raw[EVENTS].filter(F.col(EVENT_TS) < catalog.LATE + 86400 * (day + 1)))
        site.extend()
        seen.append(len(site.store.days("view_counts")))
    assert seen == [2, 1, 2]
    site.check(hide=GOLD_NAMES)  # marts over the stored counts


def test_a_run_that_ended_early_is_caught_up(site, raw):
    """Two versions of the event table later, the derived tables still find the days they were made from."""
    for until in (catalog.LATE + 86400, catalog.LATE + 2 * 86400):
        site.load(raw[EVENTS].filter(F.col(EVENT_TS) < until))
        pipeline._build_events(site.store, False, catalog.WHOLE_MONTH, False)
    assert incremental.changes(site.store, "view_counts", EVENTS_TABLE)
    incremental.refresh(site.store)
    site.check(hide=GOLD_NAMES)


def test_old_rows_that_are_gone_are_counted_anew(site, raw):
    for until in (catalog.LATE + 86400, catalog.LATE + 2 * 86400):
        site.load(raw[EVENTS].filter(F.col(EVENT_TS) < until))
        pipeline._build_events(site.store, False, catalog.WHOLE_MONTH, False)
        site.store.expire(EVENTS_TABLE, keep=1)
    old = incremental.changes(site.store, "view_counts", EVENTS_TABLE).old
    assert old and not site.store.holds(EVENTS_TABLE, old)
    incremental.refresh(site.store)
    assert len(site.store.days("view_counts")) == 1
    site.check(hide=GOLD_NAMES)


def test_marts_over_counts_scan_no_events(site):
    """Their plans open counts and catalog tables alone, and multiply no rows for distinct numbers."""
    marts = pipeline.Marts(pipeline.StoredTables(site.store, hide=GOLD_NAMES))
    for name in MARTS:
        plan = harness.plan_text(marts[name])
        assert f"/{EVENTS_TABLE}/" not in plan and f"/{EVENTS}/" not in plan, name
        assert "Expand" not in plan, name


def test_what_several_marts_read_is_made_once(site, raw):
    """Benchmarks of three marts, and counts with segments to add; a single segment is read as it is."""
    shared = lambda names=MARTS: {n for n in pipeline.SHARED if pipeline._is_shared(site.store, n, names)}
    added = lambda name: "Exchange" in harness.plan_text(incremental.read_count(site.store, name))
    assert shared() == {"silver_laptop_model", "silver_laptop_benchmark_result"}
    assert not shared(("gold_battery_vs_interest", "gold_user_os")) and not any(map(added, COUNTS))
    site.load(raw[EVENTS].filter(F.col(EVENT_TS) < catalog.LATE + 86400))
    site.extend()
    assert shared() == set(pipeline.SHARED) and all(map(added, COUNTS))


def test_snapshots_are_read_once(spark, store, raw):
    """The write takes the measures; an empty source and equal content commit nothing and leave no files."""
    brands = raw["brand"]
    assert ingest.replace_snapshot(store, "brand", brands) == 1
    assert ingest.replace_snapshot(store, "brand", brands.repartition(3).orderBy(F.desc("id"))) == 1
    with pytest.raises(BatchError):
        ingest.replace_snapshot(store, "brand", brands.limit(0))
    assert store.version("brand") == 1 and len(store._names("brand", "data")) == 1
    # Two rows that trade names are other content.
    traded = brands.withColumn("name", F.when(F.col("id") == 11, "x").when(F.col("id") == 12, "y").otherwise(F.col("name")))
    back = brands.withColumn("name", F.when(F.col("id") == 11, "y").when(F.col("id") == 12, "x").otherwise(F.col("name")))
    assert [ingest.replace_snapshot(store, "brand", df) for df in (traded, back, back)] == [2, 3, 3]


def test_counts_are_relations_without_a_store(raw):
    assert set(COUNTS) <= set(RELATIONS)
    marts = Marts(raw)
    views = marts["view_counts"].agg(F.sum("n")).first()[0]
    assert views == marts[EVENTS_TABLE].filter("event_name = 'pageview' AND page_name = 'DeviceDetail' AND device_id IS NOT NULL").count()
