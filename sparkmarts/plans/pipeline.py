"""Building the layers from the raw tables of a store, with the data tests as gates."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Iterable, Mapping
from contextlib import ExitStack
from datetime import datetime, timedelta, timezone
from functools import partial
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import lookback
from ..functions import BUSINESS_TZ, business_date, epoch_to_timestamp, fingerprint
from ..operators.versions import merge_by_key
from ..schemas import EVENT_KEY, EVENT_TS, EVENTS, GOLD_NAMES, RAW_SCHEMAS
from ..session import in_threads, measured_broadcasts, pin_utc
from ..sources.store import TableStore
from . import bronze, gold, incremental, silver  # noqa: F401  (register the relations)
from .counts import COUNTS
from .quality import run_tests
from .registry import Marts, inputs_of

SILVER_EVENTS = "silver_user_event_tracking"
# Written to scratch for the length of a build in which several marts read them; counts only if segments have to be added.
SHARED = ("silver_laptop_model", "silver_laptop_benchmark_result", "view_counts", "comparison_counts")


class StoredTables(Mapping):
    """The tables a store holds, opened on demand; counts with their segments added."""

    def __init__(self, store: TableStore, hide: tuple[str, ...] = ()):
        self._store, self._names = store, tuple(n for n in store.names() if n not in hide)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return incremental.read_count(self._store, name) if name in COUNTS else self._store.read(name)

    def __contains__(self, name: object) -> bool:
        return name in self._names

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def business_day(at: datetime) -> str:
    """The day folder of an instant."""
    return at.astimezone(ZoneInfo(BUSINESS_TZ)).date().isoformat()


def _server_day():
    return business_date(F.col("server_timestamp"))


def recent_events(raw: DataFrame, newest: datetime | None, lookback_seconds: int) -> DataFrame:
    """Raw events at or after the silver table's own newest instant minus the lookback."""
    if newest is None:
        return raw
    since = newest - timedelta(seconds=lookback_seconds)
    # The plain comparison (a second wider) reaches the Parquet statistics, the exact one decides.
    return raw.filter(
        (F.col(EVENT_TS) >= since.timestamp() - 1) & (epoch_to_timestamp(F.col(EVENT_TS)) >= F.lit(since))
    )


def newest_instant(stored: DataFrame) -> datetime | None:
    micros = stored.agg(F.unix_micros(F.max("server_timestamp")).alias("at")).first()["at"]
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def silver_incremental(raw: DataFrame, stored: DataFrame, lookback_seconds: int) -> DataFrame:
    """The silver event table after an incremental run, as one relation."""
    fresh = silver.silver_event_table(recent_events(raw, newest_instant(stored), lookback_seconds))
    return merge_by_key(stored, fresh, EVENT_KEY)


def unlike_stored(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows that are not stored already, as they are; a row of other columns is never the same.

    They are joined on the key alone, the marks are compared beside it: rows that come dealt by key, as those of
    `silver_event_table` do, are not shuffled again.
    """
    if set(rows.columns) != set(stored.columns):
        return rows
    values = [F.col(c) for c in rows.columns if c != EVENT_KEY]
    marks = stored.select(F.col(EVENT_KEY).alias("_key"), fingerprint(*values).alias("_mark"))
    marked = rows.withColumn("_own_mark", fingerprint(*values))
    same = (F.col(EVENT_KEY) == F.col("_key")) & (F.col("_own_mark").bitwiseXOR(F.col("_mark")) == 0)
    return marked.join(marks, same, "left_anti").drop("_own_mark")


def build_events(
    store: TableStore,
    full_refresh: bool = False,
    lookback_seconds: int | None = None,
    invalidate: bool = False,
    threads: int = 4,
) -> int:
    """Builds or extends the silver event table and what is derived from its days; returns the table's version.

    Rows of the lookback that are stored already are left alone, so a run without news changes no day. With
    `invalidate`, ids whose newest raw version lost its session or name also leave the table, which by default
    takes a full refresh.
    """
    with measured_broadcasts(store.spark):
        version = _build_events(store, full_refresh, lookback_seconds, invalidate)
        incremental.refresh(store, threads)
    return version


def _build_events(store: TableStore, full_refresh: bool, lookback_seconds: int | None, invalidate: bool) -> int:
    if full_refresh or not store.exists(SILVER_EVENTS):
        return store.overwrite(SILVER_EVENTS, silver.silver_event_table(store.read(EVENTS)), day=_server_day())
    reach = lookback(lookback_seconds)
    # Both tables keep their events by business day of arrival: only the days in reach are opened.
    newest = newest_instant(store.read(SILVER_EVENTS, from_day=store.last_day(SILVER_EVENTS)))
    first_day = None if newest is None else business_day(newest - timedelta(seconds=reach))
    recent = recent_events(store.read(EVENTS, from_day=first_day), newest, reach)
    rejected = recent.filter("event_name is null or session_id is null") if invalidate else None
    fresh = silver.silver_event_table(recent)
    with ExitStack() as staged:

        def news(stored: DataFrame) -> DataFrame:
            return staged.enter_context(store.stage(unlike_stored(fresh, stored)))

        # The keys come straight from the raw table: only what is new is parsed into a staged table.
        keys = silver.eligible_events(recent).select(EVENT_KEY)
        version = store.merge(SILVER_EVENTS, keys, EVENT_KEY, _server_day(), choose=news)
    if rejected is not None:
        version = store.delete(SILVER_EVENTS, rejected.select(EVENT_KEY), EVENT_KEY)
    return version


PASSED = "passed_tests_"


def _tested(store: TableStore, layer: str, tables: tuple[str, ...], marts: Marts, always: bool) -> None:
    """Runs a layer's tests, unless they passed over just these versions of the tables they are about."""
    state = {name: str(store.version(name)) for name in tables}
    name = f"{PASSED}{layer}"
    if always or store.applied(name) != state:
        run_tests(marts, layer)
        counts = [(table, int(version)) for table, version in state.items()]
        store.overwrite(name, store.spark.createDataFrame(counts, "relation string, version bigint"), applied=state)
        store.expire(name)


def build(
    store: TableStore,
    full_refresh: bool = False,
    lookback_seconds: int | None = None,
    threads: int = 4,
    test: bool = True,
    invalidate: bool = False,
) -> Marts:
    """Raw tests, silver events, silver tests, gold tables, gold tests; a failing test stops what follows.

    Relations by day are replaced for the days that changed. The other marts read counts, not events, and are
    left alone where neither counts nor catalog changed, and tests are not repeated over the versions that passed them;
    a full refresh makes and tests all anew.
    """
    pin_utc(store.spark)
    layers = {"raw": tuple(RAW_SCHEMAS), "silver": (*RAW_SCHEMAS, SILVER_EVENTS), "gold": (*RAW_SCHEMAS, SILVER_EVENTS, *GOLD_NAMES)}

    def check(layer: str, marts: Marts) -> None:
        if test:
            _tested(store, layer, layers[layer], marts, always=full_refresh)

    with measured_broadcasts(store.spark):
        _build(store, full_refresh, lookback_seconds, threads, check, invalidate)
    return Marts(StoredTables(store))


def _is_shared(store: TableStore, name: str, marts: Iterable[str]) -> bool:
    readers = sum(name in inputs_of(mart) for mart in marts)
    return readers > 1 and (name not in COUNTS or len(store.days(name)) > 1)


def _build(store: TableStore, full_refresh: bool, lookback_seconds: int | None, threads: int, check, invalidate: bool) -> None:
    check("raw", Marts(StoredTables(store)))
    build_events(store, full_refresh, lookback_seconds, invalidate, threads)
    stored = StoredTables(store, hide=GOLD_NAMES)
    all_time = [name for name in GOLD_NAMES if name not in incremental.DAILY_GOLD]
    states = incremental.stale_marts(store, all_time, always=full_refresh)
    with ExitStack() as stack:
        source = Marts(stored)
        frames = {name: source[name] for name in SHARED if _is_shared(store, name, states)}
        # Each table is registered by the job that wrote it, so it goes even if another job fails.
        jobs = [lambda frame=frame: stack.enter_context(store.stage(frame)) for frame in frames.values()]
        shared = dict(zip(frames, in_threads(store.spark, threads, jobs)))
        marts = Marts(ChainMap(shared, stored))
        check("silver", marts)
        daily = [partial(incremental.refresh_daily, store, *item) for item in incremental.DAILY_GOLD.items()]
        whole = [partial(store.overwrite, name, marts[name], applied=state) for name, state in states.items()]
        in_threads(store.spark, threads, [*daily, *whole])
        check("gold", Marts(ChainMap(shared, StoredTables(store))))
    for name in (SILVER_EVENTS, *incremental.DAILY_SILVER, *COUNTS, *GOLD_NAMES):
        store.expire(name)


def materialize(store: TableStore, name: str, df: DataFrame) -> None:
    """Keeps a relation the way its layer is kept: gold as a stored table, bronze and silver as a view."""
    if name in GOLD_NAMES:
        store.overwrite(name, df)
    else:
        df.createOrReplaceTempView(name)


def publish_views(marts: Marts) -> list[str]:
    """Registers every relation as a temporary view, for use from SQL; counts are no layer's relations."""
    names = [name for name in marts if name not in COUNTS]
    for name in names:
        marts[name].createOrReplaceTempView(name)
    return names


def load_gold(store: TableStore, name: str) -> DataFrame:
    if name not in GOLD_NAMES:
        raise ValueError(f"not a gold relation: {name}")
    return store.read(name)


def missing_gold(store: TableStore) -> list[str]:
    """Gold relations a store does not hold yet; empty when reports can be served."""
    return [name for name in GOLD_NAMES if not store.exists(name)]


def inventory(store: TableStore) -> dict[str, int]:
    """Relations per layer: stored raw and gold tables, declared bronze and silver relations."""
    stored = set(store.names())
    known = Marts(StoredTables(store))
    names = set(known)
    return {
        "raw": sum(name in stored for name in RAW_SCHEMAS),
        "bronze": sum(name.startswith("bronze_") for name in names),
        "silver": sum(name.startswith("silver_") for name in names),
        "gold": sum(name in stored for name in GOLD_NAMES),
    }
