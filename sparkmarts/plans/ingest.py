"""Raw loading: snapshot replacement and versioned event upsert, each table committed on its own."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import lookback
from ..functions import business_date, epoch_to_timestamp, fingerprint
from ..operators.versions import (
    BatchError,
    assert_same_columns,
    batch_summary,
    check_columns,
    compare_versions,
    require_clean,
    resolve_versions,
)
from ..schemas import EVENT_KEY, EVENT_TS, EVENTS, SNAPSHOT_TABLES
from ..session import measured_broadcasts
from ..sources.scan import Period, scan_events, scan_snapshot
from ..sources.store import CommitConflict, TableStore

_MARKS = ("_rows", "_bad_rows", "_conflict")


def event_day(ts: str = EVENT_TS) -> Column:
    return business_date(epoch_to_timestamp(F.col(ts).try_cast("double")))


def content(df: DataFrame) -> dict[str, Column]:
    """Rows and order-free sums of two kinds of hash over them: equal for equal content, however it is stored."""
    columns = [F.col(c) for c in sorted(df.columns)]
    return {
        "rows": F.count("*"),
        "content": F.sum(fingerprint(*columns).cast("decimal(38,0)")),
        "check": F.sum(F.hash(*columns).cast("bigint")),
    }


def replace_snapshot(store: TableStore, name: str, df: DataFrame) -> int:
    """Replaces a snapshot table; an empty source or another column set leaves the old rows in place.

    The source is read once. A snapshot with the content of the stored one adds no version, so nothing that
    depends on it is made anew.
    """
    if name not in SNAPSHOT_TABLES:
        raise ValueError(f"not a snapshot table: {name}")
    if store.exists(name):
        stored = store.read(name)
        assert_same_columns(stored.columns, df.columns)
        df = df.select(*(F.col(f.name).cast(f.dataType) for f in stored.schema.fields))
    if store.overwrite_unless(name, df, content(df), refused=lambda found: found["rows"] == "0") is None:
        raise BatchError(f"source of {name} is empty; the stored rows are kept")
    return store.version(name)


def upsert_events(store: TableStore, df: DataFrame, name: str = EVENTS) -> dict[str, int]:
    """Loads an event batch: newer and equal versions replace, older ones are skipped, clashes raise.

    The batch is reduced to one row per id and staged once; every check runs on the staged rows before the
    first write to the table.
    """
    with measured_broadcasts(store.spark):
        return _upsert_events(store, df, name)


def _upsert_events(store: TableStore, df: DataFrame, name: str) -> dict[str, int]:
    key, ts = EVENT_KEY, EVENT_TS
    check_columns(df, key, ts)
    with store.stage(resolve_versions(df, key, ts)) as staged:
        summary = batch_summary(staged, key).first()
        require_clean(summary)
        counts = {
            "source_rows": summary["source_rows"],
            "source_ids": summary["source_ids"],
            "older_ids_skipped": 0,
            "written_ids": summary["source_ids"],
        }
        if not counts["source_ids"]:
            return counts
        latest = staged.drop(*_MARKS)
        if not store.exists(name):
            try:
                store.overwrite(name, latest, day=event_day(ts), new=True)
                return counts
            except CommitConflict:
                pass  # somebody else created the table meanwhile: merge onto it
        target = store.read(name)
        assert_same_columns(target.columns, latest.columns)
        latest = latest.select(*(F.col(f.name).cast(f.dataType) for f in target.schema.fields))

        with ExitStack() as staged_choices:

            def winners(stored: DataFrame) -> DataFrame:
                # Counted while they are compared: replays are not staged, and their days are left as they are.
                seen = Observation()
                compared = compare_versions(latest, stored, key, ts).observe(
                    seen, F.count_if("_older").alias("older"), F.count_if("_clash").alias("clashes")
                )
                news = compared.filter(~F.col("_older") & ~F.col("_same")).drop("_older", "_clash", "_same")
                chosen = staged_choices.enter_context(store.stage(news))
                outcome = seen.get
                if outcome["clashes"]:
                    raise BatchError(f"{outcome['clashes']} ids are stored with the same timestamp but another payload")
                counts["older_ids_skipped"] = outcome["older"]
                counts["written_ids"] = counts["source_ids"] - outcome["older"]  # a replay counts as written
                return chosen

            store.merge(name, latest, key, event_day(ts), choose=winners)
        return counts


def run_ingest(
    store: TableStore,
    source,
    period: Period | None = None,
    lookback_seconds: int | None = None,
) -> dict:
    """The five snapshots, then the events: of a period where one is given, else past the watermark."""
    reach = lookback(lookback_seconds)
    for name in SNAPSHOT_TABLES:
        replace_snapshot(store, name, scan_snapshot(source, name))
    # Days follow the timestamp, so the newest day alone holds the watermark.
    target = store.read(EVENTS, from_day=store.last_day(EVENTS)) if store.exists(EVENTS) else None
    counts = upsert_events(store, scan_events(source, target, reach, period))
    for name in (*SNAPSHOT_TABLES, EVENTS):
        if store.exists(name):
            store.expire(name)
    # Row counts of plain columns come from the files' footers.
    rows = {name: store.read(name).count() for name in (*SNAPSHOT_TABLES, EVENTS) if store.exists(name)}
    return {"lookback_seconds": reach, "events": {EVENTS: counts}, "rows": rows}
