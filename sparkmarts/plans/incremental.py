"""Keeps what is derived from the event table up to date from the days that changed.

The commit of a table by day names, for each day, the write that holds its rows. A derived table's commit repeats the
names of its source that it was made from, so the changed days are those whose names differ: nobody has to announce
them, a run that failed half way is caught up by the next, and without a difference no data file is opened.

* Relations of the grain of a day are replaced for the changed days.
* Marts over all time are made from counts and the catalog, and only where a version of these is new.
* Counts over all time (`counts`) get a segment with the difference: the changed days' new rows counted, their old rows,
  which the names still lead to, subtracted. Segments are added when read and merged into one from time to time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import in_threads
from ..sources.store import TableStore, day_text
from . import gold, silver  # noqa: F401  (register the relations)
from .counts import BRIDGE, COUNTS, EVENTS_TABLE, added
from .registry import Marts, inputs_of

# Relations by day -> the table by day that they are made from, in the order in which they are made.
DAILY_SILVER = {
    "silver_session_day": EVENTS_TABLE,
    BRIDGE: EVENTS_TABLE,
    "silver_device_traffic_event": EVENTS_TABLE,
}
DAILY_GOLD = {"gold_daily_site_kpis": "silver_session_day", "gold_behavior_funnel_daily": "silver_session_day"}
MOST_SEGMENTS = 8


@dataclass(frozen=True)
class Changes:
    """Days of a source that differ from those a derived table was made from: as they were and as they are."""

    old: dict[str, str]
    new: dict[str, str]
    now: dict[str, str]  # all days

    def __bool__(self) -> bool:
        return bool(self.old or self.new)

    @property
    def days(self) -> set[str]:
        return set(self.old) | set(self.new)


def changes(store: TableStore, name: str, source: str) -> Changes | None:
    """What a derived table lacks; None where it does not say what it was made from."""
    seen, now = store.applied(name), store.days(source)
    if seen is None:
        return None
    return Changes(
        {day: write for day, write in seen.items() if now.get(day) != write},
        {day: write for day, write in now.items() if seen.get(day) != write},
        now,
    )


def refresh_daily(store: TableStore, name: str, source: str) -> set[str]:
    """Replaces a relation's changed days; returns them."""
    found = changes(store, name, source)
    whole = found is None
    if whole:
        now = store.days(source)
        found = Changes({}, now, now)
    elif not found:
        return set()
    rows = Marts({source: store.read_days(source, found.new)})[name]
    gone = set(store.days(name)) if whole else found.days
    store.replace_parts(name, rows, day_text(F.col("event_date")), gone, found.now)
    return found.days


def _segment(number: int) -> str:
    return f"segment-{number:06d}"


def refresh_count(store: TableStore, name: str) -> set[str]:
    """Takes the changed days into a count; returns them.

    It is counted anew where it is cheaper (most days changed), or where the old rows are no longer kept.
    """
    count, segments = COUNTS[name], store.days(name)
    found = changes(store, name, count.source)
    if found is not None and not found:
        return set()
    if found is None or 2 * len(found.days) > len(found.now) or not store.holds(count.source, found.old):
        rows = count.of(store.read(count.source))
        now = store.days(count.source)
        store.replace_parts(name, rows, F.lit(_segment(0)), set(segments), now)
        return set(now)
    taken = count.of(store.read_days(count.source, found.old)).withColumn("n", -F.col("n"))
    difference = count.of(store.read_days(count.source, found.new)).unionByName(taken)
    if len(segments) < MOST_SEGMENTS:
        number = 1 + max((int(s.rsplit("-", 1)[1]) for s in segments), default=0)
        store.replace_parts(name, added(difference, count.keys), F.lit(_segment(number)), set(), found.now)
    else:
        merged = added(store.read(name).unionByName(difference), count.keys)
        store.replace_parts(name, merged, F.lit(_segment(0)), set(segments), found.now)
    return found.days


def read_count(store: TableStore, name: str) -> DataFrame:
    """The segments added; one alone was added when it was written."""
    rows = store.read(name)
    return rows if len(store.days(name)) == 1 else added(rows, COUNTS[name].keys)


def made_from(name: str, versions: Mapping[str, int]) -> dict[str, str]:
    """The stored tables that a relation is made from, with their versions."""
    found, open_names = {}, list(inputs_of(name))
    while open_names:
        parent = open_names.pop()
        if parent in versions:
            found[parent] = str(versions[parent])
        else:
            open_names += inputs_of(parent)
    return found


def stale_marts(store: TableStore, names: Iterable[str], always: bool = False) -> dict[str, dict[str, str]]:
    """The marts over all time whose tables have changed since they were made (or all), with what to make them from."""
    versions = {name: store.version(name) for name in store.names() if name not in names}
    states = {name: made_from(name, versions) for name in names}
    return {name: state for name, state in states.items() if always or store.applied(name) != state}


def refresh(store: TableStore, threads: int = 4) -> dict[str, set[str]]:
    """Brings all that is derived from the event table up to date; the changed days by table."""
    daily = [partial(refresh_daily, store, *item) for item in DAILY_SILVER.items()]
    done = dict(zip(DAILY_SILVER, in_threads(store.spark, threads, daily), strict=True))
    counted = in_threads(store.spark, threads, [partial(refresh_count, store, name) for name in COUNTS])
    return done | dict(zip(COUNTS, counted, strict=True))
