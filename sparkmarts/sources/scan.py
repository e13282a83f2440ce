"""Reading a source: whole snapshots, the part past a watermark, or a bounded range."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT_TS, EVENTS, RAW_SCHEMAS, SNAPSHOT_TABLES


class ParquetSource:
    """Source tables as `<root>/<table>` Parquet folders, read with their declared schemas."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self._spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self._root}/{name}")


class JdbcSource:
    """Source tables over JDBC; the driver jar and its options (url, user, ...) come from the caller.

    `per_table` adds options to single tables: a large one needs partitionColumn, lowerBound, upperBound and
    numPartitions of its own, or it is read over one connection by one task.
    """

    def __init__(self, spark: SparkSession, per_table: Mapping[str, Mapping[str, str]] | None = None, **options: str):
        self._spark, self._options, self._per_table = spark, options, dict(per_table or {})
        if unknown := set(self._per_table) - set(RAW_SCHEMAS):
            raise ValueError(f"not source tables: {sorted(unknown)}")

    def options(self, name: str) -> dict[str, str]:
        if name not in RAW_SCHEMAS:
            raise ValueError(f"not a source table: {name}")
        return {"dbtable": name, **self._options, **self._per_table.get(name, {})}

    def table(self, name: str) -> DataFrame:
        return self._spark.read.format("jdbc").options(**self.options(name)).load()


class FrameSource:
    """Source tables given as DataFrames (fixtures, or tables another job has opened)."""

    def __init__(self, frames: dict[str, DataFrame]):
        self.frames = dict(frames)

    def table(self, name: str) -> DataFrame:
        return self.frames[name]


def scan_snapshot(source, name: str) -> DataFrame:
    if name not in SNAPSHOT_TABLES:
        raise ValueError(f"not a snapshot table: {name}")
    return source.table(name)


@dataclass(frozen=True)
class Period:
    """A stretch of server time in epoch seconds, its end exclusive. There is no unbounded, empty or reversed one."""

    start: float
    end: float

    def __post_init__(self):
        if not -math.inf < self.start < self.end < math.inf:
            raise ValueError(f"not a period: {self.start} to {self.end}")

    @classmethod
    def between(cls, start: str | datetime, end: str | datetime) -> Period:
        """From ISO 8601 texts or datetimes, which must say their offset from UTC."""
        moments = [datetime.fromisoformat(m) if isinstance(m, str) else m for m in (start, end)]
        if any(m.utcoffset() is None for m in moments):
            raise ValueError("both ends of a period need an offset from UTC")
        return cls(*(m.timestamp() for m in moments))

    def holds(self, ts: str) -> Column:
        """The bounds are literals, so they reach the source scan."""
        return (F.col(ts) >= F.lit(float(self.start))) & (F.col(ts) < F.lit(float(self.end)))


def watermark(target: DataFrame, ts: str = EVENT_TS) -> DataFrame:
    """One row with the newest timestamp of the target, NULL when it is empty."""
    return target.agg(F.max(ts).alias("watermark"))


def read_watermark(target: DataFrame | None, ts: str = EVENT_TS) -> float | None:
    """The watermark as a number. Errors surface: a failed read never turns into a full scan."""
    if target is None:
        return None
    value = watermark(target, ts).first()["watermark"]
    if value is None:
        return None
    if not math.isfinite(float(value)):
        raise ValueError("the watermark must be finite")
    return float(value)


def scan_range(df: DataFrame, period: Period, ts: str = EVENT_TS) -> DataFrame:
    return df.filter(period.holds(ts))


def scan_since(df: DataFrame, newest: float | None, lookback_seconds: int, ts: str = EVENT_TS) -> DataFrame:
    """Rows at or after newest - lookback; everything when there is no watermark yet."""
    return df if newest is None else df.filter(F.col(ts) >= F.lit(newest - lookback_seconds))


def scan_incremental(
    df: DataFrame, target: DataFrame | None, lookback_seconds: int, ts: str = EVENT_TS
) -> DataFrame:
    return scan_since(df, read_watermark(target, ts), lookback_seconds, ts)


def scan_events(source, target: DataFrame | None, lookback_seconds: int, period: Period | None = None) -> DataFrame:
    """The events of a run: a period where one is given (the watermark is not read), else past the watermark."""
    events = source.table(EVENTS)
    return scan_incremental(events, target, lookback_seconds) if period is None else scan_range(events, period)
