"""Newest-version-wins operators: choose, check and merge versions of keyed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import canonical_json, fingerprint
from ..schemas import EVENT_KEY, EVENT_TS


class BatchError(ValueError):
    """The batch breaks its contract; nothing was written."""


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    Written as row_number() = 1 so that Spark puts a group limit ahead of the shuffle: each task sends at
    most one row per key, whatever share of the rows that key holds.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")


# ---------------------------------------------------------------- batch contract


def check_columns(df: DataFrame, key: str = EVENT_KEY, ts: str = EVENT_TS) -> None:
    if len(set(df.columns)) != len(df.columns):
        raise BatchError(f"column names repeat: {df.columns}")
    missing = {key, ts} - set(df.columns)
    if missing:
        raise BatchError(f"batch lacks {sorted(missing)}")


def assert_same_columns(existing: Sequence[str], incoming: Sequence[str]) -> None:
    missing, extra = set(existing) - set(incoming), set(incoming) - set(existing)
    if missing or extra:
        raise BatchError(f"columns changed: missing={sorted(missing)}, extra={sorted(extra)}")


def _missing_key(key: str) -> Column:
    return F.col(key).isNull() | F.col(key).cast("string").rlike(r"^\s*\z")


def _seconds(ts: str) -> Column:
    return F.col(ts).try_cast("double")


def _bad_seconds(ts: str) -> Column:
    seconds = _seconds(ts)
    return seconds.isNull() | F.isnan(seconds) | (F.abs(seconds) == float("inf"))


def batch_violations(df: DataFrame, key: str = EVENT_KEY, ts: str = EVENT_TS) -> DataFrame:
    """One row: how many rows have no key, or no finite timestamp."""
    return df.agg(
        F.count_if(_missing_key(key)).alias("missing_key"), F.count_if(_bad_seconds(ts)).alias("bad_timestamp")
    )


def canonical_payload(df: DataFrame, columns: Sequence[str] = ("event_data", "device")) -> DataFrame:
    """Nested JSON columns as canonical text; text columns stay as they are."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *(
            canonical_json(F.col(field.name), field.dataType).alias(field.name)
            if field.name in columns and isinstance(field.dataType, nested)
            else F.col(field.name)
            for field in df.schema.fields
        )
    )


def _mark(payload: Sequence[str], schema: T.StructType) -> Column:
    """Fingerprint of a payload, taken in the types of `schema` and in an order free of the column order."""
    return fingerprint(*(F.col(c).cast(schema[c].dataType) for c in sorted(payload)))


def resolve_versions(df: DataFrame, key: str = EVENT_KEY, ts: str = EVENT_TS) -> DataFrame:
    """One row per key: its newest version plus `_rows`, `_bad_rows` and `_conflict`.

    A key conflicts when two different payloads share its newest timestamp. The highest and the lowest
    fingerprint there are plain max/min states, so replays and old versions collapse before the shuffle and no key, however
    frequent, is gathered in one task. The outcome does not depend on row order or partitioning.
    """
    check_columns(df, key, ts)
    df = canonical_payload(df)
    columns = df.columns
    payload = [c for c in columns if c != key]
    # Computed ahead of the aggregation, once per row for the states that read them.
    marked = df.withColumns({"_at": _seconds(ts), "_mark": _mark(payload, df.schema)})
    resolved = marked.groupBy(key).agg(
        F.max_by(F.struct(*payload, "_mark"), F.struct("_at", "_mark")).alias("_newest"),
        F.min(F.struct((-F.col("_at")).alias("_before"), "_mark")).alias("_first"),
        F.count("*").alias("_rows"),
        F.count_if(_bad_seconds(ts)).alias("_bad_rows"),
    )
    return resolved.select(
        *(F.col(c) if c == key else F.col(f"_newest.{c}").alias(c) for c in columns),
        "_rows",
        "_bad_rows",
        (F.col("_newest._mark") != F.col("_first._mark")).alias("_conflict"),
    )


def batch_latest(df: DataFrame, key: str = EVENT_KEY, ts: str = EVENT_TS) -> DataFrame:
    """Newest version per key, identical replays collapsed (conflicts are reported by `batch_conflicts`)."""
    return resolve_versions(df, key, ts).drop("_rows", "_bad_rows", "_conflict")


def batch_conflicts(df: DataFrame, key: str = EVENT_KEY, ts: str = EVENT_TS) -> DataFrame:
    """Keys whose newest timestamp carries more than one payload."""
    return resolve_versions(df, key, ts).filter("_conflict").select(key)


def batch_summary(resolved: DataFrame, key: str = EVENT_KEY) -> DataFrame:
    return resolved.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("source_rows"),
        F.count("*").alias("source_ids"),
        F.count_if(_missing_key(key)).alias("missing_key"),
        F.coalesce(F.sum("_bad_rows"), F.lit(0)).alias("bad_timestamp"),
        F.count_if("_conflict").alias("conflicts"),
        F.min(key).alias("lowest_key"),
        F.max(key).alias("highest_key"),
    )


def require_clean(summary) -> None:
    """Raises when a `batch_summary` row reports a broken contract."""
    if summary["missing_key"]:
        raise BatchError(f"{summary['missing_key']} ids without a value")
    if summary["bad_timestamp"]:
        raise BatchError(f"{summary['bad_timestamp']} rows without a finite timestamp")
    if summary["conflicts"]:
        raise BatchError(f"{summary['conflicts']} ids with different payloads at their newest timestamp")


def prepare_batch(df: DataFrame, key: str = EVENT_KEY, ts: str = EVENT_TS) -> DataFrame:
    """Checks the batch and returns its newest versions."""
    check_columns(df, key, ts)
    resolved = resolve_versions(df, key, ts)
    require_clean(batch_summary(resolved, key).first())
    return resolved.drop("_rows", "_bad_rows", "_conflict")


# ---------------------------------------------------------------- upsert


def compare_versions(latest: DataFrame, target: DataFrame, key: str = EVENT_KEY, ts: str = EVENT_TS) -> DataFrame:
    """Prepared rows against the stored ones: `_older`, `_clash` and `_same` say what the upsert may do with each.

    Of the stored table only key, timestamp and a fingerprint are moved.
    """
    payload = [c for c in target.columns if c != key]
    stored = target.select(
        F.col(key).alias("_key"), _seconds(ts).alias("_stored_at"), _mark(payload, target.schema).alias("_stored_mark")
    )
    joined = latest.join(stored, F.col(key) == F.col("_key"), "left")
    seconds = _seconds(ts)
    tie = seconds == F.col("_stored_at")
    clash = tie & (_mark(payload, target.schema) != F.col("_stored_mark"))
    same = tie & (_mark(payload, target.schema) == F.col("_stored_mark"))
    return joined.select(
        *latest.columns,
        F.coalesce(seconds < F.col("_stored_at"), F.lit(False)).alias("_older"),
        F.coalesce(clash, F.lit(False)).alias("_clash"),
        F.coalesce(same, F.lit(False)).alias("_same"),
    )


def merge_by_key(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Delete-and-insert: stored rows with a key in `rows` give way.

    The columns follow `rows`: stored rows get NULL in a new column and lose one that is gone.
    """
    kept = target.join(rows.select(key), key, "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True).select(*rows.columns)


def upsert_versions(latest: DataFrame, target: DataFrame, key: str = EVENT_KEY, ts: str = EVENT_TS) -> DataFrame:
    """Target after the upsert of prepared rows: newer and equal versions replace, older ones are dropped.

    One shuffle of both sides on the key; on equal timestamps (identical rows) the batch row stands.
    """
    assert_same_columns(target.columns, latest.columns)
    stacked = target.withColumn("_side", F.lit(0)).unionByName(latest.withColumn("_side", F.lit(1)))
    return newest_per_key(stacked, [key], [_seconds(ts).desc(), F.col("_side").desc()]).drop("_side")


def upsert_counts(batch: DataFrame, target: DataFrame, key: str = EVENT_KEY, ts: str = EVENT_TS) -> DataFrame:
    """One row: source rows, source ids, ids skipped as older, ids written."""
    compared = compare_versions(resolve_versions(batch, key, ts), target, key, ts)
    return compared.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("source_rows"),
        F.count("*").alias("source_ids"),
        F.count_if("_older").alias("older_ids_skipped"),
        F.count_if(~F.col("_older")).alias("written_ids"),
    )


def upsert_conflicts(latest: DataFrame, target: DataFrame, key: str = EVENT_KEY, ts: str = EVENT_TS) -> DataFrame:
    """Keys stored with the same timestamp but another payload."""
    return compare_versions(latest, target, key, ts).filter("_clash").select(key)
