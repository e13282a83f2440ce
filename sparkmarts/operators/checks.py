"""Generic data checks; each returns the violations, an empty result is a pass.

Values are counted before any join or shuffle of rows, so a value that most rows share is one row here.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _per_value(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row (NULLs are the not-null check's business)."""
    return _per_value(df.filter(F.col(column).isNotNull()), column).filter("n_rows > 1")


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    """One row with the number of NULLs, none when there are none."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("n_rows")).filter("n_rows > 0")


def dq_relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child values absent from the parent, with their row counts; NULL children are ignored."""
    values = _per_value(child.filter(F.col(fk).isNotNull()), fk)
    return values.join(parent.select(F.col(pk).alias("value")), "value", "left_anti")


def dq_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the given set, with their row counts; NULL is ignored."""
    return _per_value(df.filter(~F.col(column).isin(*values)), column)


def dq_freshness(
    df: DataFrame, ts: Column, as_of: datetime | Column, warn_hours: float = 24, error_hours: float = 48
) -> DataFrame:
    """One status row: newest instant, its age at `as_of` in hours, and pass / warn / error."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    newest = df.agg(F.max(ts).alias("latest_at"))
    seconds = (F.unix_micros(now.cast("timestamp")) - F.unix_micros("latest_at")) / F.lit(1e6)
    age = seconds / 3600
    status = (
        F.when(age.isNull(), "error").when(age > error_hours, "error").when(age > warn_hours, "warn").otherwise("pass")
    )
    return newest.select("latest_at", age.alias("age_hours"), status.alias("status"))
