"""Exact ranks without gathering a whole table, or a whole partition key, in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Codes are accumulated in buckets of 2**20 neighbouring codes: a window inside a bucket sees at most a
# million rows, one over buckets 4096 for a 32-bit integer, or a million for decimals up to 2**40 units of
# their last digit (a hundred million minutes at four places).
BUCKET_BITS = 20
MISSING_CODE = -(1 << 61)  # below every integer and every 18-digit decimal: missing values rank last


def order_code(value: Column, dtype: T.DataType) -> Column:
    """Order-preserving bigint of an integer or a decimal of at most 18 digits; NULL is lowest."""
    if isinstance(dtype, T.DecimalType):
        if dtype.precision > 18:
            raise TypeError(f"cannot rank {dtype.simpleString()}: more than 18 digits")
        value = value * F.lit(10**dtype.scale).cast("decimal(18,0)")
    elif not isinstance(dtype, T.IntegerType | T.ShortType | T.ByteType):
        raise TypeError(f"cannot rank {dtype.simpleString()}")
    return F.coalesce(value.cast("bigint"), F.lit(MISSING_CODE))


def rows_ahead(histogram: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per histogram row (by..., code, n) the number of rows of its group with a greater code, as `ahead`.

    Bucket totals are accumulated first, then the codes within each bucket. Equal values are one histogram
    row, so a frequent value or a large group costs no more than its distinct values.
    """
    bucketed = histogram.withColumn("bucket", F.shiftright("code", BUCKET_BITS))

    def before(column: str, *within: str) -> Column:
        earlier = Window.partitionBy(*within).orderBy(F.desc(column)).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(earlier), F.lit(0))

    totals = bucketed.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    offsets = totals.select(
        *(F.col(c).alias(f"_{c}") for c in (*by, "bucket")), before("bucket", *by).alias("buckets_ahead")
    )
    inside = bucketed.select(*by, "bucket", "code", before("code", *by, "bucket").alias("codes_ahead"))
    same_bucket = F.col("bucket") == F.col("_bucket")
    for c in by:
        same_bucket &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return inside.join(offsets, same_bucket).select(
        *by, "code", (F.col("buckets_ahead") + F.col("codes_ahead")).alias("ahead")
    )


def add_ranks(df: DataFrame, within: str, measures: dict[str, tuple[str, str]]) -> DataFrame:
    """RANK() by each measure, descending with NULLs last, inside `within` and over all rows.

    `measures` maps a value column to the names of its (inner, overall) rank columns.
    """
    dtypes = {field.name: field.dataType for field in df.schema.fields}
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("measure"),
                F.lit(inner).alias("inner"),
                (F.col(within) if inner else F.lit(None).cast(dtypes[within])).alias("grp"),
                order_code(F.col(name), dtypes[name]).alias("code"),
            )
            for name in measures
            for inner in (True, False)
        )
    )
    # One pass and one shuffle count the values of all measures, by group and overall.
    histogram = df.select(F.inline(entries)).groupBy("measure", "inner", "grp", "code").agg(F.count("*").alias("n"))
    ranks = rows_ahead(histogram, ["measure", "inner", "grp"]).withColumn("rank", F.col("ahead") + 1)
    overall = ranks.filter(~F.col("inner")).select("measure", "code", F.col("rank").alias("overall"))
    both = ranks.filter("inner").select("measure", "grp", "code", "rank").join(overall, ["measure", "code"])

    for name, (inner_rank, overall_rank) in measures.items():
        places = both.filter(F.col("measure") == name).select(
            F.col("grp").alias("_grp"),
            F.col("code").alias("_code"),
            F.col("rank").alias(inner_rank),
            F.col("overall").alias(overall_rank),
        )
        same_place = F.col(within).eqNullSafe(F.col("_grp")) & (
            order_code(F.col(name), dtypes[name]) == F.col("_code")
        )
        df = df.join(places, same_place, "left").drop("_grp", "_code")
    return df
