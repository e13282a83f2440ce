"""A Bloom filter as a table: `bucket`, `bits`, where bits is one of Spark's 4 KB bitmaps and a key sets two cells of a bucket."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 32768  # the size of Spark's bitmap type
BITS_PER_ROW = 16
MAX_BUCKETS = 2**15  # what is broadcast stays under 128 MB


def buckets_for(rows: int) -> int:
    return min(MAX_BUCKETS, 2 ** max(0, math.ceil(math.log2(max(1, rows) * BITS_PER_ROW / BUCKET_BITS))))


def _cells(key: Column, buckets: int) -> tuple[Column, Column, Column]:
    """The bucket of a 64-bit key and its two cells there."""
    mask = F.lit(BUCKET_BITS - 1)
    first = F.shiftrightunsigned(key, 16).bitwiseAND(mask)
    second = F.shiftrightunsigned(key, 32).bitwiseAND(mask)
    return key.bitwiseAND(F.lit(buckets - 1)), first, second


def build(keys: DataFrame, buckets: int, least: int = 1) -> DataFrame:
    """The cells that at least `least` rows of the column `key` hit."""
    bucket, first, second = _cells(F.col("key"), buckets)
    hit = keys.select(bucket.alias("bucket"), F.explode(F.array(first, second)).alias("cell"))
    counted = hit.groupBy("bucket", "cell").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return counted.groupBy("bucket").agg(F.bitmap_construct_agg("cell").alias("bits"))


def _is_set(bits: Column, cell: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(cell, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, cell.bitwiseAND(F.lit(7)).cast("int")) == 1


def tested(rows: DataFrame, filter: DataFrame, buckets: int) -> DataFrame:
    """The rows with `possible`: whether both cells of `key` are set. The filter's size is bounded, so it is broadcast."""
    bucket, first, second = _cells(F.col("key"), buckets)
    found = rows.withColumn("bucket", bucket).join(F.broadcast(filter), "bucket", "left")
    both = _is_set(F.col("bits"), first) & _is_set(F.col("bits"), second)
    return found.withColumn("possible", F.coalesce(both, F.lit(False))).drop("bucket", "bits")
