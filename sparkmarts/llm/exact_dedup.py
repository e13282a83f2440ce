"""Exact deduplication in two passes over a Bloom filter: only rows that may be repeated are shuffled.

Pass 1 sends two cells per row (positions in the filter, 16 bytes, counted before the shuffle) and keeps the
cells hit at least twice. Pass 2 tests each row: a row with a cell of its own is the only one of its text and
passes straight through; the others are grouped by SHA-256. A cell shared by chance costs a row a shuffle and
never changes a result. Where the filter is at its largest and full, all rows are grouped.

Defined cases: null text counts as empty, and empty texts are equal to each other; a null doc_id is the last
choice; rows equal in length and doc_id too are told apart by their place in the input, so exactly one is kept
(the input should be a stored table, as the place is computed twice); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import SPACE, carried, whole_text, written

def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, "")


def groups(docs: DataFrame, text: str = "text", id: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """Per input row: `row` (its columns, or those in `carry`), keep_id, group_size, kept, text_sha256."""
    plain = whole_text(text)
    buckets = bloom.buckets_for(docs.count())
    keyed = docs.select(
        carried(docs, carry).alias("row"),
        F.col(id).alias("id"),
        F.length(plain).alias("length"),
        F.monotonically_increasing_id().alias("place"),
        F.sha2(normalised(plain), 256).alias("sha"),
    ).withColumn("key", F.xxhash64("sha"))
    repeated = bloom.build(keyed.select("key"), buckets, least=2)
    tested = bloom.tested(keyed, repeated, buckets)
    alone = tested.filter(~F.col("possible")).select(
        "row", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )

    possible = tested.filter("possible")
    rank = F.struct("length", F.col("id").isNotNull().alias("known"), (-F.col("id")).alias("low"), (-F.col("place")).alias("early"))
    best = possible.groupBy("sha").agg(
        F.max_by(F.struct("id", "place"), rank).alias("best"), F.count("*").alias("group_size")
    )
    best = written(best)  # a row per text; as a stored table, its join can be split where one text has many copies
    grouped = possible.join(best, "sha").select(
        "row", F.col("best.id").alias("keep_id"), "group_size", (F.col("place") == F.col("best.place")).alias("kept"), "sha"
    )
    return alone.unionByName(grouped).withColumnRenamed("sha", "text_sha256")


def deduplicate(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The kept rows with their own columns."""
    return groups(docs, text, id).filter("kept").select("row.*")
