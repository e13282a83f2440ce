"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Each source gets a share of the budget by weight. A source whose share passes `max_epochs` times its size is
clamped there and the excess is shared again by weight among the others, until no source is above its cap.
The target is met by whole repetitions of every document and one partial repetition: the documents of the
source in a seeded order, as far as the remaining words reach; the last document reached is taken in part.

The order is cut into 4096 slices by hash. Word counts are summed per source and slice before the shuffle, the
slice in which the target falls follows from these sums, and only its documents are put in order. So a source
with a third of all rows is never gathered in one task.

Defined cases: null text has size 0; null is a source of its own and the last; sources and documents without
words take nothing; repeated rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, carried, shuffle_tasks, whole_text, written

SLICE_BITS = 12
WEIGHTS, SHARE, MAX_EPOCHS = (5, 2, 1), 1.5, 2


def ranked(sources: DataFrame) -> DataFrame:
    """`place` from 0 in code point order, null last: ranges are numbered, then rows within each range."""
    tasks = max(1, shuffle_tasks(sources.sparkSession) // 4)
    dealt = written(
        sources.repartitionByRange(tasks, F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id())
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = dealt.groupBy("range").agg(F.count("*").alias("n"))
    starts = starts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())
    numbered = dealt.withColumn("nth", F.row_number().over(within) - 1).join(starts, "range")
    return numbered.withColumn("place", F.col("start") + F.col("nth")).drop("range", "nth", "start")


def water_fill(sources: DataFrame, budget: float, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Adds `target` to rows of (source_size, weight): the level rises until no open source is above its cap.

    Each round is one aggregate over the sources; the driver sees its three numbers.
    """
    cap = F.col("source_size") * float(max_epochs)
    level, clamped = 0.0, -1
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        used, weight, now = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight").cast("double"))), F.lit(0.0)),
            F.count(F.when(full, 1)),
        ).first()
        if now == clamped or weight == 0:
            break
        level, clamped = max(level, (budget - used) / weight), now
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    id: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = 42,
    carry: list[str] | None = None,
) -> DataFrame:
    """Per input row: `row` (its columns, or those in `carry`), size, source_size, target, taken (words).

    `weights` are dealt to the sources in code point order, again and again; `share` is the budget as a part
    of all words.
    """
    order = F.xxhash64(F.col(id), F.col(text), F.lit(seed))
    sized = docs.select(
        carried(docs, carry).alias("row"),
        F.col(source).alias("source"),
        F.regexp_count(whole_text(text), F.lit(WORD)).cast("long").alias("size"),
        order.alias("order"),
    ).withColumn("slice", F.shiftrightunsigned("order", 64 - SLICE_BITS))
    slices = written(sized.groupBy("source", "slice").agg(F.sum("size").alias("words")))

    sources = ranked(slices.groupBy("source").agg(F.sum("words").alias("source_size")))
    dealt = F.array(*map(F.lit, weights))
    sources = written(sources.withColumn("weight", F.get(dealt, (F.col("place") % len(weights)).cast("int"))))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    sources = water_fill(sources, share * total, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    sources = sources.withColumn("whole", epochs).withColumn(
        "rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    )

    # The slice in which the partial repetition ends; the sums have at most 4096 rows a source.
    reached = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = slices.withColumn("before", F.coalesce(F.sum("words").over(reached), F.lit(0)))
    known = sources.withColumnRenamed("source", "of")
    edges = sums.join(known, F.col("source").eqNullSafe(F.col("of"))).filter(
        (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))
    )
    edges = edges.select(F.col("of").alias("at"), F.col("slice").alias("edge"), "before")
    plan = written(known.join(edges, F.col("of").eqNullSafe(F.col("at")), "left").drop("at", "weight", "place"))

    placed = sized.join(plan, F.col("source").eqNullSafe(F.col("of")))
    at_edge = F.coalesce(F.col("slice") == F.col("edge"), F.lit(False))
    below = F.coalesce(F.col("slice") < F.col("edge"), F.col("rest") > 0)
    far = placed.filter(~at_edge).withColumn("part", F.when(below, F.col("size")).otherwise(F.lit(0)))
    running = Window.partitionBy("source").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(running), F.lit(0))
    near = placed.filter(at_edge).withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    return far.unionByName(near).select(
        "row", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).cast("long").alias("taken")
    )


def repeat(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows with their own columns, each as often as its taken words make whole copies (rounded)."""
    mixed = mix(docs, **options).filter("taken > 0")
    copies = F.floor(F.col("taken") / F.col("size") + F.lit(0.5)).cast("int")
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), copies))).select("row.*")
