"""Water-filling and sampling against a plain version."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkmarts.llm import mixing, queries


def plain_targets(sizes, weights, share, cap):
    """Clamp and share again until nothing is above its cap."""
    budget, target = share * sum(sizes.values()), {}
    open_sources = dict(weights)
    while open_sources:
        level = (budget - sum(target.values())) / sum(open_sources.values())
        over = [s for s, w in open_sources.items() if level * w >= cap * sizes[s]]
        for s in over:
            target[s] = cap * sizes[s]
            del open_sources[s]
        if not over:
            target |= {s: level * w for s, w in open_sources.items()}
            break
    return target


def sizes_of(rows):
    return [(r["source"], len(re.findall("[^\x20\x09-\x0d]+", r["text"] or ""))) for r in rows]


def check(docs, found):
    rows = docs.collect()
    sizes = defaultdict(int)
    for source, n in sizes_of(rows):
        sizes[source] += n
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target = plain_targets(sizes, weights, 1.5, 2)
    taken = defaultdict(int)
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1


def mixed(docs, **options):
    found = mixing.mix(docs, carry=["doc_id", "source"], **options)
    return found.select("row.*", "size", "source_size", "target", "taken")


def test_matches_plain_version(spark, documents):
    docs = queries.documents(spark, documents)
    check(docs, mixed(docs))


def test_odd_rows(odd_rows, no_rows):
    check(odd_rows, mixed(odd_rows))
    assert mixed(no_rows).collect() == []
    assert mixing.repeat(odd_rows).columns == odd_rows.columns


def test_reruns_agree_and_seeds_differ(spark, documents):
    docs = queries.documents(spark, documents)
    again = mixed(docs.repartition(3))
    assert sorted(mixed(docs).collect()) == sorted(again.collect())
    assert sorted(mixed(docs).collect()) != sorted(mixed(docs, seed=1).collect())


def test_repeats_follow_the_mix(spark, documents):
    docs = queries.documents(spark, documents)
    copies = {r["doc_id"]: r["count"] for r in mixing.repeat(docs).groupBy("doc_id").count().collect()}
    for r in mixed(docs).collect():
        assert copies.get(r["doc_id"], 0) == (int(r["taken"] / r["size"] + 0.5) if r["size"] else 0)


def test_ranks_follow_code_points(spark):
    names = ["z", "Z", "é", "", None, "漢", "a" * 50, *[f"s{i}" for i in range(40)]]
    sources = spark.createDataFrame([(n,) for n in names], "source string")
    found = [r["source"] for r in mixing.ranked(sources).orderBy("place").collect()]
    assert found == sorted((n for n in names if n is not None), key=lambda n: n.encode()) + [None]


def test_hot_source_is_not_one_group(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("source"),
        F.expr("repeat('w ', cast(id % 17 as int))").alias("text"),
    )
    check(rows, mixed(rows))


