"""Exact and near deduplication against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import odd_documents as odd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkmarts.llm import blocks, bloom, components, exact_dedup, jaccard_join, queries


def bare(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def test_exact_groups_match_brute_force(odd_rows):
    found = exact_dedup.groups(odd_rows, carry=["doc_id", "text"]).select("row.*", "keep_id", "group_size", "kept", "text_sha256")
    groups = defaultdict(list)
    for i, t in odd.TEXTS:
        groups[bare(t)].append((-len(t or ""), i is None, i))
    rows = found.collect()
    assert len(rows) == len(odd.TEXTS)
    for r in rows:
        group = groups[bare(r["text"])]
        assert r["keep_id"] == min(group)[2]
        assert r["group_size"] == len(group)
        assert r["text_sha256"] == hashlib.sha256(bare(r["text"]).encode()).hexdigest()
    assert sum(r["kept"] for r in rows) == len(groups)  # one of two equal rows with one id, too


def test_exact_dedup_returns_the_columns(odd_rows, no_rows):
    assert exact_dedup.deduplicate(odd_rows).columns == odd_rows.columns
    assert exact_dedup.deduplicate(no_rows).collect() == []


def test_full_filter_only_costs_shuffles(odd_rows, monkeypatch):
    monkeypatch.setattr(bloom, "BITS_PER_ROW", 0)
    monkeypatch.setattr(bloom, "BUCKET_BITS", 1)
    monkeypatch.setattr(bloom, "buckets_for", lambda rows: 1)
    before = sorted(map(str, exact_dedup.deduplicate(odd_rows).collect()))
    monkeypatch.undo()
    assert before == sorted(map(str, exact_dedup.deduplicate(odd_rows).collect()))


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    buckets = bloom.buckets_for(5000)
    seen = bloom.tested(keys, bloom.build(keys, buckets), buckets)
    assert seen.filter("not possible").count() == 0
    others = spark.range(5000, 15000).select(F.xxhash64("id").alias("key"))
    assert bloom.tested(others, bloom.build(keys, buckets), buckets).filter("possible").count() < 1500


def brute_components(rows, words=5, percent=80):
    sets = {}
    for key, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[key] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in keys}


def near_copies():
    """Chains of edits, a hub with spokes that are linked to it alone, sets around the small boundary, a shared passage."""
    pick = random.Random(5)
    texts = []
    for words in (5, 6, 7, 8, 9, 10, 11, 12, 14, 18, 25, 60):
        base = odd.prose(100 + words, words)
        texts += [base, base.upper(), base + " tail", odd.edited(base, 0), odd.edited(base, words // 2), " ".join(base.split()[1:])]
    hub = odd.prose(500, 140)
    texts += [hub] + [odd.edited(hub, *pick.sample(range(140), 2)) for _ in range(40)]
    passage = odd.prose(501, 30)
    texts += [odd.prose(600 + i, 20) + " " + passage + " " + odd.prose(700 + i, 20) for i in range(30)]
    chain = odd.prose(502, 100).split()
    for i in range(12):
        chain = [*chain[4:], *odd.prose(800 + i, 4).split()]
        texts.append(" ".join(chain))
    pick.shuffle(texts)
    return texts


@pytest.mark.parametrize("rounds", [4, 0])
def test_components_match_brute_force(spark, monkeypatch, rounds):
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    texts = near_copies()
    found = jaccard_join.join(odd.of(spark, texts)).collect()
    expected = brute_components(list(enumerate(texts)))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected


def test_repeated_rows_and_null_ids_change_no_component(spark):
    """Rows that come twice, and null ids beside a class of null ids alone, so all their texts are posted."""
    texts = list(enumerate(near_copies()[:60]))
    rows = [*texts, *texts[::2], (None, odd.prose(5, 30)), (None, odd.edited(odd.prose(5, 30), 0)), (None, ""), (None, None)]
    found = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    expected = brute_components(texts)
    assert all((r["n_shingles"], r["component_id"]) == expected[r["doc_id"]] for r in found if r["doc_id"] is not None)
    assert sorted(r["n_shingles"] for r in found if r["doc_id"] is None) == [0, 0, 26, 26]


def test_postings_of_the_first_count_are_small():
    """5 bytes of a shingle and each set once per run; a hash and a set in full took 16 before compression."""
    table = pa.table({"doc_id": range(200), "text": [odd.prose(i, 400) for i in range(200)]})
    made = list(jaccard_join._postings(5, 4)(table.to_batches()))
    size = sum(len(b) for batch in made for c in batch.columns[1:] for b in c.to_pylist())
    postings = sum(len(b) for batch in made for b in batch.column("c1").to_pylist())
    assert postings > 15_000 and size < 7 * postings


@given(st.lists(st.lists(st.integers(-3, 3), max_size=300), max_size=4))
@settings(max_examples=60, deadline=None)
def test_repeats_are_taken_back(parts):
    made = [blocks.repeated(np.array(p, dtype=np.int64)) for p in parts]
    table = pa.table({"c0": pa.array(made, pa.binary())})
    assert blocks.repeated_column(table, 0, np.int64).tolist() == [x for p in parts for x in p]


def test_subsets_and_lists_agree(spark, monkeypatch):
    """All sets as large, then all up to 16 shingles as small."""
    texts = [t for t in near_copies() if len(t.split()) <= 20]
    expected = brute_components(list(enumerate(texts)))
    for boundary in (0, 16):
        monkeypatch.setattr(jaccard_join, "_small_boundary", lambda *_, b=boundary: b)
        found = jaccard_join.join(odd.of(spark, texts)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected


def test_join_of_odd_rows(odd_rows, no_rows):
    found = {r["doc_id"]: r for r in jaccard_join.join(odd_rows).collect() if r["doc_id"] is not None}
    assert [found[i]["n_shingles"] for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert [found[i]["component_id"] for i in (1, 2, 3, 4, 5)] == [1, 2, 3, 4, 4]
    assert (found[7]["component_id"], found[9]["component_id"], found[10]["component_id"]) == (6, 8, 8)
    assert jaccard_join.join(odd_rows).count() == len(odd.TEXTS)
    assert jaccard_join.join(no_rows).collect() == []


def test_near_dedup_keeps_one_of_each_group(odd_rows):
    kept = jaccard_join.deduplicate(odd_rows)
    assert kept.columns == odd_rows.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {1, 2, 3, 4, 6, 8, 11, 12, 13, None} == ids


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 80)]
    found = components.components(spark.createDataFrame(path + star, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 180)}


def test_registered_queries(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in queries.documents(spark, documents).collect()]
    found = queries.op2_ngram_jaccard_join(spark, documents).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(rows)
