"""Toxicity and languages: held-out accuracy, learned folds and odd rows."""

import random
import zlib

import numpy as np
import odd_documents as odd
import pytest
from pyspark.sql import functions as F

from sparkmarts.llm import hashing, languages, queries, toxicity

RUDE = ("blockhead", "nitwit", "dunce", "oaf")


def labelled(spark, n=400):
    pick = random.Random(3)
    docs, labels = [], []
    for i in range(n):
        words, bad = odd.prose(i, pick.randint(20, 200)).split(), i % 5 == 0
        for _ in range(max(2, len(words) // 40) if bad else 0):
            words[pick.randrange(len(words))] = pick.choice(RUDE) + pick.choice(["", ",", "!"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_toxicity_generalises_and_hides_the_held_out_fold(spark):
    docs, labels = labelled(spark)
    found = {r["row"]["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert all(r["held_out"] == (fold(i, 4) == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for i, r in found.items())
    unseen = [i for i in found if fold(i, 4) == 2]
    right = [found[i]["predicted"] == int(i % 5 == 0) for i in unseen]
    assert sum(right) / len(right) > 0.95
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["row"]["doc_id"]: r["score"] for r in toxicity.score(docs, flipped).collect()}
    assert again == pytest.approx({i: r["score"] for i, r in found.items()})


def test_toxicity_of_odd_rows(spark, odd_rows, no_rows):
    docs, labels = labelled(spark, 120)
    extra = spark.createDataFrame([(None, 1, 1), (6, 1, None), (7, 0, 5), (999_999, 0, 1)], "doc_id long, quality int, toxic int")
    for given in (labels.unionByName(extra), labels.limit(0), labels.filter("toxic = 0")):
        rows = toxicity.score(odd_rows, given).collect()
        assert len(rows) == len(odd.TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
        empty = {r["score"] for r in rows if r["row"]["doc_id"] in (1, 2, 3)}
        assert len(empty) == 1
    assert toxicity.score(no_rows, labels).collect() == []
    assert toxicity.clean(odd_rows, labels).columns == odd_rows.columns


def test_expression_counts_match_brute_force(spark):
    docs, labels = labelled(spark, 60)
    tables = toxicity.counted(docs.join(labels, "doc_id"))
    expected = np.zeros_like(tables)
    for d in docs.join(labels, "doc_id").collect():
        words, stems, _ = hashing.bare_words([d["text"].lower().encode()], toxicity.STEM_SIGNS)
        for name, hashes in ((toxicity.WORD, words), (toxicity.STEM, hashing.mix(stems))):
            for h in set(hashes.tolist()):
                expected[name + d["toxic"]][h & (toxicity._CELLS - 1)] += 1
    for t in (toxicity.WORD, toxicity.WORD + 1, toxicity.STEM, toxicity.STEM + 1):
        assert (tables[t] == expected[t]).all()


def test_logistic_curve():
    pick = np.random.default_rng(0)
    x = pick.normal(size=(4000, 2))
    y = (pick.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] - 1)))).astype(float)
    assert toxicity.fitted(x, y) == pytest.approx([2, -1, -1], abs=0.25)
    assert toxicity.fitted(x, np.zeros(4000))[-1] < -10 and toxicity.fitted(x[:0], y[:0])[-1] < -10


def test_registered_toxicity(spark, documents):
    found = queries.op6_toxicity(spark, documents)
    assert found.count() == queries.documents(spark, documents).count()
    labels = queries.table(spark, documents, "labels")
    known = found.join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert known > 0.9


# ---------------------------------------------------------------- languages


def speech(sounds, seed, words):
    pick = random.Random(seed)
    return " ".join("".join(pick.choices(sounds, k=pick.randint(2, 4))) for _ in range(words))


SOUNDS = {"one": ("ba", "do", "ri", "mel"), "two": ("the", "ing", "sh", "ou"), "three": ("çã", "ñu", "éè", "lla")}


def spoken(spark, n=150):
    pick = random.Random(4)
    rows = [(i, speech(SOUNDS[lang], i, pick.randint(3, 120)), lang) for i in range(n) for lang in [list(SOUNDS)[i % 3]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_the_held_out_fold(spark):
    docs = spoken(spark)
    found = languages.identify(docs).collect()
    assert all(r["held_out"] == (fold(r["row"]["doc_id"], 5) == 0) for r in found)
    assert all(r["lang_pred"] == r["row"]["lang"] for r in found)
    changed = docs.withColumn("lang", F.when(languages.held_out(), F.lit("other")).otherwise(F.col("lang")))
    assert {r["lang_pred"] for r in languages.identify(changed).collect()} == set(SOUNDS)


def test_mixtures_and_their_proportions(spark):
    mixed = speech(SOUNDS["one"], 900, 100) + " " + speech(SOUNDS["two"], 901, 50)
    docs = spoken(spark).unionByName(spark.createDataFrame([(1000, mixed, None)], "doc_id long, text string, lang string"))
    row = languages.identify(docs).filter("row.doc_id = 1000").first()
    shares = {p.split(":")[0]: float(p.split(":")[1]) for p in row["mixture"].split(",")}
    assert set(shares) == {"one", "two"} and row["lang_pred"] == "one"
    assert 0.5 < shares["one"] < 0.8 and row["score"] == pytest.approx(shares["one"], abs=1e-3)


def test_proportions_match_plain_expectation_maximisation():
    pick = np.random.default_rng(1)
    likely, weight = pick.random((30, 3)).astype(np.float32), pick.integers(1, 5, 30).astype(np.float32)
    first, mixed = np.array([0, 12]), []
    for part in (slice(0, 12), slice(12, 30)):
        p = np.full(3, 1 / 3)
        for _ in range(languages.STEPS):
            share = likely[part] * p
            p = (share / share.sum(axis=1, keepdims=True) * weight[part][:, None]).sum(axis=0) / weight[part].sum()
        mixed.append(p)
    found, _ = languages.proportions(likely, weight, first, np.ones((2, 3), dtype=np.float32))
    assert found == pytest.approx(np.array(mixed), abs=1e-4)


def test_trigrams_stay_in_their_text():
    texts = ["", "ab", "  ", "a-b", "ÀB c", "9"]
    cells, owner, letters = languages.trigrams(texts)
    assert letters.tolist() == [0, 2, 0, 2, 3, 0]
    assert np.bincount(owner, minlength=6).tolist() == [0, 2, 0, 2, 3, 0]
    alone = [languages.trigrams([t])[0].tolist() for t in texts]
    assert [c for part in alone for c in part] == cells.tolist()


def test_languages_of_odd_rows(spark, odd_rows, no_rows):
    found = {r["row"]["doc_id"]: r for r in languages.identify(odd_rows).collect()}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (1, 2, 3, 12))
    assert all(found[i]["lang_pred"] in ("aa", "bb") for i in (4, 5, 6, 7, 11, 13))
    assert languages.identify(odd_rows).count() == len(odd.TEXTS)
    unlearned = odd_rows.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in languages.identify(unlearned).collect()} == {"und"}
    assert languages.identify(no_rows).collect() == []


def test_registered_languages(spark, documents):
    found = queries.op10_language_mixture(spark, documents).join(queries.documents(spark, documents).select("doc_id", "lang"), "doc_id")
    right = found.filter("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
