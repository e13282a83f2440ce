"""Periodic runs, line cleaning and the prefix trie against brute force and DuckDB."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import harness
import numpy as np
import odd_documents as odd
import pytest

from sparkmarts.llm import line_cleaning, periodic_runs, prefix_trie, queries

WORDS = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def duck(documents):
    return harness.duck(documents)


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_line_cleaning"])
def test_matches_duckdb(spark, documents, duck, name):
    assert harness.differences(queries.queries()[name](spark, documents), duck, queries.oracle_sql()[name]) == ""


# ---------------------------------------------------------------- periodic runs


def plain_runs(words):
    """Every lag, every stretch that agrees with itself, and every smaller period of it."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            start = at
            while at + q < n and words[at] == words[at + q]:
                at += 1
            length = at + q - start
            if at > start and length >= max(6, 4 * q):
                run = words[start : start + length]
                if not any(run[d:] == run[:-d] for d in range(1, q)):
                    found.append((start, length, q))
            at += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_match_brute_force():
    pick, found = random.Random(1), 0
    for _ in range(1500):
        kinds = pick.choice([1, 2, 2, 3, 5])
        words = [pick.randrange(kinds) for _ in range(pick.randint(0, 60))]
        for _ in range(pick.randint(0, 3)):
            unit = [pick.randrange(kinds) for _ in range(pick.randint(1, 12))] * pick.randint(2, 7)
            at = pick.randint(0, len(words))
            words[at:at] = unit[: len(unit) - pick.randint(0, 3)]
        wanted = plain_runs(words)
        assert periodic_runs.runs_of(np.array(words, dtype=np.int64)) == wanted, words
        found += len(wanted)
    assert found > 1000


def test_unit_whose_seeds_all_occur_twice():
    """Each 5-gram stands twice in a unit, so neighbouring 5-grams never are one period apart; longer seeds are."""
    a, b = list(range(10)), list(range(20, 30))
    unit = a + a + a + b + a + b + b + b
    words = unit * 5
    assert periodic_runs.runs_of(np.array(words)) == plain_runs(words) == [(0, 400, 80)]


def test_seeds_of_one_stretch_are_extended_once(monkeypatch):
    extended = []
    agreement = periodic_runs._agreement
    monkeypatch.setattr(periodic_runs, "_agreement", lambda a, b: extended.append(1) or agreement(a, b))
    assert periodic_runs.runs_of(np.zeros(50_000, dtype=np.int64)) == [(0, 50_000, 1)]
    assert len(extended) == 2  # to both sides


def test_collapsed_keeps_first_periods():
    words = "x a b a b a b a b y y y y y y".split()
    runs = plain_runs(words)
    assert runs == [(1, 8, 2), (9, 6, 1)]
    encoded = [w.encode() for w in words]
    assert periodic_runs.collapsed(encoded, runs) == b"x a b y"


def looped(doc_id, text):
    words = WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check_periodic(rows, found):
    found = {r["doc_id"]: r for r in found}
    for doc_id, text in rows:
        words, r = looped(doc_id, text) if doc_id is not None else WORDS.findall(text or ""), found[doc_id]
        runs = periodic_runs.runs_of(periodic_runs.numbered([w.encode() for w in words]))
        if len(words) < 400:
            assert runs == plain_runs(words)
        assert r["n_runs"] == len(runs)
        if runs:
            start, length, period = min(runs, key=lambda x: (-x[1], x[0], x[2]))
            assert (r["start"], r["length"], r["period"]) == (start, length, period)
            assert r["exponent_milli"] == 1000 * length // period
        else:
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (None,) * 4
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r["collapsed_sha256"] == sha(" ".join(w for i, w in enumerate(words) if i not in dropped))


def test_periodic_query(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in queries.documents(spark, documents).collect()]
    found = queries.op13_periodic_runs(spark, documents).collect()
    assert len(found) == len(rows) and any(r["n_runs"] for r in found)
    check_periodic(rows, found)


def test_periodic_odd_rows(spark, odd_rows, no_rows, tmp_path):
    found = periodic_runs.find(odd_rows)
    assert found.columns == ["row", "runs", "collapsed"] and found.select("row.*").columns == odd_rows.columns
    for r in found.collect():
        assert r["collapsed"] == " ".join(WORDS.findall(r["row"]["text"] or "")) and r["runs"] == []
    assert periodic_runs.find(no_rows).collect() == []
    odd_rows.dropDuplicates(["doc_id"]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()]
    check_periodic(rows, queries.op13_periodic_runs(spark, str(tmp_path)).collect())


# ---------------------------------------------------------------- line cleaning


def repeated_words(words):
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    return len({i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)})


def plain_base(text):
    words = WORDS.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORDS.search(line)]
    repeated = repeated_words(words)
    failed = len(words) < 20 or 100 * repeated > 30 * len(words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated, failed


def check_base(judged):
    rows = judged.select(
        "row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    ).collect()
    for text, *got, kept in rows:
        assert tuple(got) == plain_base(text)
        assert not (kept and got[-1])
    return rows


def test_line_cleaning_matches_plain_version(spark, documents):
    rows = check_base(line_cleaning.judge(queries.documents(spark, documents)))
    assert 0 < sum(r["kept"] for r in rows) < len(rows)


def test_line_cleaning_odd_rows(odd_rows, no_rows):
    assert len(check_base(line_cleaning.judge(odd_rows))) == len(odd.TEXTS)
    assert line_cleaning.clean(odd_rows).columns == odd_rows.columns
    assert line_cleaning.judge(no_rows).collect() == [] and line_cleaning.clean(no_rows).collect() == []


PROSE = [f"{odd.prose(100 + i, 12)} and so it went on." for i in range(5)]
LINES = {
    "Home | About | Contact": "navigation",
    "home menu search log in": "navigation",
    "News » Sports » Local teams": "navigation",
    "All rights reserved.": "boilerplate",
    "We use cookies to improve this site.": "boilerplate",
    "Licensed under the Apache License, Version 2.0.": "boilerplate",
    "no mark at its end": "punctuation",
    "buy!! now!! cheap!! here!!": "punctuation",
    "a### b$$$ c%%% d&&& e.": "punctuation",
    "It said: no end": None,
    "Was it? Yes": None,
    "An 'ordinary' sentence (in brackets).": None,
}


def test_rules_by_line(spark):
    lines = spark.createDataFrame([(line,) for line in LINES], "line string")
    from pyspark.sql import functions as F

    found = lines.select("line", line_cleaning.failed_rule(F.col("line")).alias("failed")).collect()
    assert {r["line"]: r["failed"] for r in found} == LINES


def test_lines_go_before_documents(spark):
    noisy = "\n".join([PROSE[0], "Home | About | Contact", PROSE[1], "On it went.", "", PROSE[2], "On it went."])
    lost = "\n".join([PROSE[3], *(f"{odd.prose(200 + i, 14)}" for i in range(3))])
    docs = odd.of(spark, [noisy, lost, "\n".join(PROSE)])
    assert [(r["doc_id"], r["text"]) for r in line_cleaning.clean(docs).orderBy("doc_id").collect()] == [
        (0, "\n".join([*PROSE[:2], "On it went.", PROSE[2]])),
        (2, "\n".join(PROSE)),
    ]
    judged = {r["row"]["doc_id"]: r for r in line_cleaning.judge(docs).collect()}
    assert judged[0]["lost_navigation"] == len("Home|About|Contact")
    assert judged[0]["lost_repeated"] == len("Onitwent.")
    assert not judged[1]["kept"] and not judged[1]["base_failed"]


def test_line_cleaning_stays_on_the_jvm(spark, documents):
    plan = harness.plan_text(queries.op12_line_cleaning(spark, documents))
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# ---------------------------------------------------------------- prefix trie


def plain_trie(rows, rebuild=True):
    own = defaultdict(list)
    for conv, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[conv].append((role or "", text or ""))
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        convs[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(int)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, m in members.items():
        own_saved = (len(m) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += own_saved
            leaves[path[:d]] += children[path] == 0
    out = []
    for path, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(path))
        above = min(members[path[:-1]]) if path else None
        out.append((min(m), len(path), above, len(m), children[path], leaves[path], saved[path], sha(ends)))
    return sorted(out, key=str)


def nodes(df):
    return sorted((tuple(r) for r in df.select(*prefix_trie.NODE_COLUMNS).collect()), key=str)


TURNS = "conv_id long, turn long, role string, text string"


def made(spark, rows):
    return queries.rebuilt(prefix_trie.turns(spark.createDataFrame(rows, TURNS)))


def test_trie_query(spark, documents):
    rows = [tuple(r) for r in queries.table(spark, documents, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(queries.op11_prefix_trie(spark, documents)) == plain_trie(rows)


def test_trie_of_hot_and_odd_conversations(spark):
    """A third of all conversations are copies, many share a first turn, one is long, some have no turn left."""
    pick, rows = random.Random(2), []
    for c in range(240):
        if c % 3 == 0:
            rows += [(c, t, "user", f"copy {t}") for t in range(4)]
        else:
            rows += [(c, t, pick.choice(["a", "ab", None]), pick.choice(["", "b", "é", None])) for t in range(pick.randint(1, 6))]
    rows += [(241, t, "user", f"turn {t % 7}") for t in range(500)] + [(246, t, "user", f"turn {t % 7}") for t in range(499)]
    rows += [(250, None, "user", "null first"), (250, -1, "user", "then"), (None, 0, "user", "of no one"), (252, 0, "a", "bc"), (253, 0, "ab", "c")]
    assert nodes(prefix_trie.trie(made(spark, rows))) == plain_trie(rows)


def test_skeleton_is_bounded_and_cuts_change_nothing(spark, monkeypatch):
    rows = [(c, t, "user", f"{t} {c % (t + 1)}") for c in range(120) for t in range(c % 12)]
    rows += [(c, 0, "user", "only") for c in range(120, 180)]
    wanted = plain_trie(rows)
    conversations = made(spark, rows)
    for budget, sample in ((16 * 8, 2), (32 * 8, 1), (1 << 20, 32)):
        monkeypatch.setattr(prefix_trie, "SKELETON_BYTES", budget)
        monkeypatch.setattr(prefix_trie, "SAMPLE_PER_SHARD", sample)
        cuts = prefix_trie.splitters(prefix_trie.paths(conversations), 8)
        assert 0 < len(cuts) < 8 and sum(len(path) for path, _ in cuts) <= budget
        assert len(prefix_trie.Skeleton(cuts).parent) <= 1 + budget // 16
        assert nodes(prefix_trie.trie(conversations)) == wanted
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 2)
    monkeypatch.setattr(prefix_trie, "ROWS", 3)
    assert nodes(prefix_trie.trie(conversations)) == wanted


def test_trie_of_none_and_of_other_columns(spark, tmp_path):
    none = spark.createDataFrame([], TURNS + ", path string, shard string, skeleton string")
    none.write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    assert queries.op11_prefix_trie(spark, str(tmp_path / "none")).collect() == []
    rows = [(1, 0, "user", "x", "p", None, "q"), (1, 0, "user", "x", "p", None, "q"), (2, 3, "user", "x", None, "r", None)]
    some = spark.createDataFrame(rows, TURNS + ", path string, shard string, skeleton string")
    some.write.parquet(str(tmp_path / "some" / "conversations.parquet"))
    assert nodes(queries.op11_prefix_trie(spark, str(tmp_path / "some"))) == plain_trie([r[:4] for r in rows])
