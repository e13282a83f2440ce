"""Shared passages, packing and the pipeline."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import odd_documents as odd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sparkmarts.llm import blocks, packing, passages, queries, tokens

# ---------------------------------------------------------------- passages


def covered(spans, start, end):
    inside = np.zeros(end - start, dtype=bool)
    for s in spans:
        inside[max(0, s["start"] - start) : max(0, s["end"] - start)] = True
    return inside.mean()


def test_planted_passages_and_clean_documents(spark):
    pick, texts, places = random.Random(6), [], []
    exact, fuzzy, short = odd.prose(1000, 70), odd.prose(1001, 120), odd.prose(1002, 30)
    for i in range(40):
        before, after = odd.prose(2000 + i, pick.randint(0, 80)), odd.prose(3000 + i, pick.randint(0, 80))
        inner = (exact, odd.edited(fuzzy, *pick.sample(range(120), 4)), short, odd.prose(4000 + i, 60))[i % 4]
        places.append((len(before.split()), len(before.split()) + len(inner.split())))
        texts.append(" ".join(filter(None, (before, inner, after))))
    found = {r["row"]["doc_id"]: r for r in passages.mark(odd.of(spark, texts)).collect()}
    for i, (start, end) in enumerate(places):
        if i % 4 in (0, 1):
            assert covered(found[i]["passages"], start, end) > 0.9
            assert sum(s["end"] - s["start"] for s in found[i]["passages"]) <= end - start + 12
            assert bool(found[i]["copies"]) == (i > 1)
        else:
            assert found[i]["passages"] == []


def test_two_passages_in_another_order(spark):
    a, b = odd.prose(1100, 80), odd.prose(1101, 80)
    texts = [f"{a} {odd.prose(1102, 50)} {b}", f"{odd.prose(1103, 20)} {b} {a}"]
    found = passages.mark(odd.of(spark, texts)).orderBy("row.doc_id").collect()
    assert covered(found[0]["passages"], 0, 80) == covered(found[0]["passages"], 130, 210) == 1
    assert covered(found[1]["passages"], 20, 180) == 1 and covered(found[0]["passages"], 80, 130) < 0.1


def plain_chain_score(x, y, k, cost):
    """Quadratic version of the chaining recurrence."""
    score = np.zeros(len(x))
    for i in sorted(range(len(x)), key=lambda i: (x[i], y[i])):
        score[i] = k
        for j in range(len(x)):
            if x[j] < x[i] and y[j] < y[i] and score[j]:
                covers = min(k, x[i] - x[j], y[i] - y[j])
                score[i] = max(score[i], score[j] + covers - cost * (x[i] - x[j] + y[i] - y[j] - 2 * covers))
    return score.max()


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=25, unique=True))
@settings(max_examples=60, deadline=None)
def test_chains_are_ordered_and_start_from_good_scores(points):
    x, y = np.array([p[0] for p in points]) * 7, np.array([p[1] for p in points]) * 7
    found = passages.chains(x, y, 6)
    assert sorted(i for chain in found for i in chain) == list(range(len(points)))
    for chain in found:
        assert (np.diff(x[chain]) > 0).all() and (np.diff(y[chain]) > 0).all()
    first = found[0]
    scored = 6 + sum(6 - 0.1 * (x[b] - x[a] + y[b] - y[a] - 12) for a, b in zip(first[:-1], first[1:], strict=True))
    assert scored == pytest.approx(plain_chain_score(x, y, 6, 0.1))


def test_alignment_passes_edits():
    x = np.arange(100, dtype=np.uint32)
    y = np.concatenate([x[:30], [900, 901], x[31:60], x[63:]]).astype(np.uint32)  # replaced, inserted, left out
    assert passages.extend(x, y) == (100, 98, 96)
    assert passages.extend(x, x[::-1].copy()) == (0, 0, 0) and passages.extend(x[:0], y) == (0, 0, 0)


def test_passages_of_odd_rows(odd_rows, no_rows):
    found = passages.mark(odd_rows).collect()
    assert len(found) == len(odd.TEXTS)
    by_id = {r["row"]["doc_id"]: r["passages"] for r in found}
    assert covered(by_id[6], 0, 30_000) > 0.999 and covered(by_id[7], 0, 30_000) > 0.999
    assert covered(by_id[9], 0, 120) == 1 and not any(by_id[i] for i in (1, 2, 3, 4, 5, 11, 12, 13, None))
    assert passages.mark(no_rows).collect() == []


def test_registered_passages_cover_repeated_windows(spark, documents):
    words = {r["doc_id"]: re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")) for r in queries.documents(spark, documents).collect()}
    holders = defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 50):
            holders[tuple(w[k : k + 51])].add(i)
    total = missed = 0
    found = {r["row"]["doc_id"]: r["passages"] for r in passages.mark(queries.documents(spark, documents)).collect()}
    for i, w in words.items():
        for k in range(len(w) - 50):
            if len(holders[tuple(w[k : k + 51])]) > 1:
                total += 1
                missed += covered(found[i], k, k + 51) < 0.9
    assert total and missed <= 0.02 * total


@pytest.mark.parametrize("families", [3, 30])
def test_exact_copies_behind_other_holders_of_every_seed(spark, families):
    """Three copies of a passage; before each of them ten documents hold each of its 4-word runs, but no long part of it."""
    texts, places = [], []
    for n in range(families):
        passage = odd.prose(9000 + n, (50, 64, 80)[n % 3])
        words = passage.split()
        for copy in range(3):
            for other in range(10):
                runs = [" ".join([*words[i : i + 4], *odd.prose(10_000 + 1000 * n + 100 * other + i, 12 + other).split()]) for i in range(len(words) - 3)]
                random.Random(other).shuffle(runs)
                texts.append(" ".join(runs))
            before = odd.prose(9100 + 3 * n + copy, 7 * copy + n % 5)
            places.append((len(texts), len(before.split()), len(before.split()) + len(words)))
            texts.append(f"{before} {passage} {odd.prose(9200 + 3 * n + copy, 20)}")
    found = {r["row"]["doc_id"]: r["passages"] for r in passages.mark(odd.of(spark, texts)).collect()}
    assert all(covered(found[i], start, end) == 1 for i, start, end in places)


@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=6), st.integers(1, 6))
@settings(max_examples=80, deadline=None)
def test_chosen_runs(texts, width):
    runs, made = np.array([h for t in texts for h in t], dtype=np.uint64), np.array([len(t) for t in texts])
    some, first = set(passages.chosen(runs, made, width).tolist()), 0
    wanted = set()
    for t in texts:
        wanted |= {first + min(range(i, i + width), key=lambda j: (t[j], j)) for i in range(len(t) - width + 1)}
        first += len(t)
    assert some == wanted


def test_windows_meet_an_earlier_holder():
    """Brute force: for every window of 50 words, each holder meets an earlier one, and the first is met."""
    pick = random.Random(4)
    base, texts = [pick.randrange(10**6) for _ in range(90)], []
    for _ in range(40):
        a = pick.randrange(25)
        texts.append([pick.randrange(10**6) for _ in range(pick.randrange(30))] + base[a : a + pick.randint(40, 65)] + [pick.randrange(10**6)])
    table = passages.pa.table({"text": [" ".join(map(str, t)) for t in texts], "doc_id": list(range(len(texts)))})
    blocks_ = passages.pa.Table.from_batches(list(passages._anchors(50, 1)(table.to_batches())))
    columns = ["doc", "owner", "place", "owner_place"]
    found = set(zip(*(passages._met(50, 4)(blocks_).column(c).to_pylist() for c in columns), strict=True))
    holders = defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - 49):
            holders[tuple(t[p : p + 50])].append((i, p))
    pairs = 0
    for held in holders.values():
        meets = lambda i, p, j, q: sum((i, j, p + s, q + s) in found for s in range(47)) >= 7
        for n, (i, p) in enumerate(held[1:], 1):
            pairs += 1
            assert any(meets(i, p, j, q) for j, q in held[:n])
        if len(held) > 1:
            assert any(meets(i, p, *held[0]) for i, p in held[1:])
    assert pairs > 50
    assert all(texts[i][p : p + 4] == texts[j][q : q + 4] and i > j for i, j, p, q in found)


@pytest.mark.parametrize("families", [4, 40])
def test_passages_with_planted_edits(spark, families):
    """Passages of 60 to 200 words with every 5th to 12th word replaced, so 80 to 92 % equal, at two corpus sizes."""
    texts, places = [], []
    for n in range(families):
        length, step = ((60, 12), (100, 10), (100, 8), (200, 8), (200, 6), (60, 5), (100, 5))[n % 7]
        plain = odd.prose(5000 + n, length)
        for copy, inner in enumerate((plain, odd.edited(plain, *range(step - 1, length, step)))):
            before = odd.prose(6000 + 2 * n + copy, 30 + n % 11)
            places.append((30 + n % 11, 30 + n % 11 + length))
            texts.append(f"{before} {inner} {odd.prose(8000 + 2 * n + copy, 30)}")
    found = {r["row"]["doc_id"]: r["passages"] for r in passages.mark(odd.of(spark, texts)).collect()}
    assert [i for i, place in enumerate(places) if covered(found[i], *place) < 0.9] == []


def test_passage_whose_seeds_begin_elsewhere(spark):
    """Every run of 8 words of the passage occurs in an earlier document of its own, out of context."""
    passage = odd.prose(5500, 80).split()
    pieces = [" ".join([odd.prose(5600 + i, 40), *passage[i : i + 8], odd.prose(5700 + i, 40)]) for i in range(0, 77, 4)]
    texts = [*pieces, *(f"{odd.prose(5800 + i, 30)} {' '.join(passage)} {odd.prose(5810 + i, 30)}" for i in range(2))]
    found = {r["row"]["doc_id"]: r["passages"] for r in passages.mark(odd.of(spark, texts)).collect()}
    assert all(covered(found[len(pieces) + i], 30, 110) > 0.9 for i in range(2))
    assert not any(found[i] for i in range(len(pieces)))


@given(st.lists(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=20), max_size=5))
@settings(max_examples=60, deadline=None)
def test_steps_are_taken_back(parts):
    made = [blocks.stepped(np.array(p, dtype=np.int64)) for p in parts]
    table = passages.pa.table({"c0": passages.pa.array(made, passages.pa.binary())})
    assert blocks.stepped_column(table, 0, np.int64).tolist() == [x for p in parts for x in p]


def test_shuffled_seeds_are_small():
    """What a seed takes in the shuffle, which compresses by lz4: 4 bytes of hash, one around, and little for its place."""
    pick = random.Random(3)
    texts = [" ".join(str(pick.randrange(10**6)) for _ in range(300)) for _ in range(800)]
    table = passages.pa.table({"text": texts, "doc_id": [10**9 + 7 * i for i in range(800)]})
    size = sum(len(passages.pa.compress(b, "lz4", asbytes=True)) for batch in passages._seeds(4, 32)(table.to_batches()) for c in batch.columns[1:] for b in c.to_pylist())
    assert size < 8 * 297 * 800


@given(st.lists(st.tuples(st.integers(-(2**63), 2**63 - 1), st.integers(0, 3), st.integers(-3, 3)), max_size=30), st.booleans())
@settings(max_examples=100, deadline=None)
def test_rows_are_ordered_once(rows, near):
    rows = [(a % 5 - 2 if near else a, b, c) for a, b, c in rows]
    columns = [np.array([r[i] for r in rows], dtype=t) for i, t in enumerate((np.int64, np.uint32, np.int32))]
    found = blocks.ordered(*columns)
    assert [c.dtype for c in found] == [c.dtype for c in columns]
    assert list(zip(*(c.tolist() for c in found), strict=True)) == sorted(set(rows))
    order = blocks.order_of(*columns)
    assert sorted(order.tolist()) == list(range(len(rows))) and [rows[i] for i in order] == sorted(rows)


def test_shuffled_matches_are_small():
    """Runs of matches of one shift: less than 5 bytes each, where rows of two longs and two ints took 11."""
    pick = random.Random(7)
    n = 40_000
    doc, owner = np.repeat(np.arange(n // 40) + 10**9, 40), np.repeat([pick.randrange(10**9) for _ in range(n // 40)], 40)
    place, shift = np.tile(np.arange(40) * 8, n // 40), np.repeat([pick.randrange(300) for _ in range(n // 40)], 40)
    mixed = np.array(pick.sample(range(n), n))
    columns = [c[mixed].astype(t) for c, t in ((doc, np.int64), (owner, np.int64), (place + shift, np.int32), (place, np.int32))]
    table = passages.pa.table(dict(zip(("doc", "owner", "place", "owner_place"), columns, strict=True)))
    dealt = passages._dealt(lambda t: t, 4)(table)
    assert sum(len(passages.pa.compress(b, "lz4", asbytes=True)) for c in dealt.columns[1:] for b in c.to_pylist()) < 5 * n


@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 30)), min_size=2, max_size=25))
@settings(max_examples=100, deadline=None)
def test_rising_matches_chain_as_over_places(steps):
    """Matches that rise in both texts need no tree; an unrelated match far behind brings the tree back."""
    x, y = (np.cumsum([s[i] for s in steps]) + 1000 for i in (0, 1))
    plain = passages.chains(x, y, 4)
    beside = passages.chains(np.append(x, x[-1] + 10**6), np.append(y, 0), 4)
    assert plain == [c for c in beside if c != [len(x)]]


# ---------------------------------------------------------------- packing


def test_remembered_pieces_take_little_memory():
    import tracemalloc

    encoder, pick = tokens.Encoder(queries.tokenizer()), random.Random(5)
    texts = [" ".join(f"{pick.getrandbits(40):x}".translate(str.maketrans("0123456789", "ghijklmnop")) for _ in range(1000)) for _ in range(100)]
    tracemalloc.start()
    try:
        for text in texts:
            encoder.encode([text])
        held, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert 95_000 < len(encoder.begin) and held < 80 * len(encoder.begin) and most < 200 * len(encoder.begin)


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(queries.tokenizer())
    made.encode_special_tokens = True
    return made


SIGNS = " \n\t\r'sdtmrvel.,!?-_09²Ⅷ٣aZéßñ漢字👍​ 　\x85\x1c<|endoftext|>"


@given(st.lists(st.one_of(st.text(alphabet=SIGNS, max_size=25), st.text(max_size=12), st.just("<|endoftext|>")), max_size=12))
@settings(max_examples=150, deadline=None)
def test_ids_are_the_tokenizers_own(tokenizer, texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 for c in t)]
    ids, counts = tokens.encoder(queries.tokenizer()).encode(texts)
    cuts = np.split(ids, np.cumsum(counts)[:-1]) if texts else []
    assert [c.tolist() for c in cuts] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def fewest(lengths, size):
    """Sequences of the best packing, by search."""
    best = len(lengths)

    def place(rest, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not rest:
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= rest[0] and rooms[i] not in rooms[:i]:
                place(rest[1:], rooms[:i] + [rooms[i] - rest[0]] + rooms[i + 1 :])
        place(rest[1:], [*rooms, size - rest[0]])

    place(sorted(lengths, reverse=True), [])
    return best


@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_bounds_hold(lengths):
    sequence, offset, used = packing.best_fit(np.array(lengths), 20)
    assert packing.lower_bound(np.array(lengths), 20) <= fewest(lengths, 20) <= used == len(set(sequence))
    for s in set(sequence):
        parts = sorted((o, n) for o, n, q in zip(offset, lengths, sequence, strict=True) if q == s)
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 20


def check_packing(rows, docs, tokenizer, size=1024):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= size
    wanted = defaultdict(list)
    for i, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        cuts = [0, *range((len(ids) - 1) % size + 1, len(ids), size), len(ids)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            wanted[i].append((k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    got = {i: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in p) for i, p in pieces.items()}
    assert got == {i: sorted(p) for i, p in wanted.items()}
    return len(sequences)


def test_packing_of_odd_rows(odd_rows, no_rows, tokenizer):
    check_packing(packing.pack(odd_rows, queries.tokenizer()).collect(), odd.TEXTS, tokenizer)
    assert packing.pack(no_rows, queries.tokenizer()).collect() == []


def test_gaps_are_repacked_over_partitions(spark, documents, tokenizer, monkeypatch):
    docs = queries.documents(spark, documents).select("doc_id", "text")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    monkeypatch.setattr(packing, "PARTITION_PIECES", 40)
    monkeypatch.setattr(packing, "MOST_ROUNDS", 1)
    single = check_packing(packing.pack(docs, queries.tokenizer()).collect(), texts, tokenizer)
    monkeypatch.setattr(packing, "MOST_ROUNDS", 4)
    rows = packing.pack(docs, queries.tokenizer()).collect()
    exchanged = check_packing(rows, texts, tokenizer)
    bound = packing.lower_bound(np.array([r["length"] for r in rows]), 1024)
    assert bound <= exchanged <= single and exchanged <= 1.02 * bound


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, documents, tokenizer):
    docs = queries.documents(spark, documents)
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, kept[-1], documents)
        kept.append(corpus_pipeline.written(made))
    assert all(d.columns == docs.columns for d in kept[:-1])
    toxic = {r["doc_id"] for r in queries.op6_toxicity(spark, documents).filter("predicted = 1").collect()}
    ids = [{r["doc_id"] for r in d.collect()} for d in kept[:-1]]
    assert ids[0] - ids[1] == toxic and ids[1] >= ids[2] >= ids[3] >= ids[4]
    assert kept[2].select(F.regexp_replace("text", "[\\x20\\x09-\\x0D]", "")).distinct().count() == kept[2].count()
    near = {r["doc_id"] for r in queries.jaccard_join.join(kept[2]).filter("doc_id = component_id").collect()}
    assert ids[3] == near
    mixed = [(r["doc_id"], r["text"]) for r in kept[4].collect()]
    check_packing(kept[5].collect(), mixed, tokenizer)


def test_pipeline_run(spark, documents):
    assert corpus_pipeline.run(spark, documents).count() > 100
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_pipeline_of_odd_and_no_rows(spark, odd_rows, no_rows, documents):
    for docs in (odd_rows, no_rows):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, documents))
        assert docs.count() > 0 or docs.columns[0] == "doc_id"
