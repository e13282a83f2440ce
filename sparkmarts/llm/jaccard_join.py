"""Exact n-gram Jaccard join: a size-aware, heavy-light set join that reports the components of its links.

Documents become sets of hashed k-word shingles (64 bits); equal sets are one set from then on. With threshold t
a set of n shingles can miss at most s = n - ceil(t n) of them in a partner. Everything below follows from that:

1. Shingles are dealt by hash to blocks of numbers and counted there. A set with more than s shingles that no
   other set has is out. The first count uses a quarter of the hash space, the second, of the sets that are
   left, all of it. A Bloom filter picks the texts to read again.
2. Small sets enumerate their subsets of each size that a partner's overlap can have: partners meet under an
   equal subset. Large sets post their s + 1 rarest shingles: partners meet in an inverted list. The boundary is
   the size up to which the subsets cost less than the lists, by the counted lengths. Small sets that a large
   one can match post to the lists too.
3. Lists are scanned without listing their pairs: each has a pivot (the member made most of shared shingles)
   and every set is verified against the pivot it meets most often. Sets so linked are one component. This is
   repeated with other pivots while lists still hold many sets of different components; then the remaining
   pairs of different components, and only they, are verified one by one. Pairs whose sizes, or whose numbers of
   shingles from the common one on, rule a link out are not formed. Every pair that could link two
   components is therefore verified or implied, and the components are exact.

Defined cases: null, empty and blank texts have empty sets and link with nothing; fewer than k words make one
shingle; repeated rows get the same component; a null doc_id is the largest; an empty table gives no rows.
Equal 64-bit hashes of different shingles or sets are taken as equal (chance below 1e-6 at 10^6 documents).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks, bloom, hashing
from .common import shuffle_tasks, written
from .components import components

WORDS, PERCENT = 5, 80
SLICE = np.uint64(62)  # the first count takes hashes whose top two bits are 0
SHORTER = np.uint64(22)  # and of them the next 40 bits
MOST_SMALL = 16  # above this size subsets never cost less than lists
ROUNDS = 2  # of pivots, before the remaining pairs are listed
_FLUSH = 1 << 20


def _spare(n, percent: int):
    """How many shingles of a set of n a partner can lack."""
    return n - (percent * n + 99) // 100


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    text = batch.column("text")
    for first, end in hashing.chunks(text):
        texts = [(t or "").encode() for t in text.slice(first, end - first).to_pylist()]
        hashes, bounds = hashing.shingles(texts, words)
        for i in range(len(texts)):
            yield first + i, np.unique(hashes[bounds[i] : bounds[i + 1]])


def _in_slice(members: np.ndarray) -> np.ndarray:
    """What the first count takes of a set: the distinct beginnings of its hashes in the slice. Each that no other set
    has belongs to a shingle that none has."""
    part = members[members >> SLICE == 0] >> SHORTER
    return part[blocks.group_starts(part)]


def _set_id(members: np.ndarray) -> int:
    total = np.add.reduce(hashing.mix(members ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)
    return int(hashing.mix(np.array([total + np.uint64(len(members))], dtype=np.uint64)).view(np.int64)[0])


def _summaries(words: int):
    def run(batches):
        for batch in batches:
            rows = [(i, len(s), _set_id(s), len(_in_slice(s))) for i, s in _sets(batch, words)]
            at, size, sid, part = zip(*rows, strict=True) if rows else ((), (), (), ())
            ids = batch.column("doc_id").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(size, pa.int64()), pa.array(sid, pa.int64()), pa.array(part, pa.int64())],
                names=["doc_id", "n", "sid", "n_slice"],
            )

    return run


def _postings(words: int, parts: int):
    """Blocks of (shingle, set) of the slice: 4 bytes and 1 of a shingle."""

    def flushed(hashes, sids):
        h = np.concatenate(hashes)
        columns = [(h >> np.uint64(8)).astype(np.uint32), h.astype(np.uint8), np.concatenate(sids)]
        return blocks.dealt(columns, hashing.mix(h), parts, repeats=(2,))

    def run(batches):
        hashes, sids, held = [], [], 0
        for batch in batches:
            for _, s in _sets(batch, words):
                part = _in_slice(s)
                if len(part):
                    hashes.append(part)
                    sids.append(np.full(len(part), _set_id(s), dtype=np.int64))
                    held += len(part)
                if held >= _FLUSH:
                    yield flushed(hashes, sids)
                    hashes, sids, held = [], [], 0
        if held:
            yield flushed(hashes, sids)

    return run


def _counted(hashes: np.ndarray, sids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct postings, ordered by shingle, with the number of sets that have the shingle."""
    order = np.lexsort((sids, hashes))
    h, s = hashes[order], sids[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
    h, s = h[new], s[new]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
    count = np.diff(np.append(first, len(h)))
    return h, s, np.repeat(count, count)


def _shared_in_slice(table: pa.Table) -> pa.Table:
    shingles = blocks.column(table, 0, np.uint32).astype(np.uint64) << np.uint64(8) | blocks.column(table, 1, np.uint8)
    _, sids, df = _counted(shingles, blocks.repeated_column(table, 2, np.int64))
    sid, n = np.unique(sids[df > 1], return_counts=True)
    return pa.table({"sid": pa.array(sid, pa.int64()), "shared": pa.array(n, pa.int64())})


def _set_rows(words: int):
    def run(batches):
        for batch in batches:
            rows = [(i, _set_id(s), len(s), s.tobytes()) for i, s in _sets(batch, words)]
            at, sid, n, members = zip(*rows, strict=True) if rows else ((), (), (), ())
            ids = batch.column("doc_id").take(pa.array(at, pa.int64()))
            arrays = [ids, pa.array(sid, pa.int64()), pa.array(n, pa.int64()), pa.array(members, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "sid", "n", "members"])

    return run


def _all_postings(parts: int):
    """Blocks of (shingle, set, size) from written sets."""

    def run(batches):
        for batch in batches:
            sids, sizes, members = (batch.column(c).to_pylist() for c in ("sid", "n", "members"))
            if not sids:
                continue
            h = np.frombuffer(b"".join(members), dtype=np.uint64)
            sizes = np.array(sizes, dtype=np.int64)
            yield blocks.dealt([h, np.repeat(np.array(sids, dtype=np.int64), sizes), np.repeat(sizes, sizes).astype(np.int32)], h, parts, repeats=(1, 2))

    return run


def _shared(parts: int):
    """Blocks by set of the shingles that more than one set has."""

    def run(table: pa.Table) -> pa.Table:
        hashes = blocks.column(table, 0, np.uint64)
        sids, sizes = blocks.repeated_column(table, 1, np.int64), blocks.repeated_column(table, 2, np.int32)
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        order = order[(np.append(same, False) | np.append(False, same))[: len(order)]]
        h, s, n = blocks.ordered(hashes[order], sids[order], sizes[order])  # a set may be there more than once
        first = blocks.group_starts(h)
        count = np.diff(np.append(first, len(h)))
        df = np.repeat(count, count)
        keep = np.flatnonzero(df > 1)
        keep = keep[np.argsort(s[keep], kind="stable")]  # those of a set together
        h, s, n, df = h[keep], s[keep], n[keep], df[keep].astype(np.int32)
        return pa.Table.from_batches([blocks.dealt([h, s, n, df], hashing.mix(s.view(np.uint64)), parts, steps=(3,), repeats=(1, 2))])

    return run


def _prefixes(percent: int):
    """The rarest shared shingles of each set that can have a partner."""

    def run(table: pa.Table) -> pa.Table:
        h, s = blocks.column(table, 0, np.uint64), blocks.repeated_column(table, 1, np.int64)
        n, df = blocks.repeated_column(table, 2, np.int32).astype(np.int64), blocks.stepped_column(table, 3, np.int32).astype(np.int64)
        order = np.lexsort((h, df, s))
        h, s, n, df = h[order], s[order], n[order], df[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, int)
        count = np.diff(np.append(first, len(s)))
        place = np.arange(len(s)) - np.repeat(first, count)
        alone = n - np.repeat(count, count)
        # How much of the set is shared widely: copies of a common original have most of it in the original.
        typical = np.repeat(np.add.reduceat(np.log2(df), first) if len(first) else np.zeros(0), count) / n
        keep = place < _spare(n, percent) + 1 - alone
        return pa.table(
            {
                "key": pa.array(h[keep].view(np.int64)),
                "sid": pa.array(s[keep]),
                "n": pa.array(n[keep]),
                "rest": pa.array((n - alone - place)[keep]),
                "df": pa.array(df[keep]),
                "typical": pa.array(typical[keep]),
            }
        )

    return run


def subsets(n: int, percent: int) -> int:
    return sum(math.comb(n, c) for c in range((percent * n + 99) // 100, n + 1))


def _subset_keys(percent: int):
    def run(batches):
        for batch in batches:
            keys, owners, sizes = [], [], []
            for sid, n, members in zip(*(batch.column(c).to_pylist() for c in ("sid", "n", "members")), strict=True):
                h = hashing.mix(np.frombuffer(members, dtype=np.uint64) + np.uint64(1))
                for c in range((percent * n + 99) // 100, n + 1):
                    picks = np.array(list(combinations(range(n), c)))
                    made = hashing.mix(np.add.reduce(h[picks], axis=1, dtype=np.uint64) + np.uint64(c))
                    keys.append(made.view(np.int64))
                    owners += [sid] * len(made)
                    sizes += [n] * len(made)
            arrays = [pa.array(np.concatenate(keys) if keys else [], pa.int64()), pa.array(owners, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "sid", "n"])

    return run


def _verified(percent: int):
    """The pairs whose sets are as alike as asked."""

    def run(batches):
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            good = []
            for x, y in zip(left, right, strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are alike enough. Only sets that stand in a pair are shuffled, and at every size by the same plan."""
    pairs = written(pairs)
    named = pairs.select(F.explode(F.array("a", "b")).alias("sid")).select(F.xxhash64("sid").alias("key"))
    buckets = bloom.buckets_for(2 * pairs.count())
    keyed = sets.select("sid", "members", F.xxhash64("sid").alias("key"))
    members = bloom.tested(keyed, bloom.build(named, buckets), buckets).filter("possible").select("sid", "members")
    with_left = pairs.hint("merge").join(members.withColumnsRenamed({"sid": "a", "members": "left"}), "a")
    both = with_left.join(members.withColumnsRenamed({"sid": "b", "members": "right"}), "b")
    return both.select("a", "b", "left", "right").mapInArrow(_verified(percent), "a long, b long")


def _in_reach(a: str, b: str, percent: int):
    """Whether two sets whose first common shingle this is can be alike enough: it and what follows must suffice."""
    n, m, rest = F.col(f"{a}n"), F.col(f"{b}n"), F.least(f"{a}rest", f"{b}rest")
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (rest * (100 + percent) >= (n + m) * percent)


def _small_boundary(sets: DataFrame, lists: DataFrame, percent: int) -> int:
    """The size up to which enumerating subsets costs less than scanning lists."""
    scans = {r["n"]: r["cost"] for r in lists.filter(F.col("n") <= MOST_SMALL).groupBy("n").agg(F.sum("df").alias("cost")).collect()}
    sized = sets.filter(F.col("n") <= MOST_SMALL).groupBy("n").count().collect()
    made = {r["n"]: r["count"] * subsets(r["n"], percent) for r in sized}
    best, saved, most = 0, 0, 0
    for n in range(1, MOST_SMALL + 1):
        saved += scans.get(n, 0) - made.get(n, 0)
        if saved > most:
            best, most = n, saved
    return best


def set_components(sets: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """`node`, `root` of the linked sets; `lists` has (key, sid, n, rest, typical)."""
    spark = sets.sparkSession
    edges = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "node long, root long")
    for round in range(ROUNDS + 1):
        placed = lists.join(roots.withColumnRenamed("node", "sid"), "sid", "left")
        placed = placed.withColumn("root", F.coalesce("root", "sid"))
        inside = placed.groupBy("key", "root").agg(F.count("*").alias("m")).groupBy("key")
        mixed = inside.agg(F.sum("m").alias("m"), (F.sum("m") * F.sum("m") - F.sum(F.col("m") * F.col("m"))).alias("pairs"))
        mixed = written(mixed.filter("pairs > 0"))
        pairs, postings = mixed.agg(F.coalesce(F.sum("pairs"), F.lit(0)) / 2, F.coalesce(F.sum("m"), F.lit(0))).first()
        if not postings:
            return roots
        lists_now = written(placed.join(mixed.select("key"), "key", "left_semi"))
        if round == ROUNDS or (round and pairs <= 2 * postings):
            break
        own = F.xxhash64("sid", F.lit(round))
        score = F.struct("typical", own) if round == 0 else F.struct(F.xxhash64("root", F.lit(round)), own)
        pivots = lists_now.groupBy("key").agg(F.max_by(F.struct("sid", "n", "rest", "root"), score).alias("pivot"))
        met = lists_now.alias("x").join(pivots, "key").filter((F.col("root") != F.col("pivot.root")) & _in_reach("x.", "pivot.", percent))
        met = met.groupBy("sid", F.col("pivot.sid").alias("pivot")).agg(F.count("*").alias("times"))
        best = met.groupBy("sid").agg(F.max_by("pivot", F.struct("times", "pivot")).alias("pivot"))
        chosen = best.select(F.greatest("sid", "pivot").alias("a"), F.least("sid", "pivot").alias("b")).distinct()
        edges = edges.unionByName(written(_links(chosen, sets, percent)))
        roots = written(components(edges))
        lists = lists_now.drop("root")
    one, two = lists_now.alias("x"), lists_now.alias("y")
    rest = one.join(two, "key").filter(
        (F.col("x.sid") > F.col("y.sid")) & (F.col("x.root") != F.col("y.root")) & _in_reach("x.", "y.", percent)
    )
    rest = rest.select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b")).distinct()
    return components(edges.unionByName(written(_links(rest, sets, percent))))


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id (the smallest doc_id that links reach), sid (the set)."""
    spark = docs.sparkSession
    parts = shuffle_tasks(spark)
    read = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = written(read.mapInArrow(_summaries(words), "doc_id long, n long, sid long, n_slice long"))
    classes = rows.filter("n > 0").groupBy("sid", "n", "n_slice").agg(F.min("doc_id").alias("low"))
    classes = written(classes)

    dealt = read.mapInArrow(_postings(words, parts), blocks.schema(3))
    shared = dealt.groupBy("part").applyInArrow(_shared_in_slice, "sid long, shared long")
    shared = shared.groupBy("sid").agg(F.sum("shared").alias("shared"))
    spare = F.col("n") - F.floor((F.col("n") * percent + 99) / 100)
    left = classes.join(shared, "sid", "left").filter(F.col("n_slice") - F.coalesce("shared", F.lit(0)) <= spare)
    left = written(left.select("sid", "low", F.xxhash64("low").alias("key")))
    buckets = bloom.buckets_for(left.count())
    again = bloom.tested(read.withColumn("key", F.xxhash64("doc_id")), bloom.build(left, buckets), buckets)
    sets = again.filter("possible").select("doc_id", "text").mapInArrow(
        _set_rows(words), "doc_id long, sid long, n long, members binary"
    )
    # Not joined with those that are left, as that would shuffle the sets: the few beside them, which the filter lets
    # through, and sets that come again (under a repeated or null doc_id) change no component.
    sets = written(sets.filter("n > 0").select("sid", "n", "members"))

    postings = sets.mapInArrow(_all_postings(parts), blocks.schema(3))
    by_set = postings.groupBy("part").applyInArrow(_shared(parts), blocks.schema(4))
    lists = by_set.groupBy("part").applyInArrow(_prefixes(percent), "key long, sid long, n long, rest long, df long, typical double")
    lists = written(lists)
    small = _small_boundary(sets, lists, percent)
    keys = sets.filter(F.col("n") <= small).mapInArrow(_subset_keys(percent), "key long, sid long, n long")
    sides = lists.filter(F.col("n") * 100 > small * percent).drop("df")
    roots = set_components(sets, sides.unionByName(keys.withColumn("rest", F.col("n")).withColumn("typical", F.lit(0.0))), percent)

    of_class = classes.select("sid", "low").join(roots.withColumnRenamed("node", "sid"), "sid", "left")
    of_class = of_class.withColumn("root", F.coalesce("root", "sid"))
    lowest = of_class.groupBy("root").agg(F.min("low").alias("component_id"))
    found = of_class.join(lowest, "root").select("sid", "component_id")
    with_set = rows.join(found, "sid", "left")
    return with_set.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "sid"
    )


def deduplicate(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id; empty documents are linked with nothing and stay."""
    found = join(docs, words, percent)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(F.col("kept_id")), "left_semi")
