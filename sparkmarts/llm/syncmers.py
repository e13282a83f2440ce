"""Document fingerprints from closed syncmers of words.

A run of k words is an anchor if the smallest of its runs of s words (by hash) is its first or its last. That
depends on the run alone, not on its surroundings, so an edit moves no anchor outside of it, and two texts that
share a passage share its anchors: of any k - s runs in a row one is an anchor, so 5 equal words always share one.

Two texts are compared by all their anchors, matched by place (`with_likeness`). Each distinct hash stands in the
place (word number) of its first occurrence. Anchors that both texts have and that follow one another at the same
shift are a run; the heaviest chain of runs that have one order in both texts counts, so anchors that only occur
in both somewhere do not. Likeness is the number of matched anchors over the distinct anchors of both texts. Where
one of the texts has fewer than FEW distinct anchors (short texts, scripts without spaces), both are compared in the same way by
their runs of 3 characters (`with_near`).

The fingerprint that is shown or stored is the list of the smallest anchors, with their places; `likeness` of two
such lists estimates the share of common anchors without the texts.

Words are lowered and separated by ASCII white space. Everything is array expressions on the JVM.

Defined cases: null text counts as empty; a text with fewer than k words is one anchor, an empty one has none and
the empty fingerprint; two empty texts are alike (1.0), an empty and another are not (0.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, carried, shuffle_tasks, whole_text

K, S, KEPT = 4, 2, 64
FEW, CHARACTERS = 8, (3, 2)
_PLACE = 2**31 - 1


def _short(hash: Column) -> Column:
    return F.shiftrightunsigned(hash, 32)  # a hash of 32 bits leaves room for the place in one number


def _words(text: Column) -> Column:
    """Word hashes; runs of separators leave empty strings, which are dropped."""
    return F.transform(F.array_remove(F.split(F.lower(text), f"{SPACE}+"), ""), lambda w: F.xxhash64(w))


def _from(values: Column, start: int) -> Column:
    """The array without its first elements."""
    return F.slice(values, start + 1, F.greatest(F.size(values) - start, F.lit(0)))


def _runs(words: Column, length: int) -> Column:
    """Hashes of all runs of `length` words."""
    out = words
    for k in range(1, length):
        out = F.zip_with(out, _from(words, k), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
    return F.filter(out, lambda h: h.isNotNull())


def _computed(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that later expressions read instead of taking it in: inside a lambda it would be computed
    again for every element. Exploding an array of one is what Spark does not merge with other projections."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _anchored(rows: DataFrame, units: Column, out: str, k: int, s: int) -> DataFrame:
    """Adds `out`: the anchors of the units (hashes) in order, each as hash * 2^31 + place."""
    rows = _computed(rows, "_w", units)
    rows = _computed(rows, "_s", _runs(F.col("_w"), s))
    inner = k - s + 1

    def anchor(first: Column, i: Column) -> Column:
        run = F.slice("_s", i + 1, inner)
        least = F.array_min(run)
        edge = (least == first) | (least == F.get("_s", i + (inner - 1)))
        return F.when((i + inner <= F.size("_s")) & edge, _packed(F.xxhash64(run), i))

    found = F.filter(F.transform("_s", anchor), lambda x: x.isNotNull())
    short = F.when(F.size("_w") > 0, F.array(_packed(F.xxhash64("_w"), F.lit(0)))).otherwise(F.slice(found, 1, 0))
    return _computed(rows, out, F.when(F.size("_w") >= k, found).otherwise(short)).drop("_w", "_s")


def with_anchors(rows: DataFrame, text: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """Adds `out`: the anchors of the text column in order, each as hash * 2^31 + place."""
    return _anchored(rows, _words(whole_text(text)), out, k, s)


def _packed(hash: Column, place: Column) -> Column:
    return F.shiftleft(_short(hash), 31) + place


def _hash(anchor: Column) -> Column:
    return F.shiftright(anchor, 31)


def _place(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit(_PLACE))


def _distinct(rows: DataFrame, anchors: str, out: str) -> DataFrame:
    """Adds `out`: the distinct anchors by hash, each in its first place."""
    rows = _computed(rows, "_sorted", F.sort_array(anchors))
    new = F.filter("_sorted", lambda x, i: (i == 0) | (_hash(F.get("_sorted", i - 1)) != _hash(x)))
    return _computed(rows, out, new).drop("_sorted")


def with_distinct(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Adds `out`: all distinct anchors of the text by hash, each in its first place."""
    return _distinct(with_anchors(rows, text, "_anchors"), "_anchors", out).drop("_anchors")


def with_fingerprint(rows: DataFrame, text: str, out: str, kept: int = KEPT) -> DataFrame:
    """Adds `out`: the anchors with the smallest distinct hashes, each in its first place."""
    return with_distinct(rows, text, "_all").withColumn(out, smallest(F.col("_all"), kept)).drop("_all")


def smallest(anchors: Column, kept: int = KEPT) -> Column:
    """The fingerprint out of all distinct anchors."""
    return F.slice(anchors, 1, kept)


def _sided(anchors: Column, side: int) -> Column:
    """Hash, side and place in one number, so that equal hashes of both sides sort next to one another."""
    return F.transform(anchors, lambda x: F.shiftleft(_hash(x), 32).bitwiseOR(F.lit(side << 31)).bitwiseOR(_place(x)))


def _chained(pairs: str) -> Column:
    """Most pairs in runs of one shift that have the same order in both texts; pairs are place * 2^31 + place, in order.

    Of the chains that end before a place only those are kept that no other beats in both end and weight.
    """
    here, there = (lambda x: F.shiftright(x, 31)), _place
    moved = lambda x: there(x) - here(x)
    starts = F.filter(F.transform(pairs, lambda x, i: F.when((i == 0) | (moved(x) != moved(F.get(pairs, i - 1))), i)), lambda i: i.isNotNull())

    def runs(starts: Column) -> Column:
        end = lambda j: F.coalesce(F.get(starts, j + 1), F.size(pairs))
        return F.transform(
            starts,
            lambda i, j: F.struct(
                there(F.get(pairs, i)).alias("first"), there(F.get(pairs, end(j) - 1)).alias("last"), (end(j) - i).cast("long").alias("n")
            ),
        )

    def taken(chains: Column, run: Column) -> Column:
        before = F.array_max(F.transform(F.filter(chains, lambda c: c["last"] < run["first"]), lambda c: c["n"]))
        new = F.struct(run["last"].alias("last"), (run["n"] + F.coalesce(before, F.lit(0).cast("long"))).alias("n"))
        left = F.transform(F.array(new), lambda m: F.concat(F.filter(chains, lambda c: (c["last"] < m["last"]) | (c["n"] > m["n"])), F.array(m)))
        return F.get(left, 0)

    none = F.array().cast("array<struct<last:bigint,n:bigint>>")
    best = F.transform(F.array(starts), lambda s: F.aggregate(runs(s), none, taken, lambda chains: F.array_max(F.transform(chains, lambda c: c["n"]))))
    return F.coalesce(F.get(best, 0), F.lit(0).cast("long"))


def with_likeness(rows: DataFrame, one: Column, two: Column, out: str) -> DataFrame:
    """Adds `out`: matched anchors of two arrays of distinct anchors over all of both."""
    rows = _computed(rows, "_both", F.sort_array(F.concat(_sided(one, 0), _sided(two, 1))))

    def pair(x: Column, i: Column) -> Column:
        after = F.get("_both", i + 1)
        same = F.shiftrightunsigned(x, 32) == F.shiftrightunsigned(after, 32)
        return F.when(same, F.shiftleft(_place(x), 31).bitwiseOR(_place(after)))

    rows = _computed(rows, "_size", F.size("_both"))
    rows = _computed(rows, "_pairs", F.sort_array(F.filter(F.transform("_both", pair), lambda p: p.isNotNull()))).drop("_both")
    crossed = F.exists(F.transform("_pairs", lambda x, i: (i > 0) & (_place(x) <= _place(F.get("_pairs", i - 1)))), lambda c: c)
    matched = F.when(crossed, _chained("_pairs")).otherwise(F.size("_pairs"))
    near = F.when(F.col("_size") == 0, F.lit(1.0)).otherwise(matched / (F.col("_size") - F.size("_pairs")))
    return _computed(rows, out, near).drop("_size", "_pairs")


def _characters(text: str, where: Column) -> Column:
    """Hashes of the characters of the lowered words, one blank between words; none where the condition fails."""
    words = F.array_join(F.array_remove(F.split(F.lower(whole_text(text)), f"{SPACE}+"), ""), " ")
    units = F.transform(F.array_remove(F.split(words, ""), ""), lambda c: F.xxhash64(c))
    return F.when(where, units).otherwise(F.array().cast("array<bigint>"))


def with_near(rows: DataFrame, one: tuple[str, str], two: tuple[str, str], out: str) -> DataFrame:
    """Adds `out`: the likeness of two texts, each given by the names of its text and of its distinct anchors."""
    rows = _computed(rows, "_few", F.least(F.size(one[1]), F.size(two[1])) < FEW)
    compared = []
    for (text, anchors), name in ((one, "_one"), (two, "_two")):
        rows = _distinct(_anchored(rows, _characters(text, F.col("_few")), "_c", *CHARACTERS), "_c", name).drop("_c")
        compared.append(F.when(F.col("_few"), F.col(name)).otherwise(F.col(anchors)))
    return with_likeness(rows, *compared, out).drop("_few", "_one", "_two")


def likeness(one: Column, two: Column, kept: int = KEPT) -> Column:
    """The share of common hashes among the smallest of both fingerprints."""
    a, b = (F.transform(f, _hash) for f in (one, two))
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, kept)
    common = F.size(F.array_intersect(F.array_intersect(least, a), b))
    return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(common / F.size(least))


def shift(one: Column, two: Column) -> Column:
    """How many words later the common anchors stand in the second text (the middle one of the differences); null without any."""
    at = F.map_from_entries(F.transform(two, lambda x: F.struct(_hash(x), _place(x))))
    moved = F.filter(F.transform(one, lambda x: F.try_element_at(at, _hash(x)) - _place(x)), lambda d: d.isNotNull())
    return F.get(F.sort_array(moved), F.floor(F.size(moved) / 2).cast("int"))


def shown(print: Column) -> Column:
    return F.array_join(F.transform(print, lambda x: F.concat(F.lpad(F.lower(F.hex(_hash(x))), 8, "0"), F.lit("@"), _place(x))), " ")


# ---------------------------------------------------------------- each document and the next one


def _blocks(docs: DataFrame) -> Column:
    """Ranges of about as many rows each, by quantiles of the order key, found in two steps of comparisons."""
    tasks = shuffle_tasks(docs.sparkSession)
    steps = max(1, int(tasks**0.5))
    cuts = [i / tasks for i in range(1, tasks)]
    bounds = docs.agg(F.percentile_approx("order", cuts, 10_000 + 20 * tasks)).first()[0] if cuts else None
    if not bounds:
        return F.lit(0)
    bounds = sorted(set(bounds))
    parts = [bounds[i : i + steps] for i in range(0, len(bounds), steps)]
    above = lambda cuts: F.size(F.filter(cuts, lambda c: c < F.col("order")))
    coarse = F.greatest(above(F.array(*(F.lit(p[0]) for p in parts))) - 1, F.lit(0))
    fine = F.get(F.array(*(F.array(*map(F.lit, p)) for p in parts)), coarse)
    return F.coalesce(coarse * steps + above(fine), F.lit(0))


def with_next(docs: DataFrame, text: str = "text", id: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """Per input row: `row`, text, anchors (all distinct ones), and next_text, next_anchors of the next document in descending id order.

    Rows are dealt once, by ranges of the id, and only then anchored, so that texts alone are moved. Inside a range the next row is a neighbour; the last row of a
    range takes the first of the next range, of which there is one for each range.
    """
    tied = docs.select(
        carried(docs, carry).alias("row"), F.col(id).alias("order"), F.xxhash64(whole_text(text)).alias("tie"), whole_text(text).alias("text")
    )
    block = _blocks(tied.select("order"))
    tied = tied.withColumn("block", block)
    dealt = with_distinct(tied.repartition("block"), "text", "anchors")

    firsts = tied.groupBy("block").agg(F.max(F.struct("order", "tie")).alias("first"))
    first_rows = tied.join(
        F.broadcast(firsts.select(F.col("block").alias("of"), "first.*").withColumnsRenamed({"order": "o", "tie": "t"})),  # a row for each range
        (F.col("block") == F.col("of")) & F.col("order").eqNullSafe(F.col("o")) & (F.col("tie") == F.col("t")),
    )
    first_rows = with_distinct(first_rows.groupBy("block").agg(F.first("text").alias("text")), "text", "anchors")
    in_turn = Window.orderBy("block")  # over the ranges
    wrapped = F.last("first").over(in_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    entry = first_rows.select("block", F.struct("text", "anchors").alias("first"))
    entry = entry.select("block", F.coalesce(F.lag("first").over(in_turn), wrapped).alias("entry"))

    down = Window.partitionBy("block").orderBy(F.col("order").desc_nulls_last(), F.col("tie").desc())
    following = F.lead(F.struct("text", "anchors")).over(down)
    paired = dealt.withColumn("next", following).join(entry, "block").withColumn("next", F.coalesce("next", "entry"))
    return paired.select("row", "text", "anchors", F.col("next.text").alias("next_text"), F.col("next.anchors").alias("next_anchors"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last floor(n / 2) code points replaced by the first as many of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))
