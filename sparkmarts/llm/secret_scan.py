"""Secret scan over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams: an OR of clauses, each an AND of
trigrams that every match of that form holds. The index has a posting for each text and each trigram that some
rule asks for; a clause is answered by intersecting its postings, which is done by document (a bit for each
trigram, or-ed in partial aggregates), so a trigram that stands in every document gathers nowhere. Only texts
in a rule's answer are verified with its expression. A rule without mandatory trigrams scans all texts.

Trigrams are taken from lowered text, so rules may ignore case. Keys are 64-bit hashes of (id, text): two rows
that share one only share their candidates, and every candidate is verified.

Defined cases: null text counts as empty and has no spans; repeated rows each get their result; spans count
code points, the end exclusive; matches of a rule are leftmost and do not overlap, those that are too short are
dropped afterwards; equal starts are ordered by the rules' order; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, whole_text

_parser = re._parser  # the standard library's own reading of an expression
MOST_BRANCHES = 8  # members of a character class that are followed one by one
MOST_STATES = 512


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0  # characters that a match, or its group, must have
    group: int = 0
    ignore_case: bool = False


#: The base kinds.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
#: Public formats of keys that name their issuer.
RULES = (
    *BASE,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)


# ---------------------------------------------------------------- trigram queries

State = tuple[frozenset[str], str]  # trigrams that must occur so far, and up to two characters read last


def _read(states: set[State], char: str) -> set[State]:
    out = set()
    for grams, tail in states:
        run = tail + char.lower()
        out.add((grams | {run} if len(run) == 3 else grams, run[-2:]))
    return out


def _unknown(states: set[State]) -> set[State]:
    return {(grams, "") for grams, _ in states}


def _members(items) -> set[str] | None:
    """The characters of a class, or None where there are many."""
    chars: set[str] = set()
    for kind, value in items:
        name = str(kind)
        if name == "LITERAL":
            chars.add(chr(value).lower())
        elif name == "RANGE" and value[1] - value[0] < MOST_BRANCHES:
            chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return chars if len(chars) <= MOST_BRANCHES else None


def _walk(items, states: set[State]) -> set[State]:
    for kind, value in items:
        name = str(kind)
        if name == "LITERAL":
            states = _read(states, chr(value))
        elif name == "IN" and (chars := _members(value)):
            states = set().union(*(_read(states, c) for c in chars))
        elif name == "SUBPATTERN":
            states = _walk(value[-1], states)
        elif name == "BRANCH":
            states = set().union(*(_walk(option, states) for option in value[1]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = value
            for _ in range(min(least, 3)):
                states = _walk(inner, states)
            if least > 3:
                states = _unknown(states)
            if most == least + 1:
                states = states | _walk(inner, states)
            elif most != least:
                states = states | _unknown(states)
        elif name != "AT":
            states = _unknown(states)
        if len(states) > MOST_STATES:
            states = _unknown(states)
    return states


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of which every match fulfils one; none where some match needs no trigram."""
    clauses = {grams for grams, _ in _walk(_parser.parse(pattern), {(frozenset(), "")})}
    least = [c for c in clauses if not any(other < c for other in clauses)]
    return [] if frozenset() in least else sorted(least, key=sorted)


# ---------------------------------------------------------------- index and candidates


def index(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (`trigram`, its place in the list, and `key`) of the column `text`."""
    lowered = texts.select("key", F.lower("text").alias("low"))
    held = F.array(*(F.when(F.contains(F.col("low"), F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)))
    return lowered.select("key", F.explode(F.array_compact(held)).alias("trigram"))


def candidates(postings: DataFrame, trigrams: list[str], clauses: list[tuple[int, frozenset[str]]]) -> DataFrame:
    """`key`, `rules`: a bit for each rule of which the key's postings fulfil a clause."""
    uses = [
        F.array(*(F.struct(F.lit(c).alias("clause"), F.lit(1 << sorted(grams).index(t)).cast("long").alias("bit")) for c, (_, grams) in enumerate(clauses) if t in grams))
        for t in trigrams
    ]
    asked = postings.select("key", F.explode(F.get(F.array(*uses), F.col("trigram"))).alias("use"))
    met = asked.groupBy("key", F.col("use.clause").alias("clause")).agg(F.bit_or("use.bit").alias("bits"))
    whole = F.array(*(F.lit((1 << len(grams)) - 1).cast("long") for _, grams in clauses))
    rule = F.array(*(F.lit(1 << r).cast("long") for r, _ in clauses))
    full = met.filter(F.col("bits") == F.get(whole, F.col("clause")))
    return full.groupBy("key").agg(F.bit_or(F.get(rule, F.col("clause"))).alias("rules"))


# ---------------------------------------------------------------- verification


def _searched(rule: Rule) -> str:
    """What is searched for. Whole runs of one class are asked for in their least length at once: the same matches
    without the many short ones that would be dropped."""
    flag = "(?i)" if rule.ignore_case else ""
    if rule.least and not rule.group and re.fullmatch(r"\[[^\]]+\]\+", rule.pattern):
        return f"{flag}{rule.pattern[:-1]}{{{rule.least},}}"
    return flag + rule.pattern


def _spans(text: Column, place: int, rule: Rule) -> Column:
    """The rule's matches as (start, place, end), from the pieces of text between them."""
    pattern = _searched(rule)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    steps = F.zip_with(between, found, lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")))
    none = F.array().cast("array<struct<start:int,place:int,end:int,match:string>>")

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + F.length(step["match"])
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"), step["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    all_spans = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("out")), add)["out"]
    part = (lambda m: F.regexp_extract(m, pattern, rule.group)) if rule.group else (lambda m: m)
    long_enough = F.filter(all_spans, lambda s: F.length(part(s["match"])) >= rule.least)
    return F.transform(long_enough, lambda s: F.struct(s["start"], s["place"], s["end"]))


def _listed(spans: Column, kinds: list[str]) -> Column:
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["place"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", id: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """Per input row: `row` (its columns, or those in `carry`) and `spans`, ordered structs (start, place of the rule, end)."""
    queries = [trigram_query(rule.pattern) for rule in rules]
    clauses = [(r, grams) for r, query in enumerate(queries) for grams in query]
    trigrams = sorted(set().union(*(grams for _, grams in clauses)))
    plain = whole_text(text)
    keyed = docs.select(carried(docs, carry).alias("row"), plain.alias("text"), F.xxhash64(F.col(id), plain).alias("key"))
    if clauses:
        answers = candidates(index(keyed, trigrams), trigrams, clauses)
        keyed = keyed.join(answers, "key", "left")
    else:
        keyed = keyed.withColumn("rules", F.lit(0).cast("long"))
    none = F.array().cast("array<struct<start:int,place:int,end:int>>")
    found = []
    for place, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        if query:
            possible = F.col("rules").bitwiseAND(F.lit(1 << place)) != 0
        else:
            possible = F.col("text").rlike(_searched(rule))
        found.append(F.when(possible, _spans(F.col("text"), place, rule)).otherwise(none))
    # Exploding an array of one keeps later projections from taking the expression in, once for each use.
    spans = F.explode(F.array(F.array_sort(F.concat(*found))))
    return keyed.select("row", spans.alias("spans"))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> DataFrame:
    """Adds n_<kind> of the first `base` rules, base_sha256 and the listing of all spans."""
    kinds = [rule.kind for rule in rules]
    first = F.filter("spans", lambda s: s["place"] < base)

    def count(place: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["place"] == place)).cast("long").alias(f"n_{kinds[place]}")

    counts = [count(place) for place in range(base)]
    listed = F.sha2(_listed(first, kinds), 256).alias("base_sha256")
    return found.select("row.*", *counts, listed, _listed(F.col("spans"), kinds).alias("spans"))
