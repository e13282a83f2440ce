"""Line-first cleaning: rules look at each line, lines that fail go, and a document that loses too much is rejected.

Lines are what \\n separates and count if they hold a word. Three rules look at a line by itself:

* punctuation: prose has a sentence mark at the end of the line, or within it before white space, and neither many
  symbols among its characters nor words that mostly end in repeated marks;
* navigation: items between bars, arrows or dots, or nothing but words of menus;
* boilerplate: notices of rights, licences, cookies, scripts and subscriptions, and place-holder text.

A line equal to an earlier one of its document goes as well. So each distinct line is judged once, and what stays is
the distinct lines that pass, in order. A document is kept if at least LEAST_KEPT percent of the characters in its words
stay and it passes the rules on whole documents (`base_failed`): enough words, and not too many of them in repeated
windows of WINDOW words. Everything is array expressions on the JVM, in one pass over the rows without a shuffle.

Words are what ASCII white space separates. Windows are compared by 64-bit hashes within their document.

Defined cases: null text counts as empty; a text without a word has no lines, loses nothing and fails the rule on its
number of words; an empty table gives an empty result; the input's columns are kept in `row`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, carried, computed, whole_text

LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED = 30  # percent of the words
MOST_SYMBOLS = 10  # percent of a line's characters in words
LEAST_KEPT = 50  # percent of a document's characters in words
SYMBOLS = "#*$%&|<>"

# Marks, menu words and notices that the rules look for.
SENTENCE_MARK = r"[.!?…:;。！？؟।][\"'”’»)\]]*([\x20\x09-\x0D]|\z)"
REPEATED_MARKS = r"[!?*#$%&=~_-]{2,}([\x20\x09-\x0D]|\z)"
ITEM_BREAK = r"[\x20\x09-\x0D]([|»›•·]|::|>|->|/)[\x20\x09-\x0D]"
MENU = (
    "home", "menu", "about", "contact", "login", "log in", "sign in", "sign up", "register", "search", "help", "faq",
    "next", "previous", "back", "top", "more", "read more", "share", "tweet", "print", "email", "sitemap", "archive",
    "categories", "tags", "comments", "reply", "cart", "checkout", "account", "blog", "news", "products", "services",
)
NOTICES = (
    "all rights reserved", "copyright", "©", "licensed under", "released under the", "creative commons",
    "terms of (use|service)", "privacy policy", "cookie", "enable javascript", "subscribe to", "newsletter",
    "click here", "lorem ipsum", "powered by", "public license",
)
MENU_LINE = rf"(?i)^[\x20\x09-\x0D]*(({'|'.join(MENU)})[\x20\x09-\x0D|,/>»›•·-]*)+\z"
NOTICE = rf"(?i)({'|'.join(NOTICES)})"


def _word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE, ""))


def _symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def failed_rule(line: Column) -> Column:
    """The first rule that the line fails: navigation, boilerplate or punctuation; null if it passes all."""
    breaks, words = F.regexp_count(line, F.lit(ITEM_BREAK)), F.regexp_count(line, F.lit(WORD))
    chars = _word_chars(line)
    navigation = ((breaks >= 2) & (breaks * 6 >= words)) | line.rlike(MENU_LINE)
    marked = F.regexp_count(line, F.lit(REPEATED_MARKS)) * 2 > words
    unmarked = ~line.rlike(SENTENCE_MARK)
    symbols = _symbols(line) * 100 > chars * MOST_SYMBOLS
    return (
        F.when(navigation, "navigation").when(line.rlike(NOTICE), "boilerplate").when(marked | unmarked | symbols, "punctuation")
    )


# ---------------------------------------------------------------- words in repeated windows


def _later(values: Column, steps: int) -> Column:
    return F.slice(values, steps + 1, F.greatest(F.size(values) - steps, F.lit(0)))


def _with_windows(rows: DataFrame, words: str) -> DataFrame:
    """Adds `_windows`: hashes of all runs of WINDOW words, of pairs of pairs of pairs."""
    rows = computed(rows, "_runs1", F.transform(words, lambda w: F.xxhash64(w)))
    step = 1
    while step < WINDOW:
        runs = F.col(f"_runs{step}")
        paired = F.zip_with(runs, _later(runs, step), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))
        rows = computed(rows, f"_runs{2 * step}", paired).drop(f"_runs{step}")
        step *= 2
    whole = F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))  # behind them, runs that the text's end cuts off
    return computed(rows, "_windows", F.slice(f"_runs{WINDOW}", F.lit(1), whole)).drop(f"_runs{WINDOW}")


def _with_repeated_words(rows: DataFrame, words: str) -> DataFrame:
    """Adds `n_repeat_words`: words in windows that occur twice or more. Only texts with one are looked at closer."""
    rows = _with_windows(rows, words)
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("hash"), i.alias("place"))))
    rows = computed(rows, "_placed", F.when(repeated, placed)).drop("_windows")

    def again(window: Column, i: Column) -> Column:
        beside = [F.get("_placed", i + side)["hash"] for side in (-1, 1)]
        return F.when((window["hash"] == beside[0]) | (window["hash"] == beside[1]), window["place"])

    starts = F.sort_array(F.array_compact(F.transform("_placed", again)))
    rows = computed(rows, "_starts", starts).drop("_placed")
    # Each window adds the words up to the next window's start, at most all of its own.
    added = F.transform("_starts", lambda s, i: F.least(F.lit(WINDOW), F.get("_starts", i + 1) - s))
    total = F.aggregate(added, F.lit(0).cast("long"), lambda n, words: n + words)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_starts")


# ---------------------------------------------------------------- documents


def judge(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per input row: `row` (its columns, or those in `carry`); n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines; lost_<rule> and lost_repeated, the characters in words of lines that go; cleaned, the text of the lines that
    stay; base_failed and kept."""
    rows = docs.select(carried(docs, carry).alias("row"), whole_text(text).alias("_text"))
    rows = computed(rows, "_words", F.array_remove(F.split("_text", f"{SPACE}+"), ""))
    rows = rows.withColumn("n_words", F.size("_words").cast("long"))
    rows = _with_repeated_words(rows, "_words").drop("_words")
    rows = computed(rows, "_all", F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(WORD)))
    judged = F.transform(
        F.array_distinct("_all"),
        lambda line: F.struct(line.alias("line"), _word_chars(line).alias("chars"), failed_rule(line).alias("failed")),
    )
    rows = computed(rows, "_lines", judged)

    def chars(lines: Column) -> Column:
        return F.aggregate(lines, F.lit(0).cast("long"), lambda n, line: n + line["chars"])

    rules = ("navigation", "boilerplate", "punctuation")
    lost = {f"lost_{rule}": chars(F.filter("_lines", lambda line: line["failed"] == rule)) for rule in rules}  # noqa: B023
    staying = F.filter("_lines", lambda line: line["failed"].isNull())
    rows = rows.select(
        "row",
        "n_words",
        _word_chars(F.col("_text")).cast("long").alias("word_chars"),
        _symbols(F.col("_text")).cast("long").alias("n_symbols"),
        (F.size("_all") - F.size("_lines")).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_all").cast("long").alias("n_lines"),
        *(value.alias(name) for name, value in lost.items()),
        chars(F.col("_lines")).alias("_distinct"),
        F.array_join(F.transform(staying, lambda line: line["line"]), "\n").alias("cleaned"),
    )
    rows = rows.withColumn("lost_repeated", F.col("word_chars") - F.col("_distinct")).drop("_distinct")
    stays = F.col("word_chars") - sum((F.col(name) for name in lost), F.col("lost_repeated"))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    return rows.withColumns(
        {"base_failed": failed, "kept": ~failed & (stays * 100 >= F.col("word_chars") * LEAST_KEPT)}
    )


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The kept documents with their own columns, the text column cleaned."""
    judged = judge(docs, text).filter("kept")
    return judged.select(*(F.col("cleaned" if c == text else f"row.`{c}`").alias(c) for c in docs.columns))
