"""A table with every awkward case: nulls, blanks, repeats, ties, a very long text and columns whose names clash."""

from __future__ import annotations

import random

from pyspark.sql import types as T

CLASHING = ("row", "key", "kept", "size", "score", "sid", "bucket", "place", "text_sha256", "block", "order")
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(name, T.StringType()) for name in CLASHING),
    ]
)
SYLLABLES = ("an", "bo", "cu", "da", "el", "fi", "go", "hu", "il", "jo", "ka", "lu")


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choices(SYLLABLES, k=pick.randint(2, 4))) for _ in range(words))


def edited(text: str, *places: int) -> str:
    words = text.split(" ")
    for p in places:
        words[p] = f"edit{p}"
    return " ".join(words)


LONG = prose(1, 30_000)
TEXTS: list[tuple[int | None, str | None]] = [
    (1, ""),
    (2, None),
    (3, " \n\t "),
    (4, "one two three"),
    (5, "ONE  two\nthree"),
    (6, LONG),
    (7, edited(LONG, 100, 20_000)),
    (8, prose(2, 120)),
    (8, prose(2, 120)),
    (9, prose(2, 120) + " "),
    (10, edited(prose(2, 120), 7)),
    (11, "héé ÀÉ 漢字 👍 x"),
    (12, "12 34 !!"),
    (13, prose(3, 60)),
    (None, "no id here at all"),
    (None, None),
]


def odd(spark):
    rows = [
        (i, t, ("aa", "bb", None)[k % 3], ("s", None, "", "t")[k % 4], None, *([None] * len(CLASHING)))
        for k, (i, t) in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def of(spark, texts):
    """A table of texts with ids from 0."""
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
