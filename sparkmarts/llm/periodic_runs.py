"""Runs of words that repeat with a period, found by seeds and extended along diagonals.

A run with smallest period q is a stretch in which words q apart are equal and which is at least LEAST_REPEATS * q and
LEAST_WORDS words long. Laid over itself q words later it agrees in `length - q` words, so some run of as many words (a
k-gram) occurs both at i and at i + q. Those are the seeds:

* Periods are taken by octaves, 1, 2-3, 4-7, ..., each with the longest k-gram that its shortest runs guarantee
  (5, 6, 12, 24, ... words). Such a k-gram is at least 1.5 q long. If it occurred a second time less than q further on
  inside the run, its two periods would give the run a smaller one; so within a run the next occurrence of a k-gram is
  exactly q away. Only neighbouring occurrences are paired, and each octave has at most one seed a word.
* k-grams of an octave are named by pairs of names of the octave before, and only those that occur twice are carried
  on, so text without repetition ends after the first octave.
* A seed is extended to both sides along its diagonal (lag q). A table of the furthest place covered for each lag passes
  over the other seeds of the same stretch, so a stretch is extended once.

Words are what ASCII white space separates, compared exactly. Each text is handled alone, in memory in proportion to
its words; no row is moved.

Defined cases: null text counts as empty; texts without a run come back with their words joined by one space; an empty
table gives an empty result; the input's columns are kept in `row`, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, whole_text

LEAST_WORDS, LEAST_REPEATS = 6, 4
RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))

Run = tuple[int, int, int]
Grams = tuple[np.ndarray, np.ndarray]  # a name for each place (-1: occurs once or not at all), and the places with one


def _paired(grams: Grams, step: int) -> Grams:
    """Names of the runs that a named run and the one `step` words further on make, where such a run occurs twice."""
    names, places = grams
    places = places[: np.searchsorted(places, len(names) - step)]
    following = names[places + step]
    both = following >= 0
    places = places[both]
    _, name, count = np.unique(names[places] * (len(names) + 1) + following[both], return_inverse=True, return_counts=True)
    again = count[name] > 1
    found = np.full(len(names), -1, dtype=np.int64)
    found[places[again]] = name[again]
    return found, places[again]


def _seeds(grams: Grams, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of neighbouring occurrences with a lag of the octave, by lag and place."""
    names, places = grams
    order = np.argsort(names[places], kind="stable")
    at, name = places[order], names[places][order]
    lag = at[1:] - at[:-1]
    good = (name[1:] == name[:-1]) & (lag >= shortest) & (lag < 2 * shortest)
    at, lag = at[:-1][good], lag[good]
    order = np.lexsort((at, lag))
    return at[order], lag[order]


def _agreement(a: np.ndarray, b: np.ndarray) -> int:
    """How many first elements of both arrays agree."""
    done, step, size = 0, 64, min(len(a), len(b))
    while done < size:
        differ = np.flatnonzero(a[done : done + step][: size - done] != b[done : done + step][: size - done])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, 2 * step
    return size


def _extended(words: np.ndarray, seeds: tuple[np.ndarray, np.ndarray], k: int) -> list[Run]:
    covered: dict[int, int] = {}
    found = []
    for at, lag in zip(seeds[0].tolist(), seeds[1].tolist(), strict=True):
        if at < covered.get(lag, 0):
            continue
        end = at + k + _agreement(words[at + k :], words[at + k + lag :])
        start = at - _agreement(words[:at][::-1], words[: at + lag][::-1])
        covered[lag] = end
        length = end + lag - start
        if length >= max(LEAST_WORDS, LEAST_REPEATS * lag):
            found.append((start, length, lag))
    return found


def runs_of(words: np.ndarray) -> list[Run]:
    """(start, length, period) of all runs of an array of word numbers, by start and period."""
    n = len(words)
    if n < LEAST_WORDS:
        return []
    grams = (words.astype(np.int64), np.arange(n))
    three = _paired(_paired(grams, 1), 1)
    lag, k, grams = 1, LEAST_WORDS - 1, _paired(three, 2)
    found = _extended(words, _seeds(grams, lag), k)
    lag, k, grams = 2, LEAST_WORDS, _paired(three, 3)
    while len(grams[1]) and LEAST_REPEATS * lag <= n:
        found += _extended(words, _seeds(grams, lag), k)
        grams = _paired(grams, k)
        lag, k = 2 * lag, 2 * k
    return sorted(found, key=lambda run: (run[0], run[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words as equal numbers."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, of each run only those before its first repetition."""
    if runs:
        dropped = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            dropped[start + period] += 1
            dropped[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(dropped[:-1]) == 0)]
    return b" ".join(words)


def _run(batches):
    for batch in batches:
        found, texts = [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            words = text.split()  # bytes: at ASCII white space
            runs = runs_of(numbered(words))
            found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
            texts.append(collapsed(words, runs).decode())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(found, kind), pa.array(texts, pa.string())], names=["row", "runs", "collapsed"]
        )


def find(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per input row: `row` (its columns, or those in `carry`), `runs` by start and period, and the `collapsed` text."""
    read = docs.select(carried(docs, carry).alias("row"), whole_text(text).alias("text"))
    return read.mapInArrow(_run, T.StructType([read.schema["row"]]).add("runs", RUNS).add("collapsed", T.StringType()))
