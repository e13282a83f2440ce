"""Language identification by multilingual mixtures of letter n-grams.

Each language is a distribution over letter trigrams (lowered; other signs are one space), counted over all
training documents. A document is a mixture of languages: expectation-maximisation estimates the proportions
from its trigrams' likelihoods. The set of languages is chosen by penalised likelihood among the nested sets of
the largest proportions: a further language must raise the log-likelihood, scaled to independent trigrams, by
more than half the logarithm of their number. The prediction is the language with the largest proportion in the
chosen set, the score is that proportion.

Trigrams are hashed into 2^16 cells, so the broadcast model takes 256 KB a language. Counts are summed within a
task, then over waves of tasks, then over all.

Defined cases: null texts and texts without a letter are `und` with score 0, as is every text where nothing was
learned; equal proportions go to the first language in code point order; repeated rows count as often as they
are there; a null doc_id is neither learned from nor held out.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks, hashing
from .common import carried

FOLDS, HELD_OUT, UNKNOWN = 5, 0, "und"
CELLS, RANGES, WAVE = 1 << 16, 16, 256
ADDED = 0.5  # to every count
OVERLAP = 3.0  # each letter is in so many trigrams
STEPS = 15


def held_out(id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of all trigrams, the text of each, and the letters of each text. Texts are padded with a space."""
    lowered = [t.lower() for t in texts]
    signs = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le"), dtype=np.uint32)
    lengths = np.array([len(t) + 1 for t in lowered], dtype=np.int64)  # with the space after it
    text = np.repeat(np.arange(len(texts) + 1), np.append(lengths, 1))  # the space before the first is its own
    letter = _letters()[signs]
    count = np.bincount(text[np.flatnonzero(letter) - 1], minlength=len(texts))[: len(texts)]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # one space after a word
    owner = np.concatenate([[0], text[:-1]])[keep]
    kept = np.where(letter, signs, 32)[keep].astype(np.uint64)
    if len(kept) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), count
    middle = kept[1:-1] != 32  # a trigram belongs to the text of its middle letter
    runs = kept[:-2] | (kept[1:-1] << np.uint64(21)) | (kept[2:] << np.uint64(42))
    cells = (hashing.mix(runs[middle]) >> np.uint64(48)).astype(np.int64)
    return cells, owner[1:-1][middle], count


def _texts(column: pa.Array):
    for a, b in hashing.chunks(column):
        yield a, [t or "" for t in column.slice(a, b - a).to_pylist()]


def _counts(batches):
    from pyspark import TaskContext

    held: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, texts in _texts(batch.column("text")):
            names, code = np.unique(langs[first : first + len(texts)], return_inverse=True)
            cells, owner, _ = trigrams(texts)
            for i, name in enumerate(names.tolist()):
                mine = cells[code[owner] == i]
                held[name] = held.get(name, 0) + np.bincount(mine, minlength=CELLS)
    wave = TaskContext.get().partitionId() // WAVE
    rows = [(name, r, wave, part.astype(np.int64).tobytes()) for name, n in held.items() for r, part in enumerate(np.split(n, RANGES))]
    if rows:
        lang, r, waves, n = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(r, pa.int32()), pa.array(waves, pa.int32()), pa.array(n, pa.binary())], names=["lang", "cells", "wave", "n"])


def _sum(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(n, dtype=np.int64) for n in table.column("n").to_pylist()], axis=0)
    return table.slice(0, 1).drop_columns(["n"]).append_column("n", pa.array([total.tobytes()], pa.binary()))


def learned(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in code point order, and for each cell their probabilities."""
    train = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    shape = "lang string, cells int, wave int, n binary"
    counted = train.select("lang", "text").mapInArrow(_counts, shape)
    waves = counted.groupBy("lang", "cells", "wave").applyInArrow(_sum, shape)
    sums = waves.groupBy("lang", "cells").applyInArrow(_sum, shape)
    found: dict[str, np.ndarray] = {}
    for row in sums.toLocalIterator():  # 512 KB a language
        n = found.setdefault(row["lang"], np.zeros((RANGES, CELLS // RANGES)))
        n[row["cells"]] = np.frombuffer(row["n"], dtype=np.int64)
    names = sorted(name for name, n in found.items() if n.sum())
    counts = np.array([found[name].ravel() for name in names]).reshape(len(names), CELLS) + ADDED
    return names, (counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)


def proportions(likely: np.ndarray, weight: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each document (its rows start at `first`): the mixture over the allowed languages, and its log-likelihood."""
    size = np.diff(np.append(first, len(weight)))
    total = np.add.reduceat(weight, first)
    mixed = allowed / allowed.sum(axis=1, keepdims=True)
    for step in range(STEPS + 1):
        share = likely * np.repeat(mixed, size, axis=0)
        whole = share.sum(axis=1)
        if step == STEPS:
            return mixed, np.add.reduceat(weight * np.log(whole), first)
        share *= (weight / whole)[:, None]
        mixed = np.add.reduceat(share, first, axis=0) / total[:, None]
    raise AssertionError


def mixtures(cells: np.ndarray, owner: np.ndarray, probabilities: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents that have trigrams, and their proportions in the chosen sets of languages."""
    key, count = np.unique(owner * CELLS + cells, return_counts=True)
    doc, weight = key // CELLS, count.astype(np.float32)
    first = blocks.group_starts(doc)
    ids, likely = doc[first], probabilities[key % CELLS]
    number = likely.shape[1]
    everything = np.ones((len(ids), number), dtype=np.float32)
    mixed, _ = proportions(likely, weight, first, everything)
    rank = np.argsort(np.argsort(-mixed, axis=1, kind="stable"), axis=1)
    size = np.diff(np.append(first, len(weight)))
    penalty = 0.5 * np.log(np.maximum(np.add.reduceat(weight, first) / OVERLAP, 2))

    best = (rank < 1).astype(np.float32)
    reached = np.add.reduceat(weight * np.log((likely * np.repeat(best, size, axis=0)).sum(axis=1)), first) / OVERLAP
    open_docs = np.arange(len(ids))
    for languages in range(2, number + 1):
        rows = np.repeat(np.isin(np.arange(len(ids)), open_docs), size)
        starts = np.cumsum(size[open_docs]) - size[open_docs]
        allowed = (rank[open_docs] < languages).astype(np.float32)
        now, gain = proportions(likely[rows], weight[rows], starts, allowed)
        better = gain / OVERLAP - reached[open_docs] > penalty[open_docs]
        open_docs = open_docs[better]
        if not len(open_docs):
            break
        best[open_docs], reached[open_docs] = now[better], gain[better] / OVERLAP
    return ids, best


def _predicted(model, columns: list[str]):
    def run(batches):
        names, probabilities = model.value
        for batch in batches:
            langs, scores, sets = [], [], []
            for _, texts in _texts(batch.column("text")):
                lang, score, mixed = [UNKNOWN] * len(texts), [0.0] * len(texts), [""] * len(texts)
                cells, owner, letters = trigrams(texts)
                if len(cells) and names:
                    ids, best = mixtures(cells, owner, probabilities)
                    for d, p in zip(ids.tolist(), best, strict=True):
                        if letters[d]:
                            top = int(p.argmax())
                            lang[d], score[d] = names[top], min(1.0, float(p[top]))
                            mixed[d] = ",".join(f"{names[i]}:{p[i]:.3f}" for i in np.argsort(-p, kind="stable") if p[i] > 0)
                langs += lang
                scores += score
                sets += mixed
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.string())],
                names=[*columns, "lang_pred", "score", "mixture"],
            )

    return run


def identify(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Per input row: `row` (its columns, or those in `carry`), held_out, lang_pred, score, mixture (language:proportion, largest first)."""
    model = docs.sparkSession.sparkContext.broadcast(learned(docs))
    read = docs.select(carried(docs, carry).alias("row"), held_out().alias("held_out"), F.col("text").alias("text"))
    row = read.schema["row"].dataType.simpleString()
    return read.mapInArrow(_predicted(model, ["row", "held_out"]), f"row {row}, held_out boolean, lang_pred string, score double, mixture string")
