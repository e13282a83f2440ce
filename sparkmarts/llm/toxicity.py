"""Toxicity by class-conditional models of words and word pairs after Kneser and Ney, with two departures: lower
orders use document counts, not numbers of contexts, and discounts are fixed.

For each class, an expression (a word, its stem, or a pair of words) counts the training documents that hold it. Counts
are discounted; the mass so freed, which is pooled over both classes, backs off from the pair to the word, from the word to its stem (its first
four letters) and from the stem to counts that both classes share. A word's part of its stem is shared too, so
an expression seen in few documents is judged by its family, and alike under both models where that is rare. A document is
described by the difference of its two log-likelihoods per word, by the part of it that speaks clearly for the
toxic model, and by the strongest word; a logistic curve over these three turns them into a score from 0 to 1.

All training rows are counted. Counts are summed within a task, dealt by hash of the expression and summed
there, so frequent words gather nowhere. The model that scoring tasks hold is hashed into tables of 2^20 cells
(10 of them, 40 MB: a proven bound); expressions in one cell share its counts. Only the curve is fitted on a
bounded sample: the training rows with the lowest hashes, about `sample_rows` of them.

Defined cases: null and empty texts have no evidence and get the curve's value for none; repeated documents
count as often as they are there; a document labelled twice has the higher label; other labels than 0 and 1 and
labels without a document are left out; with one class or none in training, every score is the share of toxic
rows (0 without rows); a null doc_id is never trained on and is not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks, bloom, hashing
from .common import carried, shuffle_tasks, written

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
SAMPLE_ROWS, SEED = 20_000, 7
CELL_BITS, DISCOUNT, PAIR_DISCOUNT, CLEAR = 20, 2.0, 8.0, 1.0
_CELLS = 1 << CELL_BITS
_MASK = np.uint64(_CELLS - 1)
_FLUSH = 1 << 19
# Tables of the model, each for class 0 and 1.
WORD, STEM, HISTORY, FREED, PAIR, TABLES = 0, 2, 4, 6, 8, 10
STEM_SIGNS = 4


def held_out(id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _pairs(words: np.ndarray) -> np.ndarray:
    """Pairs as one number: the cell of the first word in the top 20 bits, then 44 bits of the second."""
    return ((words[:-1] & _MASK) << np.uint64(64 - CELL_BITS)) | (words[1:] >> np.uint64(CELL_BITS))


def _pair_cells(pairs: np.ndarray) -> np.ndarray:
    return hashing.mix(pairs) & _MASK


def _lowered(texts: pa.Array) -> list[bytes]:
    return [(t or "").lower().encode() for t in texts.to_pylist()]


def _expressions(parts: int):
    """Blocks of (sort, expression, documents of class 0, of class 1), summed within the task."""

    def flushed(keys, sorts, labels):
        key, sort, label = np.concatenate(keys), np.concatenate(sorts), np.concatenate(labels)
        order = np.lexsort((key, sort))
        key, sort, label = key[order], sort[order], label[order]
        first = blocks.group_starts(key, sort)
        toxic = np.add.reduceat(label, first, dtype=np.int64)
        plain = np.diff(np.append(first, len(key))) - toxic
        columns = [sort[first], key[first], plain.astype(np.uint32), toxic.astype(np.uint32)]
        return blocks.dealt(columns, hashing.mix(key[first]), parts)

    def run(batches):
        keys, sorts, labels, held = [], [], [], 0
        for batch in batches:
            toxic = batch.column("toxic").to_pylist()
            text = batch.column("text")
            for a, b in hashing.chunks(text):
                words, stems, first = hashing.bare_words(_lowered(text.slice(a, b - a)), STEM_SIGNS)
                for i in range(b - a):
                    own = words[first[i] : first[i + 1]]
                    single, stem = np.unique(own), np.unique(hashing.mix(stems[first[i] : first[i + 1]]))
                    for sort, found in ((WORD, single), (STEM, stem), (PAIR, np.unique(_pairs(own)))):
                        keys.append(found)
                        sorts.append(np.full(len(found), sort, dtype=np.uint8))
                        labels.append(np.full(len(found), toxic[a + i], dtype=np.uint8))
                    held += len(own)
                    if held >= _FLUSH:
                        yield flushed(keys, sorts, labels)
                        keys, sorts, labels, held = [], [], [], 0
        if held:
            yield flushed(keys, sorts, labels)

    return run


def _summed(parts: int):
    """Blocks of (table, cell, value) from whole counts of expressions."""

    def run(table: pa.Table) -> pa.Table:
        sort, key = blocks.column(table, 0, np.uint8), blocks.column(table, 1, np.uint64)
        counts = [blocks.column(table, c, np.uint32) for c in (2, 3)]
        order = np.lexsort((key, sort))
        key, sort = key[order], sort[order]
        first = blocks.group_starts(key, sort)
        key, sort = key[first], sort[first]
        own = (np.where(sort == PAIR, _pair_cells(key), key & _MASK)).astype(np.uint32)
        history = (key >> np.uint64(64 - CELL_BITS)).astype(np.uint32)
        single, stem, pair = sort == WORD, sort == STEM, sort == PAIR
        tables, cells, values = [], [], []

        def add(name, label, cell, value):
            some = value > 0
            tables.append(np.full(some.sum(), name + label, dtype=np.uint8))
            cells.append(cell[some])
            values.append(value[some])

        for label in (0, 1):
            n = np.add.reduceat(counts[label][order], first, dtype=np.float64) if len(first) else np.zeros(0)
            add(WORD, label, own[single], n[single])
            add(STEM, label, own[stem], n[stem])
            add(HISTORY, label, history[pair], n[pair])
            add(FREED, label, history[pair], np.minimum(n[pair], PAIR_DISCOUNT))
            add(PAIR, label, own[pair], np.maximum(n[pair] - PAIR_DISCOUNT, 0))
        name, cell, value = np.concatenate(tables), np.concatenate(cells), np.concatenate(values)
        place = name.astype(np.int64) * _CELLS + cell
        place, which = np.unique(place, return_inverse=True)
        value = np.bincount(which, weights=value, minlength=len(place))
        deal = (place.astype(np.uint64) >> np.uint64(12)) << np.uint64(20)  # ranges of 4096 cells
        return pa.Table.from_batches([blocks.dealt([place, value], deal, parts)])

    return run


def _cells(table: pa.Table) -> pa.Table:
    place, which = np.unique(blocks.column(table, 0, np.int64), return_inverse=True)
    value = np.bincount(which, weights=blocks.column(table, 1, np.float64), minlength=len(place))
    return pa.table({"place": pa.array([place.astype(np.uint32).tobytes()]), "value": pa.array([value.astype(np.float32).tobytes()])})


def counted(train: DataFrame) -> np.ndarray:
    """The model's tables from all rows of `text`, `toxic`."""
    parts = shuffle_tasks(train.sparkSession)
    expressions = train.select("text", "toxic").mapInArrow(_expressions(parts), blocks.schema(4))
    sums = expressions.groupBy("part").applyInArrow(_summed(parts), blocks.schema(2))
    cells = sums.groupBy("part").applyInArrow(_cells, "place binary, value binary")
    model = np.zeros(TABLES * _CELLS, dtype=np.float32)
    for row in cells.toLocalIterator():  # at most 10 x 2^20 cells in all
        model[np.frombuffer(row["place"], dtype=np.uint32)] = np.frombuffer(row["value"], dtype=np.float32)
    return model.reshape(TABLES, _CELLS)


class Model:
    """Log-likelihood ratios of words in their place."""

    def __init__(self, tables: np.ndarray):
        words, stems = (tables[t : t + 2].astype(np.float64) for t in (WORD, STEM))
        shared = stems.sum(axis=0) + 0.5
        self.in_stem = (words.sum(axis=0) + 0.5).astype(np.float32)
        self.of_stem = (shared + 0.5).astype(np.float32)
        stem, freed = self._discounted(stems)
        self.stem = (stem + freed * shared / shared.sum()).astype(np.float32)
        self.word, self.freed = self._discounted(words)
        seen, freed = tables[HISTORY : HISTORY + 2], tables[FREED : FREED + 2].sum(axis=0)
        self.back = np.where(freed > 0, freed / np.maximum(seen.sum(axis=0), 1), 1).astype(np.float32)
        self.seen = np.maximum(seen, 1).astype(np.float32)
        self.pair = tables[PAIR : PAIR + 2]

    @staticmethod
    def _discounted(counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Probabilities of both classes, and the share of all counts that is freed for what is below."""
        total = np.maximum(counts.sum(axis=1), 1)[:, None]
        freed = np.minimum(counts, DISCOUNT).sum() / max(counts.sum(), 1)
        return (np.maximum(counts - DISCOUNT, 0) / total).astype(np.float32), max(float(freed), 1e-6)

    def ratios(self, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
        cell, stem = (words & _MASK).astype(np.int64), (hashing.mix(stems) & _MASK).astype(np.int64)
        part = np.minimum(1, self.in_stem[cell] / self.of_stem[stem])
        logs = []
        for label in (0, 1):
            p = self.word[label][cell] + self.freed * self.stem[label][stem] * part
            if len(cell) > 1:
                history, pair = cell[:-1], _pair_cells(_pairs(words)).astype(np.int64)
                p[1:] = self.pair[label][pair] / self.seen[label][history] + self.back[history] * p[1:]
            logs.append(np.log(np.maximum(p, 1e-30)))
        return (logs[1] - logs[0]).astype(np.float64)

    def features(self, texts: list[bytes]) -> np.ndarray:
        words, stems, first = hashing.bare_words(texts, STEM_SIGNS)
        out = np.zeros((len(texts), 3))
        for i in range(len(texts)):
            own = slice(first[i], first[i + 1])
            r = self.ratios(words[own], stems[own])
            n = max(1, len(r))
            out[i] = r.sum() / n, np.log(1e-3 + np.maximum(r - CLEAR, 0).sum() / n), max(0.0, r.max()) if len(r) else 0.0
        return out


def fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve, the constant last, by Newton's method with a small ridge; (0, 0, 0, logit) without two classes."""
    share = float(y.mean()) if len(y) else 0.0
    weights = np.zeros(x.shape[1] + 1)
    if share in (0.0, 1.0):
        weights[-1] = 50.0 if share else -50.0
        return weights
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    ridge = np.diag([1.0] * x.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        slope = z.T @ (y - p) - ridge @ weights
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    scaled = weights[:-1] / spread
    return np.append(scaled, weights[-1] - scaled @ middle)


def _described(model, columns: list[str], curve: np.ndarray | None):
    """The columns and the features, or their score where there is a curve."""

    def run(batches):
        learned = model.value
        for batch in batches:
            text = batch.column("text")
            made = [learned.features(_lowered(text.slice(a, b - a))) for a, b in hashing.chunks(text)]
            x = np.concatenate(made) if made else np.zeros((0, 3))
            kept = [batch.column(c) for c in columns]
            if curve is None:
                kept += [pa.array(x[:, i]) for i in range(3)]
                yield pa.RecordBatch.from_arrays(kept, names=[*columns, "f0", "f1", "f2"])
            else:
                score = 1 / (1 + np.exp(-np.clip(x @ curve[:-1] + curve[-1], -50, 50)))
                yield pa.RecordBatch.from_arrays([*kept, pa.array(score)], names=[*columns, "score"])

    return run


def trained(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """The model (as a broadcast) and the curve from the labelled documents that are not held out."""
    spark = docs.sparkSession
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    known = written(known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("key", F.xxhash64("doc_id")))
    rows = known.count()
    buckets = bloom.buckets_for(rows)
    texts = bloom.tested(docs.select("doc_id", "text").withColumn("key", F.xxhash64("doc_id")), bloom.build(known, buckets), buckets)
    texts = texts.filter("possible").select("doc_id", "text")

    # Always a shuffle join, so that the plan is the same at every size; the filter keeps it to labelled texts.
    tables = counted(texts.join(known.select("doc_id", "toxic").hint("merge"), "doc_id"))
    model = spark.sparkContext.broadcast(Model(tables))
    order = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000))
    picked = known.filter(order < int(1_000_000 * min(1.0, sample_rows / max(1, rows))))
    sample = texts.filter(order < int(1_000_000 * min(1.0, sample_rows / max(1, rows)))).join(picked.select("doc_id", "toxic"), "doc_id")
    found = sample.mapInArrow(_described(model, ["toxic"], None), "toxic int, f0 double, f1 double, f2 double").toPandas()
    return model, fitted(found[["f0", "f1", "f2"]].to_numpy(), found["toxic"].to_numpy(dtype=float))


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, carry: list[str] | None = None) -> DataFrame:
    """Per input row: `row` (its columns, or those in `carry`), held_out, score, predicted."""
    model, curve = trained(docs, labels, sample_rows)
    read = docs.select(carried(docs, carry).alias("row"), held_out().alias("held_out"), F.col("text").alias("text"))
    row = read.schema["row"].dataType.simpleString()
    scored = read.mapInArrow(_described(model, ["row", "held_out"], curve), f"row {row}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted toxic, with their own columns."""
    return score(docs, labels).filter("predicted = 0").select("row.*")
