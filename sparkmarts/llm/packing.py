"""Best-fit packing of documents into token sequences, certified by lower bounds and repacked where they leave a gap.

Documents become ids plus an end id; one longer than a sequence is cut so that only its first piece is short.
Pieces are dealt to partitions of bounded size and packed there by best-fit decreasing. Dual feasible functions
give a lower bound on the partition's sequences: where it is met, the packing is proven best and stays. The bound is
not rounded up for that, as the parts of a sequence that rounding hides add up over partitions. The other partitions
keep their full sequences and put the open ones into a pool, which is dealt anew each round, whole sequences together
(by turns in order of their room and at random), and packed again; a new packing replaces the old one only if it needs fewer sequences. This goes on until the pool is
empty, fits one partition, meets its own bound, or until MOST_ROUNDS rounds in a row have each closed less
than a hundredth of the gap between the two; what is open then stays as it is.

Defined cases: null and empty texts are the end id alone; repeated rows are packed once each; ties go to the
lower rows of the partition; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory, whole_text, written

SEQUENCE, END_ID = 1024, 2
PARTITION_PIECES = 65_536
MOST_ROUNDS = 4  # in a row that may gain nothing
_CHUNK = 1 << 20  # characters encoded at a time
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long, room long, loose boolean"


def _cut(path: str, size: int, end_id: int):
    def encoded(texts: list[str]) -> Iterator[np.ndarray]:
        from .tokens import encoder

        first, room = 0, 0
        for i, t in enumerate([*texts, None]):
            if t is None or (room and room + len(t) > _CHUNK):
                ids, counts = encoder(path).encode(texts[first:i])
                ends = np.cumsum(counts)
                for a, b in zip(ends - counts, ends, strict=True):
                    yield np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                first, room = i, 0
            room += len(t or "")

    def run(batches):
        release_memory()
        for batch in batches:
            if not batch.num_rows:
                continue
            at, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(encoded(batch.column("text").to_pylist())):
                head = (len(ids) - 1) % size + 1
                for k, begin in enumerate([0, *range(head, len(ids), size)]):
                    end = head + k * size
                    at.append(row)
                    piece.append(k)
                    start.append(begin)
                    length.append(end - begin)
                    crc.append(zlib.crc32(ids[begin:end].tobytes()))
            arrays = [batch.column("doc_id").take(pa.array(at)), pa.array(piece, pa.int32())]
            arrays += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def bound_tokens(count: np.ndarray, size: int) -> int:
    """Tokens of room that any packing needs, from the number of pieces of each length (0 to size): the best of two
    families of dual feasible functions.

    The first lets lengths over size - x count as a whole sequence and drops those under x; the second rounds
    k + 1 times the length down to whole sequences (a multiple stays as it is).
    """
    tokens = count * np.arange(size + 1)
    number, total = np.append(0, np.cumsum(count)), np.append(0, np.cumsum(tokens))
    x = np.arange(0, size // 2 + 1)
    large = (number[-1] - number[size - x + 1]) * size
    best = int((large + total[size - x + 1] - total[x]).max())
    each = np.arange(size + 1)
    for k in range(1, 32):
        whole = (k + 1) * each
        value = np.where(whole % size == 0, k * each, whole // size * size)  # k times the function, so it stays whole
        best = max(best, -(-int((count * value).sum()) // k))
    return best


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Sequences that any packing needs."""
    return -(-bound_tokens(np.bincount(lengths, minlength=size + 1).astype(np.int64), size) // size) if len(lengths) else 0


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece, largest first into the fullest sequence with room; and the sequences used."""
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    with_room: list[list[int]] = [[] for _ in range(size + 1)]
    some, used = 0, 0  # bit r: there is a sequence with r tokens of room
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = some >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            s = with_room[room].pop()
            if not with_room[room]:
                some &= ~(1 << room)
        else:
            room, s, used = size, used, used + 1
        sequence[i], offset[i] = s, size - room
        if room > n:
            with_room[room - n].append(s)
            some |= 1 << (room - n)
    return sequence, offset, used


def _pack(size: int, round: int, last: bool):
    def run(batches):
        from pyspark import TaskContext

        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables)
        lengths = table.column("length").to_numpy()
        sequence, offset, used = best_fit(lengths, size)
        sequence += ((round << 20) + TaskContext.get().partitionId() + 1) << 32
        if round:
            old = table.column("sequence_id").to_numpy()
            if used >= len(np.unique(old)):
                sequence, offset = old.copy(), table.column("offset").to_numpy()
        _, which, count = np.unique(sequence, return_inverse=True, return_counts=True)
        needed = bound_tokens(np.bincount(lengths, minlength=size + 1).astype(np.int64), size)
        gap = len(count) * size > needed and not last
        filled = np.bincount(which, weights=lengths)
        loose = (filled[which] < size) & gap
        for name, values in (("sequence_id", sequence), ("offset", offset), ("room", size - filled[which].astype(np.int64)), ("loose", loose)):
            if name in table.column_names:
                table = table.drop_columns([name])
            table = table.append_column(name, pa.array(values))
        yield from table.combine_chunks().to_batches()

    return run


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return read.mapInArrow(_cut(tokenizer, size, end_id), PIECES)


def _pool(loose: DataFrame, size: int) -> tuple[int, int]:
    """Rows of the pool, and its sequences beyond its own bound; from one row a length, so at most `size` of them."""
    count, used = np.zeros(size + 1, dtype=np.int64), 0
    firsts = F.count(F.when(F.col("offset") == 0, 1))
    for length, rows, first in loose.groupBy("length").agg(F.count("*"), firsts).collect():
        count[length], used = rows, used + first
    return int(count.sum()), used + (-bound_tokens(count, size) // size)


def pack(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = written(pieces(docs, tokenizer, size, end_id))
    parts = max(1, math.ceil(cut.count() / PARTITION_PIECES))
    dealt, done, gap, idle = cut.repartition(parts), None, None, 0
    for round in itertools.count():
        packed = written(dealt.mapInArrow(_pack(size, round, parts == 1), PACKED))
        loose = packed.filter("loose")
        rows, left = (0, 0) if parts == 1 else _pool(loose, size)
        idle = idle + 1 if gap is not None and 100 * (gap - left) < gap else 0
        gap, parts = left, math.ceil(rows / PARTITION_PIECES)
        ended = not rows or not left or idle == MOST_ROUNDS
        settled = packed if ended else packed.filter("not loose")
        done = settled if done is None else done.unionByName(settled)
        if ended:
            return done.drop("room", "loose")
        # by turns those with most room together, where it adds up to whole sequences, and each with new others
        if round % 2:
            dealt = loose.repartition(parts, F.xxhash64("sequence_id", F.lit(round)))
        else:
            dealt = loose.repartitionByRange(parts, "room", "sequence_id")
