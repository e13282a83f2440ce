"""Rows of numbers that are shuffled as one binary value per column and part, and counted there in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def dealt(columns: list[np.ndarray], by: np.ndarray, parts: int, steps: tuple[int, ...] = (), repeats: tuple[int, ...] = ()) -> pa.RecordBatch:
    """The columns (c0, c1, ...) cut into parts by a well mixed 64-bit key; those in `steps` as `stepped`, in `repeats` as `repeated`."""
    part = ((by >> np.uint64(20)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    there, first = np.unique(part[order], return_index=True)
    cuts = np.append(first, len(order))
    arrays = [pa.array(there, pa.int32())]
    for i, c in enumerate(columns):
        c, as_bytes = c[order], stepped if i in steps else repeated if i in repeats else np.ndarray.tobytes
        arrays.append(pa.array([as_bytes(c[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["part", *(f"c{i}" for i in range(len(columns)))])


def schema(columns: int) -> str:
    return "part int, " + ", ".join(f"c{i} binary" for i in range(columns))


def stepped(values: np.ndarray) -> bytes:
    """Steps from value to value, all their first bytes, then all second ones, and so on: slowly growing numbers are
    long runs of zeros then, which the shuffle's compression takes out."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return np.ascontiguousarray(steps).view(np.uint8).reshape(len(values), -1).T.tobytes()


def stepped_column(table: pa.Table, i: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = (np.frombuffer(b, dtype=np.uint8).reshape(size, -1) for b in table.column(f"c{i}").to_pylist())
    values = [np.cumsum(np.ascontiguousarray(p.T).view(dtype).ravel(), dtype=dtype) for p in planes]
    return np.concatenate(values) if values else np.zeros(0, dtype=dtype)


def repeated(values: np.ndarray) -> bytes:
    """The number of runs of equal values, their lengths (all first bytes, then all second ones, and so on) and values."""
    first = group_starts(values)
    lengths = np.diff(np.append(first, len(values))).astype("<u4")
    return len(first).to_bytes(8, "little") + lengths.view(np.uint8).reshape(-1, 4).T.tobytes() + values[first].tobytes()


def repeated_column(table: pa.Table, i: int, dtype) -> np.ndarray:
    values = []
    for b in table.column(f"c{i}").to_pylist():
        runs = int.from_bytes(b[:8], "little")
        lengths = np.frombuffer(b, np.uint8, 4 * runs, 8).reshape(4, runs)
        values.append(np.repeat(np.frombuffer(b, dtype, offset=8 + 4 * runs), np.ascontiguousarray(lengths.T).view("<u4").ravel()))
    return np.concatenate(values) if values else np.zeros(0, dtype=dtype)


def column(table: pa.Table, i: int, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(f"c{i}").to_pylist()), dtype=dtype)


def _packed(columns: tuple[np.ndarray, ...]) -> tuple[np.ndarray, list[tuple[np.uint64, np.uint64]]] | None:
    """The rows as 64-bit numbers of the same order, and each column's least value and bits; None where these do not fit."""
    low = [int(c.min()) for c in columns]
    bits = [(int(c.max()) - least).bit_length() for c, least in zip(columns, low, strict=True)]
    if sum(bits) > 64:
        return None
    ranges = [(np.uint64(least % 2**64), np.uint64(b)) for least, b in zip(low, bits, strict=True)]
    key = np.zeros(len(columns[0]), dtype=np.uint64)
    for c, (least, b) in zip(columns, ranges, strict=True):
        key = key << b | c.astype(np.uint64) - least
    return key, ranges


def order_of(*columns: np.ndarray) -> np.ndarray:
    """Places of the rows in order of the columns."""
    packed = _packed(columns) if len(columns[0]) else None
    return np.lexsort(columns[::-1]) if packed is None else np.argsort(packed[0])


def ordered(*columns: np.ndarray) -> list[np.ndarray]:
    """The rows in order of the columns, equal ones once."""
    packed = _packed(columns) if len(columns[0]) else None
    if packed is None:
        order = np.lexsort(columns[::-1])
        columns = tuple(c[order] for c in columns)
        once = group_starts(*columns)
        return [c[once] for c in columns]
    key, ranges = packed
    key.sort()
    key = key[group_starts(key)]
    out = []
    for c, (least, b) in zip(columns[::-1], ranges[::-1], strict=True):
        out.append(((key & ~(np.uint64(2**64 - 1) << b)) + least).astype(c.dtype))
        key = key >> b
    return out[::-1]


def group_starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """First rows of runs of equal keys."""
    if not len(sorted_keys[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.ones(len(sorted_keys[0]), dtype=bool)
    new[1:] = False
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
