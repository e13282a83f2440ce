"""64-bit hashes of words and of runs of words, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so its powers can be divided by
_INVERSE = pow(_BASE, -1, 2**64)
_CHUNK = 1 << 19  # bytes hashed at a time, to bound memory; a longer text is a chunk of its own


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), dtype=_U)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=_U)


_LOWER = np.arange(256, dtype=_U)
_LOWER[65:91] += _U(32)
_BYTE = mix(_LOWER + _U(1))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each run, independent of its place."""
    total = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values * powers(_BASE, len(values)), out=total[1:])
    shift = powers(_INVERSE, len(values) + 1)[starts]
    return mix((total[ends] - total[starts]) * shift + (ends - starts).astype(_U))


def chunks(texts: pa.Array) -> list[tuple[int, int]]:
    """Ranges of rows with about as many bytes as a chunk has."""
    out, first, size = [], 0, 0
    lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        if size and size + n > _CHUNK:
            out.append((first, i))
            first, size = i, 0
        size += int(n) + 1
    if first < len(texts):
        out.append((first, len(texts)))
    return out


def _cut(texts: list[bytes], between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined bytes, first and last places of all words, and the index of each text's first word (one more at the end)."""
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)
    space = between[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    bounds = np.cumsum([1] + [len(t) + 1 for t in texts])
    return data, edge[0::2], edge[1::2], np.searchsorted(edge[0::2], bounds)


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words between white space, A-Z lowered, and the index of each text's first word (one more at the end)."""
    data, starts, ends, first = _cut(texts, _SPACE)
    return run_hashes(_BYTE[data], starts, ends), first


def bare_words(texts: list[bytes], signs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words without ASCII punctuation, of their first `signs` characters, and each text's first word."""
    data, starts, ends, first = _cut(texts, _PLAIN)
    begins = np.flatnonzero((data & 0xC0) != 0x80)  # of UTF-8 characters
    at = np.searchsorted(begins, starts) + signs
    stems = np.minimum(ends, np.append(begins, len(data))[np.minimum(at, len(begins))])
    return run_hashes(_BYTE[data], starts, ends), run_hashes(_BYTE[data], starts, stems), first


def shingles(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words (of the whole text where it has fewer) and each text's first index."""
    hashes, first = words(texts)
    count = np.diff(first)
    whole = np.minimum(count, k)
    made = np.where(count == 0, 0, count - whole + 1)
    bounds = np.concatenate([[0], np.cumsum(made)])
    text = np.repeat(np.arange(len(texts)), made)
    starts = first[:-1][text] + np.arange(bounds[-1]) - bounds[:-1][text]
    return run_hashes(hashes, starts, starts + whole[text]), bounds
