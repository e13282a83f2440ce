"""Token ids of whole batches of texts under a byte-level BPE vocabulary of the tokenizers library.

Such a tokenizer first cuts a text into pieces (contractions, runs of letters, numbers or other signs with one
leading space, white space) and encodes each piece by itself. Pieces repeat a lot, so the cuts are found for a
batch at once and only pieces not met before go through the tokenizer; the ids are the same, which the tests
check against the tokenizer itself.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from .hashing import mix, run_hashes

LETTER, NUMBER, OTHER, WHITE = range(4)
MOST_PIECES = 1_000_000  # remembered by a worker; then it starts anew
_LEARNED = 4096  # pieces encoded at a time: the tokenizer's own records of a piece take about a kilobyte
_WHITE = "\t\n\x0b\f\r \x85\xa0                　"


@lru_cache(1)
def _kinds() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))[0]
        if category in "LN":
            kinds[c] = LETTER if category == "L" else NUMBER
    kinds[[ord(c) for c in _WHITE]] = WHITE
    return kinds


def _after(signs: np.ndarray, at: np.ndarray, endings: tuple[str, ...], text: np.ndarray) -> np.ndarray:
    """Where one of the endings follows the places `at` in the same text."""
    found = np.zeros(len(at), dtype=bool)
    for ending in endings:
        last = at + len(ending)
        inside = last < len(signs)
        good = at[inside]
        match = text[good] == text[good + len(ending)]
        for k, c in enumerate(ending, 1):
            match &= signs[good + k] == ord(c)
        found[np.flatnonzero(inside)[match]] = True
    return found


def piece_starts(signs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """First places of the pieces of texts that follow each other in `signs` (code points)."""
    kinds = _kinds()[signs]
    firsts = (np.cumsum(lengths) - lengths)[lengths > 0]
    begins = np.zeros(len(signs), dtype=bool)
    begins[firsts] = True
    start = begins.copy()
    start[1:] |= kinds[1:] != kinds[:-1]
    # White space before another sign: its last character stands alone, or with what follows if it is a space.
    before = np.flatnonzero((kinds[:-1] == WHITE) & (kinds[1:] != WHITE) & ~begins[1:])
    start[before] = True
    start[before[signs[before] == 32] + 1] = False
    quote = np.flatnonzero(start & (signs == 39))
    if len(quote):
        text = np.cumsum(begins)
        for endings in (("s", "t", "m", "d"), ("re", "ve", "ll")):
            at = quote[_after(signs, quote, endings, text)]
            start[at + 1] = False
            follow = at + 1 + len(endings[0])
            start[follow[follow < len(signs)]] = True
    return np.flatnonzero(start)


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.forget()

    def forget(self) -> None:
        # Arrays, ordered by key: a dictionary of a million pieces would take ten times their memory.
        self.keys, self.slots = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.begin, self.used = np.zeros(1, dtype=np.int64), 0

    def _learn(self, pieces: list[str], keys: np.ndarray) -> None:
        """Takes in pieces not met before, in order of their keys."""
        counts = []
        for a in range(0, len(pieces), _LEARNED):
            made = [e.ids for e in self.tokenizer.encode_batch_fast(pieces[a : a + _LEARNED], add_special_tokens=False)]
            flat = np.array([i for ids in made for i in ids], dtype=np.uint32)
            if self.used + len(flat) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(flat)), dtype=np.uint32)])
            self.flat[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
            counts += [len(ids) for ids in made]
        slots = np.arange(len(self.begin) - 1, len(self.begin) - 1 + len(keys), dtype=np.int32)
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(counts)])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, slots)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        joined = "".join(texts)
        if not joined:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        signs = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        starts = piece_starts(signs, lengths)
        ends = np.append(starts[1:], len(signs))
        keys = run_hashes(mix(signs.astype(np.uint64) + np.uint64(1)), starts, ends)
        distinct, sample, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > MOST_PIECES:
            self.forget()
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if not known.all():
            first = sample[~known]
            self._learn([joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], distinct[~known])
        slot = self.slots[np.searchsorted(self.keys, distinct)][which]
        first, count = self.begin[slot], self.begin[slot + 1] - self.begin[slot]
        place = np.cumsum(count)
        ids = self.flat[np.repeat(first - place + count, count) + np.arange(place[-1])]
        text = np.searchsorted(np.cumsum(lengths), starts, side="right")
        return ids, np.bincount(text, weights=count, minlength=len(texts)).astype(np.int64)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
