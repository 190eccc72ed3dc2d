"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Odd multipliers of the rolling and mixing steps.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

# Bytes of one hashing step: bounds the arrays a task holds.
STEP_BYTES = 1 << 20

_POWERS: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value stirred (invertible)."""
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        ones = np.full(max(n, STEP_BYTES + 1), BASE)
        ones[0] = 1
        back = np.full(len(ones), BASE_INVERSE)
        back[0] = 1
        _POWERS[:] = [np.cumprod(ones), np.cumprod(back)]
    return _POWERS[0][:n], _POWERS[1][:n]


def classes(separators: Iterator[int], marks: Iterator[int] = ()) -> np.ndarray:
    """Class of each byte: 0 parts words, 1 belongs to a word, 2 to a run of marks."""
    out = np.ones(256, np.uint8)
    out[list(separators)] = 0
    out[list(marks)] = 2
    return out


BLANKS = (0x20, *range(0x09, 0x0E))
MARKS = tuple(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
# Alphanumeric words: every other ASCII byte parts them; bytes of longer characters belong to words.
ALNUM = classes(b for b in range(0x80) if not chr(b).isalnum())
# Words and runs of punctuation, parted by blanks.
WORDS_AND_MARKS = classes(BLANKS, MARKS)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
SAME = np.arange(256, dtype=np.uint8)


@dataclass
class Words:
    """Words of consecutive texts: hash of each, and where each text's words begin."""

    first_text: int
    hashes: np.ndarray
    bounds: np.ndarray

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the runs of ``k`` words and each text's bounds among them.

        A text of fewer words (one at least) has one shingle: all its words.
        """
        counts = np.diff(self.bounds)
        short = (counts > 0) & (counts < k)
        n = np.where(counts >= k, counts - k + 1, short)
        bounds = np.concatenate([[0], np.cumsum(n)])
        if not bounds[-1]:
            return np.empty(0, np.uint64), bounds
        if len(self.hashes) >= k:
            rolled = self.hashes[:len(self.hashes) - k + 1].copy()
            for j in range(1, k):
                rolled = rolled * BASE + self.hashes[j:len(self.hashes) - k + 1 + j]
        else:
            rolled = np.empty(0, np.uint64)
        out = np.empty(bounds[-1], np.uint64)
        long = np.where(counts >= k, n, 0)
        at = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
        out[np.repeat(bounds[:-1], long) + at] = rolled[np.repeat(self.bounds[:-1], long) + at]
        for i in np.flatnonzero(short):
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for w in self.hashes[self.bounds[i]:self.bounds[i + 1]]:
                    h = h * BASE + w
                out[bounds[i]] = h * BASE + np.uint64(counts[i])
        return mixed(out), bounds


def words(texts: list[bytes], kinds: np.ndarray = ALNUM, case: np.ndarray = LOWER) -> Iterator[Words]:
    """Word hashes of the texts, some texts at a time, in order."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= STEP_BYTES):
            size += len(texts[last])
            last += 1
        part = texts[first:last]
        data = case[np.frombuffer(b"".join(part), np.uint8)]
        begins = np.concatenate([[0], np.cumsum([len(t) for t in part])])
        yield _hashed(data, begins, kinds, first)
        first = last


def _hashed(data: np.ndarray, begins: np.ndarray, kinds: np.ndarray, first: int) -> Words:
    n = len(data)
    if not n:
        return Words(first, np.empty(0, np.uint64), np.zeros(len(begins), np.int64))
    kind = kinds[data]
    cut = np.empty(n + 1, bool)
    cut[0] = cut[n] = True
    cut[1:n] = kind[1:] != kind[:-1]
    cut[begins] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    real = kind[starts] != 0
    starts, ends = starts[real], ends[real]
    up, down = _powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return Words(first, hashes, np.searchsorted(starts, begins))
