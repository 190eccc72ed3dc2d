"""Token ids of texts by way of their distinct units, over the bytes of Arrow batches.

A unit is a stretch of a text between two sure cuts. The pattern of the byte-level
tokenizers used here matches runs of letters, of digits or of other characters,
each with one space before it at most, runs of blanks, and an apostrophe with
some letters after it. So a match surely begins

- at a blank after a character that is none,
- after a letter, at a character that is none; after a digit likewise,
- after another character (an apostrophe aside), at a letter or digit,

and what the tokenizer does from there on depends on the text from there on
only. The ids of the units, one after the other, are the text's ids. Cuts are
taken only beside ASCII characters and blanks, and never within the spelling of
a special token that the tokenizer looks for.

Distinct units of a batch are found by Arrow's dictionary encoding, those met
before are looked up by hash and compared, and the others go to the library, many
joined to one text. Kept units lie in flat arrays of bytes, hashes and ids, some
fifty bytes each. When the table is full, the units that the latest batches did
not need make room.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import mixed

# Units kept per worker, and the longest that is kept (bytes): bounds the memory of the table.
KEPT_UNITS = 600_000
LONGEST_KEPT = 48
# New units encoded as one text (each begins with a blank, so each begins a unit there too).
JOINED = 256
# Texts given to the library at once.
AT_ONCE = 128
# Occurrences of units looked up at once; units of more bytes are encoded in chunks.
STEP_UNITS = 1 << 17
LONG_UNIT = 1 << 16

BLANK, LETTER, DIGIT, OTHER, WIDE = 1, 2, 3, 4, 5
ASCII_BLANKS = b"\t\n\x0b\x0c\r "


def _classes() -> np.ndarray:
    """Class of each byte; the separators U+001C to U+001F, which engines see differently, have none."""
    out = np.zeros(256, np.uint8)
    for b in range(128):
        c = chr(b)
        if b not in range(0x1C, 0x20):
            out[b] = BLANK if b in ASCII_BLANKS else LETTER if c.isalpha() else DIGIT if c.isdigit() else OTHER
    out[128:] = WIDE
    return out


CLASSES = _classes()


def cut_table(fine: bool = True, blanks: bytes = ASCII_BLANKS) -> np.ndarray:
    """For each pair of bytes: 1 if a unit begins at the second, 2 if the character before has to be looked at.

    Without ``fine`` units begin at the given blanks only.
    """
    before, after = CLASSES[:, None], CLASSES[None, :]
    blank = np.isin(np.arange(256), list(blanks))[None, :]
    out = (blank & np.isin(before, (LETTER, DIGIT, OTHER))).astype(np.uint8)
    if fine:
        out |= (before == LETTER) & np.isin(after, (DIGIT, OTHER))
        out |= (before == DIGIT) & np.isin(after, (LETTER, OTHER))
        out |= (before == OTHER) & (after == DIGIT)
        out |= (before == OTHER) & (after == LETTER) & (np.arange(256)[:, None] != ord("'"))
    out[(before == WIDE) & blank] = 2
    return out.reshape(-1)


# Last bytes of the blanks beyond ASCII, by their first two or one.
WIDE_BLANKS = np.array(sorted(int.from_bytes(chr(c).encode().rjust(3, b"\0"), "big") for c in
                              [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a batch's texts, one after the other, and where each begins (and the last ends); null is empty."""
    column = pc.fill_null(column, pa.scalar(b"").cast(column.type)) if column.null_count else column
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64)
    size = int(bounds[-1] - bounds[0])
    held = np.frombuffer(data, np.uint8, size, int(bounds[0])) if size else np.empty(0, np.uint8)
    return held, bounds - bounds[0]


def buffers(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    return text_buffers(pa.array(texts, pa.string()))


def _after_wide_blank(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether a blank beyond ASCII ends at each place."""
    two = data[places - 1].astype(np.int64) | data[np.maximum(places - 2, 0)].astype(np.int64) << 8
    three = two | data[np.maximum(places - 3, 0)].astype(np.int64) << 16
    return np.isin(three, WIDE_BLANKS) | ((two >> 8 == 0xC2) & np.isin(two, WIDE_BLANKS))


def starts(data: np.ndarray, bounds: np.ndarray, table: np.ndarray, special: re.Pattern | None = None) -> np.ndarray:
    """Where units begin; the first byte of each text that isn't empty does."""
    n = len(data)
    mark = np.zeros(n + 1, bool)
    if n > 1:
        found = table[(data[:-1].astype(np.uint16) << np.uint16(8)) | data[1:]]
        mark[1:n] = found == 1
        look = np.flatnonzero(found == 2) + 1
        mark[look[~_after_wide_blank(data, look)]] = True
    if special is not None:
        for m in special.finditer(data):
            mark[m.start() + 1:m.end()] = False
    mark[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(mark[:n])


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first[i], first[i] + 1, ... (count[i] of them) of each i, one after the other."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(first - (ends - count), count) + np.arange(total)


WORD_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def _words(data: np.ndarray, begin: np.ndarray, size: np.ndarray, at: int) -> np.ndarray:
    """The bytes ``at`` to ``at`` + 7 of each stretch as one number; what lies beyond its end is zero.

    ``data`` has eight bytes more than the stretches.
    """
    every = np.ndarray(max(len(data) - 7, 0), "<u8", np.ascontiguousarray(data), strides=(1,))
    return every[begin + np.minimum(at, size)] & WORD_MASKS[np.clip(size - at, 0, 8)]


def _padded(data: np.ndarray) -> np.ndarray:
    return np.concatenate([data, np.zeros(8, np.uint8)])


def binary_array(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1,
                                 [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


class UnitTable:
    """Distinct units met before, in flat arrays: where each one's bytes lie, its hash, and when it was last met.

    Units are found by a 64-bit hash and then compared byte by byte; of two with
    one hash only the first is kept. Entries are numbered; ``keep`` tells the
    caller which of its own rows stay. Up to ``KEPT_UNITS / share`` are kept.
    """

    def __init__(self, share: int = 1):
        self.share = share
        self.hashes = np.empty(0, np.uint64)  # in order
        self.entries = np.empty(0, np.int64)  # the entry of each hash
        self.begins, self.data = np.zeros(1, np.int64), _padded(np.empty(0, np.uint8))
        self.used = np.empty(0, np.int64)
        self.step = 0

    def __len__(self) -> int:
        return len(self.used)

    def find(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each of some distinct units (-1: none), and their hashes. ``data`` is padded."""
        begin, size = bounds[:-1], np.diff(bounds)
        small = np.flatnonzero(size <= LONGEST_KEPT)
        hashes = np.zeros(len(size), np.uint64)
        hashes[small] = size[small].astype(np.uint64)
        for at in range(0, LONGEST_KEPT, 8):
            own = small[size[small] > at]
            hashes[own] = mixed(hashes[own] * np.uint64(0x9E3779B97F4A7C15) + _words(data, begin[own], size[own], at))
        place = np.full(len(size), -1, np.int64)
        if len(self):
            small = small[np.argsort(hashes[small])]
            at = np.minimum(np.searchsorted(self.hashes, hashes[small]), len(self) - 1)
            hit = self.hashes[at] == hashes[small]
            place[small[hit]] = self.entries[at[hit]]
            rows = np.flatnonzero(place >= 0)
            kept = self.begins[place[rows]]
            same = self.begins[place[rows] + 1] - kept == size[rows]
            for w in range(0, LONGEST_KEPT, 8):
                own = np.flatnonzero(same & (size[rows] > w))
                same[own] = (_words(data, begin[rows[own]], size[rows[own]], w)
                             == _words(self.data, kept[own], size[rows[own]], w))
            place[rows[~same]] = -1
        self.step += 1
        self.used[place[place >= 0]] = self.step
        return place, hashes

    def add(self, data: np.ndarray, bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Adds units that ``find`` did not find; the numbers of those that became entries, in their order."""
        size = np.diff(bounds)
        new = np.flatnonzero(size <= LONGEST_KEPT)
        new = new[np.sort(np.unique(hashes[new], return_index=True)[1])]
        if len(self):
            at = np.minimum(np.searchsorted(self.hashes, hashes[new]), len(self) - 1)
            new = new[self.hashes[at] != hashes[new]]
        self.data = _padded(np.concatenate([self.data[:self.begins[-1]], data[spread(bounds[:-1][new], size[new])]]))
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(size[new])])
        joined = np.concatenate([self.hashes, hashes[new]])
        order = np.argsort(joined, kind="stable")
        self.hashes = joined[order]
        self.entries = np.concatenate([self.entries, len(self) + np.arange(len(new))])[order]
        self.used = np.concatenate([self.used, np.full(len(new), self.step)])
        return new

    def keep(self) -> np.ndarray | None:
        """If the table is over full, its half used last stays: their former numbers, in the order of the new ones."""
        limit = KEPT_UNITS // self.share
        if len(self) <= limit:
            return None
        stay = np.sort(np.argsort(-self.used, kind="stable")[:limit // 2])
        number = np.full(len(self), -1, np.int64)
        number[stay] = np.arange(len(stay))
        entries = number[self.entries]
        self.hashes, self.entries = self.hashes[entries >= 0], entries[entries >= 0]
        size = np.diff(self.begins)[stay]
        self.data = _padded(self.data[spread(self.begins[stay], size)])
        self.begins = np.concatenate([[0], np.cumsum(size)])
        self.used = self.used[stay]
        return stay


def steps(data: np.ndarray, at: np.ndarray):
    """(bytes, bounds in them) of the units that begin at ``at``, some at a time."""
    for s in range(0, len(at), STEP_UNITS):
        own = at[s:s + STEP_UNITS + 1]
        if s + STEP_UNITS >= len(at):
            own = np.append(at[s:], len(data))
        yield data[own[0]:own[-1]], own - own[0]


def distinct_units(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ones of some units: their bytes (padded), bounds, and which of them each unit is."""
    coded = binary_array(data, bounds).dictionary_encode()
    own, own_bounds = text_buffers(coded.dictionary)
    return _padded(own), own_bounds, coded.indices.to_numpy()


def encoded_units(encode_batch: Callable[[list[str]], Iterable[list[int]]], lengths: np.ndarray, data: np.ndarray,
                  bounds: np.ndarray, first: str = "") -> tuple[np.ndarray, np.ndarray]:
    """The ids of units, one after the other, and how many each has.

    Units that begin with a blank and end with none are joined to texts of
    ``JOINED`` units each, whose ids are cut where the units end; the others are
    encoded one by one. ``lengths`` has the bytes of each id's token. ``first``
    is put before each text; its ids are left out.
    """
    size = np.diff(bounds)
    n_first = len(first.encode())
    inner = (np.isin(data[bounds[:-1]], list(ASCII_BLANKS)) & ~np.isin(CLASSES[data[bounds[1:] - 1]], (0, BLANK))
             & ~_after_wide_blank(data, bounds[1:]))
    order = np.concatenate([np.flatnonzero(inner), np.flatnonzero(~inner)])
    n_inner = int(inner.sum())
    moved = data[spread(bounds[order], size[order])]
    ends = np.cumsum(size[order])
    edges = np.concatenate([np.arange(0, n_inner, JOINED), np.arange(n_inner, len(order) + 1)])
    at = np.concatenate([[0], ends])[edges]
    raw = moved.tobytes()
    batch = [first + raw[a:b].decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    found = [np.array(x, np.int32) for i in range(0, len(batch), AT_ONCE) for x in encode_batch(batch[i:i + AT_ONCE])]
    if first:
        skip = [int(np.searchsorted(np.cumsum(lengths[x]), n_first)) + 1 for x in found]
        if any(int(lengths[x[:k]].sum()) != n_first for x, k in zip(found, skip)):
            raise ValueError("the tokenizer joined units")
        found = [x[k:] for x, k in zip(found, skip)]
    ids = np.concatenate([np.empty(0, np.int32), *found])
    token_ends = np.cumsum(lengths[ids])
    cuts = np.searchsorted(token_ends, ends) + 1
    if len(ends) and (cuts[-1] != len(ids) or not np.array_equal(token_ends[cuts - 1], ends)):
        raise ValueError("the tokenizer joined units")
    count = np.empty(len(order), np.int64)
    own = np.diff(cuts, prepend=0)
    count[order] = own
    begin = np.empty(len(order), np.int64)
    begin[order] = cuts - own
    return ids[spread(begin, count)], count


class UnitIds:
    """Ids of texts; distinct units are encoded once and kept for the worker's next batches.

    ``encode_batch`` gives the ids of each of some texts, ``lengths`` the bytes
    of each id's token, ``special`` the spellings that the tokenizer looks for
    before anything else, ``encode_long`` the ids of a text of any length.
    """

    def __init__(self, encode_batch: Callable[[list[str]], Iterable[list[int]]], lengths: np.ndarray,
                 special: Sequence[str] = (), encode_long: Callable[[str], np.ndarray] | None = None):
        self.encode_batch, self.encode_long = encode_batch, encode_long
        self.lengths = lengths
        self.cuts = cut_table()
        self.special = re.compile(b"|".join(re.escape(s.encode()) for s in special)) if special else None
        self.kept = UnitTable()
        self.begins, self.flat = np.zeros(1, np.int64), np.empty(0, np.int32)  # the kept units' ids

    def encoded(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts in ``data``, one after the other, and where each text's begin (and the last's end)."""
        at = starts(data, bounds, self.cuts, self.special)
        found = [self._step(part, own) for part, own in steps(data, at)]
        before = np.concatenate([[0], np.cumsum(np.concatenate([np.empty(0, np.int64), *(n for _, n in found)]))])
        return np.concatenate([np.empty(0, np.int32), *(ids for ids, _ in found)]), before[np.searchsorted(at, bounds)]

    def ids(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text."""
        flat, bounds = self.encoded(*buffers(texts))
        return [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def _step(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units between ``bounds``, one after the other, and how many each has."""
        data, bounds, occurring = distinct_units(data, bounds)
        place, hashes = self.kept.find(data, bounds)
        fresh = np.flatnonzero(place < 0)
        size = np.diff(bounds)[fresh]
        new_data, new_bounds = _padded(data[spread(bounds[fresh], size)]), np.concatenate([[0], np.cumsum(size)])
        new_ids, new_counts = self._new(new_data, new_bounds)
        n_kept = len(self.kept)
        place[fresh] = n_kept + np.arange(len(fresh))
        new_begins = self.begins[-1] + np.cumsum(new_counts)
        begins, flat = np.concatenate([self.begins, new_begins]), np.concatenate([self.flat, new_ids])
        count = np.diff(begins)[place]
        out = flat[spread(begins[place][occurring], count[occurring])]
        added = self.kept.add(new_data, new_bounds, hashes[fresh])
        stay = np.concatenate([np.arange(n_kept), n_kept + added]) if len(added) < len(fresh) else None
        half = self.kept.keep()
        if half is not None:
            stay = half if stay is None else stay[half]
        if stay is not None:
            n = np.diff(begins)[stay]
            begins, flat = np.concatenate([[0], np.cumsum(n)]), flat[spread(begins[stay], n)]
        self.begins, self.flat = begins, flat
        return out, count[occurring]

    def _new(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units, one after the other, and how many each has; long ones by ``encode_long``."""
        long = np.flatnonzero(np.diff(bounds) > LONG_UNIT) if self.encode_long else []
        if not len(long):
            return encoded_units(self.encode_batch, self.lengths, data, bounds)
        ids, counts, edges = [], [], [-1, *long.tolist(), len(bounds) - 1]
        for a, b in zip(edges[:-1], edges[1:]):
            if a >= 0:
                ids.append(np.asarray(self.encode_long(data[bounds[a]:bounds[a + 1]].tobytes().decode()), np.int32))
                counts.append([len(ids[-1])])
            if a + 1 < b:
                own = bounds[a + 1:b + 1]
                part = encoded_units(self.encode_batch, self.lengths, data[own[0]:own[-1]], own - own[0])
                ids.append(part[0])
                counts.append(part[1])
        return np.concatenate(ids), np.concatenate(counts).astype(np.int64)
