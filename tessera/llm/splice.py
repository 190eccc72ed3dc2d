"""Token ids of texts of any length, from overlapping chunks spliced at proven stable boundaries.

Two neighbouring chunks, the left one right up to its end at least, are spliced
at a place in their overlap where one of two proofs holds:

- *Match border.* Whatever comes before, a match of the tokenizer's pattern
  begins at the place: a blank after another character, a character that is no
  letter after a letter, none that is a digit after a digit, a letter or digit
  after another character (but an apostrophe). Both encodings have a boundary
  there, and what follows it does not depend on what comes before.
- *Shared token.* Both encodings have one and the same token there, and it and
  the two characters after it are of one kind (letters, digits, blanks,
  others), so that it ends inside a match. A sequence of tokens is the encoding
  of its bytes if and only if each pair of neighbours is that of theirs
  (Berglund and van der Merwe 2023, for merges whose parts come before them).
  The pairs up to the shared token are the left encoding's, those from it on
  the right one's, so the spliced sequence has right pairs only.

Tokens before the place come from the left chunk, the others from the right
one. A right chunk begins at a boundary of the left one, so even one character
repeated without end falls into step at once. If an overlap has no such place,
it is widened (doubled) up to the last splice; the chunk is then encoded from
there. Special tokens that the library looks for cut the text beforehand.

The kind of a character is what the tokenizer's own pattern takes it for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

LONG_CHARS = 65_536
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256

LETTER, DIGIT, OTHER, BLANK = 1, 2, 3, 4


class Splicer:
    """Ids of long texts by a byte-level tokenizer of the tokenizers library.

    ``special`` maps the spellings that it looks for in texts to their ids.
    """

    def __init__(self, model, special: dict[str, int] | None = None, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        self.model, self.chunk, self.overlap = model, chunk, overlap
        self.special = special or {}
        self.pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.kinds: dict[str, int] = {}

    def ids(self, text: str) -> Iterator[np.ndarray]:
        """The ids of ``text``, some at a time."""
        for part in self.pattern.split(text) if self.pattern else [text]:
            if part in self.special:
                yield np.array([self.special[part]], np.int32)
            elif part:
                yield from self._plain(part)

    def _plain(self, text: str) -> Iterator[np.ndarray]:
        n, done = len(text), 0  # tokens before ``done``, the last splice, are given out
        end = min(self.chunk, n)
        left = self._tokens(text, 0, end)
        while end < n:
            further = min(end + self.chunk, n)
            overlap = self.overlap
            while True:
                at = np.searchsorted(left[:, 1], end - overlap, "right") - 1
                start = max(done, int(left[at, 1])) if at >= 0 else done
                if start == done:  # widened to the last splice: one chunk from there
                    left = self._tokens(text, start, further)
                    break
                right = self._tokens(text, start, further)
                cut = self._splice(text, end, left, right)
                if cut is not None:
                    i, j, done = cut
                    yield left[:i, 2].astype(np.int32)
                    left = right[j:]
                    break
                overlap *= 2
            end = further
        yield left[:, 2].astype(np.int32)

    def _tokens(self, text: str, start: int, end: int) -> np.ndarray:
        """Rows (start, end, id) of the tokens of one chunk, places in the text; a split character's tokens have all of it."""
        found = self.model.encode(text[start:end], add_special_tokens=False)
        places = np.array(found.offsets, np.int64).reshape(-1, 2) + start
        return np.column_stack([places, np.array(found.ids, np.int64)])

    def _splice(self, text: str, end: int, left: np.ndarray, right: np.ndarray) -> tuple[int, int, int] | None:
        """(left tokens before, right tokens before, place) of the first stable place in the overlap."""
        places = np.intersect1d(left[:, 1], right[1:, 0])
        places = places[places < end]
        before_left = np.searchsorted(left[:, 1], places, "right")
        before_right = np.searchsorted(right[:, 0], places, "left")
        for i, j, place in zip(before_left.tolist(), before_right.tolist(), places.tolist()):
            if self._border(text, place) or (
                    (left[i - 1, 1:] == right[j - 1, 1:]).all() and place + 2 <= end
                    and len(set(map(self.kind, text[left[i - 1, 0]:place + 2]))) == 1):
                return i, j, place
        return None

    def _border(self, text: str, place: int) -> bool:
        """Whether a match surely begins at the place."""
        a, b = self.kind(text[place - 1]), self.kind(text[place])
        return (a != b and a != BLANK and (a != OTHER or text[place - 1] != "'" or b == BLANK))

    def kind(self, character: str) -> int:
        found = self.kinds.get(character)
        if found is None:
            split = self.model.pre_tokenizer.pre_tokenize_str
            found = next((kind for kind, one in ((LETTER, "a"), (DIGIT, "1"), (OTHER, "!"))
                          if len(split(one + character)) == 1), BLANK)
            self.kinds[character] = found
        return found
