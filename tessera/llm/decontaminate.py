"""Benchmark decontamination: short test items found inside long documents.

A document is contaminated by an item if it holds at least ``THRESHOLD`` of
the item's distinct word shingles (five words; A-Z lower-cased; words are runs
without ASCII blanks and punctuation). An item of fewer words is one shingle of
all of them and is held by every document with these words in a row; a text
without words has none and matches nothing.

Candidates come from a size-partitioned MinHash containment search after LSH
Ensemble (Zhu et al. 2016). MinHash estimates Jaccard similarity, which for an
item inside a text many times its size is near zero; so what is searched is
partitioned by size: for each power-of-two class of item sizes, documents are
cut into overlapping windows of twice the class's upper size, in which
containment of 0.8 means a similarity of 0.19 at least. Window signatures for
larger classes are minima of those for smaller ones. With ``HASHES`` bands of
one row, an item at that bound is missed with probability 0.81^64, about
1.4e-6. Candidates are then verified by exact containment on the shingles'
words over the whole document. Items of under five words have a class for each
number of words: the documents' runs of that length are looked up in it.

The documents are read once per block of items, without a shuffle. A block
holds at most ``BLOCK_SHINGLES`` shingles (one item at least), so what is
broadcast is bounded however many items there are.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import checkpointed, mapped, text_bytes
from .words import Words, mixed, words

K = 5
THRESHOLD = 0.8
HASHES = 64
BLOCK_SHINGLES = 500_000
SMALLEST_CLASS = 0

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
FACTORS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
SHIFTS = mixed(np.arange(HASHES + 1, 2 * HASHES + 1, dtype=np.uint64))
SIEVE_BITS = 16


def shingles(text: bytes) -> set[tuple[bytes, ...]]:
    """The text's distinct shingles as words."""
    found = WORD.findall(text.lower())
    if not found:
        return set()
    if len(found) < K:
        return {tuple(found)}
    return set(zip(*(found[i:] for i in range(K))))


def held_run(text: bytes, wanted: set[tuple[bytes, ...]]) -> int:
    """1 if the wanted shingle has under five words and the text has them in a row."""
    (run, *others) = wanted
    if others or len(run) >= K:
        return 0
    found = WORD.findall(text.lower())
    return int(any(tuple(found[i:i + len(run)]) == run for i in range(len(found) - len(run) + 1)))


def size_class(n: int) -> int:
    """c with 2^c <= n < 2^(c + 1), at least the smallest class."""
    return max(SMALLEST_CLASS, n.bit_length() - 1)


@dataclass
class Index:
    """One block of items: their shingles, and by class and hash function their minima."""

    items: list[tuple[object, set]] = field(default_factory=list)
    minima: dict[int, list] = field(default_factory=dict)
    runs: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # hashes and numbers of items by words

    @classmethod
    def of(cls, items: list[tuple[object, bytes]]) -> Index:
        out = cls()
        by_class, by_words = defaultdict(list), defaultdict(list)
        for item_id, text in items:
            own = shingles(text)
            if own:
                (part,) = words([text])
                hashes, _ = part.shingles(K)
                n_words = len(next(iter(own)))
                if n_words < K:
                    by_words[n_words].append((int(part.shingles(n_words)[0][0]), len(out.items)))
                    out.items.append((item_id, own))
                    continue
                lows = [(hashes * a + b).min() for a, b in zip(FACTORS, SHIFTS)]
                by_class[size_class(len(own))].append((len(out.items), np.array(lows, np.uint64)))
                out.items.append((item_id, own))
        for c, rows in by_class.items():
            numbers = np.array([n for n, _ in rows])
            lows = np.stack([x for _, x in rows])
            out.minima[c] = []
            for j in range(HASHES):
                order = np.argsort(lows[:, j], kind="stable")
                sieve = np.zeros(1 << SIEVE_BITS, bool)
                sieve[lows[:, j] & np.uint64((1 << SIEVE_BITS) - 1)] = True
                out.minima[c].append((lows[order, j], numbers[order], sieve))
        for n, rows in by_words.items():
            rows.sort()
            out.runs[n] = np.array([h for h, _ in rows], np.uint64), np.array([i for _, i in rows])
        return out

    def short_candidates(self, part: Words) -> Iterator[tuple[int, int]]:
        """(text, item) for items of few words of which a text may hold the run."""
        for n, (values, numbers) in self.runs.items():
            hashes, bounds = part.shingles(n)
            left, right = np.searchsorted(values, hashes, "left"), np.searchsorted(values, hashes, "right")
            for at in np.flatnonzero(right > left).tolist():
                text = int(np.searchsorted(bounds, at, "right")) - 1
                yield from ((text, int(i)) for i in numbers[left[at]:right[at]])

    def candidates(self, part: Words) -> set[tuple[int, int]]:
        """(text, item) pairs with an equal minimum in some window."""
        hashes, bounds = part.shingles(K)
        out: set[tuple[int, int]] = set()
        if not len(hashes) or not self.minima:
            return out
        counts = np.diff(bounds)
        low = min(self.minima)
        levels = {}
        width = 2 << low
        blocks = -(-counts // width)
        level = low
        while True:  # where each class's blocks begin, and the text each belongs to
            begins = np.concatenate([[0], np.cumsum(blocks)])
            levels[level] = (begins, np.repeat(np.arange(len(counts)), blocks))
            if level >= max(self.minima):
                break
            blocks = -(-blocks // 2)
            level += 1
        begins, owner = levels[low]
        edges = bounds[owner] + (np.arange(begins[-1]) - begins[owner]) * width
        for j in range(HASHES):
            lows = np.minimum.reduceat(hashes * FACTORS[j] + SHIFTS[j], edges)
            for level in range(low, max(self.minima) + 1):
                begins, owner = levels[level]
                if level > low:
                    before = levels[level - 1][0]
                    within = np.arange(begins[-1]) - begins[owner]
                    first = before[owner] + 2 * within
                    second = np.minimum(first + 1, before[owner + 1] - 1)
                    lows = np.minimum(lows[first], lows[second])
                if level in self.minima:
                    after = np.minimum(np.arange(len(lows)) + 1, begins[owner + 1] - 1)
                    self._matched(level, j, np.minimum(lows, lows[after]), owner, out)
        return out

    def _matched(self, level: int, j: int, windows: np.ndarray, owner: np.ndarray, out: set) -> None:
        values, numbers, sieve = self.minima[level][j]
        maybe = np.flatnonzero(sieve[windows & np.uint64((1 << SIEVE_BITS) - 1)])
        if not len(maybe):
            return
        left = np.searchsorted(values, windows[maybe], "left")
        right = np.searchsorted(values, windows[maybe], "right")
        for w in np.flatnonzero(right > left):
            for n in numbers[left[w]:right[w]].tolist():
                out.add((int(owner[maybe[w]]), n))

    def hits(self, texts: list[bytes]) -> Iterator[tuple[int, object, int, int]]:
        """(text, item_id, shared shingles, item's shingles) of every verified pair, texts in order."""
        for part in words(texts):
            by_text = defaultdict(list)
            for t, n in self.candidates(part) | set(self.short_candidates(part)):
                by_text[t].append(n)
            for t in sorted(by_text):
                text = texts[part.first_text + t]
                own = shingles(text)
                for n in sorted(by_text[t]):
                    item_id, wanted = self.items[n]
                    shared = len(wanted & own) or held_run(text, wanted)
                    if shared >= THRESHOLD * len(wanted):
                        yield part.first_text + t, item_id, shared, len(wanted)


def blocks(benchmark: DataFrame) -> Iterator[Index]:
    """The items in blocks of bounded size, read a partition at a time."""
    held, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = (row.text or "").encode()
        n = len(text) // 2 + 1  # no text has more words
        if held and size + n > BLOCK_SHINGLES:
            yield Index.of(held)
            held, size = [], 0
        held.append((row.item_id, text))
        size += n
    if held:
        yield Index.of(held)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) for every contaminated pair of rows.

    Repeated rows of either table give repeated pairs; null and empty texts and
    those without words match nothing; empty tables give no pairs. Texts are
    searched as a whole, whatever their length; other columns don't matter.
    """
    schema = StructType([docs.schema["doc_id"], StructField("item_id", benchmark.schema["item_id"].dataType),
                         StructField("n_shared", LongType()), StructField("n_item", LongType()),
                         StructField("containment", DoubleType())])
    slim, spark = docs.select("doc_id", "text"), docs.sparkSession
    parts, before = [], None
    for index in blocks(benchmark):
        if before is not None:  # several blocks: the earlier one is done before the next is broadcast
            parts[-1] = checkpointed(parts[-1])
            before.unpersist()
        before = spark.sparkContext.broadcast(index)
        parts.append(mapped(slim, _pairs(before, schema), schema))
    out = parts[0] if parts else spark.createDataFrame([], schema)
    for more in parts[1:]:
        out = out.unionAll(more)
    return out


def _pairs(shared, schema: StructType):
    names = schema.names

    def found(batches):
        for batch in batches:
            hits = list(shared.value.hits(list(text_bytes(batch))))
            rows = pa.array([h[0] for h in hits], pa.int64())
            item = pa.array([h[1] for h in hits])
            columns = [batch.column("doc_id").take(rows), item if len(hits) else pa.array([], pa.int64()),
                       pa.array([h[2] for h in hits], pa.int64()), pa.array([h[3] for h in hits], pa.int64()),
                       pa.array([h[2] / h[3] for h in hits], pa.float64())]
            if hits:
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return found


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns kept."""
    out, spark = docs, docs.sparkSession
    for index in blocks(benchmark):
        if out is not docs:
            out = checkpointed(out)
        out = mapped(out, _clean(spark.sparkContext.broadcast(index)), docs.schema)
    return out


def _clean(shared):
    def kept(batches):
        for batch in batches:
            mask = np.ones(batch.num_rows, bool)
            mask[[h[0] for h in shared.value.hits(list(text_bytes(batch)))]] = False
            yield batch.filter(pa.array(mask))

    return kept


ORACLE = r"""
WITH words AS (
  SELECT 'doc' AS kind, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL
  SELECT 'item', row_number() OVER (), item_id, text FROM benchmark),
parted AS (
  SELECT kind, r, id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM words WHERE text IS NOT NULL),
shingled AS (
  SELECT kind, r, id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    ELSE [] END) AS s
  FROM parted),
brief AS (SELECT r, id, ' ' || array_to_string(ws, ' ') || ' ' AS run FROM parted
          WHERE kind = 'item' AND len(ws) BETWEEN 1 AND 4),
items AS (SELECT r, id, s, count(*) OVER (PARTITION BY r) AS n_item
          FROM (SELECT DISTINCT r, id, s FROM shingled WHERE kind = 'item')),
held AS (SELECT DISTINCT r, id, s FROM shingled WHERE kind = 'doc' AND s IN (SELECT s FROM items))
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, i.n_item, count(*) / i.n_item AS containment
FROM held d JOIN items i USING (s)
GROUP BY d.r, d.id, i.r, i.id, i.n_item HAVING count(*) >= 0.8 * i.n_item
UNION ALL
SELECT d.id, b.id, 1, 1, 1.0
FROM parted d JOIN brief b ON d.kind = 'doc' AND contains(' ' || array_to_string(d.ws, ' ') || ' ', b.run)
"""
