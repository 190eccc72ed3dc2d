"""SimHash near-dedup with pigeonring filtering.

A text's fingerprint has 64 bits: bit i is set if it is set in over half of
the XXH64 values of the text's word shingles. Fingerprints that differ in few
bits are linked; a document's group is what its fingerprint reaches.

Links are found on distinct fingerprints (a group of equal ones is one row) by
the pigeonring principle (Qin & Xiao 2018): cut the fingerprint into a ring of
``max_bits + 1`` segments; if two differ in at most ``max_bits`` bits, then
from some segment on every chain of l consecutive segments differs in at most
``floor(l * max_bits / segments)`` bits. So the first segment of that chain is
equal and the next differs in one bit at most, hence in one of its halves not
at all: a table for each (start segment, half) joins fingerprints on these
bits. Within a bucket, pairs must keep each longer chain's budget before the
full distance is taken.

Buckets over ``SPLIT_OVER`` fingerprints are split exactly: the bits not in
their key are cut into parts of four at most, and of any two fingerprints
within ``max_bits`` all but ``max_bits`` of these parts agree, so each choice
of the agreeing parts makes a sub-bucket. Only the bits of the chosen parts
are then free: a sub-bucket has at most 2^(4 * max_bits) fingerprints (4,096
for three bits) however many documents there are. A bucket emits the edges of
a spanning forest, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import boxed, checkpointed, mapped, row_key, text_bytes, unboxed
from .components import components, forest
from .words import mixed

SEED = 42
BITS = 64
SPLIT_OVER = 4096
SHINGLE_STEP = 1 << 16


def fingerprint(text: bytes, k: int = 3) -> int:
    """SimHash of the text's ``k``-word shingles (A-Z lower-cased, words parted by blanks).

    Fewer words: the whole sequence is one shingle; no words: zero.
    """
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(k, len(found))
    n = len(found) - k + 1
    starts, ends = starts[:n].tolist(), ends[k - 1:].tolist()
    votes = np.zeros(BITS, np.int64)
    hashed = xxhash.xxh64_intdigest
    for i in range(0, n, SHINGLE_STEP):
        h = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts[i:i + SHINGLE_STEP], ends[i:i + SHINGLE_STEP])],
                     np.uint64)
        votes += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """(doc_id, row_key, fp) per row; ``fp`` is the fingerprint as a signed 64-bit number.

    A null text has no words.
    """
    slim = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("row_key"))

    def hashed(batches):
        for batch in batches:
            fp = np.array([fingerprint(t, k) for t in text_bytes(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(fp)],
                                             names=["doc_id", "row_key", "fp"])

    return mapped(slim, hashed, StructType([slim.schema["doc_id"], StructField("row_key", slim.schema["row_key"].dataType),
                                               StructField("fp", LongType())]))


class Ring:
    """Segments, chain budgets and tables for a largest distance."""

    def __init__(self, max_bits: int):
        if not 1 <= max_bits <= 7:
            raise ValueError("max_bits is 1 to 7")
        self.max_bits = max_bits
        self.segments = max_bits + 1
        edges = [round(i * BITS / self.segments) for i in range(self.segments + 1)]
        self.masks = [self._mask(range(a, b)) for a, b in zip(edges, edges[1:])]
        self.tables = []  # (start segment, mask of the bits that must agree)
        for i in range(self.segments):
            j = (i + 1) % self.segments
            half = (edges[j] + edges[j + 1]) // 2
            for part in (range(edges[j], half), range(half, edges[j + 1])):
                self.tables.append((i, self.masks[i] | self._mask(part)))

    @staticmethod
    def _mask(bits) -> int:
        return sum(1 << b for b in bits)

    def budget(self, length: int) -> int:
        return length * self.max_bits // self.segments

    def split_masks(self, table: int) -> list[int]:
        """Masks of a split bucket: the key's bits and all but ``max_bits`` parts of the others."""
        free = [b for b in range(BITS) if not self.tables[table][1] >> b & 1]
        parts = [free[i:i + 4] for i in range(0, len(free), 4)]
        whole = (1 << BITS) - 1
        return [whole & ~sum(self._mask(p) for p in chosen) for chosen in combinations(parts, self.max_bits)]

    def within(self, a: np.ndarray, b: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Whether each pair keeps the budgets of all chains from its table's start, then the full distance."""
        differ = a ^ b
        left = np.arange(len(differ))
        used = np.zeros(len(differ), np.int64)
        start = table // 2
        masks = np.array(self.masks, np.uint64)
        for length in range(1, self.segments + 1):
            at = (start[left] + length - 1) % self.segments
            used = used + np.bitwise_count(differ[left] & masks[at])
            fits = used <= self.budget(length)
            left, used = left[fits], used[fits]
        out = np.zeros(len(differ), bool)
        out[left[np.bitwise_count(differ[left]) <= self.max_bits]] = True
        return out


def _bucket_edges(ring: Ring, table: np.ndarray, key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of rows sorted by (table, key); each run of equal ones is a bucket."""
    n = len(fp)
    change = np.flatnonzero((table[1:] != table[:-1]) | (key[1:] != key[:-1])) + 1
    ends = np.repeat(np.append(change, n), np.diff(np.concatenate([[0], change, [n]])))
    us, vs, held = [], [], 0
    rows = np.arange(n)
    step = 1
    while len(rows):
        rows = rows[rows + step < ends[rows]]
        ok = ring.within(fp[rows], fp[rows + step], table[rows])
        us.append(fp[rows[ok]])
        vs.append(fp[rows[ok] + step])
        held += int(ok.sum())
        if held > 1_000_000:
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            us, vs, held = [u], [v], 0
        step += 1
    if not us:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return forest(np.concatenate(us), np.concatenate(vs))


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges (u, v) between fingerprints of ``distinct`` (one column fp, no repeats).

    Two fingerprints are connected by these edges exactly if a path of links of
    at most ``max_bits`` differing bits connects them.
    """
    ring = Ring(max_bits)
    masks = np.array([m for _, m in ring.tables], np.uint64)

    def keyed(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            t = np.repeat(np.arange(len(masks)), len(fp))
            f = np.tile(fp, len(masks))
            yield _batch(t=t.astype(np.int32), key=(f & masks[t]).view(np.int64), fp=f.view(np.int64))

    def split(batches):
        for batch in batches:
            t, key, fp = (batch.column(c).to_numpy() for c in ("t", "key", "fp"))
            hot = batch.column("n").to_numpy() > SPLIT_OVER
            yield _batch(t=t[~hot], key=key[~hot], fp=fp[~hot])
            for table in np.unique(t[hot]):
                own = fp[hot & (t == table)].view(np.uint64)
                for i, mask in enumerate(ring.split_masks(int(table))):
                    sub = mixed((own & np.uint64(mask)) + np.uint64(i))
                    yield _batch(t=np.full(len(own), table, np.int32), key=sub.view(np.int64), fp=own.view(np.int64))

    def edges(batches):
        held = [np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)]
        for batch in batches:
            held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("t", "key", "fp"))]
            t, key, _ = held
            last = np.flatnonzero((t != t[-1]) | (key != key[-1])) if len(t) else []
            whole = int(last[-1]) + 1 if len(last) else 0  # the last bucket may go on in the next batch
            if whole:
                yield from out(held, whole)
                held = [h[whole:] for h in held]
        yield from out(held, len(held[0]))

    def out(held, n):
        t, key, fp = (h[:n] for h in held)
        if n > 1:
            u, v = _bucket_edges(ring, t, key, fp.view(np.uint64))
            if len(u):
                yield _batch(u=u.view(np.int64), v=v.view(np.int64))

    rows = mapped(distinct, keyed, "t int, key long, fp long")
    shared = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = mapped(rows.join(shared, ["t", "key"]), split, "t int, key long, fp long")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mapped(buckets.repartition(parts, "t", "key").sortWithinPartitions("t", "key"), edges, "u long, v long")


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def simhash_groups(docs: DataFrame, k: int = 3, max_bits: int = 3) -> DataFrame:
    """Groups of near copies: (doc_id, fingerprint, component_id, representative, row_key) per row of ``docs``.

    ``fingerprint`` is 16 hex digits; ``component_id`` the smallest doc_id that
    links of at most ``max_bits`` bits reach (null if all of them are null);
    ``representative`` is true on the rows of the group's first (doc_id,
    row_key), so on one row unless whole rows repeat. Null and empty texts have
    fingerprint zero and are linked like any other; texts of any length are read
    as a whole; an empty table gives no rows; other columns don't matter.
    """
    prints = checkpointed(fingerprints(docs, k))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
    distinct = prints.groupBy("fp").agg(first.alias("first"))
    roots = components(links(distinct.select("fp"), max_bits))
    member = (distinct.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    head = member.groupBy("root").agg(F.min("first").alias("head"))
    labels = member.join(head, "root").select("fp", "head")
    return (prints.join(labels, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.col("head.doc_id").alias("component_id"),
                    (F.col("head.row_key") == F.col("row_key")).alias("representative"), "row_key"))


def one_per_group(docs: DataFrame, k: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of each group of near copies, all columns kept, whatever their names; of repeated rows one stays."""
    kept = simhash_groups(docs, k, max_bits).where("representative").select(F.col("row_key").alias("key"))
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), boxed(docs))
    return keyed.join(kept, "key", "left_semi").dropDuplicates(["key"]).select(*unboxed(docs))
