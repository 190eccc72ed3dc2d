"""Embedding near-dedup by cross-polytope hashing after fast Hadamard rotations.

Distinct vectors are hashed into ``TABLES`` tables (Andoni et al. 2015). Each
hash rotates the vector by three rounds of random signs and a fast Hadamard
transform and takes the axis it is nearest to, with its sign; a bucket is two
such hashes. Every vector is stored in its bucket and also probes the
``PROBES`` next likely ones. Within a bucket, stored vectors are compared with
all that came there, by cosine in double precision. Two vectors at cosine 0.9
meet with probability 0.999 (measured; more above it), and every link that is
missed must be the only path between its ends to change a component.

Components of the verified links follow, and then the links are counted
exactly: linked vectors share a component, so each component's vectors are
compared with one another.

A bucket or component of more than ``BLOCK`` vectors is cut into blocks, and
each pair of blocks is a group of its own, so no task holds more than two
blocks at once; pairs are counted or reduced to spanning edges where they are
found and never written out. Copies are one vector with a count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import checkpointed, mapped
from .components import components, forest

LEAST_COSINE = 0.9
TABLES = 8
PROBES = 3
BLOCK = 2048
SMALL_RUN = 32
ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row (a power of two long), unnormalised."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, -1, 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x


def table_keys(x: np.ndarray, table: int) -> np.ndarray:
    """Bucket keys of unit rows in one table: its own, then the probed ones, likeliest first."""
    n, d = x.shape
    size = 1 << max(2, (d - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, size - d)))
    signs = np.random.default_rng([table, size])
    codes, losses = [], []
    for _ in range(2):
        y = x
        for _ in range(ROUNDS):
            y = hadamard(y * signs.choice([-1.0, 1.0], size)) / np.sqrt(size)
        near = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :3]
        value = np.take_along_axis(y, near, 1)
        codes.append(near * 2 + (value < 0))
        losses.append((np.abs(value[:, :1]) - np.abs(value)) ** 2)
    choices = [(i, j) for i in range(3) for j in range(3) if i * j < 2]
    keys = np.stack([codes[0][:, i] * (2 * size) + codes[1][:, j] for i, j in choices], 1)
    loss = np.stack([losses[0][:, i] + losses[1][:, j] for i, j in choices], 1)
    best = np.argsort(loss, axis=1, kind="stable")[:, :1 + PROBES]
    return np.take_along_axis(keys, best, 1)


def _unit(vectors: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _canonical(value) -> bytes | None:
    """The vector's bytes in double precision; None if it links with nothing."""
    if value is None or not len(value) or None in value:
        return None
    x = np.array(value, np.float64) + 0.0
    return x.tobytes() if np.isfinite(x).all() and x.any() else None


def _nodes(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, node, v): the vector's bytes and a 128-bit key of them, both null if it links with nothing."""
    slim = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))

    def keyed(batches):
        for batch in batches:
            v = [_canonical(x) for x in batch.column("v").to_pylist()]
            node = [x and hashlib.md5(x).digest() for x in v]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(node, pa.binary()), pa.array(v, pa.binary())],
                                             names=["id", "node", "v"])

    return mapped(slim, keyed, StructType([slim.schema["id"], StructField("node", BinaryType()),
                                           StructField("v", BinaryType())]))


def _blocked(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with block, low, high: the row's block within its key, and the pair of blocks
    of each group it takes part in. Keys of up to ``BLOCK`` rows have one block."""
    n = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    return (rows.join(n, list(keys))
            .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
            .drop("n", "other"))


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = [*keys, "low", "high"]
    return rows.repartition(parts, *group).sortWithinPartitions(*group)


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by the keys, whole groups at a time, with the groups' bounds."""
    held: pa.Table | None = None

    def bounds(t: pa.Table) -> np.ndarray:
        change = np.zeros(t.num_rows - 1, bool)
        for k in keys:
            codes = t.column(k).combine_chunks().dictionary_encode()
            codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
            change |= codes[1:] != codes[:-1]
        return np.concatenate([[0], np.flatnonzero(change) + 1, [t.num_rows]])

    for batch in batches:
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        if not held.num_rows:
            continue
        edges = bounds(held)
        if len(edges) > 2:  # the last group may go on
            yield held.slice(0, edges[-2]), edges[:-1]
            held = held.slice(edges[-2])
    if held is not None and held.num_rows:
        yield held, bounds(held)


def _near(x: np.ndarray, edges: np.ndarray, apart: np.ndarray, block: np.ndarray, stored: np.ndarray,
          ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each group with the least cosine: one of them stored, and of two blocks where ``apart``."""
    def allowed(a, b):
        return (stored[a] | stored[b]) & (~apart[a] | (block[a] != block[b]))

    sizes = np.diff(edges)
    ends = np.repeat(edges[1:], sizes)
    small = np.repeat(sizes <= SMALL_RUN, sizes)
    rows, step = np.flatnonzero(small), 1
    while len(rows):
        rows = rows[rows + step < ends[rows]]
        a = rows[allowed(rows, rows + step)]
        a = a[np.einsum("ij,ij->i", x[a], x[a + step]) >= LEAST_COSINE]
        yield a, a + step
        step += 1
    for g in np.flatnonzero(sizes > SMALL_RUN):
        for s in range(edges[g], edges[g + 1], 512):
            e = min(s + 512, edges[g + 1])
            a, b = np.nonzero(x[s:e] @ x[s:edges[g + 1]].T >= LEAST_COSINE)
            a, b = a + s, b + s
            keep = (a < b) & allowed(a, b)
            yield a[keep], b[keep]


def _arrays(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low, high, block = (t.column(c).to_numpy() for c in ("low", "high", "block"))
    return _unit(t.column("v").to_pylist()), low != high, block


def links(distinct: DataFrame) -> DataFrame:
    """Edges (u, v) whose components are those of the links found among distinct (node, v)."""
    def hashed(batches):
        for batch in batches:
            v = batch.column("v").to_pylist()
            lengths = np.array([len(b) for b in v])
            for size in np.unique(lengths):  # vectors of different length are never linked
                rows = np.flatnonzero(lengths == size)
                x = _unit([v[i] for i in rows])
                for t in range(TABLES):
                    keys = table_keys(x, t)
                    for p in range(keys.shape[1]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), t, np.int32)), pa.array(np.full(len(rows), size, np.int32)),
                             pa.array(keys[:, p].astype(np.int64)), pa.array(np.full(len(rows), p == 0)),
                             batch.column("node").take(pa.array(rows)), batch.column("v").take(pa.array(rows))],
                            names=["t", "size", "key", "stored", "node", "v"])

    def edges(batches):
        for t, bounds in _runs(batches, ("t", "size", "key", "low", "high")):
            for s, e in _same_length(t, bounds):
                part, own = t.slice(bounds[s], bounds[e] - bounds[s]), bounds[s:e + 1] - bounds[s]
                x, apart, block = _arrays(part)
                us, vs, held = [], [], 0
                for a, b in _near(x, own, apart, block, part.column("stored").to_numpy()):
                    us.append(a)
                    vs.append(b)
                    held += len(a)
                    if held > 1_000_000:
                        u, v = forest(np.concatenate(us), np.concatenate(vs))
                        us, vs, held = [u], [v], 0
                if held:
                    u, v = forest(np.concatenate(us), np.concatenate(vs))
                    nodes = part.column("node").combine_chunks()
                    yield pa.RecordBatch.from_arrays([nodes.take(pa.array(u)), nodes.take(pa.array(v))], names=["u", "v"])

    rows = mapped(distinct.select("node", "v"), hashed,
                  "t int, size int, key long, stored boolean, node binary, v binary")
    keys = ("t", "size", "key")
    return mapped(_dealt(_blocked(rows, *keys), *keys), edges, "u binary, v binary")


def _same_length(t: pa.Table, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive groups whose vectors have one length."""
    lengths = np.array([len(t.column("v")[int(b)].as_py()) for b in bounds[:-1]])
    cuts = np.concatenate([[0], np.flatnonzero(lengths[1:] != lengths[:-1]) + 1, [len(lengths)]])
    yield from zip(cuts[:-1], cuts[1:])


def link_counts(members: DataFrame) -> DataFrame:
    """(node, n): for each of members (root, node, v, copies), how many vectors of other nodes it is linked with."""
    def counted(batches):
        for t, bounds in _runs(batches, ("root", "low", "high")):
            for s, e in _same_length(t, bounds):
                part, own = t.slice(bounds[s], bounds[e] - bounds[s]), bounds[s:e + 1] - bounds[s]
                x, apart, block = _arrays(part)
                copies = part.column("copies").to_numpy()
                n = np.zeros(len(x), np.int64)
                for a, b in _near(x, own, apart, block, np.ones(len(x), bool)):
                    np.add.at(n, a, copies[b])
                    np.add.at(n, b, copies[a])
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").combine_chunks().take(pa.array(some)), pa.array(n[some])], names=["node", "n"])

    found = mapped(_dealt(_blocked(members, "root"), "root"), counted, "node binary, n long")
    return found.groupBy("node").agg(F.sum("n").alias("n"))


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``table``.

    ``n_links`` counts the other rows linked with it, copies included;
    ``component_id`` is the smallest id that links reach; ``kept`` tells
    whether it is the row's own. A vector that is null, empty or zero, or holds
    a null or non-finite component, and vectors of different length link with
    nothing; null ids are passed over for the smallest id. Repeated rows link
    with one another; an empty table gives no rows; other columns don't matter,
    whatever their names.
    """
    rows = _nodes(table, id_col, vector_col)
    ids = checkpointed(rows.select("id", "node"))
    distinct = checkpointed(rows.where("node IS NOT NULL").groupBy("node").agg(F.first("v").alias("v")))
    copies = ids.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"), F.min("id").alias("first"))
    roots = components(links(distinct))
    members = distinct.join(roots, "node").join(copies.select("node", "copies"), "node")
    rooted = (copies.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = (rooted.join(least, "root").join(link_counts(members), "node", "left")
              .select("node", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    linked = ids.join(labels, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return linked.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
