"""The token stream of a table: every row's ids in one stable order, with global offsets by two-pass prefix sums.

Rows are ordered by id (null first), then by a hash of the text. Rows equal in
both have the same ids, so the stream is the same however the table is
partitioned or read; an arbitrary third key only lets ranges part a heap of such
rows. The first pass deals the texts to ranges of that order, encodes them
there and stores the ids compressed, with each row's place in its range; one
number per range, its total, comes to the driver, and the sums of the totals
before it place a range in the stream. The second pass, whatever it makes of
the ids, is narrow.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import checkpointed, mapped, row_slices
from .units import text_buffers

STEP_BYTES = 1 << 22


def ordered(docs: DataFrame) -> DataFrame:
    """(doc_id, packed) in ranges of the stable order, each sorted; ``packed`` is the text, compressed."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
                       F.monotonically_increasing_id().alias("salt"))

    def packed(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece in row_slices(batch, STEP_BYTES):
                data, bounds = text_buffers(piece.column("text"))
                edges = bounds.tolist()
                own = [pack.compress(data[a:b]) for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(own, pa.binary()), *piece.columns[2:]],
                                                 names=["doc_id", "packed", "h", "salt"])

    rows = mapped(slim, packed, StructType([slim.schema["doc_id"], StructField("packed", BinaryType()),
                                            slim.schema["h"], slim.schema["salt"]]))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("salt")]
    return rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("doc_id", "packed")


def unpacked_slices(batch: pa.RecordBatch):
    """(rows, texts) of an ordered batch, some at a time."""
    unpack = zstandard.ZstdDecompressor()
    start, held, size = 0, [], 0
    for i, data in enumerate(batch.column("packed")):
        text = unpack.decompress(data.as_py())
        if held and size + len(text) > STEP_BYTES:
            yield batch.slice(start, len(held)), pa.array(held, pa.binary())
            start, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield batch.slice(start), pa.array(held, pa.binary())


@dataclass
class Places:
    """What tasks know of the stream: the ids before each part, the ids in all, and the type that holds one."""

    before: dict[int, int]
    total: int
    kind: np.dtype

    def firsts(self, batch: pa.RecordBatch) -> np.ndarray:
        """How many ids of the stream come before each row."""
        parts = batch.column("part").to_numpy()
        own, at = np.unique(parts, return_inverse=True)
        return np.array([self.before[p] for p in own.tolist()], np.int64)[at] + batch.column("start").to_numpy()

    def unpacked(self, data: bytes, unpack: zstandard.ZstdDecompressor) -> np.ndarray:
        return np.frombuffer(unpack.decompress(data), self.kind)


@dataclass
class Stream:
    """``table`` has (doc_id, part, start, n, ids): a row's ids, compressed, and how many ids of its part come before it."""

    table: DataFrame
    places: Places


def id_kind(largest: int) -> np.dtype:
    """The smallest type that holds ids up to ``largest``."""
    return np.dtype("<u2") if largest < 1 << 16 else np.dtype("<u4")


def token_stream(docs: DataFrame, encode: Callable[[], Callable], end: int, largest: int) -> Stream:
    """The stream of ``docs``: each row's ids, then ``end``.

    ``encode()`` gives, in a task, a function from an Arrow column of texts to
    their ids, one after the other, and the bounds of each text's; ``largest``
    is the largest id. Null and empty texts have ``end`` only, repeated rows
    come as often as they do; other columns don't matter, whatever their names.
    """
    kind = id_kind(max(end, largest))
    slim = ordered(docs)
    id_type = dict(slim.dtypes)["doc_id"]

    def rows(batches):
        part, start = TaskContext.get().partitionId(), 0
        own, pack = encode(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece, texts in unpacked_slices(batch):
                ids, bounds = own(texts)
                with_end = np.insert(ids, bounds[1:], end).astype(kind)
                bounds = bounds + np.arange(len(bounds))
                n = np.diff(bounds)
                starts = start + np.cumsum(n) - n
                start += int(n.sum())
                data = [pack.compress(with_end[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(starts), pa.array(n),
                     pa.array(data, pa.binary())], names=["doc_id", "part", "start", "n", "ids"])

    table = checkpointed(mapped(slim, rows, f"doc_id {id_type}, part int, start long, n long, ids binary"))
    totals = {r.part: r.n for r in table.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # one per part
    before, total = {}, 0
    for part in sorted(totals):
        before[part] = total
        total += totals[part]
    return Stream(table, Places(before, total, kind))
