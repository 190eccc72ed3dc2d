"""Packing by concatenating and cutting: fixed windows over the token stream.

Every document's ids and an end id form one stream in a stable order (see
``stream``), whose offsets come from prefix sums over the totals of its
partitions. Sequence i is the window of ``WIDTH`` ids from i * ``WIDTH`` on;
every sequence but the last is full. The last one is padded to ``WIDTH``,
unless its length is a power of two.

``pieces`` are the boundary records: which ids of which document lie where in
which sequence. ``sequences`` puts the ids together. A window within one
partition is made there; only the windows that a partition's border cuts, two
for each partition at most, are shuffled and joined.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped
from .stream import Stream, token_stream
from .token_counts import VOCABULARY, encoder

WIDTH = 2048
END = 1
PAD = 0


def stream(docs: DataFrame, path: str | None = None, end: int = END) -> Stream:
    """The token stream that is cut: ids as the library gives them, without added special tokens, then ``end``."""
    path = path or public_tokenizers.path(VOCABULARY)
    largest = len(encoder(path).lengths) - 1
    return token_stream(docs, lambda: lambda column: _encoded(path, column), end, largest)


def _encoded(path: str, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    from .units import text_buffers

    return encoder(path).units.encoded(*text_buffers(column))


def _cuts(first: int, n: int, width: int) -> list[tuple[int, int, int]]:
    """(sequence, place in it, ids) of each piece of a document whose ids begin at ``first`` of the stream."""
    out, at = [], first
    while at < first + n:
        sequence, place = divmod(at, width)
        size = min(width - place, first + n - at)
        out.append((sequence, place, size))
        at += size
    return out


def pieces(docs: DataFrame, path: str | None = None, width: int = WIDTH, end: int = END) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece of each row of ``docs``.

    ``start`` counts the document's ids before the piece, ``offset`` the
    sequence's; ``ids_crc32`` is that of the ids as little-endian unsigned
    32-bit numbers; ``doc_tokens`` counts the document's ids, the end id
    included. A null or empty text has one piece, the end id; repeated rows are
    packed as often as they come; an empty table gives no rows. A text of any
    length is cut into as many pieces as it takes. Other columns don't matter.
    """
    return pieces_of(stream(docs, path, end), width)


def pieces_of(source: Stream, width: int = WIDTH) -> DataFrame:
    places = source.places

    def rows(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            row, start, length, crc, sequence, offset = [], [], [], [], [], []
            numbers = batch.column("n").to_numpy()
            for i, (first, n, data) in enumerate(zip(places.firsts(batch).tolist(), numbers.tolist(), batch.column("ids"))):
                ids, at = places.unpacked(data.as_py(), unpack).astype("<u4"), 0
                for s, place, size in _cuts(first, n, width):
                    row.append(i)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[at:at + size]))
                    sequence.append(s)
                    offset.append(place)
                    at += size
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                 pa.array(numbers[row] if row else [], pa.int64()), *(pa.array(x, pa.int64()) for x in (sequence, offset))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = dict(source.table.dtypes)["doc_id"]
    return mapped(source.table, rows, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                      "sequence_id long, offset long")


def sequences(docs: DataFrame, path: str | None = None, width: int = WIDTH, end: int = END, pad: int = PAD) -> DataFrame:
    """(sequence_id, n_tokens, ids, pieces), one row per sequence.

    ``ids`` has ``width`` ids, the last sequence's filled up with ``pad``
    unless its ``n_tokens`` are a power of two; ``pieces`` is an array of
    (offset, length, doc_id, start). No rows, no sequences.
    """
    return sequences_of(stream(docs, path, end), width, pad)


def sequences_of(source: Stream, width: int = WIDTH, pad: int = PAD) -> DataFrame:
    places, kind = source.places, dict(source.table.dtypes)["doc_id"]
    piece = f"struct<offset:long,length:long,doc_id:{kind},start:long>"

    def windows(whole: bool):
        def rows(batches):
            unpack = zstandard.ZstdDecompressor()
            held, sequence, parts, docs = 0, None, [], []

            def record():
                return pa.RecordBatch.from_arrays(
                    [pa.array([sequence], pa.int64()), pa.array([docs[0][0]], pa.int64()), pa.array([held], pa.int64()),
                     pa.array([np.concatenate(parts).astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([[dict(zip(("offset", "length", "doc_id", "start"), d)) for d in docs]],
                              pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64()),
                                                  ("doc_id", id_type), ("start", pa.int64())])))],
                    names=["sequence_id", "offset", "n_tokens", "ids", "pieces"])

            for batch in batches:
                id_type = batch.column("doc_id").type
                for doc, first, n, data in zip(batch.column("doc_id").to_pylist(), places.firsts(batch).tolist(),
                                               batch.column("n").to_pylist(), batch.column("ids")):
                    ids, at = places.unpacked(data.as_py(), unpack), 0
                    for s, place, size in _cuts(first, n, width):
                        if s != sequence:
                            if held and (held == width) == whole:
                                yield record()
                            held, sequence, parts, docs = 0, s, [], []
                        parts.append(ids[at:at + size])
                        docs.append((place, size, doc, at))
                        held += size
                        at += size
            if held and (held == width) == whole:
                yield record()

        return mapped(source.table, rows, f"sequence_id long, offset long, n_tokens long, ids array<int>, pieces array<{piece}>")

    def flat(column: str):
        return F.flatten(F.transform("cut", lambda c: c[column])).alias(column)

    joined = (windows(False).groupBy("sequence_id")
              .agg(F.sort_array(F.collect_list(F.struct("offset", "n_tokens", "ids", "pieces"))).alias("cut"))
              .select("sequence_id", F.aggregate("cut", F.lit(0).cast("long"), lambda n, c: n + c["n_tokens"]).alias("n_tokens"),
                      flat("ids"), flat("pieces")))
    every = windows(True).select("sequence_id", "n_tokens", "ids", "pieces").unionAll(joined)
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    missing = F.when(power, 0).otherwise(F.lit(width) - F.col("n_tokens")).cast("int")
    return every.withColumn("ids", F.concat("ids", F.array_repeat(F.lit(pad), missing)))
