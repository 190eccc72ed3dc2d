"""Token-id output in training order: fixed-stride shards by a keyed permutation.

Every document's ids and an end-of-text id form one stream, in a stable order
that does not depend on how the table is partitioned (see ``stream``); sequence
i is the stream's i-th run of ``length`` ids (the last one is filled up with
end-of-text ids). A Feistel network keyed by the seed permutes the next power
of four; cycle-walking (applying it again while the value is no sequence
number) makes it a permutation of the sequence numbers, so any sequence's slot
is known without sorting or a shuffle table.

Shard s holds the slots from s * ``per_shard`` on, each record of the same
number of bytes, so slot n is read at a computed offset and training resumes at
any slot by reading shards in order. Ids take two bytes each, so a vocabulary
that reaches the end-of-text id is refused; one shuffle deals the documents'
pieces, compressed, to ranges of slots, where Spark sorts them and each shard is
put together by itself. Shards are rows of a Parquet table: Spark commits a
task's shards at once, so lost executors leave no partial ones.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import VOCABULARY, read_ranks, tokenizer
from .common import mapped
from .stream import Stream, token_stream
from .words import mixed

END_OF_TEXT = 50_256
LENGTH = 512
PER_SHARD = 4096
ROUNDS = 4


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of 0 .. n-1."""

    n: int
    seed: int

    @property
    def _half(self) -> int:
        return max(1, (max(self.n - 1, 1).bit_length() + 1) // 2)

    def _keys(self) -> np.ndarray:
        return mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                     + np.uint64(self.seed % (1 << 64)))

    def _network(self, x: np.ndarray, back: bool) -> np.ndarray:
        half = np.uint64(self._half)
        mask = np.uint64((1 << self._half) - 1)
        left, right = x >> half, x & mask
        for key in self._keys()[::-1] if back else self._keys():
            if back:
                left, right = right ^ (mixed(left ^ key) & mask), left
            else:
                left, right = right, left ^ (mixed(right ^ key) & mask)
        return left << half | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        out = self._network(np.asarray(x).astype(np.uint64), back)
        while (over := out >= self.n).any():
            out[over] = self._network(out[over], back)
        return out.astype(np.int64)

    def slot(self, sequence: np.ndarray) -> np.ndarray:
        return self._walk(sequence, False)

    def sequence(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, True)


def stream(docs: DataFrame, path: str | None = None) -> Stream:
    """The token stream of ``docs``, an end-of-text id after each row's ids.

    A vocabulary with ids from the end-of-text id on raises ValueError: they
    would wrap or be taken for it.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    largest = max(read_ranks(path).values(), default=-1)
    if largest >= END_OF_TEXT:
        raise ValueError(f"{path}: ids go up to {largest}, shards hold ids below {END_OF_TEXT}")
    return token_stream(docs, lambda: tokenizer(path).encode_column, END_OF_TEXT, largest)


def shards(docs: DataFrame, seed: int = 17, length: int = LENGTH, per_shard: int = PER_SHARD,
           path: str | None = None) -> DataFrame:
    """(shard, first_slot, n_sequences, n_tokens, stride, sha256, payload), one row per shard.

    ``n_tokens`` leaves the filling out; ``stride`` is a record's bytes. The
    same rows, seed and sizes give the same shards, however the table is
    partitioned. Null and empty texts have the end-of-text id only, a text of
    any length goes on over as many sequences as it takes, repeated rows come as
    often as they do, other columns don't matter. No documents, no shards.
    """
    return shards_of(stream(docs, path), seed, length, per_shard)


def shards_of(source: Stream, seed: int = 17, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """The shards of a stored token stream."""
    places = source.places
    sequences = -(-places.total // length)
    order = Permutation(sequences, seed)

    def pieces(batches):
        pack, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            first, n = places.firsts(batch), batch.column("n").to_numpy()
            sequence = first // length
            count = (first + n - 1) // length - sequence + 1
            row = np.repeat(np.arange(len(n)), count)
            own = sequence[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            begin = np.maximum(own * length, first[row])
            end = np.minimum((own + 1) * length, (first + n)[row])
            cut, held, data = [], -1, None
            for r, a, b in zip(row.tolist(), (begin - first[row]).tolist(), (end - first[row]).tolist()):
                if r != held:
                    held, data = r, places.unpacked(batch.column("ids")[r].as_py(), unpack)
                cut.append(pack.compress(data[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(order.slot(own)), pa.array((begin - own * length).astype(np.int32)),
                 pa.array(cut, pa.binary())], names=["slot", "place", "ids"])

    def written(batches):
        held, payload, used = None, None, 0
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            columns = [batch.column(c) for c in ("slot", "place", "ids")]
            for slot, place, ids in zip(columns[0].to_pylist(), columns[1].to_pylist(), columns[2]):
                if slot // per_shard != held:
                    if held is not None:
                        yield record(held, payload, used)
                    held, used = slot // per_shard, 0
                    payload = np.full(min(per_shard, sequences - held * per_shard) * length, END_OF_TEXT, "<u2")
                own = places.unpacked(ids.as_py(), unpack)
                at = (slot - held * per_shard) * length + place
                payload[at:at + len(own)] = own
                used += len(own)
        if held is not None:
            yield record(held, payload, used)

    def record(shard, payload, used):
        data = payload.tobytes()
        return pa.RecordBatch.from_pydict({
            "shard": [shard], "first_slot": [shard * per_shard], "n_sequences": [len(payload) // length],
            "n_tokens": [used], "stride": pa.array([2 * length], pa.int32()),
            "sha256": [hashlib.sha256(data).hexdigest()], "payload": [data]})

    n_shards = max(1, -(-sequences // per_shard))
    parts = min(n_shards, int(source.table.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = mapped(source.table.select("part", "start", "n", "ids"), pieces, "slot long, place int, ids binary")
    ranges = dealt.repartitionById(parts, F.expr(f"cast((slot div {per_shard}) * {parts} div {n_shards} as int)"))
    return mapped(ranges.sortWithinPartitions("slot", "place"), written,
                  "shard long, first_slot long, n_sequences long, n_tokens long, stride int, sha256 string, payload binary")


def write_shards(docs: DataFrame, folder: str, **options) -> None:
    """The shards as a Parquet table in ``folder``."""
    shards(docs, **options).write.parquet(folder)


def read_slots(spark: SparkSession, folder: str, first: int, count: int) -> DataFrame:
    """(slot, ids) of ``count`` slots from ``first`` on; only the shards that hold them are read."""
    table = spark.read.parquet(folder).where(
        (F.col("first_slot") < first + count) & (F.col("first_slot") + F.col("n_sequences") > first))

    def records(batches):
        for batch in batches:
            for begin, n, stride, data in zip(*(batch.column(c).to_pylist() for c in (
                    "first_slot", "n_sequences", "stride", "payload"))):
                a, b = max(first, begin), min(first + count, begin + n)
                ids = [np.frombuffer(data, "<u2", stride // 2, (s - begin) * stride).astype(np.int32) for s in range(a, b)]
                yield pa.RecordBatch.from_arrays([pa.array(range(a, b), pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                                                 names=["slot", "ids"])

    return mapped(table, records, "slot long, ids array<int>")
