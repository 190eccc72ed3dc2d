"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The ranks of a .tiktoken file become a byte-level BPE model: every byte is
mapped to a printable character, each vocabulary entry is spelled in these
characters, and every split of an entry into two others is a merge of the
entry's rank. Its ids are those of the tiktoken library for the same ranks and
pattern, without special tokens.

Decoding maps ids to their spellings, reverses the byte table and joins the
bytes, so a character split between tokens comes out whole; ``decode_text``
replaces only bytes that form no character.
"""

from __future__ import annotations

import base64
import os
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from .common import mapped, row_slices, texts
from .splice import Splicer
from .units import UnitIds, text_buffers

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Bytes of text encoded at once by a task.
STEP_BYTES = 1 << 22


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """A byte-level BPE tokenizer from ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        from tokenizers import Tokenizer, models, pre_tokenizers

        table = byte_characters()

        def spelled(token: bytes) -> str:
            return "".join(table[b] for b in token)

        vocabulary = {spelled(t): r for t, r in ranks.items()}
        merges = [(spelled(t[:i]), spelled(t[i:])) for t, _ in sorted(ranks.items(), key=lambda x: x[1])
                  for i in sorted((i for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks),
                                  key=lambda i: (ranks[t[:i]], ranks[t[i:]]))]
        self.model = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        back = {c: b for b, c in table.items()}
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for spelling, i in vocabulary.items():
            self.bytes_of[i] = bytes(back[c] for c in spelling)
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        splicer = Splicer(self.model)
        self.units = UnitIds(lambda batch: (e.ids for e in self.model.encode_batch_fast(batch, add_special_tokens=False)),
                             self.lengths, encode_long=lambda text: np.concatenate(list(splicer.ids(text))))

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return self.units.ids(batch)

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of an Arrow column, one after the other, and where each text's begin (and the last's end)."""
        return self.units.encoded(*text_buffers(column))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def decode_text(self, ids: np.ndarray) -> str:
        return self.decode(ids).decode("utf-8", "replace")

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end character (exclusive) of each token; parts of a split character have all of it."""
        data = np.frombuffer(text.encode(), np.uint8)
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
        return character[starts], character[ends - 1] + 1


@cache
def tokenizer(path: str) -> ByteBpe:
    """One tokenizer per worker and file, on one thread (Spark runs the tasks side by side)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ByteBpe(read_ranks(path))


def encoded(docs: DataFrame, path: str | None = None, offsets: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) per row; ``decoded`` has the bytes that the ids decode to.

    With ``offsets`` also ``starts`` and ``ends``, the tokens' character
    offsets. Null and empty texts have no tokens, repeated rows a row each; an
    empty table gives no rows, other columns don't matter, whatever their names.
    Texts are encoded as a whole, a stretch of over 64 KB without a sure cut in
    spliced chunks (see ``splice``).
    """
    path = path or public_tokenizers.path(VOCABULARY)
    slim = docs.select("doc_id", "text")
    numbers = ArrayType(IntegerType(), False)
    fields = [slim.schema["doc_id"], StructField("n_tokens", LongType()), StructField("ids", numbers),
              StructField("decoded", BinaryType())]
    if offsets:
        fields += [StructField("starts", numbers), StructField("ends", numbers)]

    def listed(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))

    def rows(batches):
        model = tokenizer(path)
        for batch in batches:
            for part in row_slices(batch, STEP_BYTES):
                ids, bounds = model.encode_column(part.column("text"))
                own = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                columns = [part.column("doc_id"), pa.array(np.diff(bounds)), listed(bounds, ids),
                           pa.array([model.decode(x) for x in own], pa.binary())]
                if offsets:
                    places = [model.offsets(t, x) for t, x in zip(texts(part), own)]
                    columns += [listed(bounds, np.concatenate([*(p[k] for p in places), ids[:0]])) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return mapped(slim, rows, StructType(fields))
