"""Token counts with overlap resynchronisation for huge documents.

Texts up to ``LONG_CHARS`` characters are counted through their distinct units
(see ``units``). A longer one is encoded in overlapping chunks, with offsets,
which are spliced at proven stable boundaries (see ``splice``); overlaps without
one are widened. The counts are exact. Where the text lets the encodings fall
into step, which every text but one made for the purpose does within some
hundred characters, the work is linear in its length, blanks or none, and a
chunk and its overlap are in the library at once.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from .common import mapped, row_slices
from .splice import CHUNK_CHARS, LONG_CHARS, OVERLAP_CHARS, Splicer
from .units import UnitIds, text_buffers

VOCABULARY = "byte_bpe_50k.json"
STEP_BYTES = 1 << 22


def checked_byte_level(model, path: str) -> None:
    """Raises ValueError unless the tokenizer is a byte-level BPE whose pattern the cuts of ``units`` hold for."""
    import json

    parts = json.loads(model.to_str())
    before = parts["pre_tokenizer"] or {}
    if (parts["normalizer"] is not None or parts["model"]["type"] != "BPE" or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space") or not before.get("use_regex")
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"])):
        raise ValueError(f"{path}: not a plain byte-level BPE tokenizer, which this operator is for")


def token_lengths(model) -> np.ndarray:
    """Bytes of each token of a byte-level vocabulary; special tokens are spelled as they are."""
    special = {i: t.content for i, t in model.get_added_tokens_decoder().items()}
    out = np.zeros(model.get_vocab_size(), np.int64)
    for spelling, i in model.get_vocab().items():
        out[i] = len(special[i].encode()) if i in special else len(spelling)  # one character stands for one byte
    return out


class Encoder:
    """Ids by a byte-level tokenizer of the tokenizers library.

    Special strings in texts are handled as the library does, unless ``plain_special``
    makes them ordinary text.
    """

    def __init__(self, path: str, long: int = LONG_CHARS, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
                 plain_special: bool = False):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        checked_byte_level(self.model, path)
        self.model.no_truncation()
        self.model.no_padding()
        self.model.encode_special_tokens = plain_special
        self.lengths = token_lengths(self.model)
        added = {t.content: i for i, t in self.model.get_added_tokens_decoder().items()
                 if not (plain_special and t.special)}
        self.long = long
        self.splicer = Splicer(self.model, added, chunk, overlap)
        self.units = UnitIds(
            lambda batch: (e.ids for e in self.model.encode_batch_fast(batch, add_special_tokens=False)), self.lengths,
            list(added), lambda text: np.concatenate(list(self.splicer.ids(text))))

    def counts(self, column: pa.Array) -> np.ndarray:
        """Tokens of each text of an Arrow column."""
        data, bounds = text_buffers(column)
        out = np.zeros(len(column), np.int64)
        # A character has a byte at least, so only texts of many bytes can have many characters.
        big = [i for i in np.flatnonzero(np.diff(bounds) > self.long).tolist() if len(column[i].as_py()) > self.long]
        for i in big:
            out[i] = sum(map(len, self.splicer.ids(column[i].as_py())))
        edges = np.array([-1, *big, len(column)])
        for a, b in zip(edges[:-1] + 1, edges[1:]):
            if a < b:
                own = bounds[a:b + 1]
                out[a:b] = np.diff(self.units.encoded(data[own[0]:own[-1]], own - own[0])[1])
        return out


@cache
def encoder(path: str, plain_special: bool = False) -> Encoder:
    """One encoder per worker and file, on one thread (Spark runs the tasks side by side)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, plain_special=plain_special)


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row: UTF-8 bytes and tokens of its whole text.

    Null and empty texts have zeros, repeated rows a row each; an empty table gives
    none, and other columns don't matter, whatever their names. Texts of any length
    are counted as a whole, those over ``LONG_CHARS`` characters in chunks. A
    tokenizer other than a plain byte-level BPE raises ValueError.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    encoder(path)
    slim = docs.select("doc_id", "text")
    schema = StructType([slim.schema["doc_id"], StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])

    def rows(batches):
        own = encoder(path)
        for batch in batches:
            for part in row_slices(batch, STEP_BYTES):
                column = part.column("text")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(text_buffers(column)[1])), pa.array(own.counts(column))],
                    names=schema.names)

    return mapped(slim, rows, schema)
