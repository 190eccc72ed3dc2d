import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from llm_helpers import ODD_ROWS, SF0001, documents, nothing, odd  # noqa: F401
from tessera.llm import packing
from tessera.llm import queries as K


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def ids_of(whole, text):
    return [*whole.encode(text or "", add_special_tokens=False).ids, packing.END]


def checked(rows, docs, width, whole):
    """Asserts that the pieces tile documents and sequences, and gives the sequences' lengths."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(docs)
    for doc, own in by_doc.items():
        ids, at = ids_of(whole, docs[doc]), 0
        for r in sorted(own, key=lambda r: r.start):
            cut = np.array(ids[r.start:r.start + r.length], "<u4")
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(cut.tobytes())
            at += r.length
        assert at == len(ids)
    lengths = []
    for s in range(len(by_sequence)):
        at = 0
        for r in sorted(by_sequence[s], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        lengths.append(at)
    assert all(n == width for n in lengths[:-1]) and 0 < lengths[-1] <= width
    return lengths


def test_query(spark, whole):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    checked(K.QUERIES["op11_packing"](spark, SF0001).collect(), docs, 2048, whole)


@pytest.mark.parametrize("width", [7, 64, 2048])
def test_pieces_and_sequences_hold_the_stream(spark, whole, width):
    docs = {i: t for i, t in ODD_ROWS if i not in (4, None)} | {i: f"doc {i} <|endoftext|> " * (i % 9) for i in range(10, 150)}
    frame = documents(spark, list(docs.items()))
    found = [packing.pieces(frame.repartition(n), width=width).collect() for n in (1, 5)]
    lengths = checked(found[0], docs, width, whole)
    assert sorted(map(tuple, found[0])) == sorted(map(tuple, found[1]))  # the input's partitions don't matter
    stream = [i for d in sorted(docs) for i in ids_of(whole, docs[d])]
    rows = packing.sequences(frame.repartition(3), width=width).orderBy("sequence_id").collect()
    assert [r.n_tokens for r in rows] == lengths
    assert [i for r in rows for i in r.ids[:r.n_tokens]] == stream
    last = rows[-1]
    full = last.n_tokens if last.n_tokens & (last.n_tokens - 1) == 0 else width
    assert [len(r.ids) for r in rows] == [width] * (len(rows) - 1) + [full]
    assert last.ids[last.n_tokens:] == [packing.PAD] * (full - last.n_tokens)
    records = {(p.doc_id, p.start, p.length, r.sequence_id, p.offset) for r in rows for p in r.pieces}
    assert records == {(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in found[0]}


def test_odd_rows(odd, nothing, whole):
    rows = packing.pieces(odd).collect()
    texts = {(i, t) for i, t in ODD_ROWS}
    assert sum(r.length for r in rows) == sum(len(ids_of(whole, t)) for _, t in ODD_ROWS)
    assert {r.doc_id for r in rows} == {i for i, _ in texts}
    assert sorted(r.start for r in rows if r.doc_id == 4) == [0, 0]  # a repeated row is packed twice
    assert packing.pieces(nothing).count() == packing.sequences(nothing).count() == 0
