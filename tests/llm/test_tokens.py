import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from llm_helpers import ODD_ROWS, SF0001, documents, nothing, odd  # noqa: F401
from tessera.llm import bpe, shards, token_counts, units
from tessera.llm import queries as K

PATH = P.path(bpe.VOCABULARY)
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
PIECES = list("abc de\n\n\t .,!'s1é漢😀  　\x1c\x85") + ["<|endoftext|>", "don't", "  \n", "ﬁ", "́"]


def odd_texts(seed, n, longest=60):
    r = random.Random(seed)
    return ["".join(r.choices(PIECES, k=r.randint(0, longest))) for _ in range(n)] + ["", " ", "\n\n  "]


def test_ids_are_those_of_the_other_library():
    model = bpe.tokenizer(PATH)
    batch = odd_texts(1, 3000)
    for _ in range(2):  # the second time from kept units
        for t, ids in zip(batch, model.encode(batch)):
            assert ids.tolist() == REFERENCE.encode_ordinary(t) and model.decode(ids) == t.encode()


def test_every_character_parts_alike():
    model = bpe.tokenizer(PATH)
    batch = [f"a{c}b {c}1{c} {c}{c}!{c} ,\n{c}x" for c in map(chr, [*range(0x3100), 0xFEFF, 0x1F600])]
    assert [x.tolist() for x in model.encode(batch)] == [REFERENCE.encode_ordinary(t) for t in batch]


def test_offsets_are_the_librarys_and_split_characters_come_back():
    model = bpe.tokenizer(PATH)
    for t in odd_texts(2, 300):
        ids = model.encode([t])[0]
        starts, ends = model.offsets(t, ids)
        assert list(zip(starts.tolist(), ends.tolist())) == model.model.encode(t, add_special_tokens=False).offsets
    ids = model.encode(["😀漢"])[0]
    assert len(ids) > 2 and model.decode_text(ids) == "😀漢" and model.decode_text(ids[:1]) != "😀"


def test_kept_units_are_bounded(monkeypatch):
    monkeypatch.setattr(units, "KEPT_UNITS", 20)
    monkeypatch.setattr(units, "STEP_UNITS", 50)
    model = bpe.ByteBpe(bpe.read_ranks(PATH))
    batch = odd_texts(3, 300)
    for i in range(0, len(batch), 7):
        part = batch[i:i + 7]
        assert [x.tolist() for x in model.encode(part)] == [REFERENCE.encode_ordinary(t) for t in part]
        assert len(model.units.kept) <= 20


def test_long_counts_are_whole_counts():
    path = P.path(token_counts.VOCABULARY)
    whole = Tokenizer.from_file(path)
    r = random.Random(0)
    endless = ["".join(r.choices("abcdefgh"[:r.randint(1, 8)], k=900)) for _ in range(40)]
    few = ["".join(r.choices(r.sample(PIECES, 3), k=400)) for _ in range(60)]
    for long, chunk, overlap in ((100, 40, 4), (50, 64, 1), (200, 33, 16)):
        own = token_counts.Encoder(path, long, chunk, overlap)
        batch = odd_texts(long, 200, 500) + endless + few + [
            "x" * 900, " " * 700, "\n " * 400, "a " * 600, "é" * 300, "漢字" * 300, "́" * 500, "<|endoftext|>" * 40,
            "<|endoftext|" * 40, "'s" * 300, "!'" * 300]
        want = [x.ids for x in whole.encode_batch(batch, add_special_tokens=False)]
        assert own.counts(pa.array(batch)).tolist() == list(map(len, want))
        for t, ids in zip(batch, want):
            assert np.concatenate([*own.splicer.ids(t), []]).tolist() == ids


def test_long_units_are_spliced(monkeypatch):
    monkeypatch.setattr(units, "LONG_UNIT", 60)
    model = bpe.ByteBpe(bpe.read_ranks(PATH))
    batch = ["x" * 900, "漢字" * 300, "ab" * 200 + " c", "é" * 200]
    assert [x.tolist() for x in model.encode(batch)] == [REFERENCE.encode_ordinary(t) for t in batch]


@pytest.mark.parametrize("text", ["".join(chr(0x4E00 + i * 7919 % 20_000) for i in range(400_000)), "a" * 400_000])
def test_texts_without_blanks_take_linear_work(text):
    own = token_counts.Encoder(P.path(token_counts.VOCABULARY))
    given = []
    encode = own.splicer._tokens
    own.splicer._tokens = lambda t, a, b: given.append(b - a) or encode(t, a, b)
    assert own.counts(pa.array([text])).tolist() == [len(own.model.encode(text, add_special_tokens=False).ids)]
    assert sum(given) < 1.2 * len(text) and max(given) < 2 * token_counts.CHUNK_CHARS


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Encoder(P.path("word_bpe_49k.json"))


def test_query_digests(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    whole = Tokenizer.from_file(P.path(token_counts.VOCABULARY))
    for r in K.QUERIES["op4_byte_bpe"](spark, SF0001).collect():
        ids = REFERENCE.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    for r in K.QUERIES["op5_token_counts"](spark, SF0001).collect():
        n = len(whole.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)


def test_odd_rows(odd, nothing):
    rows = bpe.encoded(odd, offsets=True).collect()
    assert len(rows) == 11 and {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert all(len(r.ids) == len(r.starts) == len(r.ends) == r.n_tokens for r in rows)
    counts = {r.doc_id: r for r in token_counts.token_counts(odd).collect()}
    assert counts[1].n_tokens == counts[2].n_bytes == 0 and counts[5].n_bytes == 30_000 and None in counts
    long = ODD_ROWS[8][1]
    assert len(long) > token_counts.LONG_CHARS
    assert counts[9].n_tokens == len(Tokenizer.from_file(P.path(token_counts.VOCABULARY)).encode(long).ids)
    for frame in (bpe.encoded(nothing), token_counts.token_counts(nothing), shards.shards(nothing)):
        assert frame.count() == 0
    assert sum(r.n_tokens for r in shards.shards(odd).collect()) == sum(r.n_tokens for r in rows) + 11


def test_permutation():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        p = shards.Permutation(n, 5)
        slots = p.slot(np.arange(n))
        assert sorted(slots) == list(range(n)) and (p.sequence(slots) == np.arange(n)).all()
    assert (shards.Permutation(1000, 1).slot(np.arange(1000)) != shards.Permutation(1000, 2).slot(np.arange(1000))).any()


def in_stream_order(rows):
    """(doc_id, text) rows of distinct ids as the stream has them."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_shards_hold_the_stream_in_training_order(spark, tmp_path):
    texts = list(enumerate(odd_texts(4, 200)))
    docs = documents(spark, texts)
    folders = [str(tmp_path / f"shards{i}") for i in range(2)]
    for folder, frame in zip(folders, (docs.repartition(5), docs.repartition(3, "text"))):
        shards.write_shards(frame, folder, seed=9, length=16, per_shard=50)
    rows, again = (spark.read.parquet(f).orderBy("shard").collect() for f in folders)
    assert [r.payload for r in rows] == [r.payload for r in again]  # the input's partitions don't matter
    stream = np.array([i for _, t in in_stream_order(texts) for i in [*REFERENCE.encode_ordinary(t), shards.END_OF_TEXT]])
    slots = np.concatenate([np.frombuffer(r.payload, "<u2").reshape(-1, 16) for r in rows])
    assert all(len(r.payload) == r.stride * r.n_sequences and r.first_slot == 50 * r.shard for r in rows)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.sha256 for r in rows)
    order = shards.Permutation(len(slots), 9).slot(np.arange(len(slots)))
    back = slots[order].reshape(-1)
    assert (back[:len(stream)] == stream).all() and (back[len(stream):] == shards.END_OF_TEXT).all()
    assert sum(r.n_tokens for r in rows) == len(stream) and len(slots) == -(-len(stream) // 16)
    part = shards.read_slots(spark, folders[0], 30, 90).orderBy("slot").collect()  # resume anywhere
    assert [r.slot for r in part] == list(range(30, 120)) and (np.array([r.ids for r in part]) == slots[30:120]).all()


@pytest.mark.parametrize("last", [shards.END_OF_TEXT, 70_000])
def test_shards_refuse_ids_that_do_not_fit(spark, tmp_path, last):
    path = str(tmp_path / "wide.tiktoken")
    with open(path, "wb") as out:
        for i, b in enumerate(range(256)):
            out.write(base64.b64encode(bytes([b])) + b" %d\n" % (last if i == 255 else i))
    with pytest.raises(ValueError, match=str(last)):
        shards.shards(documents(spark, [(1, "a text")]), path=path)
