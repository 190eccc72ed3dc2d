import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm_helpers import ODD_ROWS, SF0001, documents, nothing, odd  # noqa: F401
from tessera.llm import alignment, units
from tessera.llm import queries as K
from tessera.llm.bpe import byte_characters

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
PIECES = list("abc de\n\n\t .,!'s1é漢😀\r　\x1c▁") + ["<|endoftext|>", "don't", "  ", ";\r", "</s>", " \t", "the ", "▁ "]


class Plain:
    """Groups and links of whole texts, and counts over all of them."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        back = {c: b for b, c in byte_characters().items()}
        self.bytes_a = {i: bytes(back.get(c, 0) for c in t) for t, i in self.a.get_vocab().items()}

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, self.bytes_a[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
             for i in self.b.encode(text) for p in [self.b.id_to_piece(i)]]
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == b"".join(x for _, x in b) == whole else ([], [])

    def groups(self, text):
        sides = self.tokens(text)
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in sides]
        common = sorted(set(ends[0]) & set(ends[1]))
        out = [([], []) for _ in common]
        for k, side in enumerate(sides):
            for (i, _), end in zip(side, ends[k]):
                out[bisect_left(common, end)][k].append(i)
        return len(sides[0]), len(sides[1]), out

    def rows(self, docs):
        found = [(doc_id, *self.groups(text)) for doc_id, text in docs]
        counts = Counter((g[0][-1], g[1][-1]) for f in found for g in f[3])
        best = {}
        for (_, b), n in counts.items():
            best[b] = max(best.get(b, 0), n)
        out = []
        for doc_id, n_a, n_b, groups in found:
            links = [(g[0][-1], g[1][-1]) for g in groups]
            text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
            out.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                        sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if n_a else ""))
        return sorted(out, key=str)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query(spark, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    assert found(K.QUERIES["op13_alignment"](spark, SF0001)) == plain.rows(docs)


@pytest.mark.parametrize("hot", [alignment.HOT_PAIRS, 4, 1])
def test_odd_texts_with_hot_and_rare_pairs(spark, plain, monkeypatch, hot):
    monkeypatch.setattr(alignment, "HOT_PAIRS", hot)
    r = random.Random(7)
    docs = [(i, "".join(r.choices(PIECES[:r.choice([15, len(PIECES)])], k=r.randint(0, 40)))) for i in range(300)] + [
        (-1, None), (-2, ""), (-3, " "), (-4, "▁"), (-5, "a▁b"), (-6, "\n"), (-7, "\0"), (-8, "a" * 500)]
    frame = documents(spark, docs).repartition(5)
    assert found(alignment.linked(frame)) == plain.rows(docs)


def test_units_and_whole_texts_agree(plain, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(units, "KEPT_UNITS", 50)
    monkeypatch.setattr(units, "STEP_UNITS", 40)
    own, r = alignment.Aligner(A, B), random.Random(1)
    for _ in range(30):
        batch = ["".join(r.choices(PIECES, k=r.randint(0, 60))) for _ in range(20)]
        totals, spelled, bounds, links = own.aligned(pa.array(batch))
        for t, n, s in zip(batch, totals.tolist(), spelled):
            n_a, n_b, groups = plain.groups(t)
            assert n == [n_a, n_b, len(groups)], t
            assert s.decode() == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)


def test_long_pieces_are_spliced(monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 60)
    monkeypatch.setattr(alignment, "OVERLAP_BYTES", 8)
    own, r = alignment.PieceEncoder(B), random.Random(2)
    texts = ["".join(r.choices(kind, k=900)) for kind in ("ab", "abcdefghij", "é漢a", "x", "漢字語", "<>()a;\n", "abc  ") for _ in range(8)]
    for t in texts:
        assert own.long(t.encode()).tolist() == own.model.encode(t), t


def test_odd_rows(odd, nothing, plain):
    assert found(alignment.linked(odd)) == plain.rows(ODD_ROWS)
    assert alignment.linked(nothing).count() == 0
