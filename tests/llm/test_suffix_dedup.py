import collections
import hashlib
import random

import numpy as np
import pytest

from llm_helpers import documents, nothing, odd  # noqa: F401
from tessera.llm import suffix_dedup as S


def covered(texts, width=S.WIDTH):
    """Bytes of each text that lie in a string of ``width`` bytes that starts elsewhere too."""
    seen = collections.Counter(t[i:i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] > 1:
                mask[i:i + width] = True
        out.append(mask)
    return out


def corpus(seed):
    r = random.Random(seed)
    passages = [bytes(r.choices(b"abcdefg ", k=r.randint(150, 900))) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(r.randint(1, 4)):
            kind = r.random()
            if kind < 0.5:
                parts.append(bytes(r.choices(b"abcdefg ", k=r.randint(0, 500))))
            elif kind < 0.9:
                p = r.choice(passages)
                a = r.randint(0, len(p) // 2)
                p = bytearray(p[a:r.randint(a, len(p))])
                if p and r.random() < 0.4:
                    p[r.randrange(len(p))] = ord("x")
                parts.append(bytes(p))
            else:
                parts.append(bytes([r.choice(b"xy")]) * r.randint(0, 700))
        texts.append(b"".join(parts))
    return texts + [texts[0], texts[1], texts[1], b"", b"ab" * 400]


@pytest.mark.parametrize("seed", range(4))
def test_maximal_repeats_have_all_occurrences(seed):
    texts = corpus(seed)
    mask = [np.zeros(len(t), bool) for t in texts]
    for length, member, offset in S.repeat_groups(texts):
        strings = {texts[m][o:o + length] for m, o in zip(member, offset)}
        assert len(strings) == 1 and len(member) > 1 and length >= S.WIDTH
        (string,) = strings
        everywhere = {(m, i) for m, t in enumerate(texts) for i in range(len(t)) if t.startswith(string, i)}
        assert everywhere == set(zip(member.tolist(), offset.tolist()))
        left = {texts[m][o - 1] if o else None for m, o in zip(member, offset)}
        assert len(left) > 1 or None in left
        right = {texts[m][o + length] if o + length < len(texts[m]) else None for m, o in zip(member, offset)}
        assert len(right) > 1 or None in right
        for m, o in zip(member, offset):
            mask[m][o:o + length] = True
    assert all((a == b).all() for a, b in zip(mask, covered(texts)))


def check(spark, texts, parts=3):
    df = documents(spark, [(i, t.decode()) for i, t in enumerate(texts)]).repartition(parts)
    masks = covered(texts)
    for r in S.removed_spans(df).collect():
        t, mask = texts[r.doc_id], np.zeros(len(texts[r.doc_id]), bool)
        for s in r.spans:
            mask[s.start:s.end] = True
        assert (mask == masks[r.doc_id]).all() and r.n_bytes == len(t)
        assert r.kept_sha256 == hashlib.sha256(np.frombuffer(t, np.uint8)[~mask].tobytes()).hexdigest()
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


@pytest.mark.parametrize("split_over,array_bytes", [(8192, 1 << 19), (2, 1 << 19), (8192, 2000)])
def test_removal_matches_brute_force(spark, monkeypatch, split_over, array_bytes):
    monkeypatch.setattr(S, "SPLIT_OVER", split_over)
    monkeypatch.setattr(S, "ARRAY_BYTES", array_bytes)
    check(spark, corpus(split_over + array_bytes))


def test_multibyte_text(spark):
    r = random.Random(5)
    passage = "".join(r.choices("éà漢字 abc", k=150))
    texts = ["".join(r.choices("éà漢字 abc", k=80)) + passage + x for x in ("", "ß" * 50, "zz")]
    check(spark, [t.encode() for t in texts])


def test_odd_rows(odd, nothing):
    got = S.removed_spans(odd).collect()
    assert len(got) == 11
    by_id = {r.doc_id: r for r in got}
    empty = hashlib.sha256(b"").hexdigest()
    for i in (1, 2):
        assert by_id[i].n_bytes == 0 and by_id[i].spans == [] and by_id[i].kept_sha256 == empty
    assert by_id[5].spans == [(0, 30_000)] and by_id[6].spans == [(0, 40_000)]  # they repeat themselves throughout
    assert by_id[4].spans == [] and by_id[7].n_bytes == len("Ünï çødé 漢字 😀 !?".encode())
    assert S.removed_spans(nothing).count() == 0


def test_a_repeated_row_loses_all(spark):
    text = "".join(random.Random(2).choices("abcdefgh ", k=700))
    df = documents(spark, [(1, text), (1, text), (2, text[:199])])
    assert sorted((r.doc_id, len(r.spans), r.n_bytes) for r in S.removed_spans(df).collect()) == [
        (1, 1, 700), (1, 1, 700), (2, 0, 199)]


def groups_of(frame):
    out = collections.defaultdict(list)
    for r in S.repeats(frame).collect():
        out[r.group_id].append(r)
    return out


@pytest.mark.parametrize("split", [S.SPLIT_OVER, 1])
def test_repeat_groups_through_spark(spark, monkeypatch, split):
    monkeypatch.setattr(S, "SPLIT_OVER", split)
    texts = corpus(5)
    groups = groups_of(documents(spark, [(i, t.decode()) for i, t in enumerate(texts)]).repartition(3))
    mask = [np.zeros(len(t), bool) for t in texts]
    for rows in groups.values():
        length, n = rows[0].length, rows[0].n
        assert {(r.length, r.n) for r in rows} == {(length, n)} and n == len(rows) > 1 and length >= S.WIDTH
        (string,) = {texts[r.doc_id][r.start:r.start + length] for r in rows}
        assert len(string) == length
        everywhere = {(m, i) for m, t in enumerate(texts) for i in range(len(t) - length + 1) if t.startswith(string, i)}
        assert everywhere == {(r.doc_id, r.start) for r in rows}
        for r in rows:
            mask[r.doc_id][r.start:r.start + length] = True
    assert all((a == b).all() for a, b in zip(mask, covered(texts)))


@pytest.mark.parametrize("split", [S.SPLIT_OVER, 1])
def test_long_repeats_are_one_group(spark, monkeypatch, split):
    monkeypatch.setattr(S, "SPLIT_OVER", split)
    r = random.Random(3)

    def own(n):
        return "".join(r.choices("abcdefghijklmnop ", k=n))

    long, copy, short = own(3000), own(1500), own(199)
    docs = [(1, own(400) + "X" + long + "Y" + own(300)), (2, own(100) + "Z" + long + "W" + own(700)), (3, "Q" + long + "R" + own(9)),
            (4, copy), (5, copy), (5, copy), (6, own(300) + short), (7, short + own(300))]
    groups = groups_of(documents(spark, docs))
    found = sorted((rows[0].length, sorted((x.doc_id, x.start) for x in rows)) for rows in groups.values())
    assert found == [(1500, [(4, 0), (5, 0), (5, 0)]), (3000, [(1, 401), (2, 101), (3, 1)])]


def test_repeat_groups_of_odd_rows(odd, nothing):
    rows = S.repeats(odd).collect()
    assert {r.doc_id for r in rows} == {5, 6, 9} and S.repeats(nothing).count() == 0
