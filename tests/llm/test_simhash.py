import numpy as np
import pytest
import xxhash

from llm_helpers import SF0001, components_of, nothing, odd  # noqa: F401
from tessera.llm import simhash as S


def plain_fingerprint(text, k=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \t\n", "One", "one two", "A b C d e f", "é x y z É", "a b c " * 50])
def test_fingerprint_is_the_plain_one(text):
    assert S.fingerprint(text.encode()) == plain_fingerprint(text)


def near(base, bits, rng):
    out = int(base)
    for b in rng.choice(64, bits, replace=False):
        out ^= 1 << int(b)
    return out


@pytest.mark.parametrize("max_bits,split_over", [(3, 4096), (3, 3), (1, 2), (5, 4096)])
def test_links_give_the_components_of_all_pairs(spark, monkeypatch, max_bits, split_over):
    monkeypatch.setattr(S, "SPLIT_OVER", split_over)
    rng = np.random.default_rng(max_bits)
    values = {0, (1 << 64) - 1}
    for base in rng.integers(0, 1 << 63, 30, dtype=np.uint64):
        values |= {int(base)} | {near(base, int(rng.integers(1, max_bits + 3)), rng) for _ in range(12)}
    values = sorted(values)
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long").repartition(4)
    edges = [(int(np.int64(r.u).view(np.uint64)), int(np.int64(r.v).view(np.uint64))) for r in S.links(df, max_bits).collect()]
    want = components_of(values, [(a, b) for i, a in enumerate(values) for b in values[i + 1:] if (a ^ b).bit_count() <= max_bits])
    assert components_of(values, edges) == want


def test_a_dense_group_keeps_few_edges(spark):
    # 4,000 fingerprints around one: a spanning forest per bucket, not all pairs
    rng = np.random.default_rng(1)
    values = sorted({near(12345, int(rng.integers(1, 3)), rng) for _ in range(4000)})
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    assert S.links(df, 3).count() <= 8 * len(values)


def test_groups_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    edges = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = components_of(sorted(prints), edges)
    got = S.simhash_groups(docs).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == want
    assert sum(r.representative for r in got) == len(set(want.values()))


def test_odd_rows(odd, nothing):
    got = S.simhash_groups(odd).collect()
    assert len(got) == 11
    by_id = {r.doc_id: r for r in got}
    zero = "0" * 16
    assert {by_id[i].fingerprint for i in (1, 2, 3)} == {zero} and {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert by_id[None].fingerprint == by_id[8].fingerprint and by_id[None].component_id == 8
    kept = S.one_per_group(odd)
    assert kept.columns == odd.columns and kept.count() == len({r.component_id for r in got})
    assert S.simhash_groups(nothing).count() == 0 and S.one_per_group(nothing).count() == 0
