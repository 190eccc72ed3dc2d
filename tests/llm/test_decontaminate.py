import random

import pytest

from llm_helpers import SF0001, documents, nothing, odd  # noqa: F401
from tessera.llm import decontaminate as D

SYLLABLES = ["ka", "lo", "mi", "ne", "pu", "ra", "si", "to", "vu", "we"]


def words(r, n):
    return ["".join(r.choices(SYLLABLES, k=3)) for _ in range(n)]


def brute(docs, items):
    out = {}
    for d, text in docs:
        own = D.shingles((text or "").encode())
        for i, item in items:
            wanted = D.shingles((item or "").encode())
            shared = len(own & wanted)
            run = next(iter(wanted), ())
            if 0 < len(run) < D.K:
                words = D.WORD.findall((text or "").encode().lower())
                shared = int(any(tuple(words[j:j + len(run)]) == run for j in range(len(words))))
            if wanted and shared >= 0.8 * len(wanted):
                out[d, i] = (shared, len(wanted))
    return out


def found(spark, docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): (r.n_shared, r.n_item)
            for r in D.contaminated(documents(spark, docs).repartition(3), benchmark).collect()}


def data(seed):
    r = random.Random(seed)
    items = [(i, " ".join(words(r, r.choice([1, 2, 3, 4, 5, 8, 20, 60, 150, 700])))) for i in range(40)]
    docs = []
    for d in range(120):
        body = words(r, r.choice([0, 4, 50, 3000]))
        for _ in range(r.randint(0, 3)):
            item = r.choice(items)[1].split()
            keep = [w if r.random() > 0.01 else "changed" for w in item]
            if r.random() < 0.3:  # in two places
                cut = len(keep) // 2
                at = r.randint(0, len(body))
                body = keep[:cut] + body[:at] + keep[max(0, cut - 4):] + body[at:]
            else:
                at = r.randint(0, len(body))
                body[at:at] = keep
        docs.append((d, ". ".join([" ".join(body[:100]), " ".join(body[100:]).upper()])))
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_finds_what_brute_force_finds(spark, seed):
    docs, items = data(seed)
    want = brute(docs, items)
    assert found(spark, docs, items) == want and len(want) > 30


def test_blocks_of_items(spark, monkeypatch):
    docs, items = data(7)
    want = brute(docs, items)
    monkeypatch.setattr(D, "BLOCK_SHINGLES", 2000)
    assert len(list(D.blocks(spark.createDataFrame(items, "item_id long, text string")))) > 3
    assert found(spark, docs, items) == want
    frame = documents(spark, docs)
    kept = {r.doc_id for r in D.without_contaminated(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_items_of_few_words_are_found_inside_long_documents(spark, tmp_path):
    import duckdb
    docs = [(1, "x y Alpha beta, gamma z w"), (2, "alpha beta"), (3, "alpha beta x gamma"), (4, "gamma"), (5, "alphabeta gamma"),
            (6, "w " * 5000 + "alpha BETA gamma " + "z " * 5000), (7, None), (8, "alpha beta gamma")]
    items = [(1, "alpha beta gamma"), (2, "Gamma!"), (3, "beta gamma z w"), (4, "not there")]
    want = brute(docs, items)
    assert found(spark, docs, items) == want
    assert set(want) == {(1, 1), (6, 1), (8, 1), (1, 2), (3, 2), (4, 2), (5, 2), (6, 2), (8, 2), (1, 3)}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert {(r[0], r[1]): (r[2], r[3]) for r in con.execute(D.ORACLE).fetchall()} == want


def test_oracle(spark):
    from oracle_check import duck
    from tessera.llm import queries as K
    got = sorted(tuple(r) for r in K.QUERIES["op8_decontamination"](spark, SF0001).collect())
    assert got == sorted(duck(SF0001).execute(K.ORACLE["op8_decontamination"]).fetchall()) and got


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (None, "one two three four five six"), (5, "!!"),
                                   (5, "One, two; three four five six")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in D.contaminated(odd, items).collect()), key=str)
    pairs = [(4, 3), (4, 3), (8, 3), (None, 3), (8, None), (8, 5), (None, None), (None, 5)]
    assert got == sorted(pairs, key=str)
    kept = D.without_contaminated(odd, items)
    assert kept.schema == odd.schema and kept.count() == 7
    assert D.contaminated(nothing, items).count() == 0 and D.contaminated(odd, items.limit(0)).count() == 0
    assert D.without_contaminated(odd, items.limit(0)).count() == 11
