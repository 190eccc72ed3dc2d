import numpy as np
import pytest

from llm_helpers import components_of
from tessera.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    good = {}
    for i, v in rows:
        if v and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(np.array(v, np.float32), np.float64)
            good[i] = x / np.linalg.norm(x)
    ids = sorted(good)
    edges = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.9 - 1e-12]
    count = {i: 0 for i, _ in rows}
    for a, b in edges:
        count[a] += 1
        count[b] += 1
    root = components_of([i for i, _ in rows], edges)
    return {i: (count[i], root[i]) for i, _ in rows}


def vectors(seed, n=300, d=48):
    r = np.random.default_rng(seed)
    rows = []
    for _ in range(n // 10):
        base = r.normal(size=d)
        for _ in range(10):
            rows.append(base + r.normal(size=d) * r.choice([0.0, 0.1, 0.3, 0.6]))
    rows += list(r.normal(size=(50, d)))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("block,d", [(2048, 48), (7, 64), (40, 5)])
def test_links_and_components(spark, monkeypatch, block, d):
    monkeypatch.setattr(E, "BLOCK", block)
    rows = vectors(block, d=d)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_duplicates(df).collect()}
    want = brute(rows)
    same = sum(got[i] == want[i] for i in want)
    assert same / len(want) > 0.98, same
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())


def test_recall_at_the_threshold():
    r = np.random.default_rng(3)
    x = r.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    n = r.normal(size=x.shape)
    n -= (n * x).sum(1)[:, None] * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * n / np.linalg.norm(n, axis=1)[:, None]
    met = np.zeros(len(x), bool)
    for t in range(E.TABLES):
        a, b = E.table_keys(x, t), E.table_keys(y, t)
        met |= (a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)
    assert met.mean() > 0.99


def test_odd_vectors(spark):
    same = [0.5, -0.25, 1.0, 0.0]
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0, 0.0], 0), (4, [1.0, None, 0.0, 0.0], 0),
            (5, [float("nan"), 1.0, 0.0, 0.0], 0), (6, [float("inf"), 1.0, 0.0, 0.0], 0), (7, same, 0), (7, same, 1),
            (8, [2 * x for x in same], None), (9, [-x for x in same], 0), (None, same, 0), (10, same[:3], 0), (11, [3e38] * 4, 0),
            (12, [-0.0, 0.0, 1e-30, 0.0], 0)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept)
                  for r in E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 10, 11, 12)]
    assert got == sorted(alone + [(7, 3, 7, True)] * 2 + [(8, 3, 7, False), (None, 3, 7, False)], key=str)
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_group_of_copies_is_one_vector(spark):
    df = spark.range(3000).selectExpr("id AS vec_id", "array(float(1), float(2), float(id DIV 2990)) AS embedding", "0 AS label")
    got = {(r.n_links, r.component_id) for r in E.near_duplicates(df).where("vec_id < 2990").collect()}
    assert got in ({(2999, 0)}, {(2989, 0)})
