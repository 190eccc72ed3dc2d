import hashlib
import os
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from llm_helpers import SF0001
from tessera.llm import queries as K
from tessera.llm import vector_codes as V


def plain(rows, parts=8, entries=16, rounds=6):
    """(id, code, error, label_error) and codebooks of (id, label, vector) rows, without bounds."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    d = len(rows[0][2])
    width = -(-d // parts)
    x = np.floor(np.array([r[2] for r in rows], np.float64) * 4096).astype(np.int64)
    x = np.pad(x, ((0, 0), (0, parts * width - d))).reshape(len(rows), parts, width)
    seeds, seen = [], set()
    for i, r in enumerate(rows):
        if r[0] not in seen and len(seeds) < entries:
            seen.add(r[0])
            seeds.append(i)
    books = x[seeds].transpose(1, 0, 2).copy()
    for step in range(rounds + 1):
        distance = ((x[:, :, None] - books[None]) ** 2).sum(-1)
        code = distance.argmin(-1)
        if step < rounds:
            for p in range(parts):
                for j in range(len(seeds)):
                    own = x[code[:, p] == j, p]
                    if len(own):
                        books[p, j] = [int(s) // len(own) for s in own.sum(0)]
    error = distance.min(-1).sum(1)
    by_label = defaultdict(int)
    for r, e in zip(rows, error.tolist()):
        by_label[r[1]] += e
    return sorted(((r[0], "".join(f"{c:02x}" for c in cs), e, by_label[r[1]]) for r, cs, e in
                   zip(rows, code.tolist(), error.tolist())), key=str), books


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, key string")


def test_query_equals_plain_version_and_sql(spark):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect()]
    want, books = plain(rows)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    found = K.QUERIES["op12_vector_codes"](spark, SF0001).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(*w, digest) for w in want], key=str)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{os.path.join(SF0001, 'embeddings.parquet')}'")
    assert sorted(con.sql(K.ORACLE["op12_vector_codes"]).fetchall(), key=str) == sorted([(*w, digest) for w in want], key=str)


@pytest.mark.parametrize("kind", ["clusters", "ties", "few", "uneven"])
def test_bounds_change_nothing(spark, kind):
    r = np.random.default_rng(3)
    if kind == "clusters":
        v = r.normal(size=(8, 24))[r.integers(0, 8, 700)] + r.normal(size=(700, 24)) * 0.2
    elif kind == "ties":  # many equal distances
        v = r.integers(-1, 2, (500, 16)) / 4096
    elif kind == "few":
        v = r.normal(size=(5, 8))
    else:
        v = r.normal(size=(60, 13))
    rows = [(int(i), None if i % 7 == 0 else int(i % 5), np.float32(x).tolist(), "own") for i, x in enumerate(v)]
    want, books = plain([row[:3] for row in rows])
    found = V.vector_codes(table(spark, [(a, b, c, d) for a, b, c, d in rows]).repartition(7))
    assert sorted(map(tuple, found.rows.collect()), key=str) == want and (found.codebooks == books).all()
    again = V.vector_codes(table(spark, rows).repartition(2), rounds=6)
    assert found.sha256() == again.sha256()


def test_bounds_save_work_and_use_net_displacement():
    r = np.random.default_rng(5)
    x = (r.normal(size=(12, 8, 4))[r.integers(0, 12, 4000)] * 3000 + r.normal(size=(4000, 8, 4)) * 300).astype(np.int64)
    history, bounds, rescans = x[:16].transpose(1, 0, 2)[None], V.Bounds.none(len(x), 8), []
    for step in range(6):
        bounds, work = V.assign(x, history, bounds)
        exact = ((x[:, :, None] - history[-1][None]) ** 2).sum(-1)
        assert (bounds.entry == exact.argmin(-1)).all() and sum(work.values()) == x.shape[0] * 8
        rescans.append(work["rescanned"])
        means = [[x[bounds.entry[:, p] == j, p].mean(0) if (bounds.entry[:, p] == j).any() else history[-1][p, j]
                  for j in range(16)] for p in range(8)]
        history = np.concatenate([history, np.floor(means).astype(np.int64)[None]])
    assert rescans[0] == x.shape[0] * 8 and rescans[-1] < rescans[0] / 4
    # An entry that went and came back has moved nowhere, whatever it drifted.
    there = history[:1] + 500
    net, others = V.displacements(np.concatenate([history[:1], there, history[:1]]))
    assert net[0].max() == 0 and others[0].max() == 0 and net[1].min() > 900
    assert V.assign(x, np.concatenate([history[:1], there, history[:1]]), V.assign(x, history[:1], V.Bounds.none(len(x), 8))[0])[1][
        "rescanned"] < x.shape[0] * 8 / 10


def test_odd_rows(spark):
    good = [(i, i % 3, [float(i), -0.5, 0.25, 1.0] * 2, "own") for i in range(20)]
    odd = [(100, 1, None, "own"), (101, 1, [], "own"), (102, 1, [None] * 8, "own"), (103, 1, [float("nan")] * 8, "own"),
           (104, 1, [float("inf")] * 8, "own"), (105, 1, [1.0] * 5, "own"), good[3], (None, None, [0.0] * 8, "own"),
           (7, None, [2.0] * 8, "own")]
    frame = table(spark, good + odd).withColumnRenamed("key", "a.b")
    for name in ("v", "id", "x", "state", "ids", "error", "n"):
        frame = frame.withColumn(name, frame["`a.b`"])
    want, _ = plain([r[:3] for r in good + [odd[6], odd[7], odd[8]]])
    assert sorted(map(tuple, V.vector_codes(frame).rows.collect()), key=str) == want
    assert V.vector_codes(table(spark, [])) is None and V.vector_codes(table(spark, odd[:5])) is None
    with pytest.raises(Exception, match="too large"):
        V.vector_codes(table(spark, [(1, 1, [3e38] * 8, "own")]))
