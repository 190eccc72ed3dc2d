import numpy as np
from pyspark.sql import functions as F

from llm_helpers import SF0001, documents, nothing, odd  # noqa: F401
from tessera.llm import quality as Q
from tessera.llm import queries as K
from tessera.llm import toxicity as X
from tessera.llm.common import held_out as held_out_id



def auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    rank = np.argsort(np.argsort(s, kind="stable"), kind="stable")
    p = y.sum()
    return (rank[y == 1].sum() - p * (p - 1) / 2) / (p * (len(y) - p))


def held_out(spark, name, column, folder="/root/testdata/sf0.1"):
    rows = K.QUERIES[name](spark, folder).where("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", column)
    got = rows.join(labels, "doc_id").select(column, "score", "predicted").toPandas()
    return got[column], got["score"], got["predicted"]


def test_toxicity_on_held_out_rows(spark):
    y, s, p = held_out(spark, "op3_toxicity", "toxic")
    assert auc(y, s) > 0.9 and (y == p).mean() > 0.94 and s.between(0, 1).all()


def test_toxicity_follows_the_real_share_when_both_labels_are_sampled(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = X.fit(docs, labels, per_class=300)  # 352 toxic and 2803 other training rows
    assert np.isclose(X.share_shift(labels, per_class=300), np.log(352 / 2803))
    assert X.share_shift(labels, per_class=5000) == 0
    got = X.score(docs.join(labels.select("doc_id", "toxic"), "doc_id").where(held_out_id(F.col("doc_id"))), model).toPandas()
    y, s = got["toxic"], got["toxicity"]
    assert auc(y, s) > 0.9 and abs(s.mean() - y.mean()) < 0.04
    assert (s[y == 0] >= 0.5).mean() < 0.03


def test_quality_on_held_out_rows(spark):
    y, s, p = held_out(spark, "op9_quality", "quality")
    assert auc(y, s) > 0.95 and (y == p).mean() > 0.93 and s.between(0, 1).all()
    # calibrated: the mean score is near the share of the label
    assert abs(s.mean() - y.mean()) < 0.05


def test_labels_are_the_only_target(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    a = X.fit(docs, labels)
    b = X.fit(docs.withColumnRenamed("lang", "x").drop("source"), labels.repartition(5))
    assert np.allclose(a.weights, b.weights, atol=1e-4)


def test_odd_rows(odd, nothing, spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    tox = X.fit(docs, labels)
    scored = X.score(odd, tox).collect()
    assert len(scored) == 11 and all(0 <= r.toxicity <= 1 for r in scored)
    assert len({r.toxicity for r in scored if not r.text}) == 1
    kept = X.without_toxic(odd, tox)
    assert kept.schema == odd.schema and kept.count() == sum(r.toxicity < 0.5 for r in scored)
    model = Q.fit(docs, labels)
    again = Q.score(odd, model).collect()
    assert len(again) == 11 and all(0 <= r.quality_score <= 1 for r in again)
    assert X.score(nothing, tox).count() == 0 and Q.score(nothing, model).count() == 0


def test_no_labels_or_one_class(spark, nothing):
    docs = documents(spark, [(i, f"text number {i}") for i in range(20)])
    for rows in ([], [(i, 1, 0) for i in range(20)], [(None, 1, 1), (1, None, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        for frame in (docs, nothing):
            scores = [r.toxicity for r in X.score(docs, X.fit(frame, labels)).collect()]
            assert len(set(scores)) == 1 and scores[0] < 0.5
            same = {r.quality_score for r in Q.score(docs, Q.fit(frame, labels)).collect()}
            assert len(same) == 1 and 0 <= same.pop() <= 1


def test_twice_labelled_and_held_out_ids(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(50)] + [(2, 1, 1)], "doc_id long, quality int, toxic int")
    import zlib
    rows = {r.doc_id: r.y for r in X.training_labels(labels).collect()}
    assert set(rows) == {i for i in range(50) if zlib.crc32(str(i).encode()) % 5}
    assert rows.get(2, 1) == 1 and X.training_labels(labels, per_class=3).count() == 6


def test_an_id_with_many_rows_counts_once(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    toxic = X.training_labels(labels).where("y = 1").orderBy("doc_id").limit(1).select("doc_id")
    later = docs.join(toxic, "doc_id").crossJoin(spark.range(300)).select(
        "doc_id", F.concat("text", F.lit(" more "), F.col("id").cast("string")).alias("text"))
    many = docs.unionAll(later)
    assert later.count() == 300
    a, b = X.fit(docs, labels), X.fit(many, labels)
    assert np.allclose(a.weights, b.weights, atol=1e-4) and np.isclose(a.intercept, b.intercept, atol=1e-4)
    vectors = Q.context_vectors(docs)
    monkeypatch.setattr(Q, "context_vectors", lambda _: vectors)
    a, b = Q.fit(docs, labels).network, Q.fit(many, labels).network
    assert np.allclose(a.centre, b.centre) and np.allclose(a.w1, b.w1, atol=1e-4)


def test_bucket_counts_are_those_of_the_texts(spark):
    rows = [(i % 3 % 2, np.unique(X.ngram_buckets(f"text {i} of {i * i}")).astype(np.int32)) for i in range(60)]
    want = np.zeros((2, 1 << X.BITS), np.int64)
    for y, own in rows:
        want[y, own] += 1
    frame = spark.createDataFrame([(y, bytearray(own.tobytes())) for y, own in rows], "y int, buckets binary")
    assert (X.bucket_counts(frame.repartition(4)) == want).all()


def test_contexts_are_the_same_for_any_partitioning(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    a, b = Q.context_vectors(docs.repartition(1)), Q.context_vectors(docs.repartition(7))
    assert np.allclose(a, b, atol=1e-4)
    whole = Q.Contexts()
    whole.add([(r.text or "").encode() for r in docs.collect()])
    assert np.allclose(a, Q.unit(whole.sums.reshape(Q.BUCKETS, Q.SIZE)), atol=1e-4)
