import public_tokenizers as P
import tiktoken

from llm_helpers import SF0001, components_of, documents, nothing, odd  # noqa: F401
from test_secrets import spans
from test_simhash import plain_fingerprint
from tessera.llm import bpe, decontaminate, toxicity

import corpus_pipeline



def plain_run(docs, items, model):
    """The stages' rows, in plain Python, from (doc_id, text) rows; the classifier's scores are given."""
    docs = [(i, t) for i, t in docs if model.score(t or "") < 0.5]
    prints = {i: plain_fingerprint(t) for i, t in docs}
    edges = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    root = components_of(sorted(prints), edges)
    docs = [(i, t) for i, t in docs if root[i] == i]
    wanted = [decontaminate.shingles((t or "").encode()) for _, t in items]
    docs = [(i, t) for i, t in docs if not any(
        w and len(w & decontaminate.shingles((t or "").encode())) >= 0.8 * len(w) for w in wanted)]
    out = {}
    for i, t in docs:
        at, parts = 0, []
        for a, _, b in spans(t or ""):
            if b > at:
                if a >= at:
                    parts += [t[at:a], "[secret]"]
                at = b
        out[i] = "".join([*parts, (t or "")[at:]])
    return out


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").select("item_id", "text").collect()]
    want = plain_run([(r.doc_id, r.text) for r in docs.collect()], items, toxicity.fit(docs, labels))
    rows = corpus_pipeline.run(spark, SF0001).collect()
    assert {r.doc_id: r.decoded.decode() for r in rows} == want and 0 < len(rows) < docs.count()
    model = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path(bpe.VOCABULARY)),
                              special_tokens={})
    assert all(r.ids == model.encode_ordinary(want[r.doc_id]) for r in rows)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "secrets", "byte_bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF0001).schema.simpleString() == docs.schema.simpleString()


def test_odd_rows_and_no_rows(spark, odd, nothing):
    for frame in (odd, nothing):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF0001)
        assert docs.count() <= frame.count()
    clean = documents(spark, [(1, "a plain text of some words"), (2, "another one, quite unlike the first")])
    docs = clean
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF0001)
    assert {r.doc_id for r in docs.collect()} == {1, 2}
