"""A training-data pipeline over ``documents``: filter, dedupe, decontaminate, redact, tokenize.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns the columns of ``documents`` (the last one: token ids). ``run``
writes each stage's rows as Parquet to the shared checkpoint folder and reads
them for the next, so a lost executor costs tasks of one stage only.

Null and empty texts pass the first stage by the score of an empty text, are one
SimHash group, hold no item and no secret, and end without tokens; of repeated
rows one stays. Texts of any length are handled as a whole, an empty table ends
as one, and further columns of ``documents`` stay until the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, decontaminate, secrets, simhash, toxicity
from tessera.llm.common import read
from tessera.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity classifier rejects go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays."""
    return simhash.one_per_group(docs, k=3, max_bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go."""
    return decontaminate.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each secret in a text is replaced by a mark; ``n_chars`` follows the text."""
    return secrets.redacted(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of each row: token ids and the text that they decode to."""
    return bpe.encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("byte_bpe", tokenize),
]

# Classifier, fingerprint and tokenizer have no SQL form; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents`` one after the other."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
