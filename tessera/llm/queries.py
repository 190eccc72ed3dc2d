"""Registered queries of the operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, decontaminate, embeddings, packing, quality, secrets, shards, simhash, suffix_dedup, token_counts, toxicity, vector_codes
from .common import held_out, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(oracle: str | None = None):
    def keep(query):
        QUERIES[query.__name__] = query
        if oracle:
            ORACLE[query.__name__] = oracle
        return query
    return keep


@register()
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents"), k=3, max_bits=3)


@register()
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removed_spans(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@register()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


@register()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encoded(read(spark, sf_dir, "documents"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select("doc_id", "n_tokens", F.sha2(listed, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@register()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts.token_counts(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@register()
def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shards(read(spark, sf_dir, "documents"))


@register(secrets.ORACLE)
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def n(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kinds = [r.kind for r in secrets.BASE]
    base = secrets.listed(F.filter("secrets", lambda s: s["kind"].isin(kinds)))
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(base, 256).alias("base_sha256"),
                        secrets.listed(F.col("secrets")).alias("spans"))


@register(decontaminate.ORACLE)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))


@register()
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


@register()
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(read(spark, sf_dir, "documents"))


@register(vector_codes.ORACLE)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.vector_codes(read(spark, sf_dir, "embeddings"))
    if found is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    return found.rows.withColumn("codebooks_sha256", F.lit(found.sha256()))


@register()
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.linked(read(spark, sf_dir, "documents"))
