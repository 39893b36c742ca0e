"""Registered queries of this subpackage: each applies one operator to its whole table."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressledger.llm import alignment, exactdup, langid, manifest, mixing, neardup, packing, pii, quality, secrets, tokencount, topk, toxicity
from pressledger.llm.pretokens import vocabulary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_inner_products(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_quality(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _of_kind(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] != "random")
    counts = [_of_kind(k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"), vocabulary())


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *(_of_kind(k).alias(f"n_{k}") for k in pii.BASE),
        F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify_languages(docs, langid.fit(docs))


#: The check of the manifest: which rows are tampered with, and how their text changes.
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    built = manifest.build_manifest(
        _table(spark, sf_dir, "documents"), tampered, lambda text: F.translate(text, CAPITALS, CAPITALS.lower())
    )
    proof = F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256")
    return manifest.prove(built).select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(_table(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("").alias("groups_sha256")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_groups(_table(spark, sf_dir, "documents"))


QUERIES = {"op1_toxicity": op1_toxicity, "op2_exact_topk": op2_exact_topk, "op3_mixing": op3_mixing, "op4_quality": op4_quality, "op5_packing": op5_packing, "op6_secrets": op6_secrets, "op7_token_counts": op7_token_counts, "op8_near_duplicates": op8_near_duplicates, "op9_personal_data": op9_personal_data,
    "op10_language_id": op10_language_id, "op11_manifest": op11_manifest, "op12_alignment": op12_alignment, "op13_exact_dedup": op13_exact_dedup}
