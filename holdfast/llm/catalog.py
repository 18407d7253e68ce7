"""Named queries of the operators over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import bpe, infill, language, lines, minhash, packing, phrases, quality, secrets, shards, topk, toxicity, vector_dedup
from holdfast.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, then its ids decoded; both as digests."""
    both = bpe.decode(bpe.encode(documents(spark, sf_dir)))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"),
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best others of every hundredth vector."""
    return topk.top_k(embeddings(spark, sf_dir), F.col("vec_id") % 100 == 0)


def op3_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and representative of every vector."""
    return vector_dedup.near_vectors(embeddings(spark, sf_dir))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of known shapes and strings that look random, in every text."""
    spans = F.col("spans")
    base = secrets.base_only(spans)
    return secrets.scan(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        *[secrets.count_of(spans, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(spans).alias("spans"),
    )


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents along a Hilbert curve over language, source and length, cut into 24 runs."""
    placed = shards.assign(documents(spark, sf_dir), ["lang", "source", "n_chars"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates of every document; its smallest document is kept."""
    found = minhash.near_duplicates(documents(spark, sf_dir))
    return found.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    pieces = packing.pack_texts(documents(spark, sf_dir))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("piece").alias("ids_crc32"),
        F.col("n_tokens").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learned from trusted positives and unlabelled text."""
    return quality.rate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the lines that an earlier document holds."""
    return lines.drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text."""
    return language.identify(documents(spark, sf_dir))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from labelled ones."""
    return toxicity.rate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best collocations."""
    return phrases.collocations(documents(spark, sf_dir))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut and put in another order, and rebuilt from that; both as digests."""
    both = infill.restore(infill.rearrange(documents(spark, sf_dir)))
    return both.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_topk": op2_topk,
    "op3_vectors": op3_vectors,
    "op4_secrets": op4_secrets,
    "op5_shards": op5_shards,
    "op6_minhash": op6_minhash,
    "op7_packing": op7_packing,
    "op8_quality": op8_quality,
    "op9_lines": op9_lines,
    "op10_language": op10_language,
    "op11_toxicity": op11_toxicity,
    "op12_phrases": op12_phrases,
    "op13_infill": op13_infill,
}
