"""Queries of the operators for training data, one per operator, and their SQL.

Each query applies its operator with production parameters to the whole of
its table. ``SQL`` holds DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecdex.llm import (exact_dedup, minmax_dedup, mixing, packing, piece_bpe, pu_classifier, quality_rules, secret_scan, sharding,
                        spelling, token_counts, token_files, whitening)
from vecdex.llm.tokens import vocabulary
from vecdex.session import scratch_path
from vecdex.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.quality_rules(docs, carry=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL["op1_quality_rules"] = quality_rules.SQL


@query
def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.document_pieces(table(spark, sf_dir, "documents")))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_files(table(spark, sf_dir, "documents"), path)
    return token_files.read_files(spark, path)


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_classifier.quality_scores(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.kept_ids(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("text_digest")).alias("text_sha256"))


SQL["op6_exact_dedup"] = exact_dedup.SQL


@query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.hilbert_shards(docs, ["lang", "source", "n_chars"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert")


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return secret_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *[secret_scan.n_of(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(F.encode(secret_scan.written(base), "UTF-8"), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"))


@query
def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken")


SQL["op10_mix"] = mixing.SQL


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = piece_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.encode(F.array_join("ids", ","), "UTF-8"), 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))
