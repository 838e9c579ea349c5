"""The queries of this package: one thin query an operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_chunks, curriculum, jpeg, license_scan, ppm, simhash, spann, suffix_dedup, token_count, toxicity
from .common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_texts(docs, toxicity.fit_grammar(docs, table(spark, sf_dir, "labels")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(table(spark, sf_dir, "documents")).drop("spans")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mix(table(spark, sf_dir, "documents")).withColumns({c: F.round(c, 6) for c in ("target", "position")})


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg.media_features(table(spark, sf_dir, "documents"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spann.nearest(table(spark, sf_dir, "embeddings"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_texts(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_chunks.encode_digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_simhash, op3_licenses, op4_mixing, op5_media, op6_ann, op7_suffix_dedup, op8_lm_score, op9_bpe, op10_token_counts, pipeline)}


def oracle_sql() -> dict[str, str]:
    """SQL where it can say all columns; hashes, learned models and library encoders have no SQL form, so tests hold those queries against brute-force versions."""
    return {"op4_mixing": curriculum.MIX_SQL}
