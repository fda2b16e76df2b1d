"""One query per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.llm.alignment import align_tokens
from clickpulse.llm.decontamination import find_passages
from clickpulse.llm.jaccard_join import similar_groups
from clickpulse.llm.language_id import fit_languages, identify_languages
from clickpulse.llm.licenses import scan_licenses
from clickpulse.llm.lines import judge_lines
from clickpulse.llm.mixing import mix_sources
from clickpulse.llm.page_differencing import extract_pages
from clickpulse.llm.sharding import shuffle_into_shards
from clickpulse.llm.token_counts import count_tokens
from clickpulse.llm.token_files import token_index, write_tokens
from clickpulse.llm.urls import judge_urls
from clickpulse.llm.walsh_clusters import cluster_vectors
from clickpulse.storage import run_dir

# The rules of the URL query.
URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_lines(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "tokens")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    write_tokens(_table(spark, sf_dir, "documents"), path, vocabulary, end=2)
    return token_index(spark, path)


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = fit_languages(docs, fold != 1)
    found = identify_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score")


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shuffle_into_shards(_table(spark, sf_dir, "documents"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return sharded.select(
        "doc_id",
        "size",
        crc.alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(_table(spark, sf_dir, "documents"))


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_licenses(_table(spark, sf_dir, "documents"))
    return scanned.select("doc_id", "digest", "license")


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(_table(spark, sf_dir, "embeddings"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return count_tokens(_table(spark, sf_dir, "documents"), model)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_blocks": tokens,
    "op2_language_crf": languages,
    "op3_fm_index": contamination,
    "op4_line_quality": quality_lines,
    "op5_page_differencing": page_texts,
    "op6_pareto_mixture": mixture,
    "op7_two_pass_shuffle": shards,
    "op8_jaccard_join": near_duplicates,
    "op9_license_digests": licenses,
    "op10_url_vocabulary": urls,
    "op11_token_alignment": alignments,
    "op12_walsh_clusters": clusters,
    "op13_token_counts": token_counts,
}
