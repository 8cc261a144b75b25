"""Registered queries of the corpus operators and the SQL twins of those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocations, decontaminate, language_id, license_scans, lm_scoring, nearest, oracle, packing,
               quality_rules, secret_scans, simhash_dedup, spelling, substring_dedup, token_files)
from .common import table


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file, here and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = substring_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", language_id.held_out(F.col("doc_id")).alias("held_out"))
    model = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.predicted(docs.select("doc_id", "held_out", "text"), model)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = token_files.written(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return df.select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = decontaminate.judged(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              table(spark, sf_dir, "benchmark"))
    return df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / doc_id div 10000 / doc_id div 100 / doc_id."""
    own = F.col("doc_id")
    path = F.concat_ws("/", "source", F.floor(own / 10000).cast("string"), F.floor(own / 100).cast("string"),
                       own.cast("string"))
    files = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return license_scans.scanned(files)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"),
                             mass=lm_scoring.add_one_mass)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = simhash_dedup.grouped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return df.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.scanned(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return df.drop("lang", "class_distance", "word_distance")


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_token_files": op3_token_files,
    "op4_decontaminate": op4_decontaminate,
    "op5_license_scans": op5_license_scans,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_packing": op7_packing,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_secret_scans": op9_secret_scans,
    "op10_quality_rules": op10_quality_rules,
    "op11_nearest": op11_nearest,
    "op12_spelling": op12_spelling,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op4_decontaminate": oracle.DECONTAMINATE,
    "op10_quality_rules": oracle.quality(
        quality_rules.COMMON_WORDS, quality_rules.MIN_JUDGED_WORDS,
        quality_rules.MIN_CHARS, quality_rules.MAX_WORD_DISTANCE, quality_rules.MAX_CLASS_DISTANCE),
    "op11_nearest": oracle.NEAREST,
    "op13_collocations": oracle.collocations(collocations.MIN_COUNT, collocations.ABSORBED, collocations.TOP),
}
