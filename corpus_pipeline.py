"""Corpus pipeline over ``documents``: five stages, each one of the corpus operators.

``run`` writes each stage's result as Parquet in the shared folder and reads it back, so
a stage's lineage ends where the next begins and a lost executor repeats one stage's tasks
at most.  Every stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txwatch.llm import decontaminate, packing, quality_rules, secret_scans, simhash_dedup
from txwatch.llm.catalog import vocabulary
from txwatch.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id stays."""
    return simhash_dedup.deduplicated(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; of the others benchmark passages are cut."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return secret_scans.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in a training sequence."""
    return packing.packed(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("secret scans", secrets),
    ("packing", pack),
]

#: SQL can't express linked groups of fingerprints, nor packing; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return staged(STAGES[-1][1](spark, docs, sf_dir), "packed")
