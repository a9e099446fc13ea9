"""The training-data pipeline: five stages over ``documents``, each one operator of ``fieldnotes.llm``.

Each stage takes what its predecessor kept, as Parquet in the shared folder, and
its decisions take effect: rejected documents and repeated lines go, one document
of each near-duplicate group stays (the one with the smallest id), documents that
hold benchmark items go, and the mix says how often each document is taken;
documents that it does not take go too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldnotes.llm import lines, mixing, quality, simhash, templates
from fieldnotes.llm.util import cut, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: SQL has no zstd, MinHash or XXH64 shingles; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
