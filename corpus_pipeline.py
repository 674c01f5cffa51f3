"""From raw documents to a training mix: five stages, each written and read again.

Every stage works on all rows that the one before it kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm import decontaminate, lines, mixing, ranking, simhash
from fieldgauge.session import materialise


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents below the cut of the pairwise quality ranking."""
    return ranking.keep_good(docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs; every document stays."""
    found = lines.dedup_lines(docs)
    length = F.when(F.col("n_deleted") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more lies inside benchmark windows."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each document as often as its source's target asks, with a copy number."""
    return mixing.emit(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: fitting and fingerprints have no SQL; tests compare the stages with plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
