"""Documents to packed training sequences: reject toxic ones, drop exact and near copies, drop benchmark leaks, pack.

Each stage works on all that the one before kept. All but the last return the columns of `documents`; the last returns the pieces of
the packed sequences. Null, empty, repeated and very long texts are handled as the operators define; extra columns pass through
all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creaseline.llm import decontaminate, exact_dedup, near_dup, packing, toxicity
from creaseline.llm.common import staged, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that score 0.7 or more go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of equal texts, the one with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of documents linked by 0.8 of their five-word shingles, the one with the smallest id stays."""
    return near_dup.keep_one(docs, width=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents with ten consecutive words of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: pieces of at most 1024 tokens, and the sequence and place of each."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

#: A trained model decides in the first stage, which SQL cannot express; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = staged(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
