"""Numbered loads of a table, and how far each reader of them has come.

A table that only grows is partitioned by the number of the load that added a row. A load counts when its number is in the
`loads` table next to it, which is written last; a reader keeps the numbers it has taken in a table of its own. What is new is then
whole partitions, known before the table is read. These tables have one row a load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.workspace import path_exists

LOAD = "load"
_TYPE = f"{LOAD} BIGINT"


def numbers(spark: SparkSession, path: str) -> set[int]:
    """The loads that the table at `path` lists."""
    if not path_exists(spark, path):
        return set()
    return {r[LOAD] for r in spark.read.schema(_TYPE).parquet(path).collect()}


def next_number(spark: SparkSession, path: str) -> int:
    return max(numbers(spark, path), default=0) + 1


def mark(spark: SparkSession, path: str, done: set[int]) -> None:
    if done:
        spark.createDataFrame([(n,) for n in sorted(done)], _TYPE).coalesce(1).write.mode("append").parquet(path)


def of_loads(rows: DataFrame, wanted: set[int]) -> DataFrame:
    """The rows of some loads: the numbers are literals, so no other partition is listed or read."""
    return rows.where(F.col(LOAD).isin(sorted(wanted)) if wanted else F.lit(False))


def with_load(rows: DataFrame, number: int) -> DataFrame:
    return rows.withColumn(LOAD, F.lit(number).cast("bigint"))

