"""The table that has each live ball once, split so that a micro-batch reads only the partitions it touches.

A ball's partition follows from its match alone: `match_day`, the day on which the first ball of the match was seen, and `bucket`, a hash of the
match. A ball polled again days later so falls where it was stored first. The days are kept in a small table with one row per match, next to the
table of balls. Which partitions a batch touches is known before the table is read, and given as literals: neither files nor
folders of other days are listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creaseline.operators.live_balls import LIVE_BALL_KEY
from creaseline.operators.upsert import earliest_per_key, only_new_rows
from creaseline.schemas import CLEAN_LIVE_BALL
from creaseline.sinks.tables import BUCKETS, bucket_of, in_partitions_of
from creaseline.sources.kpi_tables import read_table
from creaseline.sources.live import read_table_stream
from creaseline.workspace import path_exists

PARTS = ["match_day", "bucket"]
DAYS = "match_id STRING, match_day DATE, bucket INT, batch BIGINT"
NO_DAY = "1970-01-01"  # of a match whose balls have no time


def ball_schema() -> StructType:
    """The clean balls without the time they came in."""
    return StructType([f for f in StructType.fromDDL(CLEAN_LIVE_BALL).fields if f.name != "ingestion_time"])


def stored_schema() -> StructType:
    """As stored: partition columns last, in the order of the folders."""
    return StructType([*ball_schema().fields, *StructType.fromDDL("match_day DATE, bucket INT").fields])


def read_balls(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schema=stored_schema()).drop(*PARTS)


def read_balls_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """The balls as they are added, with the partition each is in."""
    return read_table_stream(spark, path, stored_schema(), partition_by=PARTS, **options)


def balls_beside(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Stored balls of the partitions that `rows` (with match_day and bucket) touch."""
    return in_partitions_of(read_table(spark, path, schema=stored_schema()), rows, PARTS)


def with_match_day(rows: DataFrame, path: str, number: int) -> DataFrame:
    """`rows` (with bucket) with the day of their match, from the table at `path`; matches not known yet are added under the number of the batch.

    A batch that comes again finds its matches there.
    """
    spark = rows.sparkSession
    buckets = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # at most as many as the table has

    def known() -> DataFrame:
        return read_table(spark, path, schema=StructType.fromDDL(DAYS)).where(F.col("bucket").isin(buckets)).select(F.col("match_id").alias("known_id"), "match_day")

    same = F.col("match_id").eqNullSafe(F.col("known_id"))
    day = F.coalesce(F.min(F.to_date("event_time")), F.lit(NO_DAY).cast("date")).alias("match_day")
    fresh = rows.groupBy("match_id", "bucket").agg(day)
    if path_exists(spark, path):
        fresh = fresh.join(known().drop("match_day"), same, "left_anti")
    (fresh.withColumn("batch", F.lit(number).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket", "batch").parquet(path))
    return rows.join(known(), same).drop("known_id")


def add_balls(balls: DataFrame, path: str, number: int, buckets: int = BUCKETS) -> None:
    """Add the balls that the table does not have; the first event time of a ball stays. A batch that comes again adds nothing."""
    spark = balls.sparkSession
    rows = earliest_per_key(balls, LIVE_BALL_KEY, ["event_time"]).withColumn("bucket", bucket_of("match_id", buckets)).persist()
    try:
        rows = with_match_day(rows, f"{path}_days", number).persist()
        fresh = only_new_rows(rows, balls_beside(spark, rows, path), LIVE_BALL_KEY) if path_exists(spark, path) else rows
        fresh.select(*stored_schema().names).hint("rebalance", *PARTS).write.mode("append").partitionBy(*PARTS).parquet(path)
    finally:
        rows.unpersist()
