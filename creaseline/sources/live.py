"""Live message streams."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from creaseline.schemas import ENVELOPE

# Default topics.
LIVE_BALLS_TOPIC = "live-balls"
LIVE_MATCHES_TOPIC = "live-matches"


def read_envelopes(spark: SparkSession, fmt: str = "json", path: str | None = None, servers: str | None = None,
                   topics: Sequence[str] = (LIVE_BALLS_TOPIC,), starting_offsets: str = "latest", **options) -> DataFrame:
    """Stream of `key, value, topic`.

    Reads a broker with `fmt="kafka"` (needs the connector on the class path), otherwise files of envelopes in
    a folder. Messages lost at the broker do not stop the stream. Other topics are left out.
    """
    if fmt == "kafka":
        reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                  .option("subscribe", ",".join(topics)).option("startingOffsets", starting_offsets)
                  .option("failOnDataLoss", "false"))
        return reader.options(**options).load().selectExpr("CAST(key AS STRING) key", "CAST(value AS STRING) value", "topic")
    rows = spark.readStream.format(fmt).schema(ENVELOPE).options(**options).load(path)
    return rows.filter(rows.topic.isin(*topics))


def of_topic(messages: DataFrame, topic: str) -> DataFrame:
    return messages.filter(messages.topic == topic)


def read_table_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                      **options) -> DataFrame:
    """Follow a layer table.

    Once a folder has partitions, a file source puts their columns last and maps the rows of a batch by position to the columns it was planned with. So
    `partition_by` is put last from the start, and a stream planned on an empty folder reads the same columns as one planned on a filled one.
    """
    given = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    stored = StructType([*[f for f in given if f.name not in partition_by], *[given[c] for c in partition_by]])
    return spark.readStream.format(fmt).schema(stored).options(**options).load(path).select(*given.names)
