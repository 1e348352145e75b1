"""Structured Streaming: messages to raw, raw to clean, clean to live metrics."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from creaseline.operators.live_balls import LIVE_BALL_KEY, enrich_envelope, parse_live_balls
from creaseline.plans.live import DEMO_WATERMARK, SLIDE, WATERMARK, WINDOW, live_batsmen, live_bowlers, live_windows, update_windows
from creaseline.schemas import CLEAN_LIVE_BALL
from creaseline.sinks.tables import BUCKETS, append_update, read_updates
from creaseline.sources.live import read_table_stream
from creaseline.streaming import ball_table

RAW_LIVE = "topic STRING, ingestion_time TIMESTAMP, raw_json STRING"


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_append(rows: DataFrame, path: str, checkpoint: str, every: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to a table. Without `every`, take what is there now and stop."""
    writer = (rows.writeStream.format(fmt).outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    return _trigger(writer, every).start()


def start_batches(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None,
                  mode: str = "update") -> StreamingQuery:
    """Hand each micro-batch to a function, which must give the same table when a batch comes again."""
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(writer, every).start()


def clean_stream(raw: DataFrame) -> DataFrame:
    """Parse raw messages. Stateless, so there is no watermark here."""
    return parse_live_balls(raw)


def once_per_ball(balls: DataFrame, watermark: str = WATERMARK, keys: Sequence[str] = LIVE_BALL_KEY) -> DataFrame:
    """Drop balls that a later poll sends again within the watermark."""
    return balls.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(list(keys))


def live_kpi_stream(balls: DataFrame, window: str = WINDOW, slide: str | None = SLIDE, watermark: str = WATERMARK,
                    dedup: bool = True) -> DataFrame:
    """Windowed metrics, each window once, when the watermark has passed its end."""
    balls = once_per_ball(balls, watermark) if dedup else balls.withWatermark("event_time", watermark)
    return live_windows(balls, window, slide).withColumn("computed_at", F.current_timestamp())


def start_ball_upsert(balls: DataFrame, path: str, checkpoint: str, every: str | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep one row per ball however long ago it was first sent; the first event time stays.

    Balls are never changed, so a batch only adds rows it does not find, in the partitions of its own matches.
    """
    def write(batch: DataFrame, number: int) -> None:
        ball_table.add_balls(batch, path, number, buckets)

    return start_batches(balls, write, checkpoint, every, mode="append")


def start_window_upsert(balls: DataFrame, path: str, checkpoint: str, every: str | None = None,
                        watermark: str = DEMO_WATERMARK, buckets: int = BUCKETS) -> StreamingQuery:
    """Short windows in update mode. Each micro-batch adds the windows that changed, by window date and bucket of matches;
    `read_windows` takes the latest of each, `merge_updates` merges the table on a schedule."""
    windows = (update_windows(balls.withWatermark("event_time", watermark))
               .withColumn("window_date", F.to_date("window_start")))

    def write(batch: DataFrame, number: int) -> None:
        append_update(batch, path, number, "match_id", ["window_date"], buckets)

    return start_batches(windows, write, checkpoint, every)


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    return read_updates(spark, path, ["match_id", "window_start"]).drop("window_date", "batch")


def start_rates_upsert(ball_table_path: str, path: str, checkpoint: str, player: str = "batsman", spark: SparkSession | None = None,
                       every: str | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Live strike rates (`batsman`) or economy (`bowler`) per innings, from the table that has each ball once.

    New balls only tell which innings to add up again; these are read from the partitions of the table that the new balls are in, so the query
    keeps no state, and a batch that comes again gives the same rows. `read_rates` takes the latest of each player and innings.
    """
    spark = spark or SparkSession.active()
    rates = live_batsmen if player == "batsman" else live_bowlers

    def write(batch: DataFrame, number: int) -> None:
        innings = batch.distinct().persist()
        try:
            balls = ball_table.balls_beside(spark, innings, path=ball_table_path).join(innings.drop(*ball_table.PARTS), ["match_id", "inning"], "left_semi")
            append_update(rates(balls), path, number, "match_id", [], buckets)
        finally:
            innings.unpersist()

    fresh = ball_table.read_balls_stream(spark, ball_table_path).select("match_id", "inning", *ball_table.PARTS)
    return start_batches(fresh, write, checkpoint, every, mode="append")


def read_rates(spark: SparkSession, path: str, player: str = "batsman") -> DataFrame:
    return read_updates(spark, path, ["match_id", "inning", player]).drop("batch")


def run_chain(spark: SparkSession, messages: DataFrame, base: str, every: str | None = None) -> list[StreamingQuery]:
    """Raw, clean, ball and metric queries, each with its own checkpoint, handing over through tables.

    A feed repeats each ball at every poll, for as long as it likes. The table of balls keeps the first sight of a ball, so the metrics and
    the rates that read it count a ball once, whenever it comes again. Without `every`, each query runs to the end of its
    input before the next starts.
    """
    queries = []

    def add(query: StreamingQuery) -> None:
        if every is None:
            query.awaitTermination()
        queries.append(query)

    def checkpoint(layer: str) -> str:
        return f"{base}/_checkpoints/{layer}"

    if every:  # a file source needs its folder to exist
        for layer in ("raw", "clean", "balls"):  # an empty partitioned write makes the folder and no file
            spark.createDataFrame([], "bucket INT, n INT").write.mode("append").partitionBy("bucket").parquet(f"{base}/{layer}")
    add(start_append(enrich_envelope(messages), f"{base}/raw", checkpoint("raw"), every))
    add(start_append(clean_stream(read_table_stream(spark, f"{base}/raw", RAW_LIVE)), f"{base}/clean", checkpoint("clean"), every))
    clean = read_table_stream(spark, f"{base}/clean", CLEAN_LIVE_BALL)
    add(start_ball_upsert(clean.drop("ingestion_time"), f"{base}/balls", checkpoint("balls"), every))
    balls = ball_table.read_balls_stream(spark, f"{base}/balls").drop(*ball_table.PARTS)
    add(start_append(live_kpi_stream(balls, dedup=False), f"{base}/live_kpis", checkpoint("live_kpis"), every))
    for player in ("batsman", "bowler"):
        add(start_rates_upsert(f"{base}/balls", f"{base}/{player}_rates", checkpoint(f"{player}_rates"), player, spark, every))
    return queries


def stop_chain(queries: Sequence[StreamingQuery]) -> None:
    for q in queries:
        q.stop()


def late_rows(query: StreamingQuery) -> int:
    """Rows the watermark dropped, over the recent batches."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
