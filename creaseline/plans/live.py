"""Live metrics. The windowed ones run on batch and streaming frames alike."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creaseline.functions.rates import flag_int, per_over, percent
from creaseline.operators.live_balls import LIVE_BALL_KEY
from creaseline.operators.upsert import earliest_per_key

# Fixed values of the live reports.
WINDOW, SLIDE, WATERMARK = "5 minutes", "1 minute", "10 minutes"
DEMO_WINDOW, DEMO_SLIDE, DEMO_WATERMARK = "30 seconds", "5 seconds", "30 seconds"


def live_windows(balls: DataFrame, window: str = WINDOW, slide: str | None = SLIDE) -> DataFrame:
    """Runs, balls, wickets and rates per match in sliding windows (tumbling without a slide).

    The current batsman and bowler are those of the last ball in the window. Balls are added up by pane (a slide long) and pair of players
    first; each of the few rows left then counts in all windows over its pane. On a stream these are two stateful aggregates in append mode, one on
    top of the other: a pane is handed on when the watermark has passed its end.
    """
    if slide:
        parts, at = _panes(balls, slide), F.window("pane", window, slide)
    else:
        parts, at = balls.select(
            "match_id", "event_time", F.col("runs_total").alias("runs"), F.col("runs_batsman").alias("batting_runs"), F.lit(1).alias("balls"),
            F.col("is_wicket").cast("int").alias("wickets"), "batsman", "bowler", F.struct("event_time", "inning", "over_num", "ball_num").alias("place"),
        ), F.window("event_time", window)
    runs, faced = F.sum("runs"), F.sum("balls")
    return (parts.groupBy("match_id", at.alias("w"))
            .agg(runs.alias("window_runs"), faced.alias("balls_bowled"), F.sum("wickets").alias("wickets_in_window"),
                 (runs * 6.0 / faced).alias("run_rate"), (F.sum("batting_runs") * 100.0 / faced).alias("batting_strike_rate"),
                 F.max_by(F.struct("batsman", "bowler"), "place").alias("current"))
            .select("match_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "window_runs", "balls_bowled", "wickets_in_window", "run_rate", "batting_strike_rate",
                    F.col("run_rate").alias("bowler_economy"),
                    F.col("current.batsman").alias("current_batsman"), F.col("current.bowler").alias("current_bowler")))


def _panes(balls: DataFrame, slide: str) -> DataFrame:
    """Balls added up by hash per match, pane, innings and pair of players, with the place of the last ball of each.

    Time, over and ball make one number, so that its maximum needs no sort: microseconds, five digits each for over and ball.
    """
    spot = (F.unix_micros("event_time").cast("decimal(38,0)") * 10_000_000_000
            + F.coalesce("over_num", F.lit(-1)).cast("decimal(38,0)") * 100_000 + F.coalesce("ball_num", F.lit(-1)).cast("decimal(38,0)"))
    added = (balls.groupBy("match_id", F.window("event_time", slide).alias("pane"), "inning", "batsman", "bowler")
             .agg(F.sum("runs_total").alias("runs"), F.sum("runs_batsman").alias("batting_runs"), F.count("*").alias("balls"),
                  F.sum(F.col("is_wicket").cast("int")).alias("wickets"), F.max("event_time").alias("last_time"),
                  F.max(spot.cast("decimal(38,0)")).alias("last_spot")))
    return added.select("match_id", "pane", "runs", "batting_runs", "balls", "wickets", "batsman", "bowler",
                        F.struct("last_time", "inning", "last_spot").alias("place"))


def closed_windows(windows: DataFrame, balls: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Windows an append-mode stream has put out once all these balls have arrived."""
    mark = balls.agg(F.max("event_time") - F.expr(f"INTERVAL {watermark}"))
    return windows.filter(F.col("window_end") <= mark.scalar())


def update_windows(balls: DataFrame, window: str = DEMO_WINDOW, slide: str = DEMO_SLIDE) -> DataFrame:
    """Short windows for an update-mode sink."""
    return (balls.groupBy("match_id", F.window("event_time", window, slide).alias("w"))
            .agg(F.sum("runs_total").alias("window_runs"), F.count("*").alias("balls"),
                 F.sum(F.col("is_wicket").cast("int")).alias("wickets"))
            .select("match_id", F.col("w.start").alias("window_start"), "window_runs", "balls", "wickets",
                    per_over("window_runs", "balls").alias("run_rate")))


def live_batsmen(balls: DataFrame) -> DataFrame:
    """Strike rate of each batsman in each innings so far."""
    return (balls.groupBy("match_id", "inning", "batsman")
            .agg(F.sum("runs_batsman").alias("runs"), F.count("*").alias("balls"))
            .withColumn("strike_rate", percent("runs", "balls")))


def live_bowlers(balls: DataFrame) -> DataFrame:
    """Economy of each bowler in each innings so far."""
    return (balls.groupBy("match_id", "inning", "bowler")
            .agg(F.sum("runs_total").alias("runs"), F.count("*").alias("balls"),
                 F.sum(F.col("is_wicket").cast("int")).alias("wickets"))
            .withColumn("economy", per_over("runs", "balls")))


def wickets_in_last_overs(balls: DataFrame, overs: int = 5) -> DataFrame:
    """Wickets in the latest overs of each innings. Counted per over first, so a window group has one row per over."""
    per = balls.groupBy("match_id", "inning", "over_num").agg(F.sum(F.col("is_wicket").cast("int")).alias("wickets"))
    latest = F.max("over_num").over(Window.partitionBy("match_id", "inning"))
    return (per.withColumn("last_over", latest).filter(F.col("over_num") > F.col("last_over") - overs)
            .groupBy("match_id", "inning").agg(F.max("last_over").alias("last_over"),
                                               F.sum("wickets").alias("wickets_last_overs")))


def current_partnership(balls: DataFrame) -> DataFrame:
    """Runs and balls since the last wicket of each innings, all of it if no wicket fell.

    The position of the last wicket is one row per innings, found by aggregation, so no innings is sorted
    in one task; the join to it is broadcast or skew-split by Spark.
    """
    over = ["match_id", "inning", "over_num"]
    wicket_ball = F.max(F.when(F.col("is_wicket"), F.col("ball_num")))
    last = (balls.groupBy(*over).agg(wicket_ball.alias("ball"))
            .groupBy("match_id", "inning")
            .agg(F.max(F.when(F.col("ball").isNotNull(), F.struct("over_num", "ball"))).alias("last_wicket")))
    spot = F.struct(F.col("over_num"), F.col("ball_num").alias("ball"))
    since = F.col("last_wicket").isNull() | (spot > F.col("last_wicket"))
    return (balls.join(last, ["match_id", "inning"])
            .groupBy("match_id", "inning")
            .agg(F.coalesce(F.sum(F.when(since, F.col("runs_total"))), F.lit(0)).alias("partnership_runs"),
                 F.sum(flag_int(since)).alias("partnership_balls")))


def one_per_ball(balls: DataFrame) -> DataFrame:
    """One row per ball of a batch that holds polls of the same balls; the first time it was seen counts."""
    return earliest_per_key(balls, LIVE_BALL_KEY, ["event_time"])
