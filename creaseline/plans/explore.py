"""Counts for a first look at the data, and the headline numbers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.plans.match_data import MatchData
from creaseline.plans.shaping import desc, sums, top


def documents_by_type(documents: DataFrame) -> DataFrame:
    return documents.groupBy(F.col("info.match_type").alias("match_type")).agg(F.count("*").alias("count"))


def runs_histogram(balls: DataFrame) -> DataFrame:
    return balls.groupBy("runs_total").agg(F.count("*").alias("count"))


def top_venues(documents: DataFrame, limit: int | None = 10) -> DataFrame:
    per = documents.groupBy(F.col("info.venue").alias("venue")).agg(F.count("*").alias("count"))
    return top(per, [desc("count")], ["venue"], limit)


def row_counts(balls: DataFrame) -> DataFrame:
    """Balls and matches in one pass: counted per match, then added up."""
    return (balls.groupBy("match_id").agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("deliveries"), F.count("match_id").alias("matches")))


def headline(d: MatchData) -> DataFrame:
    """One row: leading run scorer, wicket taker, six hitter and four hitter. Ties go to the first name."""
    batting = d.batting.groupBy(F.col("batsman").alias("player")).agg(*sums(runs="runs", sixes="sixes", fours="fours"))
    bowling = d.bowling.groupBy(F.col("bowler").alias("player")).agg(*sums(wickets="wickets"))
    # One long frame (measure, player, value), so each player list is aggregated once.
    long = batting.select("player", F.expr("stack(3, 'runs', runs, 'sixes', sixes, 'fours', fours) AS (measure, value)")) \
        .unionByName(bowling.select("player", F.lit("wickets").alias("measure"), F.col("wickets").alias("value")))
    best = F.min_by(F.struct("player", "value"), F.struct(-F.col("value"), "player"))
    per = long.groupBy("measure").agg(best.alias("best"))

    def pick(measure: str, part: str):
        return F.max(F.when(F.col("measure") == measure, F.col(f"best.{part}")))

    return per.agg(
        pick("runs", "player").alias("top_batsman"), pick("runs", "value").alias("top_runs"),
        pick("wickets", "player").alias("top_bowler"), pick("wickets", "value").alias("top_wickets"),
        pick("sixes", "player").alias("six_hitter"), pick("sixes", "value").alias("top_sixes"),
        pick("fours", "player").alias("four_hitter"), pick("fours", "value").alias("top_fours"))
