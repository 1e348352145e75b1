"""Bowling reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.functions.rates import DEATH_START, overs, per_over, percent, ratio
from creaseline.plans.match_data import MatchData
from creaseline.plans.shaping import asc, desc, sums, sums_and_units, top


def top_wicket_takers(d: MatchData, limit: int | None = 10, min_wickets: int = 0) -> DataFrame:
    per = sums_and_units(d.bowling, ["bowler"], ["match_id"], "matches", wickets="wickets", balls_bowled="balls")
    return top(per.filter(F.col("wickets") >= min_wickets), [desc("wickets")], ["bowler"], limit)


def best_bowling_average(d: MatchData, min_wickets: int = 3, limit: int | None = 20) -> DataFrame:
    per = (d.bowling.groupBy("bowler").agg(*sums(runs_conceded="runs", wickets="wickets"))
           .filter(F.col("wickets") >= min_wickets)
           .withColumn("bowling_average", ratio("runs_conceded", "wickets")))
    return top(per, [asc("bowling_average")], ["bowler"], limit)


def best_economy_rate(d: MatchData, min_overs: float = 5, limit: int | None = 20) -> DataFrame:
    per = (d.bowling.groupBy("bowler").agg(*sums(runs_conceded="runs", balls="balls"))
           .withColumn("overs_bowled", overs("balls")).filter(F.col("overs_bowled") >= min_overs)
           .withColumn("economy_rate", per_over("runs_conceded", "balls")))
    return top(per.drop("balls"), [asc("economy_rate")], ["bowler"], limit)


def death_over_economy(d: MatchData, death_start: int = DEATH_START, match_type: str = "T20", min_overs: float = 2,
                       limit: int | None = 20) -> DataFrame:
    keys = ["bowler", "match_type"]
    late = d.bowling.filter((F.col("over_num") >= death_start) & (F.col("match_type") == match_type))
    per = (sums_and_units(late, keys, ["match_id"], "matches", runs="runs", balls="balls")
           .withColumn("overs_bowled", overs("balls")).filter(F.col("overs_bowled") >= min_overs)
           .withColumn("death_economy", per_over("runs", "balls")))
    return top(per.drop("runs", "balls"), [asc("death_economy")], keys, limit)


def death_over_economy_all_types(d: MatchData, death_start: int = 16, min_overs: float = 2, limit: int | None = 20) -> DataFrame:
    """All match types together, from over 16 on, as the single-process version has it."""
    late = d.bowling.filter(F.col("over_num") >= death_start)
    per = (late.groupBy("bowler").agg(*sums(runs="runs", balls="balls"))
           .withColumn("overs", overs("balls", half_even=True)).filter(F.col("overs") >= min_overs)
           .withColumn("death_economy", per_over("runs", "balls", half_even=True)))
    return top(per, [asc("death_economy")], ["bowler"], limit)


def dot_ball_pct(d: MatchData, min_balls: int = 10, limit: int | None = 20) -> DataFrame:
    per = (d.bowling.groupBy("bowler").agg(*sums(balls_bowled="balls", dot_balls="dots"))
           .filter(F.col("balls_bowled") >= min_balls)
           .withColumn("dot_ball_pct", percent("dot_balls", "balls_bowled")))
    return top(per, [desc("dot_ball_pct")], ["bowler"], limit)


def best_bowling_spells(d: MatchData, min_wickets: int = 3, spell_overs: int = 5, limit: int | None = 20) -> DataFrame:
    """Wickets in one stretch of `spell_overs` overs."""
    keys = ["bowler", "match_id", "inning", "match_type", "spell"]
    per = (d.bowling.withColumn("spell", F.floor(F.col("over_num") / spell_overs)).groupBy(*keys)
           .agg(F.min("over_num").alias("spell_start_over"), F.max("over_num").alias("spell_end_over"),
                *sums(runs_conceded="runs", wickets="spell_wickets", balls="balls"))
           .filter(F.col("wickets") >= min_wickets))
    return top(per, [desc("wickets"), asc("runs_conceded")], keys, limit).drop("spell")
