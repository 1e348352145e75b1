"""The single-process reading of the reports whose question is the same in both: own columns, fewer limits, ties rounded to even."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.functions.rates import POWERPLAY_END, overs, per_over, percent, ratio
from creaseline.plans.match_data import MatchData
from creaseline.plans.shaping import asc, desc, sums, sums_and_units, top


def batting_average(d: MatchData, min_innings: int = 3, limit: int | None = 20) -> DataFrame:
    """A batsman who was never out has all runs as average."""
    per = (d.batting_innings.groupBy("batsman").agg(*sums(total_runs="runs"), F.count("*").alias("innings"), *sums(dismissals="dismissed"))
           .filter(F.col("innings") >= min_innings))
    average = F.coalesce(ratio("total_runs", "dismissals", half_even=True), F.col("total_runs").cast("double"))
    return top(per.withColumn("batting_average", average), [desc("batting_average")], ["batsman"], limit)


def bowling_average(d: MatchData, min_wickets: int = 3, limit: int | None = 20) -> DataFrame:
    per = d.bowling.groupBy("bowler").agg(*sums(wickets="wickets", runs_conceded="runs")).filter(F.col("wickets") >= min_wickets)
    return top(per.withColumn("bowling_average", ratio("runs_conceded", "wickets", half_even=True)), [asc("bowling_average")], ["bowler"], limit)


def strike_rate(d: MatchData, min_balls: int = 30, limit: int | None = 20) -> DataFrame:
    per = d.batting.groupBy("batsman").agg(*sums(total_runs="runs", balls_faced="balls")).filter(F.col("balls_faced") >= min_balls)
    return top(per.withColumn("strike_rate", percent("total_runs", "balls_faced", half_even=True)), [desc("strike_rate")], ["batsman"], limit)


def economy_rate(d: MatchData, min_overs: float = 5, limit: int | None = 20) -> DataFrame:
    per = (d.bowling.groupBy("bowler").agg(*sums(runs_conceded="runs", balls="balls"))
           .withColumn("overs_bowled", overs("balls", half_even=True)).filter(F.col("overs_bowled") >= min_overs))
    return top(per.withColumn("economy_rate", per_over("runs_conceded", "balls", half_even=True)), [asc("economy_rate")], ["bowler"], limit)


def powerplay(d: MatchData, powerplay_end: int = POWERPLAY_END) -> DataFrame:
    """Every team; no limit."""
    per = (d.overs.filter(F.col("over_num") < powerplay_end).groupBy(F.col("inning").alias("team"), "match_type").agg(*sums(runs="runs", balls="balls")))
    return per.select("team", "match_type", per_over("runs", "balls", half_even=True).alias("powerplay_run_rate"))


def team_totals(d: MatchData, limit: int | None = 20) -> DataFrame:
    per = d.overs.groupBy("match_id", F.col("inning").alias("team"), "match_type", "venue").agg(*sums(team_total="runs"))
    return top(per, [desc("team_total")], ["team", "match_id", "match_type", "venue"], limit)


def team_wins(d: MatchData) -> DataFrame:
    """Every team; no limit."""
    return d.matches.filter(F.col("winner").isNotNull()).groupBy(F.col("winner").alias("team"), "match_type").agg(F.count("*").alias("wins"))


def players_by_type(d: MatchData, limit: int | None = 30) -> DataFrame:
    per = d.batting.groupBy("batsman", "match_type").agg(*sums(total_runs="runs", balls_faced="balls"))
    return top(per.withColumn("strike_rate", percent("total_runs", "balls_faced", half_even=True)), [desc("total_runs")], ["batsman", "match_type"], limit)


def partnerships(d: MatchData, limit: int | None = 20) -> DataFrame:
    """With the match type; the top pairs are joined with the matches after the limit."""
    keys = ["batsman", "non_striker", "match_id", "inning"]
    per = top(d.pairs.groupBy(*keys).agg(*sums(partnership_runs="runs", balls="balls")), [desc("partnership_runs")], keys, limit)
    return per.join(d.matches.select("match_id", "match_type"), "match_id").select(*keys, "match_type", "partnership_runs", "balls")


def dot_balls(d: MatchData, min_balls: int = 10, limit: int | None = 20) -> DataFrame:
    per = d.bowling.groupBy("bowler").agg(*sums(balls_bowled="balls", dot_balls="dots")).filter(F.col("balls_bowled") >= min_balls)
    return top(per.withColumn("dot_ball_pct", percent("dot_balls", "balls_bowled", half_even=True)), [desc("dot_ball_pct")], ["bowler"], limit)


def extras(d: MatchData) -> DataFrame:
    """Every team; no limit."""
    per = sums_and_units(d.overs.withColumnRenamed("inning", "team"), ["team", "match_type"], ["match_id"], "matches", total_extras="extras")
    return per.withColumn("avg_extras_per_match", ratio("total_extras", "matches", half_even=True))


def consistency(d: MatchData, min_innings: int = 3, limit: int | None = 20) -> DataFrame:
    """A missing deviation is 0."""
    keys = ["batsman", "match_type"]
    per = (d.batting_innings.groupBy(*keys).agg(F.count("*").alias("innings"), F.sum("runs").alias("_runs"), F.stddev_samp("runs").alias("_deviation"))
           .filter(F.col("innings") >= min_innings)
           .select(*keys, "innings", ratio("_runs", "innings", half_even=True).alias("avg_score"), F.coalesce(F.bround("_deviation", 2), F.lit(0.0)).alias("score_stddev")))
    return top(per, [asc("score_stddev")], keys, limit)


def spells(d: MatchData, min_wickets: int = 3, spell_overs: int = 5, limit: int | None = 20) -> DataFrame:
    """With the number of the stretch of overs."""
    keys = ["bowler", "match_id", "inning", "match_type", "over_group"]
    per = (d.bowling.withColumn("over_group", F.floor(F.col("over_num") / spell_overs).cast("int")).groupBy(*keys)
           .agg(F.min("over_num").alias("spell_start_over"), F.max("over_num").alias("spell_end_over"),
                *sums(runs_conceded="runs", wickets="spell_wickets", balls="balls")).filter(F.col("wickets") >= min_wickets))
    return top(per, [desc("wickets"), asc("runs_conceded")], keys, limit)


def winning_share(d: MatchData, min_runs: int = 30, limit: int | None = 20) -> DataFrame:
    keys = ["batsman", "match_type"]
    per = sums_and_units(d.batting, keys, ["match_id"], "matches", total_runs="runs", winning_runs="winning_runs").filter(F.col("total_runs") >= min_runs)
    return top(per.withColumn("win_contribution_pct", percent("winning_runs", "total_runs", half_even=True)), [desc("win_contribution_pct")], keys, limit)
