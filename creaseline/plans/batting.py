"""Batting reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.functions.rates import percent, ratio
from creaseline.plans.match_data import MatchData
from creaseline.plans.shaping import asc, desc, sums, sums_and_units, top


def top_run_scorers(d: MatchData, limit: int | None = 10) -> DataFrame:
    per = sums_and_units(d.batting, ["batsman"], ["match_id"], "matches", total_runs="runs", balls_faced="balls")
    return top(per, [desc("total_runs")], ["batsman"], limit)


def _career(d: MatchData) -> DataFrame:
    return d.batting_innings.groupBy("batsman").agg(
        *sums(total_runs="runs", dismissals="dismissed"), F.count("*").alias("innings"))


def best_batting_average(d: MatchData, min_innings: int = 3, limit: int | None = 20, never_out: str = "runs") -> DataFrame:
    """Runs per innings in which the batsman was out. `never_out`: 'runs' gives all runs as average, 'null' none."""
    average = ratio("total_runs", "dismissals")
    if never_out == "runs":
        average = F.coalesce(average, F.col("total_runs").cast("double"))
    per = _career(d).filter(F.col("innings") >= min_innings).withColumn("batting_average", average)
    return top(per, [desc("batting_average")], ["batsman"], limit)


def best_strike_rate(d: MatchData, min_balls: int = 30, limit: int | None = 20) -> DataFrame:
    per = (d.batting.groupBy("batsman").agg(*sums(total_runs="runs", balls_faced="balls"))
           .filter(F.col("balls_faced") >= min_balls)
           .withColumn("strike_rate", percent("total_runs", "balls_faced")))
    return top(per, [desc("strike_rate")], ["batsman"], limit)


def highest_individual_scores(d: MatchData, limit: int | None = 20, per_innings: bool = False) -> DataFrame:
    keys = ["batsman", "match_id", "match_type"] + (["inning"] if per_innings else [])
    per = d.batting.groupBy(*keys).agg(*sums(score="runs", balls_faced="balls"))
    return top(per, [desc("score")], keys, limit)


def _most(d: MatchData, hit: str, limit: int | None, only_hitters: bool) -> DataFrame:
    per = d.batting.groupBy("batsman").agg(*sums(**{hit: hit}))
    if only_hitters:
        per = per.filter(F.col(hit) > 0)
    return top(per, [desc(hit)], ["batsman"], limit)


def most_sixes(d: MatchData, limit: int | None = 20, only_hitters: bool = False) -> DataFrame:
    return _most(d, "sixes", limit, only_hitters)


def most_fours(d: MatchData, limit: int | None = 20, only_hitters: bool = False) -> DataFrame:
    return _most(d, "fours", limit, only_hitters)


def player_by_match_type(d: MatchData, limit: int | None = 30) -> DataFrame:
    keys = ["batsman", "match_type"]
    per = sums_and_units(d.batting, keys, ["match_id"], "matches", total_runs="runs", balls_faced="balls")
    per = per.withColumn("strike_rate", percent("total_runs", "balls_faced"))
    return top(per, [desc("total_runs")], keys, limit)


def partnership_analysis(d: MatchData, limit: int | None = 20) -> DataFrame:
    """Runs while one batsman faced and the other watched; the pair is ordered."""
    keys = ["batsman", "non_striker", "match_id", "inning"]
    per = d.pair_innings.select(*keys, F.col("runs").alias("partnership_runs"), F.col("balls").alias("balls_faced"))
    return top(per, [desc("partnership_runs")], keys, limit)


def partnership_pairs(d: MatchData, limit: int | None = 20) -> DataFrame:
    """Runs of two batsmen together, whoever faced."""
    keys = ["player_a", "player_b", "match_id", "inning"]
    per = (d.pairs.withColumn("player_a", F.least("batsman", "non_striker"))
           .withColumn("player_b", F.greatest("batsman", "non_striker"))
           .groupBy(*keys).agg(F.sum("runs").alias("partnership_runs"), F.sum("balls").alias("balls_faced")))
    return top(per, [desc("partnership_runs")], keys, limit)


def player_consistency(d: MatchData, min_innings: int = 3, limit: int | None = 20) -> DataFrame:
    """Mean and sample deviation of a batsman's innings scores."""
    keys = ["batsman", "match_type"]
    per = (d.batting_innings.groupBy(*keys)
           .agg(F.count("*").alias("innings"), F.round(F.avg("runs"), 2).alias("avg_score"),
                F.round(F.stddev_samp("runs"), 2).alias("score_stddev"))
           .filter(F.col("innings") >= min_innings))
    return top(per, [asc("score_stddev")], keys, limit)


def win_contribution(d: MatchData, min_runs: int = 30, limit: int | None = 20) -> DataFrame:
    """Share of a batsman's runs made in won matches."""
    keys = ["batsman", "match_type"]
    per = (sums_and_units(d.batting, keys, ["match_id"], "matches", winning_runs="winning_runs", total_runs="runs")
           .filter(F.col("total_runs") >= min_runs)
           .withColumn("win_contribution_pct", percent("winning_runs", "total_runs")))
    return top(per, [desc("win_contribution_pct")], keys, limit)


def batting_summary(d: MatchData, half_even: bool = True) -> DataFrame:
    """Career line of every batsman, with the best score marked * when not out."""
    per_match = d.batting_innings.groupBy("batsman", "match_id").agg(
        *sums(runs="runs", balls="balls", dismissed="dismissed"), F.count("*").alias("innings"),
        # The better of two equal scores is the one not out.
        F.max(F.col("runs") * 2 + (1 - F.col("dismissed"))).alias("best"))
    per = per_match.groupBy("batsman").agg(
        *sums(total_runs="runs", balls_faced="balls", innings="innings", dismissals="dismissed"),
        F.count("*").alias("matches"), F.max("best").alias("best"))
    average = ratio("total_runs", "dismissals", half_even=half_even)
    return per.select(
        "batsman", "total_runs", "balls_faced", "matches", "innings", "dismissals",
        (F.col("innings") - F.col("dismissals")).alias("not_outs"),
        F.coalesce(average, F.col("total_runs").cast("double")).alias("batting_average"),
        percent("total_runs", "balls_faced", half_even).alias("strike_rate"),
        F.concat(F.expr("best div 2").cast("string"), F.when(F.col("best") % 2 == 1, "*").otherwise("")).alias("highest_score"))
