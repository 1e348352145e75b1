"""Reports on how an innings develops."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creaseline.functions.rates import DEATH_START, POWERPLAY_END, per_over, percent, phase, ratio
from creaseline.operators.innings import cumulative_means
from creaseline.plans.match_data import MatchData
from creaseline.plans.shaping import sums, sums_and_units

# Fixed value: first death over in the single-process version of the reports.
LATE_DEATH_START = 16


def boundary_pct_per_phase(d: MatchData, powerplay_end: int = POWERPLAY_END, death_start: int = DEATH_START,
                           half_even: bool = False) -> DataFrame:
    return (d.overs.groupBy("match_type", phase("over_num", powerplay_end, death_start).alias("phase"))
            .agg(*sums(total_balls="balls", boundaries="boundaries"))
            .withColumn("boundary_pct", percent("boundaries", "total_balls", half_even)))


def avg_runs_per_wicket(d: MatchData) -> DataFrame:
    """All runs over all wickets, of any kind."""
    return (d.overs.groupBy("match_type", "inning").agg(*sums(runs="runs", wickets="wickets"))
            .select("match_type", "inning", ratio("runs", "wickets").alias("avg_runs_per_wicket")))


def mean_runs_per_wicket(d: MatchData) -> DataFrame:
    """Mean over innings of runs per wicket; innings without a wicket do not count."""
    per_innings = (d.overs.groupBy("match_id", "inning", "match_type").agg(*sums(runs="runs", wickets="wickets"))
                   .filter(F.col("wickets") > 0)
                   # Hundredths as whole numbers, so the mean does not depend on the order of addition.
                   .withColumn("hundredths", F.bround(ratio("runs", "wickets", half_even=True) * 100).cast("bigint")))
    return per_innings.groupBy("inning", "match_type").agg(
        (F.bround(F.avg("hundredths"), 0) / 100.0).alias("avg_runs_per_wicket"))


def pressure_index_per_over(d: MatchData) -> DataFrame:
    """Ten points per wicket, plus 6 less the runs of the over."""
    per = d.overs.groupBy("match_id", "inning", "over_num").agg(
        *sums(runs_in_over="runs", wickets_in_over="wickets", balls="balls"))
    return per.select(
        "match_id", "inning", "over_num", "runs_in_over", "wickets_in_over",
        per_over("runs_in_over", "balls").alias("over_run_rate"),
        (F.col("wickets_in_over") * 10.0 + (6 - F.col("runs_in_over"))).alias("pressure_index"))


def pressure_index_clipped(d: MatchData) -> DataFrame:
    """The same, where a good over does not lower the index."""
    per = d.overs.groupBy("match_id", "inning", "over_num", "match_type").agg(*sums(runs="runs", wickets="wickets"))
    return per.withColumn("pressure_index", F.col("wickets") * 10 + F.greatest(6 - F.col("runs"), F.lit(0)))


def run_rate_progression(d: MatchData) -> DataFrame:
    """Mean runs of each over of the innings."""
    per_over_runs = d.overs.groupBy("match_type", "match_id", "inning", "over_num").agg(F.sum("runs").alias("runs"))
    mean = F.round(F.avg("runs"), 2)
    return per_over_runs.groupBy("match_type", "over_num").agg(
        mean.alias("avg_runs_per_over"), mean.alias("avg_run_rate"))


def cumulative_run_rate(d: MatchData, half_even: bool = True) -> DataFrame:
    """Per team and over: mean runs in that over, and run rate up to it."""
    rows = d.overs.withColumnRenamed("inning", "team")
    per = sums_and_units(rows, ["team", "match_type", "over_num"], ["match_id"], "overs", runs="runs")
    # One row per over number by now.
    so_far = (Window.partitionBy("match_type", "team").orderBy("over_num")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (per.withColumn("runs_so_far", F.sum("runs").over(so_far))
            .withColumn("overs_so_far", F.sum("overs").over(so_far))
            .select("match_type", "team", "over_num",
                    ratio("runs", "overs", half_even=half_even).alias("avg_runs_per_over"),
                    ratio("runs_so_far", "overs_so_far", half_even=half_even).alias("avg_run_rate")))


def overview_run_rate(d: MatchData) -> DataFrame:
    """Mean over teams of the runs per over, and the mean of those means so far."""
    per_team = cumulative_run_rate(d)
    per_over_mean = (per_team.groupBy("match_type", "over_num")
                     .agg(F.sum(F.bround(F.col("avg_runs_per_over") * 100).cast("bigint")).alias("hundredths"),
                          F.count("*").alias("teams"))
                     .withColumn("mean", F.col("hundredths") / (F.col("teams") * 100.0)))
    return cumulative_means(per_over_mean, "match_type", "mean", "so_far").select(
        "match_type", "over_num", F.bround("mean", 2).alias("avg_runs_per_over"), F.bround("so_far", 2).alias("avg_run_rate"))
