"""Team, venue and toss reports."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.functions.rates import POWERPLAY_END, flag_int, per_over, percent, ratio
from creaseline.plans.match_data import MatchData
from creaseline.plans.shaping import asc, desc, sums, sums_and_units, top


def powerplay_run_rate(d: MatchData, powerplay_end: int = POWERPLAY_END, limit: int | None = 20) -> DataFrame:
    early = d.overs.filter(F.col("over_num") < powerplay_end).withColumnRenamed("inning", "team")
    per = (sums_and_units(early, ["team", "match_type"], ["match_id"], "matches", runs="runs", balls="balls")
           .withColumn("powerplay_run_rate", per_over("runs", "balls")))
    return top(per.drop("runs", "balls"), [desc("powerplay_run_rate")], ["team", "match_type"], limit)


def win_by_toss_decision(d: MatchData) -> DataFrame:
    decided = d.matches.filter(F.col("toss_decision").isNotNull() & F.col("winner").isNotNull())
    return (decided.groupBy("toss_decision", "match_type")
            .agg(F.count("*").alias("total_matches"),
                 F.sum(flag_int(F.col("toss_winner") == F.col("winner"))).alias("toss_winner_wins"))
            .withColumn("win_pct", percent("toss_winner_wins", "total_matches")))


def won_batting_first() -> Column:
    """By the toss: its winner chose to bat and won, or chose to field and lost."""
    same = F.col("toss_winner") == F.col("winner")
    return ((F.col("toss_decision") == "bat") & same) | ((F.col("toss_decision") == "field") & ~same)


def win_batting_first(d: MatchData) -> DataFrame:
    return (d.matches.filter(F.col("winner").isNotNull()).groupBy("match_type")
            .agg(F.sum(flag_int(won_batting_first())).alias("batting_first_wins"), F.count("*").alias("total_matches"))
            .withColumn("batting_first_win_pct", percent("batting_first_wins", "total_matches")))


def innings_totals(d: MatchData, *extra: str) -> DataFrame:
    return (d.overs.groupBy("match_id", "inning", "match_type", "venue", *extra)
            .agg(F.sum("runs").alias("innings_total"), F.min("inning_no").alias("inning_no")))


def avg_score_by_venue(d: MatchData, limit: int | None = 30) -> DataFrame:
    keys = ["venue", "match_type", "inning"]
    per = innings_totals(d).groupBy(*keys).agg(F.round(F.avg("innings_total"), 2).alias("avg_score"))
    return top(per, [desc("avg_score")], keys, limit)


def highest_team_totals(d: MatchData, limit: int | None = 20) -> DataFrame:
    per = innings_totals(d).select(F.col("inning").alias("team"), "match_id", "match_type", "venue",
                                   F.col("innings_total").alias("team_total"))
    return top(per, [desc("team_total")], ["team", "match_id", "match_type", "venue"], limit)


def lowest_successful_chases(d: MatchData, limit: int | None = 20) -> DataFrame:
    """Lowest totals of the side that won, whichever innings it was.

    The rule that drops innings named '1st' is kept, though innings carry team names.
    """
    won = d.overs.filter((F.col("winner") == F.col("inning")) & ~F.col("inning").contains("1st"))
    per = (won.groupBy(F.col("inning").alias("team"), "match_id", "match_type", "venue")
           .agg(F.sum("runs").alias("chase_total")))
    return top(per, [asc("chase_total")], ["team", "match_id", "match_type", "venue"], limit)


def most_wins_by_team(d: MatchData, limit: int | None = 20) -> DataFrame:
    per = (d.matches.filter(F.col("winner").isNotNull())
           .groupBy(F.col("winner").alias("team"), "match_type").agg(F.count("*").alias("wins")))
    return top(per, [desc("wins")], ["team", "match_type"], limit)


def extras_analysis(d: MatchData, limit: int | None = 20) -> DataFrame:
    rows = d.overs.withColumnRenamed("inning", "team")
    per = (sums_and_units(rows, ["team", "match_type"], ["match_id"], "matches", total_extras="extras")
           .withColumn("avg_extras_per_match", ratio("total_extras", "matches")))
    return top(per, [desc("avg_extras_per_match")], ["team", "match_type"], limit)


def home_away(at_home: Column) -> Column:
    return F.when(at_home, "Home").otherwise("Away").alias("home_away")


def home_away_win_pct(d: MatchData, limit: int | None = 30) -> DataFrame:
    """Wins by ground; at home when the ground's name has the first word of the winner's."""
    word = F.substring_index("winner", " ", 1)
    per = (d.matches.filter(F.col("winner").isNotNull())
           .groupBy("winner", "venue", "match_type", home_away(F.col("venue").contains(word)))
           .agg(F.count("*").alias("wins")))
    return top(per, [desc("wins")], ["winner", "venue", "match_type"], limit)


def head_to_head(d: MatchData, limit: int | None = 30) -> DataFrame:
    per = d.matches.groupBy("team1", "team2", "match_type").agg(
        F.count("*").alias("matches_played"),
        F.count_if(F.col("winner") == F.col("team1")).alias("team1_wins"),
        F.count_if(F.col("winner") == F.col("team2")).alias("team2_wins"),
        F.count_if(F.col("winner").isNull()).alias("no_result"))
    return top(per, [desc("matches_played")], ["team1", "team2", "match_type"], limit)


def toss_impact(matches: DataFrame, min_matches: int = 5) -> DataFrame:
    """How often the toss winner won, by decision, ground and match type."""
    won = F.col("toss_winner") == F.col("winner")
    return (matches.filter(F.col("toss_decision").isNotNull() & F.col("winner").isNotNull())
            .groupBy("toss_decision", "venue", "match_type")
            .agg(F.count("*").alias("total_matches"), F.count_if(won).alias("toss_winner_wins"),
                 F.count_if(~won).alias("toss_winner_losses"))
            .withColumn("win_probability", percent("toss_winner_wins", "total_matches"))
            .filter(F.col("total_matches") >= min_matches))


def toss_summary(matches: DataFrame) -> DataFrame:
    return (matches.filter(F.col("toss_decision").isNotNull() & F.col("winner").isNotNull())
            .groupBy("toss_decision", "match_type")
            .agg(F.count("*").alias("total_matches"),
                 F.count_if(F.col("toss_winner") == F.col("winner")).alias("wins_after_toss"))
            .withColumn("win_pct", percent("wins_after_toss", "total_matches")))


# --- the same questions as the single-process version of the reports answers them ---

def toss_decision_all(d: MatchData) -> DataFrame:
    """Also counts matches without a result or a toss decision."""
    m = d.matches.na.fill("", ["winner", "toss_winner", "toss_decision"])
    return (m.groupBy("toss_decision", "match_type")
            .agg(F.count("*").alias("matches"), F.count_if(F.col("toss_winner") == F.col("winner")).alias("wins"))
            .withColumn("win_pct", percent("wins", "matches", half_even=True)))


def first_batting_team(d: MatchData) -> DataFrame:
    """By number first, so that only two rows of a match are sorted by name."""
    per = d.overs.groupBy("match_id", "inning").agg(F.min("inning_no").alias("inning_no"))
    return per.groupBy("match_id").agg(F.min_by("inning", "inning_no").alias("batting_first"))


def batting_first_actual(d: MatchData) -> DataFrame:
    """By the team that in fact batted first, over all matches."""
    m = d.matches.join(first_batting_team(d), "match_id")
    return (m.groupBy("match_type")
            .agg(F.count("*").alias("matches"), F.count_if(F.col("batting_first") == F.col("winner")).alias("bat_first_wins"))
            .withColumn("batting_first_win_pct", percent("bat_first_wins", "matches", half_even=True)))


def venue_scores(d: MatchData, limit: int | None = 30) -> DataFrame:
    """Mean innings total of a ground, all teams together."""
    keys = ["venue", "match_type"]
    per_match = innings_totals(d).groupBy(*keys, "match_id").agg(
        F.sum("innings_total").alias("runs"), F.count("*").alias("innings"))
    per = per_match.groupBy(*keys).agg(*sums(runs="runs", innings="innings"), F.count("*").alias("matches"))
    per = per.select(*keys, ratio("runs", "innings", half_even=True).alias("avg_score"), "matches")
    return top(per, [desc("avg_score")], keys, limit)


def true_chases(d: MatchData, limit: int | None = 20) -> DataFrame:
    """Lowest winning totals of a team that did not bat first."""
    chases = (innings_totals(d, "winner").join(first_batting_team(d), "match_id")
              .filter((F.col("inning") != F.col("batting_first")) & (F.col("inning") == F.col("winner")))
              .select("match_id", F.col("inning").alias("team"), "match_type", "venue",
                      F.col("innings_total").alias("chase_total"), "winner"))
    return top(chases, [asc("chase_total")], ["team", "match_id"], limit)


# Teams at home at every ground of the tournament.
HOSTS = ("India", "Sri Lanka")


def home_away_by_host(d: MatchData, hosts: Iterable[str] = HOSTS, limit: int | None = 30) -> DataFrame:
    """At home when the ground's name has the winner's whole name, or when the winner is a host."""
    at_home = F.col("venue").contains(F.col("winner")) | F.col("winner").isin(*hosts)
    per = (d.matches.filter(F.col("winner").isNotNull())
           .groupBy(F.col("winner").alias("team"), "match_type", home_away(at_home)).agg(F.count("*").alias("wins")))
    return top(per, [desc("wins")], ["team", "match_type", "home_away"], limit)


def head_to_head_pairs(d: MatchData, limit: int | None = 30) -> DataFrame:
    """Record of two teams over all match types, whoever is named first; only matches with a winner."""
    a, b = F.least("team1", "team2"), F.greatest("team1", "team2")
    per = (d.matches.filter(F.col("winner").isNotNull())
           .select(a.alias("team1"), b.alias("team2"), "winner").groupBy("team1", "team2")
           .agg(F.count("*").alias("matches_played"),
                F.count_if(F.col("winner") == F.col("team1")).alias("team1_wins"),
                F.count_if(F.col("winner") == F.col("team2")).alias("team2_wins"))
           .withColumn("no_result", F.lit(0).cast("bigint")))
    return top(per, [desc("matches_played")], ["team1", "team2"], limit)
