"""Reads of report tables for dashboards."""

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creaseline.functions.labels import pair_label, team_flag, toss_advantage, with_flag
from creaseline.functions.pressure import pressure_band
from creaseline.plans.shaping import asc, desc, top


def live_latest(kpis: DataFrame, now: datetime, within: str = "1 minute", match_id: str | None = None) -> DataFrame:
    """The newest live row, of one match or of all, computed no longer than `within` before `now`; at most one row."""
    if match_id is not None:
        kpis = kpis.filter(F.col("match_id") == match_id)
    fresh = kpis.filter(F.col("computed_at") >= F.lit(now) - F.expr(f"INTERVAL {within}"))
    return (fresh.orderBy(desc("computed_at"), desc("window_start"), F.col("match_id")).limit(1)
            .select("match_id", "window_start", "window_end", "window_runs", "balls_bowled", "wickets_in_window",
                    F.round("run_rate", 2).alias("current_run_rate"), F.round("batting_strike_rate", 2).alias("strike_rate"),
                    F.round("bowler_economy", 2).alias("economy_rate"), "current_batsman", "current_bowler", "computed_at"))


def latest_per_match(kpis: DataFrame, order: str = "window_start") -> DataFrame:
    """The newest live row of each match."""
    rest = [c for c in kpis.columns if c != "match_id"]
    return (kpis.groupBy("match_id").agg(F.max_by(F.struct(*rest), F.col(order)).alias("row"))
            .select("match_id", "row.*"))


def run_rate_trend(kpis: DataFrame, match_id: str | None = None, last: int = 10) -> DataFrame:
    """The last windows of one match, or of every match."""
    rows = kpis.select("match_id", "window_start", F.round("run_rate", 2).alias("run_rate"), "wickets_in_window")
    if match_id is not None:
        return top(rows.filter(F.col("match_id") == match_id), [desc("window_start")], [], last)
    newest = Window.partitionBy("match_id").orderBy(desc("window_start"))
    # The filter on the row number lets Spark drop rows before the shuffle.
    return rows.withColumn("n", F.row_number().over(newest)).filter(F.col("n") <= last).drop("n")


def ranked(rows: DataFrame, by: str, ties: list[str], limit: int, ascending: bool = False) -> DataFrame:
    """Top rows with their place, 1 first."""
    first = top(rows, [asc(by) if ascending else desc(by)], ties, limit)
    # At most `limit` rows are left for the window.
    order = [asc(by) if ascending else desc(by), *[F.col(t) for t in ties]]
    return first.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_batsmen(top_run_scorers: DataFrame, limit: int = 10) -> DataFrame:
    return top(top_run_scorers.select("batsman", "total_runs", "balls_faced", "matches"), [desc("total_runs")], ["batsman"], limit)


def top_bowlers(top_wicket_takers: DataFrame, limit: int = 10) -> DataFrame:
    return top(top_wicket_takers.select("bowler", "wickets", "balls_bowled", "matches"), [desc("wickets")], ["bowler"], limit)


def pressure_of_match(pressure: DataFrame, match_id: str | None = None, inning: str | None = None) -> DataFrame:
    """Pressure rows of one innings, one match, or all, with their level."""
    rows = pressure
    if match_id is not None:
        rows = rows.filter(F.col("match_id") == match_id)
    if inning is not None:
        rows = rows.filter(F.col("inning") == inning)
    return rows.select("match_id", "inning", "over_num", "pressure_index",
                       pressure_band("pressure_index").alias("pressure_level"), "runs_in_over", "wickets_in_over")


def run_rate_progression(progression: DataFrame, match_types=("T20", "ODI")) -> DataFrame:
    return (progression.filter(F.col("match_type").isin(*match_types))
            .select("match_type", "over_num", "avg_runs_per_over", "avg_run_rate").orderBy("match_type", "over_num"))


def boundary_phases(phases: DataFrame) -> DataFrame:
    return phases.select("match_type", "phase", "total_balls", "boundaries", "boundary_pct").orderBy("match_type", "phase")


def toss_wins(toss: DataFrame) -> DataFrame:
    return (toss.select("toss_decision", "match_type", "total_matches", "win_pct", toss_advantage("win_pct").alias("verdict"))
            .orderBy("match_type", desc("win_pct"), "toss_decision"))


def head_to_head(records: DataFrame, match_type: str | None = None, limit: int = 20) -> DataFrame:
    """Most frequent meetings, labelled 'A vs B'."""
    rows = records if match_type is None else records.filter(F.col("match_type") == match_type)
    label = pair_label(with_flag(team_flag("team1"), "team1"), with_flag(team_flag("team2"), "team2"), "vs")
    rows = rows.select("match_type", "team1", "team2", label.alias("matchup"), "matches_played", "team1_wins", "team2_wins", "no_result")
    return top(rows, [desc("matches_played")], ["team1", "team2", "match_type"], limit)


def partnerships(stands: DataFrame, limit: int = 20) -> DataFrame:
    """Best stands, labelled 'A & B'."""
    rows = stands.select("batsman", "non_striker", "match_id", "inning",
                         pair_label("batsman", "non_striker", "&").alias("pair"), "partnership_runs", "balls_faced")
    return top(rows, [desc("partnership_runs")], ["batsman", "non_striker", "match_id", "inning"], limit)


def chasing_pct(batting_first: DataFrame) -> DataFrame:
    return batting_first.withColumn("chasing_win_pct", F.round(100 - F.col("batting_first_win_pct"), 2))


def home_away_total(wins: DataFrame) -> DataFrame:
    return wins.groupBy("home_away").agg(F.sum("wins").alias("wins"))
