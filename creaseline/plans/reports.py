"""All reports by name, and the job that writes them.

`REPORTS` maps a report to its function and its reading order, `FRAME_REPORTS` holds the variants that answer
as the single-process version does, and `NOTEBOOK_PARAMS` the larger thresholds used for long histories.
"""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.plans import batting, bowling, frames, teams, trends
from creaseline.plans.match_data import MatchData
from creaseline.sources.kpi_tables import note_types
from creaseline.workspace import replace_path, scratch_dir


@dataclass(frozen=True)
class Report:
    fn: Callable[..., DataFrame]
    # Reading order of a report without a limit: (column, descending).
    order: tuple = field(default=())


REPORTS: dict[str, Report] = {
    "top_run_scorers": Report(batting.top_run_scorers),
    "top_wicket_takers": Report(bowling.top_wicket_takers),
    "best_batting_average": Report(batting.best_batting_average),
    "best_bowling_average": Report(bowling.best_bowling_average),
    "best_strike_rate": Report(batting.best_strike_rate),
    "best_economy_rate": Report(bowling.best_economy_rate),
    "highest_individual_scores": Report(batting.highest_individual_scores),
    "most_sixes": Report(batting.most_sixes),
    "most_fours": Report(batting.most_fours),
    "powerplay_run_rate": Report(teams.powerplay_run_rate),
    "death_over_economy": Report(bowling.death_over_economy),
    "win_by_toss_decision": Report(teams.win_by_toss_decision, (("win_pct", True), ("toss_decision", False), ("match_type", False))),
    "win_batting_first": Report(teams.win_batting_first, (("match_type", False),)),
    "avg_score_by_venue": Report(teams.avg_score_by_venue),
    "highest_team_totals": Report(teams.highest_team_totals),
    "lowest_successful_chases": Report(teams.lowest_successful_chases),
    "most_wins_by_team": Report(teams.most_wins_by_team),
    "player_by_match_type": Report(batting.player_by_match_type),
    "partnership_analysis": Report(batting.partnership_analysis),
    "dot_ball_pct": Report(bowling.dot_ball_pct),
    "boundary_pct_per_phase": Report(trends.boundary_pct_per_phase, (("match_type", False), ("phase", False))),
    "avg_runs_per_wicket": Report(trends.avg_runs_per_wicket, (("match_type", False), ("inning", False))),
    "pressure_index_per_over": Report(trends.pressure_index_per_over, (("match_id", False), ("inning", False), ("over_num", False))),
    "run_rate_progression": Report(trends.run_rate_progression, (("match_type", False), ("over_num", False))),
    "extras_analysis": Report(teams.extras_analysis),
    "home_away_win_pct": Report(teams.home_away_win_pct),
    "head_to_head": Report(teams.head_to_head),
    "player_consistency": Report(batting.player_consistency),
    "best_bowling_spells": Report(bowling.best_bowling_spells),
    "win_contribution": Report(batting.win_contribution),
}

FRAME_REPORTS: dict[str, Callable[..., DataFrame]] = {
    "top_run_scorers": batting.batting_summary,
    "top_wicket_takers": partial(bowling.top_wicket_takers, min_wickets=1),
    "highest_individual_scores": partial(batting.highest_individual_scores, per_innings=True),
    "most_sixes": partial(batting.most_sixes, only_hitters=True),
    "most_fours": partial(batting.most_fours, only_hitters=True),
    "death_over_economy": bowling.death_over_economy_all_types,
    "win_by_toss_decision": teams.toss_decision_all,
    "win_batting_first": teams.batting_first_actual,
    "avg_score_by_venue": teams.venue_scores,
    "lowest_successful_chases": teams.true_chases,
    "boundary_pct_per_phase": partial(trends.boundary_pct_per_phase, death_start=trends.LATE_DEATH_START, half_even=True),
    "avg_runs_per_wicket": trends.mean_runs_per_wicket,
    "pressure_index_per_over": trends.pressure_index_clipped,
    "run_rate_progression": trends.cumulative_run_rate,
    "home_away_win_pct": teams.home_away_by_host,
    "head_to_head": teams.head_to_head_pairs,
    "best_batting_average": frames.batting_average,
    "best_bowling_average": frames.bowling_average,
    "best_strike_rate": frames.strike_rate,
    "best_economy_rate": frames.economy_rate,
    "powerplay_run_rate": frames.powerplay,
    "highest_team_totals": frames.team_totals,
    "most_wins_by_team": frames.team_wins,
    "player_by_match_type": frames.players_by_type,
    "partnership_analysis": frames.partnerships,
    "dot_ball_pct": frames.dot_balls,
    "extras_analysis": frames.extras,
    "player_consistency": frames.consistency,
    "best_bowling_spells": frames.spells,
    "win_contribution": frames.winning_share,
}

NOTEBOOK_PARAMS: dict[str, dict] = {
    "best_batting_average": {"min_innings": 20, "never_out": "null"},
    "best_bowling_average": {"min_wickets": 50},
    "best_strike_rate": {"min_balls": 500},
    "best_economy_rate": {"min_overs": 100},
    "death_over_economy": {"min_overs": 10},
    "dot_ball_pct": {"min_balls": 100},
    "player_consistency": {"min_innings": 20},
    "win_contribution": {"min_runs": 500},
}


def report(name: str, data: MatchData, variant: str = "sql", ordered: bool = False, **params) -> DataFrame:
    """One report. `variant` is 'sql', 'notebook' (larger thresholds) or 'frame'.

    `ordered` sorts a report without a limit for reading; do not ask for it before a write.
    """
    if name not in REPORTS:
        raise ValueError(f"unknown report {name}; there are {', '.join(REPORTS)}")
    if variant == "frame":
        return FRAME_REPORTS[name](data, **params)
    if variant == "notebook":
        params = {**NOTEBOOK_PARAMS.get(name, {}), **params}
    elif variant != "sql":
        raise ValueError(f"unknown variant {variant}")
    spec = REPORTS[name]
    rows = spec.fn(data, **params)
    if ordered and spec.order:
        rows = rows.orderBy(*[F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in spec.order])
    return rows


def write_reports(spark: SparkSession, data: MatchData, out: str, names=None, variant: str = "sql",
                  parallel: int = 4) -> list[tuple[str, str]]:
    """Write one table per report; return (report, error) of those that failed. A table is written aside and then put in the
    place of the old one, so a report that fails leaves the old one.

    The small jobs are submitted a few at a time so that the tail of one does not leave the cluster idle.
    """
    names = list(REPORTS) if names is None else list(names)

    def write(name: str):
        try:
            staged = scratch_dir(spark, f"report-{name}")
            report(name, data, variant).write.parquet(staged)
            note_types(spark, staged)
            replace_path(spark, staged, f"{out}/{name}")
        except Exception as e:  # one failing report must not stop the others
            return name, str(e)
        return None

    with ThreadPoolExecutor(parallel) as pool:
        return [f for f in pool.map(write, names) if f]
