"""Hand-computed results over twelve balls of three matches, variants, and the shared inputs."""

import pytest
from pyspark.sql import functions as F

from creaseline.plans import batting, bowling, explore, teams, trends
from creaseline.plans.match_data import MatchData, matches_of_balls
from creaseline.plans.reports import FRAME_REPORTS, NOTEBOOK_PARAMS, REPORTS, report, write_reports
from creaseline.sources import bridge
from tests.conftest import SF_SMALL

BALL = ("match_id string, match_type string, team1 string, team2 string, venue string, match_date string, winner string, "
        "toss_winner string, toss_decision string, inning string, over_num int, batsman string, bowler string, non_striker string, "
        "runs_batsman int, runs_extras int, runs_total int, wicket_kind string, wicket_player_out string")
# Invented: a home win batting first, a match without a result, and a chase.
G1 = ("g1", "T20", "Reds", "Blues", "Reds Park", "2031-04-01", "Reds", "Blues", "field")
G2 = ("g2", "ODI", "Greens", "Blues", "Lake Ground", "2031-04-02", None, "Greens", "bat")
G3 = ("g3", "T20", "Blues", "Greens", "Lake Ground", "2031-04-03", "Greens", "Blues", "bat")
BALLS = [
    (*G1, "Reds", 0, "Ada", "Kit", "Bo", 4, 0, 4, None, None),
    (*G1, "Reds", 0, "Bo", "Kit", "Ada", 6, 0, 6, None, None),
    (*G1, "Reds", 1, "Ada", "Lux", "Bo", 0, 0, 0, "bowled", "Ada"),
    (*G1, "Reds", 1, "Bo", "Lux", "Cy", 1, 1, 2, None, None),
    (*G1, "Blues", 0, "Dov", "Max", "Eli", 3, 0, 3, None, None),
    (*G1, "Blues", 0, "Dov", "Max", "Eli", 0, 0, 0, "lbw", "Dov"),
    (*G1, "Blues", 0, "Eli", "Max", "Fay", 0, 0, 0, "caught", "Eli"),
    (*G2, "Greens", 0, "Gus", "Nia", "Hal", 6, 0, 6, None, None),
    (*G2, "Blues", 0, "Dov", "Ola", "Eli", 6, 0, 6, None, None),
    (*G2, "Blues", 1, "Dov", "Ola", "Eli", 4, 0, 4, "run out", "Eli"),
    (*G3, "Blues", 0, "Dov", "Nia", "Eli", 1, 0, 1, None, None),
    (*G3, "Greens", 0, "Gus", "Max", "Hal", 4, 0, 4, None, None),
]


@pytest.fixture(scope="module")
def data(spark):
    return MatchData(spark.createDataFrame(BALLS, BALL))


def as_dict(rows, key, *values):
    return {r[key]: tuple(r[v] for v in values) for r in rows.collect()}


def test_top_run_scorers(data):
    assert as_dict(batting.top_run_scorers(data), "batsman", "total_runs", "balls_faced", "matches") == {
        "Dov": (14, 5, 3), "Gus": (10, 2, 2), "Bo": (7, 2, 1), "Ada": (4, 2, 1), "Eli": (0, 1, 1)}


def test_wickets_sixes_fours(data):
    assert as_dict(bowling.top_wicket_takers(data), "bowler", "wickets") == {"Max": (2,), "Lux": (1,), "Kit": (0,), "Nia": (0,), "Ola": (0,)}
    assert as_dict(batting.most_sixes(data, only_hitters=True), "batsman", "sixes") == {"Bo": (1,), "Gus": (1,), "Dov": (1,)}
    assert as_dict(batting.most_fours(data, only_hitters=True), "batsman", "fours") == {"Ada": (1,), "Dov": (1,), "Gus": (1,)}


def test_matches_and_totals(data):
    assert as_dict(data.matches, "match_id", "winner") == {"g1": ("Reds",), "g2": (None,), "g3": ("Greens",)}
    assert [(r.team, r.match_id, r.team_total) for r in teams.highest_team_totals(data).collect()] == [
        ("Reds", "g1", 12), ("Blues", "g2", 10), ("Greens", "g2", 6), ("Greens", "g3", 4), ("Blues", "g1", 3), ("Blues", "g3", 1)]


def test_chase_and_home_win(data, spark):
    chases = teams.lowest_successful_chases(data)
    assert ("Greens", "g3") in {(r.team, r.match_id) for r in chases.collect()}
    assert as_dict(report("home_away_win_pct", data), "winner", "home_away") == {"Reds": ("Home",), "Greens": ("Away",)}


def test_run_rate_progression(data):
    rows = {(r.match_type, r.over_num): r.avg_runs_per_over for r in trends.run_rate_progression(data).collect()}
    assert rows == {("T20", 0): 4.5, ("T20", 1): 2.0, ("ODI", 0): 6.0, ("ODI", 1): 4.0}


def test_reports_with_thresholds_are_empty(data):
    for name in ("death_over_economy", "best_bowling_spells"):
        assert report(name, data).count() == 0, name
    for name in NOTEBOOK_PARAMS:
        assert report(name, data, "notebook").count() == 0, name


def test_batting_summary_marks_not_out(data):
    best = as_dict(batting.batting_summary(data), "batsman", "highest_score", "not_outs")
    assert best["Bo"] == ("7*", 1) and best["Ada"] == ("4", 0) and best["Dov"] == ("10*", 2)


def test_two_innings_of_one_team(spark):
    """A team's two innings of a match count together in SQL's reading."""
    rows = [(*BALLS[0][:10], over, "Ada", "Kit", "Bo", runs, 0, runs, None, None, no)
            for over, runs, no in ((0, 4, 1), (0, 6, 3))]
    d = MatchData(spark.createDataFrame(rows, BALL + ", inning_no int"))
    assert [r.team_total for r in teams.highest_team_totals(d).collect()] == [10]
    assert [r.avg_runs_per_over for r in trends.run_rate_progression(d).collect()] == [10.0]


def test_unordered_reports_can_be_sorted(data):
    rows = report("run_rate_progression", data, ordered=True).collect()
    assert [(r.match_type, r.over_num) for r in rows] == [("ODI", 0), ("ODI", 1), ("T20", 0), ("T20", 1)]
    for name, variant in (("head_to_head", "other"), ("no_such_report", "frame"), ("no_such_report", "sql")):
        with pytest.raises(ValueError):
            report(name, data, variant)


def test_variants_are_all_known():
    assert len(REPORTS) == 30 and set(FRAME_REPORTS) == set(REPORTS) and set(NOTEBOOK_PARAMS) <= set(REPORTS)


def test_shared_inputs_give_the_same_reports(spark, folder):
    balls = bridge.balls(spark, SF_SMALL)
    direct = MatchData(balls, matches_of_balls(balls))
    staged = direct.stage(spark, f"{folder}/inputs")
    cases = [(n, "sql") for n in REPORTS] + [(n, "frame") for n in FRAME_REPORTS]
    for name, variant in cases:
        a, b = report(name, direct, variant), report(name, staged, variant)
        assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(b.columns)).collect())), name


def test_one_failing_report_does_not_stop_the_others(spark, data, folder, monkeypatch):
    broken = dict(REPORTS)
    broken["most_sixes"] = type(REPORTS["most_sixes"])(lambda d: d.balls.select("no_such_column"))
    monkeypatch.setattr("creaseline.plans.reports.REPORTS", broken)
    spark.range(2).write.parquet(f"{folder}/most_sixes")
    failed = write_reports(spark, data, folder, ["most_sixes", "most_fours"])
    assert [name for name, _ in failed] == ["most_sixes"]
    assert spark.read.parquet(f"{folder}/most_fours").count() == 5
    assert spark.read.parquet(f"{folder}/most_sixes").count() == 2  # the old table is still there


def test_row_counts_of_nothing(spark):
    empty = spark.createDataFrame([], BALL)
    assert explore.row_counts(empty).first() == (0, 0)


def test_home_ground_names_are_not_patterns(spark):
    row = list(BALLS[0]); row[2], row[4], row[6] = "100% XI", "Oval 100 XI", "100% XI"
    d = MatchData(spark.createDataFrame([tuple(row)], BALL))
    assert report("home_away_win_pct", d).first().home_away == "Away"


def test_head_to_head_pairs_either_order(spark, data):
    swapped = list(G1); swapped[0], swapped[2], swapped[3] = "g4", "Blues", "Reds"
    extra = data.matches.unionByName(spark.createDataFrame([tuple(swapped)], data.matches.schema))
    row = teams.head_to_head_pairs(MatchData(data.balls, extra)).first()
    assert (row.team1, row.team2, row.matches_played, row.team1_wins, row.team2_wins) == ("Blues", "Reds", 2, 0, 2)
