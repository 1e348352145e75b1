"""The single-process reading of fourteen reports, straight from the balls."""

from creaseline.oracles.base import half_even, over_balls, over_innings, total
from creaseline.oracles.report_sql import CONCEDED, MATCHES, RUNS, WICKETS

SQL: dict[str, str] = {}
STRIKE = half_even(f"100 * {RUNS}", "COUNT(*)")

SQL["kpi03_best_batting_average__frame"] = over_innings(f"""
SELECT batsman, {total('runs')} AS total_runs, COUNT(*) AS innings, {total('was_out')} AS dismissals,
  CASE WHEN SUM(was_out) > 0 THEN {half_even(total('runs'), total('was_out'))} ELSE CAST(SUM(runs) AS DOUBLE) END AS batting_average
FROM knocks GROUP BY batsman HAVING COUNT(*) >= 3 ORDER BY batting_average DESC, batsman LIMIT 20""")
SQL["kpi04_best_bowling_average__frame"] = over_balls(f"""
SELECT bowler, {WICKETS} AS wickets, {CONCEDED} AS runs_conceded, {half_even(CONCEDED, WICKETS)} AS bowling_average
FROM balls GROUP BY bowler HAVING {WICKETS} >= 3 ORDER BY bowling_average, bowler LIMIT 20""")
SQL["kpi05_best_strike_rate__frame"] = over_balls(f"""
SELECT batsman, {RUNS} AS total_runs, COUNT(*) AS balls_faced, {STRIKE} AS strike_rate
FROM balls GROUP BY batsman HAVING COUNT(*) >= 30 ORDER BY strike_rate DESC, batsman LIMIT 20""")
SQL["kpi06_best_economy_rate__frame"] = over_balls(f"""
SELECT bowler, {CONCEDED} AS runs_conceded, COUNT(*) AS balls, {half_even('COUNT(*)', '6', 1)} AS overs_bowled, {half_even('6 * ' + CONCEDED, 'COUNT(*)')} AS economy_rate
FROM balls GROUP BY bowler HAVING {half_even('COUNT(*)', '6', 1)} >= 5 ORDER BY economy_rate, bowler LIMIT 20""")
SQL["kpi10_powerplay_run_rate__frame"] = over_balls(f"""
SELECT inning AS team, match_type, {half_even('6 * ' + CONCEDED, 'COUNT(*)')} AS powerplay_run_rate FROM balls WHERE over_num < 6 GROUP BY inning, match_type""")
SQL["kpi15_highest_team_totals__frame"] = over_balls(f"""
SELECT match_id, inning AS team, match_type, venue, {CONCEDED} AS team_total FROM balls GROUP BY match_id, inning, match_type, venue
ORDER BY team_total DESC, team, match_id, match_type, venue LIMIT 20""")
SQL["kpi17_most_wins_by_team__frame"] = over_balls("""
SELECT winner AS team, match_type, COUNT(*) AS wins FROM matches WHERE winner IS NOT NULL GROUP BY winner, match_type""")
SQL["kpi18_player_by_match_type__frame"] = over_balls(f"""
SELECT batsman, match_type, {RUNS} AS total_runs, COUNT(*) AS balls_faced, {STRIKE} AS strike_rate
FROM balls GROUP BY batsman, match_type ORDER BY total_runs DESC, batsman, match_type LIMIT 30""")
SQL["kpi19_partnership_analysis__frame"] = over_balls(f"""
SELECT batsman, non_striker, match_id, inning, match_type, {CONCEDED} AS partnership_runs, COUNT(*) AS balls
FROM balls GROUP BY batsman, non_striker, match_id, inning, match_type ORDER BY partnership_runs DESC, batsman, non_striker, match_id, inning LIMIT 20""")
SQL["kpi20_dot_ball_pct__frame"] = over_balls(f"""
SELECT bowler, COUNT(*) AS balls_bowled, COUNT(*) FILTER (WHERE runs_total = 0) AS dot_balls,
  {half_even('100 * COUNT(*) FILTER (WHERE runs_total = 0)', 'COUNT(*)')} AS dot_ball_pct
FROM balls GROUP BY bowler HAVING COUNT(*) >= 10 ORDER BY dot_ball_pct DESC, bowler LIMIT 20""")
SQL["kpi25_extras_analysis__frame"] = over_balls(f"""
SELECT inning AS team, match_type, {total('runs_extras')} AS total_extras, {MATCHES} AS matches, {half_even(total('runs_extras'), MATCHES)} AS avg_extras_per_match
FROM balls GROUP BY inning, match_type""")
SQL["kpi28_player_consistency__frame"] = over_innings(f"""
SELECT batsman, match_type, COUNT(*) AS innings, {half_even(total('runs'), 'COUNT(*)')} AS avg_score, COALESCE(ROUND(STDDEV_SAMP(runs), 2), 0.0) AS score_stddev
FROM knocks GROUP BY batsman, match_type HAVING COUNT(*) >= 3 ORDER BY score_stddev, batsman, match_type LIMIT 20""")
SQL["kpi29_best_bowling_spells__frame"] = over_balls(f"""
SELECT bowler, match_id, inning, match_type, CAST(FLOOR(over_num / 5) AS INT) AS over_group, MIN(over_num) AS spell_start_over, MAX(over_num) AS spell_end_over,
  {CONCEDED} AS runs_conceded, COUNT(*) FILTER (WHERE wicket_kind NOT IN ('run out', 'retired hurt')) AS wickets, COUNT(*) AS balls
FROM balls GROUP BY bowler, match_id, inning, match_type, CAST(FLOOR(over_num / 5) AS INT)
HAVING COUNT(*) FILTER (WHERE wicket_kind NOT IN ('run out', 'retired hurt')) >= 3
ORDER BY wickets DESC, runs_conceded, bowler, match_id, inning, match_type, over_group LIMIT 20""")
WON = "COALESCE(CAST(SUM(runs_batsman) FILTER (WHERE inning = winner) AS BIGINT), 0)"
SQL["kpi30_win_contribution__frame"] = over_balls(f"""
SELECT batsman, match_type, {MATCHES} AS matches, {RUNS} AS total_runs, {WON} AS winning_runs, {half_even('100 * ' + WON, RUNS)} AS win_contribution_pct
FROM balls GROUP BY batsman, match_type HAVING {RUNS} >= 30 ORDER BY win_contribution_pct DESC, batsman, match_type LIMIT 20""")
