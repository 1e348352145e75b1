"""The thirty reports, straight from the balls."""

from creaseline.oracles.base import big, half_even, half_up, over_balls, over_innings, total

SQL: dict[str, str] = {}

BOWLER_WICKET = "wicket_kind NOT IN ('run out', 'retired hurt', 'obstructing the field')"
WICKETS = f"COUNT(*) FILTER (WHERE {BOWLER_WICKET})"
RUNS, CONCEDED, MATCHES = total("runs_batsman"), total("runs_total"), "COUNT(DISTINCT match_id)"
OVERS = half_up("COUNT(*)", "6", 1)
ECONOMY = half_up(f"6 * {CONCEDED}", "COUNT(*)")
STRIKE = half_up(f"100 * {RUNS}", "COUNT(*)")


def _add(name: str, sql: str) -> None:
    SQL[name] = sql


_add("kpi01_top_run_scorers", over_balls(f"""
SELECT batsman, {RUNS} AS total_runs, COUNT(*) AS balls_faced, {MATCHES} AS matches
FROM balls GROUP BY batsman ORDER BY total_runs DESC, batsman LIMIT 10"""))


def _summary() -> str:
    return over_innings(f"""
, best AS (
  SELECT batsman, CAST(runs AS STRING) || CASE WHEN was_out = 0 THEN '*' ELSE '' END AS highest_score
  FROM knocks QUALIFY ROW_NUMBER() OVER (PARTITION BY batsman ORDER BY runs DESC, was_out, match_id, inning) = 1
), career AS (
  SELECT batsman, CAST(SUM(runs) AS BIGINT) AS total_runs, CAST(SUM(faced) AS BIGINT) AS balls_faced,
    COUNT(DISTINCT match_id) AS matches, COUNT(*) AS innings, CAST(SUM(was_out) AS BIGINT) AS dismissals
  FROM knocks GROUP BY batsman
)
SELECT batsman, total_runs, balls_faced, matches, innings, dismissals, innings - dismissals AS not_outs,
  CASE WHEN dismissals > 0 THEN {half_even('total_runs', 'dismissals')} ELSE CAST(total_runs AS DOUBLE) END AS batting_average,
  {half_even('100 * total_runs', 'balls_faced')} AS strike_rate, highest_score
FROM career JOIN best USING (batsman)""")


_add("kpi01x_batting_summary", _summary())
_add("kpi01_top_run_scorers__frame", _summary())


def _takers(having: str) -> str:
    return over_balls(f"""
SELECT bowler, {WICKETS} AS wickets, COUNT(*) AS balls_bowled, {MATCHES} AS matches
FROM balls GROUP BY bowler {having} ORDER BY wickets DESC, bowler LIMIT 10""")


_add("kpi02_top_wicket_takers", _takers(""))
_add("kpi02_top_wicket_takers__frame", _takers(f"HAVING {WICKETS} > 0"))


def _averages(min_innings: int, never_out: str) -> str:
    return over_innings(f"""
SELECT batsman, CAST(SUM(runs) AS BIGINT) AS total_runs, CAST(SUM(was_out) AS BIGINT) AS dismissals, COUNT(*) AS innings,
  CASE WHEN SUM(was_out) > 0 THEN {half_up(total('runs'), total('was_out'))} ELSE {never_out} END AS batting_average
FROM knocks GROUP BY batsman HAVING COUNT(*) >= {min_innings}
ORDER BY batting_average DESC NULLS LAST, batsman LIMIT 20""")


_add("kpi03_best_batting_average", _averages(3, "CAST(SUM(runs) AS DOUBLE)"))
_add("kpi03_best_batting_average__notebook", _averages(20, "NULL"))


def _bowling_average(least: int) -> str:
    return over_balls(f"""
SELECT bowler, {CONCEDED} AS runs_conceded, {WICKETS} AS wickets, {half_up(CONCEDED, WICKETS)} AS bowling_average
FROM balls GROUP BY bowler HAVING {WICKETS} >= {least} ORDER BY bowling_average NULLS LAST, bowler LIMIT 20""")


_add("kpi04_best_bowling_average", _bowling_average(3))
_add("kpi04_best_bowling_average__notebook", _bowling_average(50))


def _strike_rates(least: int) -> str:
    return over_balls(f"""
SELECT batsman, {RUNS} AS total_runs, COUNT(*) AS balls_faced, {STRIKE} AS strike_rate
FROM balls GROUP BY batsman HAVING COUNT(*) >= {least} ORDER BY strike_rate DESC, batsman LIMIT 20""")


_add("kpi05_best_strike_rate", _strike_rates(30))
_add("kpi05_best_strike_rate__notebook", _strike_rates(500))


def _economy(least: int) -> str:
    return over_balls(f"""
SELECT bowler, {CONCEDED} AS runs_conceded, {OVERS} AS overs_bowled, {ECONOMY} AS economy_rate
FROM balls GROUP BY bowler HAVING {OVERS} >= {least} ORDER BY economy_rate, bowler LIMIT 20""")


_add("kpi06_best_economy_rate", _economy(5))
_add("kpi06_best_economy_rate__notebook", _economy(100))

for _key, _unit in (("kpi07_highest_individual_scores", "batsman, match_id, match_type"),
                    ("kpi07_highest_individual_scores__frame", "batsman, match_id, match_type, inning")):
    _add(_key, over_balls(f"""
SELECT {_unit}, {RUNS} AS score, COUNT(*) AS balls_faced
FROM balls GROUP BY {_unit} ORDER BY score DESC, {_unit} LIMIT 20"""))

for _number, _name, _hit in (("08", "sixes", 6), ("09", "fours", 4)):
    for _suffix, _having in (("", ""), ("__frame", f"HAVING COUNT(*) FILTER (WHERE runs_batsman = {_hit}) > 0")):
        _add(f"kpi{_number}_most_{_name}{_suffix}", over_balls(f"""
SELECT batsman, COUNT(*) FILTER (WHERE runs_batsman = {_hit}) AS {_name}
FROM balls GROUP BY batsman {_having} ORDER BY {_name} DESC, batsman LIMIT 20"""))

_add("kpi10_powerplay_run_rate", over_balls(f"""
SELECT inning AS team, match_type, {ECONOMY} AS powerplay_run_rate, {MATCHES} AS matches
FROM balls WHERE over_num < 6 GROUP BY inning, match_type ORDER BY powerplay_run_rate DESC, team, match_type LIMIT 20"""))


def _death(least: int) -> str:
    return over_balls(f"""
SELECT bowler, match_type, {ECONOMY} AS death_economy, {MATCHES} AS matches, {OVERS} AS overs_bowled
FROM balls WHERE match_type = 'T20' AND over_num >= 15
GROUP BY bowler, match_type HAVING {OVERS} >= {least} ORDER BY death_economy, bowler, match_type LIMIT 20""")


_add("kpi11_death_over_economy", _death(2))
_add("kpi11_death_over_economy__notebook", _death(10))
_add("kpi11_death_over_economy__frame", over_balls(f"""
SELECT bowler, {CONCEDED} AS runs, COUNT(*) AS balls, {half_even('COUNT(*)', '6', 1)} AS overs,
  {half_even('6 * ' + CONCEDED, 'COUNT(*)')} AS death_economy
FROM balls WHERE over_num >= 16 GROUP BY bowler HAVING {half_even('COUNT(*)', '6', 1)} >= 2
ORDER BY death_economy, bowler LIMIT 20"""))

TOSS_WON = "COUNT(*) FILTER (WHERE toss_winner = winner)"
_add("kpi12_win_by_toss_decision", over_balls(f"""
SELECT toss_decision, match_type, COUNT(*) AS total_matches, {TOSS_WON} AS toss_winner_wins,
  {half_up('100 * ' + TOSS_WON, 'COUNT(*)')} AS win_pct
FROM matches WHERE winner IS NOT NULL AND toss_decision IS NOT NULL GROUP BY toss_decision, match_type"""))
_add("kpi12_win_by_toss_decision__frame", over_balls(f"""
SELECT COALESCE(toss_decision, '') AS toss_decision, match_type, COUNT(*) AS matches, {TOSS_WON} AS wins,
  {half_even('100 * ' + TOSS_WON, 'COUNT(*)')} AS win_pct
FROM matches GROUP BY ALL"""))

FIRST_WON = """COUNT(*) FILTER (WHERE CASE toss_decision WHEN 'bat' THEN toss_winner = winner
                                      WHEN 'field' THEN toss_winner <> winner ELSE FALSE END)"""
_add("kpi13_win_batting_first", over_balls(f"""
SELECT match_type, {FIRST_WON} AS batting_first_wins, COUNT(*) AS total_matches,
  {half_up('100 * ' + FIRST_WON, 'COUNT(*)')} AS batting_first_win_pct
FROM matches WHERE winner IS NOT NULL GROUP BY match_type"""))
_add("kpi13_win_batting_first__frame", over_balls(f"""
, openers AS (SELECT match_id, ARG_MIN(inning, inning_no) AS opener FROM balls GROUP BY match_id)
SELECT match_type, COUNT(*) AS matches, COUNT(*) FILTER (WHERE opener = winner) AS bat_first_wins,
  {half_even('100 * COUNT(*) FILTER (WHERE opener = winner)', 'COUNT(*)')} AS batting_first_win_pct
FROM matches JOIN openers USING (match_id) GROUP BY match_type"""))

TOTALS = """, totals AS (
  SELECT match_id, inning, match_type, venue, winner, MIN(inning_no) AS inning_no, CAST(SUM(runs_total) AS BIGINT) AS runs
  FROM balls GROUP BY match_id, inning, match_type, venue, winner
)"""
_add("kpi14_avg_score_by_venue", over_balls(TOTALS + f"""
SELECT venue, match_type, inning, {half_up(total('runs'), 'COUNT(*)')} AS avg_score
FROM totals GROUP BY venue, match_type, inning ORDER BY avg_score DESC, venue, match_type, inning LIMIT 30"""))
_add("kpi14_avg_score_by_venue__frame", over_balls(TOTALS + f"""
SELECT venue, match_type, {half_even(total('runs'), 'COUNT(*)')} AS avg_score, COUNT(DISTINCT match_id) AS matches
FROM totals GROUP BY venue, match_type ORDER BY avg_score DESC, venue, match_type LIMIT 30"""))
_add("kpi15_highest_team_totals", over_balls(TOTALS + """
SELECT inning AS team, match_id, match_type, venue, runs AS team_total
FROM totals ORDER BY runs DESC, inning, match_id, match_type, venue LIMIT 20"""))
_add("kpi16_lowest_successful_chases", over_balls(TOTALS + """
SELECT t.inning AS team, t.match_id, m.match_type, m.venue, t.runs AS chase_total
FROM totals t JOIN matches m ON m.match_id = t.match_id AND m.winner = t.inning
WHERE NOT CONTAINS(t.inning, '1st') ORDER BY chase_total, team, t.match_id LIMIT 20"""))
_add("kpi16_lowest_successful_chases__frame", over_balls(TOTALS + """
SELECT match_id, inning AS team, match_type, venue, runs AS chase_total, winner
FROM totals WHERE inning_no = 2 AND inning = winner ORDER BY chase_total, team, match_id LIMIT 20"""))
_add("kpi17_most_wins_by_team", over_balls("""
SELECT winner AS team, match_type, COUNT(*) AS wins
FROM matches WHERE winner IS NOT NULL GROUP BY winner, match_type ORDER BY wins DESC, team, match_type LIMIT 20"""))
_add("kpi18_player_by_match_type", over_balls(f"""
SELECT batsman, match_type, {RUNS} AS total_runs, COUNT(*) AS balls_faced, {STRIKE} AS strike_rate, {MATCHES} AS matches
FROM balls GROUP BY batsman, match_type ORDER BY total_runs DESC, batsman, match_type LIMIT 30"""))
_add("kpi19_partnership_analysis", over_balls(f"""
SELECT batsman, non_striker, match_id, inning, {CONCEDED} AS partnership_runs, COUNT(*) AS balls_faced
FROM balls GROUP BY ALL ORDER BY partnership_runs DESC, batsman, non_striker, match_id, inning LIMIT 20"""))
PAIRS = f"""
SELECT LEAST(batsman, non_striker) AS player_a, GREATEST(batsman, non_striker) AS player_b, match_id, inning,
  {CONCEDED} AS partnership_runs, COUNT(*) AS balls_faced
FROM balls GROUP BY ALL"""
_add("kpi19x_partnership_pairs", over_balls(PAIRS + " ORDER BY partnership_runs DESC, player_a, player_b, match_id, inning LIMIT 20"))


def _dots(least: int) -> str:
    dots = "COUNT(*) FILTER (WHERE runs_total = 0)"
    return over_balls(f"""
SELECT bowler, COUNT(*) AS balls_bowled, {dots} AS dot_balls, {half_up('100 * ' + dots, 'COUNT(*)')} AS dot_ball_pct
FROM balls GROUP BY bowler HAVING COUNT(*) >= {least} ORDER BY dot_ball_pct DESC, bowler LIMIT 20""")


_add("kpi20_dot_ball_pct", _dots(10))
_add("kpi20_dot_ball_pct__notebook", _dots(100))

HITS = "COUNT(*) FILTER (WHERE runs_batsman = 4 OR runs_batsman = 6)"
for _suffix, _death_start, _round in (("", 15, half_up), ("__frame", 16, half_even)):
    _add(f"kpi21_boundary_pct_per_phase{_suffix}", over_balls(f"""
SELECT match_type, CASE WHEN over_num >= {_death_start} THEN 'Death' WHEN over_num >= 6 THEN 'Middle' ELSE 'Powerplay' END AS phase,
  COUNT(*) AS total_balls, {HITS} AS boundaries, {_round('100 * ' + HITS, 'COUNT(*)')} AS boundary_pct
FROM balls GROUP BY ALL"""))

_add("kpi22_avg_runs_per_wicket", over_balls(f"""
SELECT match_type, inning, {half_up(CONCEDED, 'COUNT(wicket_kind)')} AS avg_runs_per_wicket
FROM balls GROUP BY match_type, inning"""))
_add("kpi22_avg_runs_per_wicket__frame", over_balls(f"""
, per AS (
  SELECT match_id, inning, match_type, CAST({half_even('100 * ' + CONCEDED, 'COUNT(wicket_kind)', 0)} AS BIGINT) AS hundredths
  FROM balls GROUP BY match_id, inning, match_type HAVING COUNT(wicket_kind) > 0
)
SELECT inning, match_type, {half_even(total('hundredths'), 'COUNT(*)', 0)} / 100 AS avg_runs_per_wicket FROM per GROUP BY inning, match_type"""))

OVER_PRESSURE = f"""
SELECT match_id, inning, over_num, {CONCEDED} AS runs_in_over, COUNT(wicket_kind) AS wickets_in_over,
  {ECONOMY} AS over_run_rate, CAST(COUNT(wicket_kind) * 10 + 6 - {CONCEDED} AS DOUBLE) AS pressure_index
FROM balls GROUP BY match_id, inning, over_num"""
_add("kpi23_pressure_index_per_over", over_balls(OVER_PRESSURE))
_add("kpi23_pressure_index_per_over__frame", over_balls(f"""
SELECT match_id, inning, over_num, match_type, {CONCEDED} AS runs, COUNT(wicket_kind) AS wickets,
  {big(f"COUNT(wicket_kind) * 10 + GREATEST(6 - {CONCEDED}, 0)")} AS pressure_index
FROM balls GROUP BY match_id, inning, over_num, match_type"""))

PROGRESSION = f"""
SELECT match_type, over_num, {half_up(total('runs'), 'COUNT(*)')} AS avg_runs_per_over, {half_up(total('runs'), 'COUNT(*)')} AS avg_run_rate
FROM (SELECT match_type, match_id, inning, over_num, {CONCEDED} AS runs FROM balls GROUP BY ALL)
GROUP BY match_type, over_num"""
_add("kpi24_run_rate_progression", over_balls(PROGRESSION))


def cumulative(rounded) -> str:
    return f"""
, per AS (
  SELECT match_type, inning AS team, over_num, {CONCEDED} AS runs, {MATCHES} AS overs FROM balls GROUP BY match_type, inning, over_num
), run_rate AS (
  SELECT match_type, team, over_num, {rounded('runs', 'overs')} AS avg_runs_per_over,
    {rounded('runs_so_far', 'overs_so_far')} AS avg_run_rate
  FROM (SELECT *, CAST(SUM(runs) OVER w AS BIGINT) AS runs_so_far, CAST(SUM(overs) OVER w AS BIGINT) AS overs_so_far
        FROM per WINDOW w AS (PARTITION BY match_type, team ORDER BY over_num ROWS UNBOUNDED PRECEDING))
)"""


_add("kpi24x_cumulative_run_rate", over_balls(cumulative(half_even) + " SELECT * FROM run_rate"))
_add("kpi24_run_rate_progression__frame", SQL["kpi24x_cumulative_run_rate"])
_add("kpi25_extras_analysis", over_balls(f"""
SELECT inning AS team, match_type, {total('runs_extras')} AS total_extras, {MATCHES} AS matches,
  {half_up(total('runs_extras'), MATCHES)} AS avg_extras_per_match
FROM balls GROUP BY inning, match_type ORDER BY avg_extras_per_match DESC, team, match_type LIMIT 20"""))
GROUNDS = """
SELECT winner, venue, match_type, COUNT(*) AS wins,
  CASE WHEN CONTAINS(venue, SPLIT_PART(winner, ' ', 1)) THEN 'Home' ELSE 'Away' END AS home_away
FROM matches WHERE winner IS NOT NULL GROUP BY ALL"""
_add("kpi26_home_away_win_pct", over_balls(GROUNDS + " ORDER BY wins DESC, winner, venue, match_type LIMIT 30"))
_add("kpi26_home_away_win_pct__frame", over_balls("""
SELECT winner AS team, match_type, COUNT(*) AS wins,
  CASE WHEN CONTAINS(venue, winner) OR winner IN ('India', 'Sri Lanka') THEN 'Home' ELSE 'Away' END AS home_away
FROM matches WHERE winner IS NOT NULL GROUP BY ALL ORDER BY wins DESC, team, match_type, home_away LIMIT 30"""))
RECORDS = """
SELECT team1, team2, match_type, COUNT(*) AS matches_played, COUNT(*) FILTER (WHERE winner = team1) AS team1_wins,
  COUNT(*) FILTER (WHERE winner = team2) AS team2_wins, COUNT(*) FILTER (WHERE winner IS NULL) AS no_result
FROM matches GROUP BY team1, team2, match_type"""
_add("kpi27_head_to_head", over_balls(RECORDS + " ORDER BY matches_played DESC, team1, team2, match_type LIMIT 30"))
_add("kpi27_head_to_head__frame", over_balls("""
, pairs AS (SELECT LEAST(team1, team2) AS a, GREATEST(team1, team2) AS z, winner FROM matches WHERE winner IS NOT NULL)
SELECT a AS team1, z AS team2, COUNT(*) AS matches_played, COUNT(*) FILTER (WHERE winner = a) AS team1_wins,
  COUNT(*) FILTER (WHERE winner = z) AS team2_wins, CAST(0 AS BIGINT) AS no_result
FROM pairs GROUP BY a, z ORDER BY matches_played DESC, a, z LIMIT 30"""))


def _consistency(least: int) -> str:
    return over_innings(f"""
SELECT batsman, match_type, COUNT(*) AS innings, {half_up(total('runs'), 'COUNT(*)')} AS avg_score, ROUND(STDDEV_SAMP(runs), 2) AS score_stddev
FROM knocks GROUP BY batsman, match_type HAVING COUNT(*) >= {least}
ORDER BY score_stddev NULLS LAST, batsman, match_type LIMIT 20""")


_add("kpi28_player_consistency", _consistency(3))
_add("kpi28_player_consistency__notebook", _consistency(20))
_add("kpi29_best_bowling_spells", over_balls(f"""
, spells AS (
  SELECT bowler, match_id, inning, match_type, over_num // 5 AS spell, MIN(over_num) AS spell_start_over, MAX(over_num) AS spell_end_over,
    {CONCEDED} AS runs_conceded, COUNT(*) FILTER (WHERE wicket_kind NOT IN ('run out', 'retired hurt')) AS wickets, COUNT(*) AS balls
  FROM balls GROUP BY ALL
)
SELECT * EXCLUDE (spell) FROM spells WHERE wickets >= 3
ORDER BY wickets DESC, runs_conceded, bowler, match_id, inning, match_type, spell LIMIT 20"""))


def _contribution(least: int) -> str:
    won = big("COALESCE(SUM(runs_batsman) FILTER (WHERE winner = inning), 0)")
    return over_balls(f"""
SELECT batsman, match_type, {MATCHES} AS matches, {won} AS winning_runs, {RUNS} AS total_runs,
  {half_up('100 * ' + won, RUNS)} AS win_contribution_pct
FROM balls GROUP BY batsman, match_type HAVING {RUNS} >= {least}
ORDER BY win_contribution_pct DESC NULLS LAST, batsman, match_type LIMIT 20""")


_add("kpi30_win_contribution", _contribution(30))
_add("kpi30_win_contribution__notebook", _contribution(500))
