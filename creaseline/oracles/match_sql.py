"""Sources, sinks, projections, joins, aggregates, windows and serving reads over the balls."""

from creaseline.oracles.base import half_even, half_up, over_balls, over_innings, over_numbered, total
from creaseline.oracles.report_sql import CONCEDED, GROUNDS, OVER_PRESSURE, PAIRS, PROGRESSION, RECORDS, RUNS, SQL as REPORT_SQL, TOTALS, cumulative

SQL: dict[str, str] = {}
# Flags of the named teams of the bridge.
FLAGS = "WHEN 'India' THEN '🇮🇳' WHEN 'Sri Lanka' THEN '🇱🇰' WHEN 'Oman' THEN '🇴🇲'"
MATCH = "match_id, match_type, team1, team2, venue, match_date, winner, toss_winner, toss_decision"
FLAT = (MATCH + ", inning, inning_no, over_num, ball_num, batsman, bowler, non_striker, runs_batsman, runs_extras, runs_total, "
        "wicket_kind, wicket_player_out")

# --- sources, sinks ---
SQL["src_match_documents"] = over_balls(f"""
SELECT match_id, match_type, venue, winner, COUNT(*) AS balls, {CONCEDED} AS runs, COUNT(wicket_kind) AS wickets,
  COUNT(DISTINCT inning_no) AS innings FROM balls GROUP BY match_id, match_type, venue, winner""")
SQL["src_match_documents__files"] = SQL["src_match_documents"]
SQL["src_table"] = over_balls(f"""
SELECT venue, COUNT(*) AS balls, {CONCEDED} AS runs FROM balls WHERE match_type = 'T20' GROUP BY venue""")
SQL["src_kpi_table"] = over_balls(TOTALS + """
SELECT inning AS team, match_id, match_type, venue, CAST(runs AS DOUBLE) AS team_total FROM totals""")
SQL["src_coerce_numeric"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(q AS DOUBLE) AS every_row,
  CASE WHEN q % 5 > 0 THEN CAST(q AS DOUBLE) END AS most_rows,
  CASE WHEN q % 5 > 2 THEN CAST(q AS VARCHAR) ELSE 'n/a' END AS few_rows, l_returnflag AS no_row
FROM (SELECT *, CAST(l_quantity AS INT) AS q FROM lineitem)"""
SQL["src_incremental_matches"] = over_balls("""
SELECT match_id, 'Cup ' || SUBSTR(match_date, 6, 2) AS event FROM matches
WHERE SUBSTR(match_date, 6, 1) = '1' AND match_date >= '2024-07-01'""")
SQL["src_load_counts"] = over_balls("""
SELECT COUNT(*) FILTER (WHERE match_date < '2024-07-01') AS existing_matches,
  COUNT(*) FILTER (WHERE match_date >= '2024-07-01') AS new_matches, COUNT(*) AS total_matches FROM matches""")
SQL["snk_raw_partitioned"] = over_balls("""
SELECT match_type, '2024' AS season, COUNT(*) AS documents, COUNT(DISTINCT match_id) AS matches FROM matches GROUP BY match_type""")
SQL["snk_clean_partitioned"] = over_balls(f"""
SELECT match_type, COUNT(*) AS balls, {CONCEDED} AS runs, COUNT(wicket_kind) AS wickets FROM balls GROUP BY match_type""")
SQL["snk_clean_incremental"] = over_balls(f"""
SELECT match_id, match_type, '2024' AS season,
  CASE WHEN match_date < '2024-07-01' AND CAST(SUBSTR(match_id, 7) AS BIGINT) % 10 = 3 THEN 2 ELSE 1 END AS revision,
  COUNT(*) AS balls, {CONCEDED} AS runs, COUNT(wicket_kind) AS wickets FROM balls GROUP BY match_id, match_type, match_date""")
SQL["dq_quarantine"] = over_balls("""
SELECT match_id, '2024' AS season, CASE runs_batsman WHEN 3 THEN 'no_bowler' ELSE 'runs_out_of_range' END AS failed_rule, COUNT(*) AS balls
FROM balls WHERE runs_batsman IN (2, 3) GROUP BY ALL""")
SQL["tbl_compact"] = over_balls(f"SELECT match_type, COUNT(*) AS balls, {CONCEDED} AS runs FROM balls GROUP BY match_type")
SQL["tbl_stats"] = "SELECT COUNT(*) AS row_count, TRUE AS has_bytes, TRUE AS has_time FROM lineitem"


# Rows of each of the thirty tables: the report's own SQL, counted.
SQL["snk_kpi_tables"] = "\nUNION ALL\n".join(
    f"SELECT '{key[6:]}' AS kpi, COUNT(*) AS row_count, 'ok' AS status FROM ({sql}) AS r"
    for key, sql in REPORT_SQL.items() if "__" not in key and key[5] == "_")
SQL["snk_kpi_tables__incremental"] = SQL["snk_kpi_tables"]
SQL["snk_export_parquet"] = "\nUNION ALL\n".join([
    *[f"SELECT '{key[6:]}' AS kpi, COUNT(*) AS row_count, 'ok' AS status FROM ({REPORT_SQL[key]}) AS r"
      for key in ("kpi17_most_wins_by_team", "kpi24_run_rate_progression")],
    "SELECT 'no_such_report' AS kpi, CAST(NULL AS BIGINT) AS row_count, 'failed: AnalysisException' AS status"])

# --- projections and data quality ---
SQL["prj_enrich_batch"] = over_balls("SELECT match_id, TRUE AS has_time, TRUE AS same_day FROM matches")
SQL["prj_rebuild_struct"] = over_balls("""
SELECT match_id, venue, '2024' AS season, 'dates,event,match_type,outcome,season,teams,toss,venue' AS fields FROM matches""")
SQL["prj_flatten_match"] = over_numbered(f"SELECT {FLAT} FROM numbered")
SQL["prj_flatten_match__frame"] = over_balls("""
SELECT match_id, COALESCE(winner, '') AS winner, COALESCE(toss_decision, '') AS toss_decision, inning, over_num, batsman, bowler, runs_total,
  wicket_kind FROM balls""")
SQL["prj_flatten_all_wickets"] = over_balls("""
SELECT match_id, inning, wicket_kind, COUNT(*) AS wickets FROM balls WHERE wicket_kind IS NOT NULL GROUP BY ALL""")

DIRTY = """, dirty AS (
  SELECT match_id, inning, ball_num, runs_batsman,
    CASE WHEN wicket_kind = 'stumped' THEN -1 ELSE over_num END AS over_num,
    CASE WHEN runs_batsman + runs_extras <> 7 THEN batsman END AS batsman,
    CASE WHEN wicket_kind IS DISTINCT FROM 'lbw' THEN bowler END AS bowler,
    CASE WHEN runs_batsman <> 1 THEN runs_extras END AS runs_extras,
    CASE runs_batsman WHEN 3 THEN NULL WHEN 2 THEN 37 ELSE runs_total END AS runs_total
  FROM numbered
)"""
SQL["dq_clean_balls"] = over_numbered(DIRTY + """
SELECT match_id, inning, over_num, ball_num, batsman, bowler, runs_batsman, COALESCE(runs_extras, 0) AS runs_extras, runs_total
FROM dirty WHERE batsman IS NOT NULL AND bowler IS NOT NULL AND runs_total BETWEEN 0 AND 36 AND over_num >= 0""")
SQL["dq_rejected_balls"] = over_numbered(DIRTY + """
SELECT * FROM (
  SELECT *, CASE WHEN batsman IS NULL THEN 'no_batsman' WHEN bowler IS NULL THEN 'no_bowler'
    WHEN runs_total IS NULL OR runs_total NOT BETWEEN 0 AND 36 THEN 'runs_out_of_range' WHEN over_num < 0 THEN 'bad_over' END AS failed_rule
  FROM dirty) WHERE failed_rule IS NOT NULL""")
SQL["dq_null_counts"] = over_numbered(DIRTY + """
SELECT COUNT(*) - COUNT(batsman) AS batsman_nulls, COUNT(*) - COUNT(bowler) AS bowler_nulls,
  COUNT(*) - COUNT(runs_total) AS runs_total_nulls, COUNT(*) - COUNT(over_num) AS over_num_nulls FROM dirty""")
SQL["flt_predicates"] = over_balls("""
SELECT match_type, venue, wicket_kind, COUNT(*) AS balls FROM balls
WHERE winner IS NOT NULL AND wicket_kind NOT IN ('run out', 'retired hurt') AND match_type IN ('T20', 'ODI') AND over_num BETWEEN 3 AND 17
  AND (venue LIKE 'T1%' OR venue NOT LIKE '%2x%') AND toss_winner <> winner
GROUP BY ALL""")

# --- joins ---
SQL["jn_balls_matches"] = over_balls(f"""
SELECT batsman, match_type, COALESCE(CAST(SUM(runs_batsman) FILTER (WHERE inning = winner) AS BIGINT), 0) AS winning_runs, {RUNS} AS total_runs
FROM balls GROUP BY batsman, match_type""")
SQL["jn_chase_theta"] = over_balls(f"""
SELECT match_id, ANY_VALUE(winner) AS team, ANY_VALUE(match_type) AS match_type, ANY_VALUE(venue) AS venue, {CONCEDED} AS total
FROM balls WHERE inning IN (winner) GROUP BY match_id""")
SQL["jn_left_fill"] = over_balls("""
SELECT a.batsman, a.innings, COALESCE(o.dismissals, 0) AS dismissals
FROM (SELECT batsman, COUNT(DISTINCT match_id || '_' || inning) AS innings FROM balls GROUP BY batsman) a
LEFT JOIN (SELECT batsman, COUNT(DISTINCT match_id || '_' || inning) AS dismissals FROM balls
           WHERE wicket_player_out = batsman GROUP BY batsman) o USING (batsman)""")
SQL["jn_composite"] = over_innings("SELECT batsman, match_id, inning, runs AS score, was_out = 0 AS not_out FROM knocks")
SQL["jn_first_innings"] = over_balls(TOTALS + "SELECT match_id, inning, runs AS innings_total FROM totals WHERE inning_no = 2")
SQL["jn_player_team"] = over_balls(f"""
SELECT batsman, total_runs, team, flag, CASE WHEN flag = '' THEN batsman ELSE flag || ' ' || batsman END AS player_display
FROM (SELECT *, CASE team {FLAGS} ELSE '' END AS flag
      FROM (SELECT batsman, {RUNS} AS total_runs, ARG_MAX(inning, match_id) AS team FROM balls GROUP BY batsman))""")
SQL["jn_team_labels"] = f"""
SELECT c_custkey, team, flag, short, flag || ' ' || team AS display
FROM customer JOIN (VALUES (0, 'India', '🇮🇳', 'India'), (1, 'South Africa', '🇿🇦', 'SA'),
  (2, 'Sri Lanka', '🇱🇰', 'SL'), (3, 'United Arab Emirates', '🇦🇪', 'UAE'),
  (4, 'Elsewhere', '🏳️', 'Elsewhere')) AS v(k, team, flag, short) ON c_nationkey % 5 = k"""
SQL["jn_new_matches"] = over_balls("SELECT match_id FROM matches WHERE match_date >= '2024-07-01'")

# --- aggregates ---
SQL["agg_matches_distinct"] = over_balls(f"SELECT {MATCH} FROM balls GROUP BY ALL")
SQL["agg_toss_impact"] = over_balls(f"""
SELECT toss_decision, venue, match_type, COUNT(*) AS total_matches, COUNT(*) FILTER (WHERE toss_winner = winner) AS toss_winner_wins,
  COUNT(*) FILTER (WHERE toss_winner <> winner) AS toss_winner_losses,
  {half_up('100 * COUNT(*) FILTER (WHERE toss_winner = winner)', 'COUNT(*)')} AS win_probability
FROM matches WHERE toss_decision IS NOT NULL AND winner IS NOT NULL GROUP BY toss_decision, venue, match_type HAVING COUNT(*) >= 5""")
SQL["agg_toss_summary"] = over_balls(f"""
SELECT toss_decision, match_type, COUNT(*) AS total_matches, COUNT(*) FILTER (WHERE toss_winner = winner) AS wins_after_toss,
  {half_up('100 * COUNT(*) FILTER (WHERE toss_winner = winner)', 'COUNT(*)')} AS win_pct
FROM matches WHERE toss_decision IS NOT NULL AND winner IS NOT NULL GROUP BY toss_decision, match_type""")
OVER_RATE = f"""
SELECT match_id, inning, over_num, {CONCEDED} AS over_runs, COUNT(*) AS balls_in_over, {half_up('6 * ' + CONCEDED, 'COUNT(*)')} AS over_run_rate
FROM balls GROUP BY match_id, inning, over_num"""
SQL["agg_over_run_rate"] = over_balls(OVER_RATE)
SQL["agg_match_batsman_totals"] = over_balls(f"SELECT match_id, batsman, {RUNS} AS innings_runs FROM balls GROUP BY match_id, batsman")
SQL["agg_count_by_type"] = over_balls("SELECT match_type, COUNT(*) AS count FROM matches GROUP BY match_type")
SQL["agg_runs_histogram"] = over_balls("SELECT runs_total, COUNT(*) AS count FROM balls GROUP BY runs_total")
SQL["agg_top_venues"] = over_balls("SELECT venue, COUNT(*) AS count FROM matches GROUP BY venue ORDER BY count DESC, venue LIMIT 10")
SQL["agg_row_counts"] = over_balls("SELECT COUNT(*) AS deliveries, COUNT(DISTINCT match_id) AS matches FROM balls")
SQL["agg_player_team"] = over_balls("""
, squads AS (
  SELECT match_id, team1, team2, i.n AS i, CAST(SUBSTR(match_id, 7) AS BIGINT) AS n
  FROM matches, (SELECT UNNEST(RANGE(0, 11)) AS n) i
), named AS (
  SELECT match_id, team1 AS team, 'S' || CAST(2 * ((n + i) % 40) AS STRING) AS player FROM squads
  UNION ALL SELECT match_id, team2, 'S' || CAST(2 * ((n + i) % 40) + 1 AS STRING) FROM squads
)
SELECT player, ARG_MAX(team, '/matches/' || match_id || '.json') AS team FROM named GROUP BY player""")
SQL["agg_overview_rr"] = over_balls(cumulative(half_even) + f"""
, over_means AS (
  SELECT *, hundredths / (teams * 100.0) AS mean
  FROM (SELECT match_type, over_num, CAST(SUM(CAST(ROUND(avg_runs_per_over * 100) AS BIGINT)) AS BIGINT) AS hundredths, COUNT(*) AS teams
        FROM run_rate GROUP BY match_type, over_num)
)
SELECT match_type, over_num, {half_even('hundredths', '100 * teams')} AS avg_runs_per_over,
  ROUND_EVEN(SUM(mean) OVER w / ROW_NUMBER() OVER w, 2) AS avg_run_rate
FROM over_means WINDOW w AS (PARTITION BY match_type ORDER BY over_num ROWS UNBOUNDED PRECEDING)""")
SQL["agg_home_away_total"] = over_balls(f"SELECT home_away, {total('wins')} AS wins FROM ({GROUNDS}) GROUP BY home_away")
SQL["agg_chasing_pct"] = f"SELECT *, ROUND(100 - batting_first_win_pct, 2) AS chasing_win_pct FROM ({REPORT_SQL['kpi13_win_batting_first']}) AS r"
SQL["agg_headline"] = over_balls(f"""
, bat AS (SELECT batsman, {RUNS} AS runs, COUNT(*) FILTER (WHERE runs_batsman = 6) AS sixes, COUNT(*) FILTER (WHERE runs_batsman = 4) AS fours
          FROM balls GROUP BY batsman),
bowl AS (SELECT bowler, COUNT(*) FILTER (WHERE wicket_kind NOT IN ('run out', 'retired hurt', 'obstructing the field')) AS wickets
         FROM balls GROUP BY bowler)
SELECT r.batsman AS top_batsman, r.runs AS top_runs, w.bowler AS top_bowler, w.wickets AS top_wickets,
  s.batsman AS six_hitter, s.sixes AS top_sixes, f.batsman AS four_hitter, f.fours AS top_fours
FROM (SELECT * FROM bat ORDER BY runs DESC, batsman LIMIT 1) r, (SELECT * FROM bowl ORDER BY wickets DESC, bowler LIMIT 1) w,
  (SELECT * FROM bat ORDER BY sixes DESC, batsman LIMIT 1) s, (SELECT * FROM bat ORDER BY fours DESC, batsman LIMIT 1) f""")

# --- windows ---
SQL["win_rolling_avg_runs"] = over_numbered("""
SELECT match_id, inning, over_num, ball_num, runs_total,
  AVG(runs_total) OVER (PARTITION BY match_id, inning ORDER BY over_num, ball_num ROWS 5 PRECEDING) AS rolling_avg_runs FROM numbered""")
SQL["win_cumulative_runs"] = over_numbered("""
SELECT match_id, inning, over_num, ball_num, runs_total,
  CAST(SUM(runs_total) OVER (PARTITION BY match_id, inning ORDER BY over_num, ball_num ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_runs
FROM numbered""")
SQL["win_momentum"] = over_balls(f""", rates AS ({OVER_RATE}), shifts AS (
  SELECT *, LAG(over_runs) OVER w AS prev_over_runs, LEAD(over_runs) OVER w AS next_over_runs
  FROM rates WINDOW w AS (PARTITION BY match_id, inning ORDER BY over_num))
SELECT *, CASE SIGN(over_runs - prev_over_runs) WHEN 1 THEN 'accelerating' WHEN -1 THEN 'decelerating' ELSE 'steady' END AS momentum_shift
FROM shifts""")
SQL["win_rank_batsmen"] = over_balls(f"""
SELECT match_id, batsman, {RUNS} AS innings_runs, CAST(RANK() OVER (PARTITION BY match_id ORDER BY {RUNS} DESC) AS INT) AS batsman_rank
FROM balls GROUP BY match_id, batsman""")
SQL["win_cumsum_team"] = over_balls(cumulative(half_up) + " SELECT * FROM run_rate")
SQL["win_cumcount"] = over_balls(f"""
, per AS (SELECT match_type, over_num, {CONCEDED} AS runs FROM balls GROUP BY match_type, over_num)
SELECT match_type, over_num, runs, CAST(ROW_NUMBER() OVER w AS INT) AS overs_so_far,
  {half_up('CAST(SUM(runs) OVER w AS BIGINT)', 'ROW_NUMBER() OVER w', 4)} AS mean_so_far
FROM per WINDOW w AS (PARTITION BY match_type ORDER BY over_num ROWS UNBOUNDED PRECEDING)""")
SQL["win_first_per_group"] = over_innings("""
, openers AS (SELECT match_id, ARG_MIN(inning, inning_no) AS batting_first FROM balls GROUP BY match_id),
best AS (SELECT * FROM knocks QUALIFY ROW_NUMBER() OVER (PARTITION BY batsman ORDER BY runs DESC, match_id, inning) = 1)
SELECT batsman, match_id, inning, runs AS score, batting_first FROM best JOIN openers USING (match_id)""")

# --- sorts, limits, sets ---
SQL["top_k"] = over_balls("SELECT runs_total, COUNT(*) AS count FROM balls GROUP BY runs_total ORDER BY count DESC, runs_total LIMIT 5")
SQL["sort_multi"] = over_balls(f"""
SELECT bowler, COUNT(wicket_kind) AS wickets, {CONCEDED} AS runs FROM balls GROUP BY bowler ORDER BY wickets DESC, runs, bowler LIMIT 20""")
SQL["sort_full"] = over_balls(OVER_PRESSURE)
SQL["serve_team_filter"] = over_balls(f"""
SELECT inning AS team, match_type, {total('runs_extras')} AS total_extras, COUNT(DISTINCT match_id) AS matches,
  {half_up(total('runs_extras'), 'COUNT(DISTINCT match_id)')} AS avg_extras_per_match
FROM balls WHERE inning = 'T3x XI' GROUP BY inning, match_type""")
SQL["serve_rank_index"] = f"""
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY balls_faced DESC, batsman) AS INT) AS rank FROM ({REPORT_SQL['kpi01_top_run_scorers']}) AS r"""
SQL["set_distinct"] = over_balls("SELECT DISTINCT inning FROM balls WHERE inning <> ''")

# --- pressure and verdicts ---
STATE = """
state AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice, ROUND(l_tax * 100) + 4.0 AS required_rr, CAST(q % 13 AS DOUBLE) AS current_rr,
    q % 10 AS wickets_lost, q * 2 AS balls_remaining, CASE WHEN q = 7 THEN 0 ELSE 120 END AS total_balls
  FROM (SELECT *, CAST(l_quantity AS INT) AS q FROM lineitem)
), indexed AS (
  SELECT *, CASE WHEN current_rr <= 0 OR total_balls <= 0 THEN 0.0 ELSE
    FLOOR(CAST(required_rr AS DOUBLE) / GREATEST(current_rr, 0.1) * (1 + CAST(wickets_lost AS DOUBLE) / 10)
      * (CAST(balls_remaining AS DOUBLE) / CAST(total_balls AS DOUBLE)) * 100 + 0.5) / 100 END AS pressure_index
  FROM state
), levelled AS (
  SELECT *, CASE WHEN pressure_index >= 2 THEN 'High' WHEN pressure_index >= 1 THEN 'Medium' ELSE 'Low' END AS pressure_level FROM indexed
)"""
SQL["fn_pressure_index"] = f"WITH {STATE} SELECT * FROM levelled"
SQL["fn_pressure_apply"] = f"""WITH {STATE}
SELECT pressure_level, COUNT(*) AS n, MIN(pressure_index) AS lowest, MAX(pressure_index) AS highest FROM levelled GROUP BY pressure_level"""
SQL["fn_pressure_per_over"] = over_balls(f"""
, per AS (SELECT match_id, inning, over_num, {CONCEDED} AS over_runs, COUNT(wicket_kind) AS wickets_in_over FROM balls GROUP BY ALL),
indexed AS (
  SELECT *, CASE WHEN over_runs <= 0 THEN 0.0 ELSE
    FLOOR(8.0::DOUBLE / over_runs * (1 + wickets_in_over / 10) * ((20 - over_num) * 6 / 120) * 100 + 0.5) / 100 END AS pressure_index FROM per)
SELECT *, CASE WHEN pressure_index >= 2 THEN 'High' WHEN pressure_index >= 1 THEN 'Medium' ELSE 'Low' END AS pressure_level FROM indexed""")
BAND = "CASE WHEN pressure_index > 16 THEN 'High' WHEN pressure_index >= 6 THEN 'Moderate' ELSE 'Low' END"
SQL["fn_pressure_band"] = over_balls(f"SELECT match_id, inning, over_num, {BAND} AS band FROM ({OVER_PRESSURE})")
VERDICT = "CASE WHEN win_pct > 50 THEN 'advantage' ELSE 'no advantage' END AS verdict"
SQL["fn_toss_advantage"] = f"SELECT toss_decision, match_type, win_pct, {VERDICT} FROM ({REPORT_SQL['kpi12_win_by_toss_decision']}) AS r"

# --- serving ---
SQL["serve_top_batsmen"] = REPORT_SQL["kpi01_top_run_scorers"]
SQL["serve_top_bowlers"] = REPORT_SQL["kpi02_top_wicket_takers"]
SQL["serve_pressure_match"] = over_balls(f"""
SELECT match_id, inning, over_num, pressure_index, {BAND} AS pressure_level, runs_in_over, wickets_in_over FROM ({OVER_PRESSURE})""")
SQL["serve_rr_progression"] = over_balls(f"SELECT * FROM ({PROGRESSION}) WHERE match_type IN ('T20', 'ODI')")
SQL["serve_phase"] = REPORT_SQL["kpi21_boundary_pct_per_phase"]
SQL["serve_toss"] = f"SELECT toss_decision, match_type, total_matches, win_pct, {VERDICT} FROM ({REPORT_SQL['kpi12_win_by_toss_decision']}) AS r"
SQL["serve_h2h"] = over_balls(f"""
SELECT match_type, team1, team2, CASE team1 {FLAGS} ELSE '🏳️' END || ' ' || team1 || ' vs ' || CASE team2 {FLAGS} ELSE '🏳️' END || ' ' || team2 AS matchup, matches_played, team1_wins, team2_wins, no_result
FROM ({RECORDS}) WHERE match_type = 'T20' ORDER BY matches_played DESC, team1, team2 LIMIT 20""")
SQL["serve_partnerships"] = f"""
SELECT batsman, non_striker, match_id, inning, batsman || ' & ' || non_striker AS pair, partnership_runs, balls_faced
FROM ({REPORT_SQL['kpi19_partnership_analysis']}) AS r"""
SQL["serve_pairs"] = over_balls(f"SELECT match_id, inning, player_a || ' & ' || player_b AS pair, partnership_runs FROM ({PAIRS})")
