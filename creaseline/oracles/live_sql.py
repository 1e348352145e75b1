"""Live parsing, streaming and live serving over the events."""

from creaseline.oracles.base import half_up, over_live, total

SQL: dict[str, str] = {}
KEY = "match_id, inning, over_num, ball_num"
BALL = KEY + ", batsman, bowler, runs_batsman, runs_extras, runs_total, wicket_kind, wicket_player_out, is_wicket"

SQL["src_live_envelope"] = over_live("SELECT match_id AS key, COUNT(*) AS messages FROM live GROUP BY match_id")
SQL["src_multi_topic"] = over_live("""
SELECT 'live-balls' AS topic, COUNT(*) AS messages, COUNT(DISTINCT match_id) AS keys FROM live
UNION ALL SELECT 'live-matches', COUNT(*), COUNT(DISTINCT user_id) FROM live""")
SQL["src_stream_table"] = over_live(f"SELECT match_id, COUNT(*) AS balls, {total('runs_total')} AS runs FROM live GROUP BY match_id")
SQL["prj_enrich_stream"] = over_live(f"SELECT {KEY}, TRUE AS has_time FROM live")
SQL["prj_parse_live"] = over_live(f"SELECT {BALL}, event_time FROM live")
SQL["snk_stream_append"] = SQL["src_stream_table"]
SQL["st_raw"] = over_live(f"SELECT {KEY} FROM live")
SQL["st_clean"] = SQL["prj_parse_live"]
SQL["st_dedup"] = over_live(f"SELECT {BALL} FROM live")
SQL["st_dedup_upsert"] = SQL["prj_parse_live"]

SQL["prj_scorecard_balls"] = over_live("""
SELECT match_id, CASE WHEN runs_total = 3 THEN 'unknown' ELSE inning END AS inning, over_num,
  CASE WHEN runs_total = 5 THEN 0 ELSE ball_num END AS ball_num, batsman || ' "x"' AS batsman,
  CASE WHEN runs_total = 4 THEN '' ELSE bowler END AS bowler, runs_batsman, runs_extras, runs_total,
  wicket_kind, wicket_player_out, is_wicket, event_time
FROM live WHERE runs_total <> 6""")

# --- score responses: one or two score lines per event, none for sign-ups, failures left out ---
OVERS = "(k % 20 + k % 6 / 10.0)"
OVERS_TEXT = f"CASE WHEN k % 6 = 0 THEN CAST(k % 20 AS STRING) ELSE CAST({OVERS} AS STRING) END"
SQL["prj_score_cards"] = over_live(f"""
SELECT CAST(event_id AS STRING) AS match_id, event_type AS status, 't20' AS match_type, '' AS venue, '' AS match_date, 'India vs Oman' AS teams,
  'India elected to bat' AS toss,
  CASE WHEN event_type = 'signup' THEN '' ELSE '1st ' || event_type END AS current_innings,
  CASE WHEN event_type = 'signup' THEN '' ELSE CAST(k * 2 AS STRING) || '/' || CAST(k % 10 AS STRING) || ' (' || {OVERS_TEXT} || ' ov)' END AS current_score,
  CASE WHEN event_type = 'signup' OR {OVERS} = 0 THEN 0.0 ELSE ROUND(k * 2 / {OVERS}, 2) END AS current_rr
FROM live WHERE event_type <> 'error'""")


def _lines(rate: str) -> str:
    return over_live(f"""
, lines AS (
  SELECT event_id, 1 AS line, '1st ' || event_type AS inning, k * 2 AS runs, k FROM live WHERE event_type NOT IN ('error', 'signup')
  UNION ALL SELECT event_id, 2, '2nd ' || event_type, k, k FROM live WHERE event_type NOT IN ('error', 'signup', 'view')
)
SELECT CAST(event_id AS STRING) AS match_id, line, inning, runs, k % 10 AS wickets, CAST({OVERS} AS DOUBLE) AS overs,
  CASE WHEN {OVERS} = 0 THEN 0.0 ELSE {rate} END AS run_rate FROM lines""")


SQL["prj_innings_scores"] = _lines(f"ROUND(runs / {OVERS}, 2)")
SQL["prj_score_cards__overs_and_balls"] = _lines("ROUND(runs * 6.0 / (k % 20 * 6 + k % 6), 2)")
SQL["prj_batting_cards"] = over_live("""
SELECT CAST(event_id AS STRING) AS match_id, '1st' AS inning, batsman AS name, CASE WHEN k % 3 = 0 THEN 'b. B' ELSE '' END AS dismissal,
  k AS runs, k + 1 AS balls, k % 4 AS fours, k % 3 AS sixes, ROUND(value, 1) AS sr
FROM live WHERE event_type <> 'error'""")
SQL["prj_bowling_cards"] = over_live(f"""
SELECT CAST(event_id AS STRING) AS match_id, '1st' AS inning, bowler AS name, CAST({OVERS} AS DOUBLE) AS overs,
  k % 2 AS maidens, k AS runs, k % 5 AS wickets, ROUND(value, 1) AS economy
FROM live WHERE event_type <> 'error'""")
SQL["prj_match_list"] = over_live("""
SELECT CAST(event_id AS STRING) AS match_id, 'Game ' || CAST(event_id AS STRING) AS name, event_type AS status,
  CASE event_id % 6 WHEN 0 THEN 'T20' WHEN 1 THEN 't20i' WHEN 2 THEN 'ODI' WHEN 3 THEN 'Test' ELSE 'odi' END AS match_type,
  '' AS venue, '' AS match_date, 'India vs Oman' AS teams,
  CASE WHEN user_id % 3 = 2 THEN 'Done' WHEN event_type <> 'view' AND user_id % 3 > 0 THEN 'Live' ELSE 'Soon' END AS state
FROM live WHERE event_id % 6 <> 4""")
SQL["prj_match_list_scores"] = over_live("""
SELECT CAST(event_id AS STRING) AS match_id, '1st' AS inning, k AS runs, CAST(event_id % 10 AS INT) AS wickets,
  CASE WHEN event_type = 'click' THEN 0.0 ELSE 20.0 END::DOUBLE AS overs FROM live WHERE event_id % 6 <> 4""")
SQL["prj_status_badge"] = """
SELECT event_id, status, CASE WHEN CONTAINS(s, 'won') OR CONTAINS(s, 'result') THEN 'finished'
  WHEN CONTAINS(s, 'live') OR CONTAINS(s, 'progress') OR CONTAINS(s, 'play') OR CONTAINS(s, 'break') THEN 'live' ELSE 'info' END AS badge
FROM (SELECT *, LOWER(status) AS s FROM (SELECT event_id, CASE event_type WHEN 'click' THEN 'India WON by 7 runs' WHEN 'error' THEN 'Match in Progress'
  WHEN 'signup' THEN 'Starts at 14:00' WHEN 'purchase' THEN 'Innings BREAK' WHEN 'view' THEN 'No Result' END AS status FROM events))"""

# --- upserts: the last state of each slot, however it got there ---
SLOTS = over_live("""
SELECT match_id, over_num, ball_num, batsman, runs_total, inning, event_time FROM live
QUALIFY ROW_NUMBER() OVER (PARTITION BY match_id, over_num, ball_num ORDER BY event_time DESC, inning DESC) = 1""")
SQL["tbl_upsert"] = SQL["tbl_upsert_partitioned"] = SQL["jn_upsert"] = SLOTS


# --- windows ---
def spread(size: str, slide: str, grain: str) -> str:
    """Each ball once per window it falls into."""
    return f"""
, placed AS (
  SELECT *, UNNEST(RANGE({grain} - INTERVAL {size} + INTERVAL {slide}, {grain} + INTERVAL 1 SECOND, INTERVAL {slide})) AS window_start FROM live
)"""


def windows(size: str, slide: str, grain: str) -> str:
    return spread(size, slide, grain) + f""", windows AS (
  SELECT match_id, window_start, window_start + INTERVAL {size} AS window_end, {total('runs_total')} AS window_runs, COUNT(*) AS balls_bowled,
    COUNT(*) FILTER (WHERE is_wicket) AS wickets_in_window, {total('runs_total')} * 6.0 / COUNT(*) AS run_rate,
    {total('runs_batsman')} * 100.0 / COUNT(*) AS batting_strike_rate, {total('runs_total')} * 6.0 / COUNT(*) AS bowler_economy,
    ARG_MAX(batsman, ROW(event_time, inning, over_num, ball_num)) AS current_batsman,
    ARG_MAX(bowler, ROW(event_time, inning, over_num, ball_num)) AS current_bowler
  FROM placed GROUP BY match_id, window_start
)"""


MINUTE = "DATE_TRUNC('minute', event_time)"
SLIDING = windows("5 MINUTES", "1 MINUTE", MINUTE)
CLOSED = " WHERE window_end <= (SELECT MAX(ts) - INTERVAL 10 MINUTES FROM events)"
SQL["st_live_kpis"] = SQL["st_chain"] = SQL["st_chain__repolled"] = over_live(SLIDING + " SELECT * FROM windows" + CLOSED)
SQL["st_live_kpis_batch"] = over_live(SLIDING + " SELECT * FROM windows")
SQL["st_tumbling"] = over_live(windows("5 MINUTES", "5 MINUTES", "TIME_BUCKET(INTERVAL 5 MINUTES, event_time)") + """
SELECT match_id, window_start, window_end, window_runs, balls_bowled, wickets_in_window FROM windows""" + CLOSED)
SQL["st_late_drop"] = over_live(SLIDING + " SELECT match_id, window_start, window_end, window_runs, balls_bowled FROM windows" + CLOSED)
SQL["st_update_windows"] = SQL["snk_stream_update"] = over_live(windows("30 SECONDS", "5 SECONDS", "TIME_BUCKET(INTERVAL 5 SECONDS, event_time)") + """
SELECT match_id, window_start, window_runs, balls_bowled AS balls, wickets_in_window AS wickets, ROUND(run_rate, 2) AS run_rate FROM windows""")

# --- per player and per innings ---
SQL["st_batsman_sr"] = over_live(f"""
SELECT match_id, inning, batsman, {total('runs_batsman')} AS runs, COUNT(*) AS balls,
  {half_up('100 * ' + total('runs_batsman'), 'COUNT(*)')} AS strike_rate FROM live GROUP BY match_id, inning, batsman""")
SQL["st_bowler_econ"] = over_live(f"""
SELECT match_id, inning, bowler, {total('runs_total')} AS runs, COUNT(*) AS balls, COUNT(*) FILTER (WHERE is_wicket) AS wickets,
  {half_up('6 * ' + total('runs_total'), 'COUNT(*)')} AS economy FROM live GROUP BY match_id, inning, bowler""")
SQL["st_live_rates__repolled"] = over_live(f"""
SELECT match_id, inning, batsman AS player, {total('runs_batsman')} AS runs, COUNT(*) AS balls,
  {half_up('100 * ' + total('runs_batsman'), 'COUNT(*)')} AS rate FROM live GROUP BY match_id, inning, batsman
UNION ALL
SELECT match_id, inning, bowler, {total('runs_total')}, COUNT(*), {half_up('6 * ' + total('runs_total'), 'COUNT(*)')} FROM live GROUP BY match_id, inning, bowler""")
SQL["st_batsman_sr_stream"], SQL["st_bowler_econ_stream"] = SQL["st_batsman_sr"], SQL["st_bowler_econ"]
SQL["st_last5_wkts"] = over_live("""
SELECT match_id, inning, last_over, COUNT(*) FILTER (WHERE is_wicket) AS wickets_last_overs
FROM (SELECT *, MAX(over_num) OVER (PARTITION BY match_id, inning) AS last_over FROM live)
WHERE over_num > last_over - 5 GROUP BY match_id, inning, last_over""")
NUMBERED_STANDS = """
, counted AS (
  SELECT *, COALESCE(CAST(SUM(CAST(is_wicket AS INT)) OVER (PARTITION BY match_id, inning ORDER BY over_num, ball_num
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) + 1 AS stand_no FROM live
), stands AS (
  SELECT match_id, inning, stand_no, CAST(SUM(runs_total) AS BIGINT) AS stand_runs, COUNT(*) AS stand_balls, MAX(CAST(is_wicket AS INT)) AS ended
  FROM counted GROUP BY match_id, inning, stand_no
)"""
SQL["st_partnership_stands"] = over_live(NUMBERED_STANDS + " SELECT * FROM stands")
SQL["st_partnership"] = over_live(NUMBERED_STANDS + """
SELECT match_id, inning, CASE WHEN ended = 1 THEN 0 ELSE stand_runs END AS partnership_runs, CASE WHEN ended = 1 THEN 0 ELSE stand_balls END AS partnership_balls
FROM stands QUALIFY ROW_NUMBER() OVER (PARTITION BY match_id, inning ORDER BY stand_no DESC) = 1""")

# --- serving ---
SQL["serve_live_latest"] = over_live(SLIDING + """
SELECT match_id, window_start, window_end, window_runs, balls_bowled, wickets_in_window, ROUND(run_rate, 2) AS current_run_rate,
  ROUND(batting_strike_rate, 2) AS strike_rate, ROUND(bowler_economy, 2) AS economy_rate, current_batsman, current_bowler, window_end AS computed_at
FROM windows WHERE window_end >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 2 HOURS
ORDER BY window_end DESC, window_start DESC, match_id LIMIT 1""")
SQL["serve_live_latest_per_match"] = over_live(SLIDING + """
SELECT match_id, window_start, window_runs, balls_bowled FROM windows
QUALIFY ROW_NUMBER() OVER (PARTITION BY match_id ORDER BY window_start DESC) = 1""")
SQL["serve_rr_trend"] = over_live(SLIDING + """
SELECT match_id, window_start, ROUND(run_rate, 2) AS run_rate, wickets_in_window FROM windows
QUALIFY ROW_NUMBER() OVER (PARTITION BY match_id ORDER BY window_start DESC) <= 10""")
