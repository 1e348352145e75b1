"""Spark schemas (as DDL text) of every input the engine reads.

All readers use these explicit types: no inference job over the files, and the
team- and player-keyed objects of a match document become maps instead of one
struct field per name.
"""

# One match document: info + innings > overs > deliveries > wickets.
MATCH_DOCUMENT = """
    match_id STRING,
    meta STRUCT<data_version: STRING, created: STRING, revision: INT>,
    info STRUCT<
        balls_per_over: INT, city: STRING, dates: ARRAY<STRING>,
        event: STRUCT<name: STRING, match_number: STRING, group: STRING, stage: STRING>,
        gender: STRING, match_type: STRING,
        officials: MAP<STRING, ARRAY<STRING>>,
        outcome: STRUCT<winner: STRING, result: STRING, method: STRING, eliminator: STRING, by: MAP<STRING, INT>>,
        overs: INT, player_of_match: ARRAY<STRING>,
        players: MAP<STRING, ARRAY<STRING>>,
        registry: STRUCT<people: MAP<STRING, STRING>>,
        season: STRING, team_type: STRING, teams: ARRAY<STRING>,
        toss: STRUCT<decision: STRING, winner: STRING>, venue: STRING>,
    innings ARRAY<STRUCT<
        team: STRING,
        overs: ARRAY<STRUCT<
            over: INT,
            deliveries: ARRAY<STRUCT<
                batter: STRING, bowler: STRING, non_striker: STRING,
                runs: STRUCT<batter: INT, extras: INT, total: INT>,
                wickets: ARRAY<STRUCT<kind: STRING, player_out: STRING>>>>>>>>
"""

# One row per match, the columns shared by every ball of it. All are text.
MATCH_COLUMNS = [
    "match_id", "match_type", "team1", "team2", "venue", "match_date", "winner", "toss_winner", "toss_decision",
]

# One row per ball.
BALL = """
    match_id STRING, match_type STRING, team1 STRING, team2 STRING, venue STRING,
    match_date STRING, winner STRING, toss_winner STRING, toss_decision STRING,
    inning STRING, inning_no INT, over_num INT, ball_num INT,
    batsman STRING, bowler STRING, non_striker STRING,
    runs_batsman INT, runs_extras INT, runs_total INT,
    wicket_kind STRING, wicket_player_out STRING
"""

# Message of a live topic: key and value as text, plus where it came from.
ENVELOPE = "key STRING, value STRING, topic STRING"

# One live ball event. `wicket` stays text because feeds send an object, an array or null.
LIVE_BALL = """
    matchId STRING, inning STRING, over INT, ball INT, batsman STRING, bowler STRING,
    runs STRUCT<batsman: INT, extras: INT, total: INT>,
    wicket STRING, eventTime STRING
"""
WICKET = "STRUCT<kind: STRING, player_out: STRING>"

CLEAN_LIVE_BALL = """
    match_id STRING, inning STRING, over_num INT, ball_num INT, batsman STRING, bowler STRING,
    runs_batsman INT, runs_extras INT, runs_total INT,
    wicket_kind STRING, wicket_player_out STRING, is_wicket BOOLEAN,
    event_time TIMESTAMP, ingestion_time TIMESTAMP
"""

# Poll response that carries ball-by-ball deliveries.
BALL_RESPONSE = """
    apiid STRING, status STRING,
    data STRUCT<id: STRING, name: STRING, matchType: STRING, status: STRING, venue: STRING,
        scorecard: ARRAY<STRUCT<
            inning: STRING,
            overs: ARRAY<STRUCT<
                over: INT,
                deliveries: ARRAY<STRUCT<
                    ball: INT, batsman: STRING, bowler: STRING,
                    runs: STRUCT<batsman: INT, extras: INT, total: INT>,
                    wickets: STRING>>>>>>>
"""

# Poll response that carries score lines and batting/bowling cards.
SCORE_RESPONSE = """
    status STRING,
    data STRUCT<id: STRING, name: STRING, matchType: STRING, status: STRING, venue: STRING, date: STRING,
        teams: ARRAY<STRING>, tossWinner: STRING, tossChoice: STRING,
        score: ARRAY<STRUCT<r: INT, w: INT, o: DOUBLE, inning: STRING>>,
        scorecard: ARRAY<STRUCT<
            inning: STRING,
            batting: ARRAY<STRUCT<batsman: STRUCT<name: STRING>, `dismissal-text`: STRING,
                r: INT, b: INT, `4s`: INT, `6s`: INT, sr: DOUBLE>>,
            bowling: ARRAY<STRUCT<bowler: STRUCT<name: STRING>,
                o: DOUBLE, m: INT, r: INT, w: INT, eco: DOUBLE>>>>>
"""

# Poll response that lists current matches.
MATCH_LIST_RESPONSE = """
    status STRING,
    data ARRAY<STRUCT<
        id: STRING, name: STRING, status: STRING, matchType: STRING, venue: STRING, date: STRING,
        teams: ARRAY<STRING>, score: ARRAY<STRUCT<r: INT, w: INT, o: DOUBLE, inning: STRING>>,
        matchStarted: BOOLEAN, matchEnded: BOOLEAN>>
"""
