"""Common table expressions: the bridged match data in SQL."""

BALLS = """
t AS (
  SELECT *, m % 25 AS k1, (m + 1 + CAST(FLOOR(m / 25) AS BIGINT) % 24) % 25 AS k2
  FROM (SELECT *, CAST(FLOOR(l_orderkey / 60) AS BIGINT) AS m FROM lineitem)
), n AS (
  SELECT *,
    CASE k1 WHEN 0 THEN 'India' WHEN 1 THEN 'Sri Lanka' WHEN 2 THEN 'Oman' ELSE 'T' || CAST(k1 AS STRING) || 'x XI' END AS team1,
    CASE k2 WHEN 0 THEN 'India' WHEN 1 THEN 'Sri Lanka' WHEN 2 THEN 'Oman' ELSE 'T' || CAST(k2 AS STRING) || 'x XI' END AS team2,
    CASE WHEN m % 29 = 0 THEN NULL WHEN m % 3 = 0 THEN 'bat' ELSE 'field' END AS toss_decision,
    (m * 13) % 7 < 3 AS toss_t1, (m * 31) % 5 < 3 AS win_t1, l_linestatus = 'F' AS bat_t1
  FROM t
), b AS (
  SELECT *,
    CASE WHEN m % 17 = 0 THEN NULL WHEN win_t1 THEN team1 ELSE team2 END AS winner,
    CASE WHEN toss_t1 THEN team1 ELSE team2 END AS toss_winner,
    CASE WHEN bat_t1 THEN team1 ELSE team2 END AS inning,
    CASE WHEN bat_t1 THEN team2 ELSE team1 END AS fielding,
    CASE WHEN (COALESCE(toss_decision, 'bat') = 'bat') = toss_t1 THEN team1 ELSE team2 END AS bat_first,
    CASE WHEN l_discount >= 0.085 AND l_returnflag <> 'N' THEN
      CASE l_partkey % 7 WHEN 0 THEN 'run out' WHEN 1 THEN 'bowled' WHEN 2 THEN 'caught' WHEN 3 THEN 'lbw'
           WHEN 4 THEN 'stumped' WHEN 5 THEN 'retired hurt' ELSE 'obstructing the field' END
    END AS wicket_kind,
    CASE CAST(l_quantity AS INT) % 12 WHEN 5 THEN 1 WHEN 6 THEN 1 WHEN 7 THEN 1 WHEN 8 THEN 2
         WHEN 9 THEN 4 WHEN 10 THEN 6 WHEN 11 THEN 3 ELSE 0 END AS runs_batsman,
    CASE WHEN l_tax >= 0.065 THEN 1 ELSE 0 END AS runs_extras,
    CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_suppkey % 11 END AS batsman_no, CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_partkey % 11 END AS bowler_no
  FROM n
), balls AS (
  SELECT 'match_' || CAST(m AS STRING) AS match_id,
    CASE WHEN m % 4 <= 1 THEN 'T20' WHEN m % 4 = 2 THEN 'ODI' ELSE 'Test' END AS match_type,
    team1, team2,
    CASE (m * 7) % 5 WHEN 0 THEN 'India Oval' WHEN 3 THEN 'T3x XI Park' ELSE 'T' || CAST((m * 7) % 5 AS STRING) || 'x Oval' END AS venue,
    '2024-' || LPAD(CAST(1 + m % 12 AS STRING), 2, '0') || '-' || LPAD(CAST(1 + m % 28 AS STRING), 2, '0') AS match_date,
    winner, toss_winner, toss_decision, inning,
    CASE WHEN inning = bat_first THEN 1 ELSE 2 END AS inning_no,
    CAST((l_partkey * 3 + l_linenumber) % 20 AS INT) AS over_num,
    inning || ' P' || CAST(batsman_no AS STRING) AS batsman,
    fielding || ' P' || CAST(bowler_no AS STRING) AS bowler,
    inning || ' P' || CAST((l_suppkey + 1 + l_linenumber) % 11 AS STRING) AS non_striker,
    runs_batsman, runs_extras, runs_batsman + runs_extras AS runs_total,
    wicket_kind,
    CASE WHEN wicket_kind IS NULL THEN NULL
         WHEN wicket_kind = 'run out' AND l_linenumber % 2 = 0 THEN inning || ' P' || CAST((l_suppkey + 1 + l_linenumber) % 11 AS STRING)
         ELSE inning || ' P' || CAST(batsman_no AS STRING) END AS wicket_player_out,
    l_orderkey AS seq_order, l_linenumber AS seq_line, l_extendedprice AS seq_price
  FROM b
), matches AS (
  SELECT DISTINCT match_id, match_type, team1, team2, venue, match_date, winner, toss_winner, toss_decision FROM balls
)"""

NUMBERED = BALLS + """, numbered AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY match_id, inning, over_num ORDER BY seq_order, seq_line, seq_price) AS INT) AS ball_num
  FROM balls
)"""

# Innings of a batsman, with whether the innings ended with that batsman out.
INNINGS = BALLS + """, knocks AS (
  SELECT batsman, match_id, inning, match_type, CAST(SUM(runs_batsman) AS BIGINT) AS runs, COUNT(*) AS faced,
    MAX(CASE WHEN wicket_player_out = batsman THEN 1 ELSE 0 END) AS was_out
  FROM balls GROUP BY ALL
)"""

LIVE = """
live AS (
  SELECT event_id, user_id, event_type, ts AS event_time,
    'L' || CAST(user_id % 8 AS STRING) AS match_id,
    'Innings ' || CAST(event_id // 120 AS STRING) AS inning,
    CAST((event_id // 6) % 20 AS INT) AS over_num, CAST(event_id % 6 + 1 AS INT) AS ball_num,
    'P' || CAST(user_id % 11 AS STRING) AS batsman, 'B' || CAST(event_id % 11 AS STRING) AS bowler,
    CAST(k % 7 AS INT) - CASE WHEN event_type = 'view' AND k % 7 > 0 THEN 1 ELSE 0 END AS runs_batsman,
    CASE WHEN event_type = 'view' AND k % 7 > 0 THEN 1 ELSE 0 END AS runs_extras,
    CAST(k % 7 AS INT) AS runs_total,
    CASE WHEN event_type = 'error' THEN 'bowled' END AS wicket_kind,
    CASE WHEN event_type = 'error' THEN 'P' || CAST(user_id % 11 AS STRING) END AS wicket_player_out,
    event_type = 'error' AS is_wicket, k, value
  FROM (SELECT *, CAST(props->>'$.k' AS INT) AS k FROM events)
)"""


def with_ctes(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def over_balls(body: str) -> str:
    return with_ctes(BALLS, body)


def over_numbered(body: str) -> str:
    return with_ctes(NUMBERED, body)


def over_innings(body: str) -> str:
    return with_ctes(INNINGS, body)


def over_live(body: str) -> str:
    return with_ctes(LIVE, body)


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def total(column: str) -> str:
    return big(f"SUM({column})")


def half_up(n: str, d: str, scale: int = 2) -> str:
    """n / d rounded half up, in whole numbers: rounding the quotient as a double misses some ties."""
    p = 10 ** scale
    return f"(({2 * p} * ({n}) + ({d})) // NULLIF(2 * ({d}), 0) / {p}.0)"


def half_even(n: str, d: str, scale: int = 2) -> str:
    """The same, ties to the even neighbour."""
    p = 10 ** scale
    q, twice_rest = f"({p} * ({n}) // NULLIF({d}, 0))", f"(2 * ({p} * ({n}) % NULLIF({d}, 0)))"
    return f"(({q} + CASE WHEN {twice_rest} > ({d}) OR ({twice_rest} = ({d}) AND {q} % 2 = 1) THEN 1 ELSE 0 END) / {p}.0)"
