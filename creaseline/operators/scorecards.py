"""Poll responses to tables: ball events, score headers, cards, match lists.

Every function takes a frame with the response text in `body`.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.functions.labels import match_state
from creaseline.functions.rates import overs_to_balls, ratio
from creaseline.operators.live_balls import first_wicket
from creaseline.schemas import BALL_RESPONSE, MATCH_LIST_RESPONSE, SCORE_RESPONSE

# Match types shown in the list of matches.
LISTED_TYPES = ("t20", "t20i", "odi", "test")


def _successful(responses: DataFrame, schema, keep: list[str]) -> DataFrame:
    # Parsed by a generator, hence once; see parse_live_balls.
    return (responses.select(*keep, F.explode(F.array(F.from_json("body", schema))).alias("response"))
                     .filter(F.col("response.status") == "success")
                     .select(*keep, F.col("response.data").alias("data")))


def _text(c) -> Column:
    return F.coalesce(c, F.lit(""))


def _zero(c) -> Column:
    return F.coalesce(c, F.lit(0))


def scorecard_balls(responses: DataFrame, poll_time: Column | None = None) -> DataFrame:
    """One live-ball message (key, value) per delivery of a successful response.

    Expects `match_id` next to `body`. Missing names, numbers and innings get '', 0 and 'unknown'.
    """
    poll_time = F.current_timestamp() if poll_time is None else poll_time
    stamped = responses.withColumn("event_time", F.date_format(poll_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    keep = ["match_id", "event_time"]
    innings = _successful(stamped, BALL_RESPONSE, keep).select(*keep, F.explode("data.scorecard").alias("innings"))
    overs = innings.select(*keep, F.coalesce("innings.inning", F.lit("unknown")).alias("inning"),
                           F.explode("innings.overs").alias("over_row"))
    balls = overs.select(*keep, "inning", _zero(F.col("over_row.over")).alias("over"),
                         F.explode("over_row.deliveries").alias("d"))
    value = F.to_json(F.struct(
        F.col("match_id").alias("matchId"), "inning", "over", _zero(F.col("d.ball")).alias("ball"),
        _text(F.col("d.batsman")).alias("batsman"), _text(F.col("d.bowler")).alias("bowler"),
        F.col("d.runs").alias("runs"), first_wicket(F.col("d.wickets")).alias("wicket"), F.col("event_time").alias("eventTime")))
    return balls.select(F.col("match_id").alias("key"), value.alias("value"))


def _run_rate(score: Column, overs_and_balls: bool) -> Column:
    if overs_and_balls:
        return ratio(score["r"] * 6.0, overs_to_balls(score["o"]))
    return ratio(score["r"], score["o"])


def _number(o: Column) -> Column:
    """Overs as text the way they are sent: 20, not 20.0."""
    return F.when(o == F.floor(o), F.floor(o).cast("string")).otherwise(o.cast("string"))


def score_headers(responses: DataFrame, overs_and_balls: bool = False) -> DataFrame:
    """One row per response: match facts, toss text, and the first score line as current score.

    The run rate takes overs as a decimal number; `overs_and_balls` reads 19.3 as 19 overs 3 balls.
    """
    first = F.get(F.col("data.score"), F.lit(0))
    return _successful(responses, SCORE_RESPONSE, []).withColumn("first", first).select(
        F.col("data.id").alias("match_id"), F.coalesce("data.status", F.lit("unknown")).alias("status"),
        _text(F.col("data.matchType")).alias("match_type"), _text(F.col("data.venue")).alias("venue"),
        _text(F.col("data.date")).alias("match_date"),
        F.concat_ws(" vs ", "data.teams").alias("teams"),
        F.concat(_text(F.col("data.tossWinner")), F.lit(" elected to "), _text(F.col("data.tossChoice"))).alias("toss"),
        _text(F.col("first.inning")).alias("current_innings"),
        F.when(F.col("first").isNull(), "").otherwise(F.format_string(
            "%s/%s (%s ov)", _zero(F.col("first.r")).cast("string"), _zero(F.col("first.w")).cast("string"),
            _number(_zero(F.col("first.o"))))).alias("current_score"),
        F.coalesce(F.when(F.col("first.o") > 0, _run_rate(F.col("first"), overs_and_balls)), F.lit(0.0)).alias("current_rr"),
    )


def innings_scores(responses: DataFrame, overs_and_balls: bool = False) -> DataFrame:
    """One row per score line."""
    lines = _successful(responses, SCORE_RESPONSE, []).select(
        F.col("data.id").alias("match_id"), F.posexplode("data.score").alias("line", "s"))
    return lines.select(
        "match_id", (F.col("line") + 1).alias("line"), _text(F.col("s.inning")).alias("inning"),
        _zero(F.col("s.r")).alias("runs"), _zero(F.col("s.w")).alias("wickets"),
        F.coalesce("s.o", F.lit(0.0)).alias("overs"),
        F.coalesce(F.when(F.col("s.o") > 0, _run_rate(F.col("s"), overs_and_balls)), F.lit(0.0)).alias("run_rate"))


def _cards(responses: DataFrame, part: str) -> DataFrame:
    innings = _successful(responses, SCORE_RESPONSE, []).select(
        F.col("data.id").alias("match_id"), F.explode("data.scorecard").alias("innings"))
    return innings.select("match_id", _text(F.col("innings.inning")).alias("inning"), F.explode(f"innings.{part}").alias("p"))


def batting_cards(responses: DataFrame) -> DataFrame:
    return _cards(responses, "batting").select(
        "match_id", "inning", _text(F.col("p.batsman.name")).alias("name"), _text(F.col("p.dismissal-text")).alias("dismissal"),
        _zero(F.col("p.r")).alias("runs"), _zero(F.col("p.b")).alias("balls"),
        _zero(F.col("p.4s")).alias("fours"), _zero(F.col("p.6s")).alias("sixes"), F.coalesce("p.sr", F.lit(0.0)).alias("sr"))


def bowling_cards(responses: DataFrame) -> DataFrame:
    return _cards(responses, "bowling").select(
        "match_id", "inning", _text(F.col("p.bowler.name")).alias("name"), F.coalesce("p.o", F.lit(0.0)).alias("overs"),
        _zero(F.col("p.m")).alias("maidens"), _zero(F.col("p.r")).alias("runs"), _zero(F.col("p.w")).alias("wickets"),
        F.coalesce("p.eco", F.lit(0.0)).alias("economy"))


def _listed(responses: DataFrame) -> DataFrame:
    rows = _successful(responses, MATCH_LIST_RESPONSE, []).select(F.explode("data").alias("m"))
    return rows.filter(F.lower("m.matchType").isin(*LISTED_TYPES))


def match_list_scores(responses: DataFrame) -> DataFrame:
    """Score lines of the listed matches."""
    lines = _listed(responses).select(_text(F.col("m.id")).alias("match_id"), F.explode("m.score").alias("s"))
    return lines.select("match_id", _text(F.col("s.inning")).alias("inning"), _zero(F.col("s.r")).alias("runs"),
                        _zero(F.col("s.w")).alias("wickets"), F.coalesce("s.o", F.lit(0.0)).alias("overs"))


def match_list(responses: DataFrame) -> DataFrame:
    """Matches of a listed type, with their state."""
    return _listed(responses).select(
        _text(F.col("m.id")).alias("match_id"), _text(F.col("m.name")).alias("name"), _text(F.col("m.status")).alias("status"),
        F.col("m.matchType").alias("match_type"), _text(F.col("m.venue")).alias("venue"), _text(F.col("m.date")).alias("match_date"),
        F.concat_ws(" vs ", "m.teams").alias("teams"), match_state("m.matchStarted", "m.matchEnded").alias("state"))
