"""Live messages to clean live balls; the same code runs on batch and streaming frames."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.schemas import LIVE_BALL, WICKET

LIVE_BALL_KEY = ["match_id", "inning", "over_num", "ball_num"]


def enrich_envelope(messages: DataFrame) -> DataFrame:
    """Raw layer: the message text and the time it arrived."""
    return messages.select(
        *[c for c in messages.columns if c not in ("key", "value")],
        F.current_timestamp().alias("ingestion_time"), F.col("value").alias("raw_json"))


def first_wicket(text: Column) -> Column:
    """Wicket of a ball sent as an object, as an array (its first entry) or as null."""
    listed = F.get(F.from_json(text, f"ARRAY<{WICKET}>"), F.lit(0))
    return F.when(F.ltrim(text).startswith("["), listed).otherwise(F.from_json(text, WICKET))


def parse_live_balls(raw: DataFrame) -> DataFrame:
    """Flat typed balls of `raw_json`; `ingestion_time` is kept when there is one."""
    # As a generator, the parser runs once per message. As a plain column it would run again in every filter
    # that Spark moves below it, such as the one for missing event times.
    ball = F.col("b")
    parsed = raw.select("*", F.explode(F.array(F.from_json("raw_json", LIVE_BALL))).alias("b")).withColumn("wicket", first_wicket(ball["wicket"]))
    return parsed.select(
        ball["matchId"].alias("match_id"), ball["inning"].alias("inning"),
        ball["over"].alias("over_num"), ball["ball"].alias("ball_num"),
        ball["batsman"].alias("batsman"), ball["bowler"].alias("bowler"),
        ball["runs"]["batsman"].alias("runs_batsman"), ball["runs"]["extras"].alias("runs_extras"),
        ball["runs"]["total"].alias("runs_total"),
        F.col("wicket.kind").alias("wicket_kind"), F.col("wicket.player_out").alias("wicket_player_out"),
        F.col("wicket.kind").isNotNull().alias("is_wicket"),
        F.try_to_timestamp(ball["eventTime"]).alias("event_time"),
        *[c for c in raw.columns if c == "ingestion_time"],
    )
