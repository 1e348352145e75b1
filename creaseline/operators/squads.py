"""Player to team lookups and the labels built from them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.functions.labels import team_flag, with_flag


def enrich_players(rows: DataFrame, player_teams: DataFrame, player: str = "batsman") -> DataFrame:
    """Add team ('' if unknown), flag ('' if none) and display name of a player.

    `player_teams` (player, team) has a player once. No broadcast hint: Spark broadcasts it if its size allows.
    """
    teams = player_teams.select(F.col("player").alias(player), "team")
    return (rows.join(teams, player, "left")
            .withColumn("team", F.coalesce("team", F.lit("")))
            .withColumn("flag", team_flag("team", unknown=""))
            .withColumn("player_display", with_flag(F.col("flag"), player)))


def teams_from_balls(balls: DataFrame) -> DataFrame:
    """player, team: the team a batsman last batted for, by match id. One row per innings first: balls are not sorted."""
    innings = balls.select(F.col("batsman").alias("player"), "match_id", "inning").distinct()
    return (innings.groupBy("player")
            .agg(F.max_by("inning", F.struct("match_id", "inning")).alias("team")))


def team_rows(rows: DataFrame, team: str | None, column: str = "team") -> DataFrame:
    """Rows of one team, or all rows."""
    return rows if team is None else rows.filter(F.col(column) == team)


def team_names(rows: DataFrame, column: str = "team") -> DataFrame:
    """Distinct team names that are not blank."""
    return rows.select(column).filter(F.col(column) != "").distinct()
