"""The inputs of all reports.

Four measure frames hold everything the reports add up: one for batting, one for bowling,
one for overs, one for pairs of batsmen. Each can be read per ball (a projection, no shuffle) or added up to its key. The sums are
the same either way, so a single report runs straight from the balls, and a run over all
reports writes the added-up tables once and reads those instead of the balls.
"""

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.functions.rates import NOT_BOWLER_WICKETS, NOT_SPELL_WICKETS, flag_int, is_wicket
from creaseline.operators.upsert import count_known
from creaseline.schemas import MATCH_COLUMNS
from creaseline.sinks.tables import append_new
from creaseline.sources.kpi_tables import read_table
from creaseline.workspace import path_exists, scratch_dir

BATTING_KEY = ["batsman", "match_id", "inning", "match_type"]
BOWLING_KEY = ["bowler", "match_id", "inning", "match_type", "over_num"]
OVER_KEY = ["match_id", "inning", "over_num", "match_type", "venue", "winner"]
PAIR_KEY = ["batsman", "non_striker", "match_id", "inning"]
REVISION = ["match_id", "revision"]


def _revision(rows: DataFrame) -> list[str]:
    """Rows of a clean layer also carry the revision of their match."""
    return [c for c in ("revision",) if c in rows.columns]


def batting_rows(balls: DataFrame) -> DataFrame:
    runs = F.col("runs_batsman")
    return balls.select(
        *BATTING_KEY, *_revision(balls),
        runs.alias("runs"), F.lit(1).alias("balls"),
        flag_int(runs == 4).alias("fours"), flag_int(runs == 6).alias("sixes"),
        flag_int(F.col("wicket_player_out") == F.col("batsman")).alias("dismissed"),
        F.when(F.col("winner") == F.col("inning"), runs).otherwise(0).alias("winning_runs"),
    )


def batting_innings(rows: DataFrame) -> DataFrame:
    """One row per batsman and innings."""
    return rows.groupBy(*BATTING_KEY, *_revision(rows)).agg(
        *[F.sum(c).alias(c) for c in ("runs", "balls", "fours", "sixes", "winning_runs")],
        F.max("dismissed").alias("dismissed"))


def bowling_rows(balls: DataFrame, not_wickets=NOT_BOWLER_WICKETS, not_spell_wickets=NOT_SPELL_WICKETS) -> DataFrame:
    return balls.select(
        *BOWLING_KEY, *_revision(balls),
        F.col("runs_total").alias("runs"), F.lit(1).alias("balls"),
        flag_int(F.col("runs_total") == 0).alias("dots"),
        flag_int(is_wicket(not_wickets)).alias("wickets"),
        flag_int(is_wicket(not_spell_wickets)).alias("spell_wickets"),
    )


def bowling_overs(rows: DataFrame) -> DataFrame:
    """One row per bowler and over."""
    return rows.groupBy(*BOWLING_KEY, *_revision(rows)).agg(
        *[F.sum(c).alias(c) for c in ("runs", "balls", "dots", "wickets", "spell_wickets")])


def over_rows(balls: DataFrame) -> DataFrame:
    number = F.col("inning_no") if "inning_no" in balls.columns else F.lit(None).cast("int")
    return balls.select(
        *OVER_KEY, *_revision(balls), number.alias("inning_no"),
        F.col("runs_total").alias("runs"), F.col("runs_extras").alias("extras"), F.lit(1).alias("balls"),
        flag_int(is_wicket()).alias("wickets"),
        flag_int(F.col("runs_batsman").isin(4, 6)).alias("boundaries"),
    )


def innings_overs(rows: DataFrame) -> DataFrame:
    """One row per innings and over; a team's innings of one match count together, as in the reports."""
    return rows.groupBy(*OVER_KEY, *_revision(rows)).agg(
        F.min("inning_no").alias("inning_no"),
        *[F.sum(c).alias(c) for c in ("runs", "extras", "balls", "wickets", "boundaries")])


def pair_rows(balls: DataFrame) -> DataFrame:
    return balls.select(*PAIR_KEY, *_revision(balls), F.col("runs_total").alias("runs"), F.lit(1).alias("balls"))


def pair_innings(rows: DataFrame) -> DataFrame:
    """One row per batsman, partner and innings."""
    return rows.groupBy(*PAIR_KEY, *_revision(rows)).agg(F.sum("runs").alias("runs"), F.sum("balls").alias("balls"))


def matches_of_balls(balls: DataFrame) -> DataFrame:
    """One row per match, from its balls."""
    return balls.select(*MATCH_COLUMNS).distinct()


class MatchData:
    """Balls, matches and the measure frames, each planned when a report first asks for it.

    `batting`, `bowling` and `overs` are at any grain, for reports that only add up. `batting_innings`, `bowling_overs`
    and `innings_overs` have one row per key.
    """

    def __init__(self, balls: DataFrame, matches: DataFrame | None = None, **wicket_rules):
        self.balls = balls
        self._matches = matches
        self._wicket_rules = wicket_rules

    @cached_property
    def matches(self) -> DataFrame:
        return matches_of_balls(self.balls) if self._matches is None else self._matches

    @cached_property
    def batting(self) -> DataFrame:
        return batting_rows(self.balls)

    @cached_property
    def bowling(self) -> DataFrame:
        return bowling_rows(self.balls, **self._wicket_rules)

    @cached_property
    def overs(self) -> DataFrame:
        return over_rows(self.balls)

    @cached_property
    def pairs(self) -> DataFrame:
        return pair_rows(self.balls)

    @cached_property
    def pair_innings(self) -> DataFrame:
        return pair_innings(self.pairs)

    @cached_property
    def batting_innings(self) -> DataFrame:
        return batting_innings(self.batting)

    @cached_property
    def bowling_overs(self) -> DataFrame:
        return bowling_overs(self.bowling)

    @cached_property
    def innings_overs(self) -> DataFrame:
        return innings_overs(self.overs)

    @classmethod
    def of_tables(cls, stored: dict[str, DataFrame], balls: DataFrame | None = None) -> "MatchData":
        """Data that reads the added-up tables (see `INPUTS`) and the matches instead of balls."""
        out = cls(balls, stored["matches"])
        out.batting = out.batting_innings = stored["batting"]
        out.bowling = out.bowling_overs = stored["bowling"]
        out.overs = out.innings_overs = stored["overs"]
        out.pairs = out.pair_innings = stored["pairs"]
        return out

    def stage(self, spark: SparkSession, path: str) -> "MatchData":
        """Write the four added-up tables and the matches; return data that reads them.

        Later jobs then depend on files in shared storage, not on executors staying alive.
        """
        tables = {"batting": self.batting_innings, "bowling": self.bowling_overs, "overs": self.innings_overs,
                  "pairs": self.pair_innings, "matches": self.matches}

        def write(item):
            name, frame = item
            frame.write.mode("overwrite").parquet(f"{path}/{name}")
            return spark.read.schema(frame.schema).parquet(f"{path}/{name}")

        with ThreadPoolExecutor(len(tables)) as pool:
            stored = dict(zip(tables, pool.map(write, tables.items())))
        return MatchData.of_tables(stored, self.balls)


INPUTS = {"batting": "batting_innings", "bowling": "bowling_overs", "overs": "innings_overs", "pairs": "pair_innings"}


class ReportInputs:
    """The added-up tables kept between runs: each takes only matches (and revisions of them) that it does not have."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, balls: DataFrame) -> None:
        """Add up the balls of matches that are not in yet. The list of matches is written last, so a failed run is repeated whole. Whole balls are joined with
        the list only if some of their matches are in it and some are not."""
        done = f"{self.path}/matches"
        if path_exists(self.spark, done):
            known = read_table(self.spark, done)
            new, old = count_known(balls, known, REVISION)
            if not new:
                return
            if old:
                balls = balls.join(known, REVISION, "left_anti")
        data = MatchData(balls)
        with ThreadPoolExecutor(len(INPUTS)) as pool:
            list(pool.map(lambda name: append_new(self.spark, getattr(data, INPUTS[name]), f"{self.path}/{name}", REVISION), INPUTS))
        append_new(self.spark, balls.select(*REVISION).distinct(), done, REVISION)

    def data(self, matches: DataFrame) -> MatchData:
        """The inputs of these matches (match_id, revision and their facts) that have balls; no ball is read.

        All reports read them, so the matches, and tables that also hold other matches or revisions, are picked once and kept as copies of their own.
        """
        path = scratch_dir(self.spark, "report-inputs")

        def copy(name: str, rows: DataFrame) -> DataFrame:
            rows.write.parquet(f"{path}/{name}")
            return self.spark.read.schema(rows.schema).parquet(f"{path}/{name}")

        loaded = copy("matches", matches.join(read_table(self.spark, f"{self.path}/matches"), REVISION, "left_semi").select(*REVISION, *MATCH_COLUMNS[1:]))
        wanted = loaded.select(*REVISION)

        def pick(name: str) -> DataFrame:
            table = read_table(self.spark, f"{self.path}/{name}")
            others, _ = count_known(table, wanted, REVISION)
            return copy(name, table.join(wanted, REVISION, "left_semi").drop("revision")) if others else table.drop("revision")

        with ThreadPoolExecutor(len(INPUTS)) as pool:
            stored = dict(zip(INPUTS, pool.map(pick, INPUTS)))
        return MatchData.of_tables({**stored, "matches": loaded.select(*MATCH_COLUMNS)})
