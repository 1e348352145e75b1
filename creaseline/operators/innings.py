"""Ordered features of an innings.

A plain window over (match_id, inning) puts a whole innings into one task: one exchange and one sort, and right for innings as they are played.
A count per innings, added up before its shuffle, finds innings of more than `LARGE` balls; only these are
cut into pieces of at most `PIECE` balls, in ball order. Piece totals are aggregated first, running totals
over the few piece rows give each piece its start, and the remaining windows work inside one piece.
So an innings of any size is spread over many tasks, and the result is the same as the plain window's.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creaseline.functions.rates import flag_int, is_wicket, per_over

# Most balls of one over, or of one stretch of an innings, that a single window group sees.
PIECE = 4096
# Most balls of an innings that is a window group as a whole: some tens of megabytes.
LARGE = 1 << 18
_INNINGS = ["_match", "_inning"]


def _keyed(balls: DataFrame) -> DataFrame:
    """Keys and order without NULLs: joins would lose such balls. As in a plain window, NULLs sort first."""
    return balls.withColumns({
        "_match": F.coalesce("match_id", F.lit("\x00")),
        "_inning": F.coalesce("inning", F.lit("\x00")),
        "_over": F.coalesce("over_num", F.lit(-1 << 31)),
        "_ball": F.coalesce("ball_num", F.lit(-1 << 31)),
    })


def _running(balls: DataFrame) -> DataFrame:
    """Add ball_seq, cumulative_runs and wickets_down (wickets up to and with this ball)."""
    piece = [*_INNINGS, "_over", "_piece"]
    cut = (_keyed(balls)
           .withColumn("_piece", F.floor(F.col("_ball") / PIECE))
           .withColumn("_wicket", flag_int(is_wicket())))
    totals = cut.groupBy(*piece).agg(
        F.count("*").alias("_balls"), F.sum("runs_total").alias("_runs"), F.sum("_wicket").alias("_wickets"))
    before = Window.partitionBy(*_INNINGS).orderBy("_over", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*piece, *[
        F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_balls", "_runs", "_wickets")])
    inside = Window.partitionBy(*piece).orderBy("_ball").rowsBetween(Window.unboundedPreceding, 0)
    return (cut.join(starts, piece)
            .withColumn("ball_seq", F.col("_balls_before") + F.row_number().over(inside))
            .withColumn("cumulative_runs", F.col("_runs_before") + F.coalesce(F.sum("runs_total").over(inside), F.lit(0)))
            .withColumn("wickets_down", F.col("_wickets_before") + F.sum("_wicket").over(inside)))


def _order() -> Window:
    return Window.partitionBy("match_id", "inning").orderBy("over_num", "ball_num")


def _by_size(balls: DataFrame, whole: Callable[[DataFrame], DataFrame], in_pieces: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`whole` of the innings up to LARGE balls and `in_pieces` of the larger ones. The latter are at most one per LARGE balls of the table, and usually none."""
    sizes = balls.groupBy("match_id", "inning").agg(F.count("*").alias("_balls")).filter(F.col("_balls") > LARGE)
    large = sizes.select(F.col("match_id").alias("_large_match"), F.col("inning").alias("_large_inning")).collect()
    if not large:
        return whole(balls)
    named = balls.sparkSession.createDataFrame(large, "_large_match STRING, _large_inning STRING")
    same = F.col("match_id").eqNullSafe(F.col("_large_match")) & F.col("inning").eqNullSafe(F.col("_large_inning"))
    return whole(balls.join(named, same, "left_anti")).unionByName(in_pieces(balls.join(named, same, "left_semi")))


def cumulative_runs(balls: DataFrame) -> DataFrame:
    """Add `cumulative_runs`: runs of the innings up to and with this ball."""
    so_far = F.coalesce(F.sum("runs_total").over(_order().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    return _by_size(balls, lambda some: some.withColumn("cumulative_runs", so_far), lambda some: _running(some).select(*balls.columns, "cumulative_runs"))


def rolling_avg_runs(balls: DataFrame, last: int = 6) -> DataFrame:
    """Add `rolling_avg_runs`: mean runs of this ball and the ones before it, `last` balls in all."""
    if last < 1:
        raise ValueError("last must be at least 1")
    mean = F.avg("runs_total").over(_order().rowsBetween(-(last - 1), 0))
    return _by_size(balls, lambda some: some.withColumn("rolling_avg_runs", mean), lambda some: _rolling_in_pieces(some, last))


def _rolling_in_pieces(balls: DataFrame, last: int) -> DataFrame:
    """Pieces are cut by position in the innings; a ball is also sent to the following pieces whose first balls
    look back as far as it, however many `last` reaches.
    """
    spot = F.col("ball_seq") - 1
    piece = F.floor(spot / PIECE)
    copies = F.sequence(piece, F.floor((spot + (last - 1)) / PIECE))
    spread = (_running(balls)
              .withColumn("_home", piece)
              .withColumn("_stretch", F.explode(copies)))
    stretch = Window.partitionBy(*_INNINGS, "_stretch").orderBy("ball_seq").rowsBetween(-(last - 1), 0)
    return (spread.withColumn("rolling_avg_runs", F.avg("runs_total").over(stretch))
                  .filter(F.col("_stretch") == F.col("_home"))
                  .select(*balls.columns, "rolling_avg_runs"))


def stands(balls: DataFrame) -> DataFrame:
    """One row per stand of an innings: runs and balls from one wicket to the next."""
    # The wicket ball itself still belongs to the stand it ends.
    columns = [*balls.columns, "_wicket", "wickets_down"]
    fell = flag_int(is_wicket())
    down = F.sum(fell).over(_order().rowsBetween(Window.unboundedPreceding, 0))
    counted = _by_size(balls, lambda some: some.withColumns({"_wicket": fell, "wickets_down": down}), lambda some: _running(some).select(*columns))
    return (counted.withColumn("stand_no", F.col("wickets_down") - F.col("_wicket") + 1).groupBy("match_id", "inning", "stand_no")
            .agg(F.sum("runs_total").alias("stand_runs"), F.count("*").alias("stand_balls"),
                 F.max("_wicket").alias("ended")))


def over_run_rate(balls: DataFrame) -> DataFrame:
    """Runs, balls and run rate of every over."""
    return (balls.groupBy("match_id", "inning", "over_num")
            .agg(F.sum("runs_total").alias("over_runs"), F.count("*").alias("balls_in_over"))
            .withColumn("over_run_rate", per_over("over_runs", "balls_in_over")))


def momentum_shifts(over_rows: DataFrame) -> DataFrame:
    """Compare each over with the one before it. Takes one row per over, so a group has no more rows than overs."""
    order = Window.partitionBy("match_id", "inning").orderBy("over_num")
    now, previous = F.col("over_runs"), F.col("prev_over_runs")
    return (over_rows
            .withColumn("prev_over_runs", F.lag("over_runs").over(order))
            .withColumn("next_over_runs", F.lead("over_runs").over(order))
            .withColumn("momentum_shift", F.when(now > previous, "accelerating")
                        .when(now < previous, "decelerating").otherwise("steady")))


def batsman_totals(balls: DataFrame) -> DataFrame:
    """Runs of each batsman in each match."""
    return balls.groupBy("match_id", "batsman").agg(F.sum("runs_batsman").alias("innings_runs"))


def rank_batsmen(balls: DataFrame) -> DataFrame:
    """Rank within the match, ties share a rank. Takes totals first: a group has one row per batsman."""
    by_runs = Window.partitionBy("match_id").orderBy(F.col("innings_runs").desc())
    return batsman_totals(balls).withColumn("batsman_rank", F.rank().over(by_runs))


def cumulative_means(over_rows: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Mean of `value` over the overs so far, per group; one row per group and over expected."""
    so_far = Window.partitionBy(group).orderBy("over_num").rowsBetween(Window.unboundedPreceding, 0)
    return (over_rows.withColumn("overs_so_far", F.row_number().over(Window.partitionBy(group).orderBy("over_num")))
                     .withColumn(out, F.sum(value).over(so_far) / F.col("overs_so_far")))
