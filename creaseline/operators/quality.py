"""Ball-level data quality."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: most runs one ball may count for.
MAX_BALL_RUNS = 36
RUN_COLUMNS = ["runs_batsman", "runs_extras", "runs_total"]


def failed_rule(max_runs: int = MAX_BALL_RUNS) -> Column:
    """Name of the first rule a ball breaks, NULL for a good ball."""
    runs, over = F.col("runs_total"), F.col("over_num")
    return (F.when(F.col("batsman").isNull(), "no_batsman")
             .when(F.col("bowler").isNull(), "no_bowler")
             .when(runs.isNull() | (runs < 0) | (runs > max_runs), "runs_out_of_range")
             .when(over.isNull() | (over < 0), "bad_over"))


def clean_balls(balls: DataFrame, max_runs: int = MAX_BALL_RUNS) -> DataFrame:
    """Good balls only, missing run parts filled with 0."""
    return balls.filter(failed_rule(max_runs).isNull()).na.fill(0, RUN_COLUMNS)


def rejected_balls(balls: DataFrame, max_runs: int = MAX_BALL_RUNS) -> DataFrame:
    """The other balls, with the rule they break."""
    return balls.withColumn("failed_rule", failed_rule(max_runs)).filter(F.col("failed_rule").isNotNull())


def null_counts(df: DataFrame, columns: Iterable[str] = ("batsman", "bowler", "runs_total", "over_num")) -> DataFrame:
    """Nulls of several columns in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])
