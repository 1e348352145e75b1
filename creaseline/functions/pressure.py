"""Match pressure as plain column expressions, so it stays inside generated code."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.functions.rates import flag_int, is_wicket, _col


def pressure_index(required_rr, current_rr, wickets_lost, balls_remaining, total_balls) -> Column:
    """Ratio of required to current rate, weighted by wickets lost and by the share of balls left.

    0 without a current rate or without balls. Rounds half towards positive infinity.
    """
    current, total = _col(current_rr).cast("double"), _col(total_balls).cast("double")
    raw = (_col(required_rr) / F.greatest(current, F.lit(0.1))
           * (1.0 + _col(wickets_lost).cast("double") / 10.0)
           * (_col(balls_remaining).cast("double") / F.nullif(total, F.lit(0.0))))
    return F.when((current <= 0) | (total <= 0), 0.0).otherwise(F.floor(raw * 100.0 + 0.5).cast("double") / 100.0)


def pressure_level(index) -> Column:
    i = _col(index)
    return F.when(i < 1.0, "Low").when(i < 2.0, "Medium").otherwise("High")


def pressure_band(index, moderate: float = 6, high: float = 16) -> Column:
    """Band of the additive per-over index (wickets * 10 + 6 - runs)."""
    i = _col(index)
    return F.when(i < moderate, "Low").when(i <= high, "Moderate").otherwise("High")


def with_pressure(df: DataFrame) -> DataFrame:
    """Add index and level to rows of match state."""
    return (df.withColumn("pressure_index", pressure_index(
                "required_rr", "current_rr", "wickets_lost", "balls_remaining", "total_balls"))
              .withColumn("pressure_level", pressure_level("pressure_index")))


def pressure_per_over(balls: DataFrame, required_rr: float = 8.0, overs: int = 20) -> DataFrame:
    """Pressure of every over, taking a flat required rate and the over's own runs as current rate."""
    per_over = balls.groupBy("match_id", "inning", "over_num").agg(
        F.sum("runs_total").alias("over_runs"),
        F.sum(flag_int(is_wicket())).alias("wickets_in_over"),
    )
    index = pressure_index(F.lit(required_rr), "over_runs", "wickets_in_over",
                           (F.lit(overs) - F.col("over_num")) * 6, F.lit(overs * 6))
    return (per_over.withColumn("pressure_index", index)
                    .withColumn("pressure_level", pressure_level("pressure_index")))
