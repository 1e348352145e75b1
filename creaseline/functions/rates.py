"""Rates and predicates shared by the reports, as column expressions."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dismissals that do not count for the bowler.
NOT_BOWLER_WICKETS = ("run out", "retired hurt", "obstructing the field")
NOT_SPELL_WICKETS = ("run out", "retired hurt")

# First over (0-based) after the powerplay, first over of the death phase.
POWERPLAY_END = 6
DEATH_START = 15


def ratio(numerator, denominator, scale: int = 2, half_even: bool = False) -> Column:
    """Rounded quotient; NULL when the denominator is 0.

    Half-up as SQL rounds, or half-even as numpy does.
    """
    rounding = F.bround if half_even else F.round
    return rounding(_col(numerator) / F.nullif(_col(denominator).cast("double"), F.lit(0.0)), scale)


def percent(numerator, denominator, half_even: bool = False) -> Column:
    return ratio(_col(numerator) * 100.0, denominator, half_even=half_even)


def per_over(runs, balls, half_even: bool = False) -> Column:
    """Runs per six balls."""
    return ratio(_col(runs) * 6.0, balls, half_even=half_even)


def overs(balls, half_even: bool = False) -> Column:
    return ratio(balls, F.lit(6.0), scale=1, half_even=half_even)


def overs_to_balls(overs_text) -> Column:
    """Balls in scorecard notation: 19.3 means 19 overs and 3 balls."""
    o = _col(overs_text).cast("decimal(10,1)")
    return (F.floor(o) * 6 + (o % 1) * 10).cast("int")


def flag_int(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def is_wicket(excluded: Iterable[str] = ()) -> Column:
    kind = F.col("wicket_kind")
    excluded = list(excluded)
    return kind.isNotNull() & ~kind.isin(excluded) if excluded else kind.isNotNull()


def phase(over, powerplay_end: int = POWERPLAY_END, death_start: int = DEATH_START) -> Column:
    o = _col(over)
    return F.when(o < powerplay_end, "Powerplay").when(o < death_start, "Middle").otherwise("Death")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
