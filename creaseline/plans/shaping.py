"""Helpers the reports share: distinct counts without row expansion, and ordered limits."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums(**columns: str) -> list[Column]:
    return [F.sum(c).alias(name) for name, c in columns.items()]


def sums_and_units(rows: DataFrame, keys: Sequence[str], unit: Sequence[str], units: str, **columns: str) -> DataFrame:
    """Sums per key plus the number of distinct units (matches, say).

    Two hash aggregates, first per key and unit, then per key. Both combine before they shuffle,
    and a frequent key is spread by its units.
    """
    inner = rows.groupBy(*keys, *unit).agg(*sums(**columns), F.count("*").alias("_rows"))
    return inner.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns], F.count("*").alias(units))


def top(rows: DataFrame, order: Sequence[Column], ties: Sequence[str], limit: int | None) -> DataFrame:
    """First rows in an order made total by `ties`; all rows, unsorted, without a limit."""
    if limit is None:
        return rows
    return rows.orderBy(*order, *[F.col(t).asc() for t in ties]).limit(limit)


def desc(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()
