"""Running totals over a table in a given order, without a window that holds a group in one task.

The rows are range-partitioned by key and order, totals run inside each range, and what lies before a range is added
from a small table with one row per range and key. A group of any size is spread over many ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creaseline.llm.common import staged


def _in_range(key: str, value: str, out: str):
    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, carried = None, 0
        for frame in frames:
            if frame.empty:
                continue
            keys, values = frame[key].to_numpy(), frame[value].to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            before = np.cumsum(values) - values
            base = -before[starts]
            if keys[0] == last:
                base[0] += carried
            before += np.repeat(base, np.diff(np.append(starts, len(keys))))
            last, carried = keys[-1], int(before[-1] + values[-1])
            yield frame.assign(**{out: before})

    return add


def with_running_total(rows: DataFrame, key: str, order: list[str | Column], value: str, label: str, before: str = "before",
                       total: str = "total") -> DataFrame:
    """`rows` with `before`, the sum of `value` over the rows of the same `key` that come earlier in `order`, and `total`, the sum over
    all rows of the key.

    `rows` should be a written table: it is read twice, once to sample its ranges. `key` is a string column without nulls and `value` a
    long without nulls; `order` should be total, else equal rows are numbered in any way. Columns `range_no` and `earlier` are used inside.
    """
    ordered = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order).withColumn("range_no", F.spark_partition_id())
    schema = T.StructType([*ordered.schema.fields, T.StructField(before, T.LongType())])
    ordered = staged(ordered.mapInPandas(_in_range(key, value, before), schema), label)
    ranges = ordered.groupBy(key, "range_no").agg(F.sum(value).alias("here"))
    of_key = Window.partitionBy(key)  # at most one row a range
    ranges = ranges.select(key, "range_no", F.sum("here").over(of_key).alias(total),
                           (F.sum("here").over(of_key.orderBy("range_no")) - F.col("here")).alias("earlier"))
    ranges = staged(ranges, f"{label}-ranges")  # its size is then known before the join
    return ordered.join(ranges, [key, "range_no"]).withColumn(before, F.col(before) + F.col("earlier")).drop("range_no", "earlier")
