"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.workspace import scratch_dir

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and the lineage ends there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not have yet, whatever extra columns it brings."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def null_as_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, as `--py-files` does: they may not have it on their path."""
    context = spark.sparkContext
    if getattr(context, "_creaseline_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="creaseline-")) / "creaseline.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))
    context._creaseline_shipped = True
