"""Reading report tables back."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from creaseline.workspace import path_exists, read_text, write_text


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """A layer table. A schema keeps partition values such as '2024' as text."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def numeric_texts(df: DataFrame, share: float = 0.5) -> tuple[int, list[str]]:
    """(rows, text columns of which more than `share` of the rows are numbers). One aggregate over all text columns; NULLs count as not a number."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    found = df.agg(F.count("*").alias("rows"), F.struct(F.lit(0).alias(""), *[
        F.avg(F.col(f"`{c}`").try_cast("double").isNotNull().cast("int")).alias(c) for c in texts]).alias("shares")).first()
    return found["rows"], [c for c in texts if (found["shares"][c] or 0.0) > share]


def as_doubles(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(f"`{c}`").try_cast("double") for c in columns}) if columns else df


def coerce_numeric(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Turn text columns into doubles when more than `share` of their rows are numbers."""
    if not any(isinstance(f.dataType, StringType) for f in df.schema.fields):
        return df
    return as_doubles(df, numeric_texts(df, share)[1])


NOTES = "_types.json"


def note_types(spark: SparkSession, path: str, fmt: str = "parquet") -> None:
    """To be called when a report table has been written whole: what a reader would have to find out is decided once and kept in the folder of the
    table: its schema, its number of rows, and the text columns that hold numbers."""
    table = read_table(spark, path, fmt)
    rows, numbers = numeric_texts(table)
    write_text(spark, f"{path}/{NOTES}", json.dumps({"schema": table.schema.jsonValue(), "rows": rows, "numbers": numbers}))


def copy_notes(spark: SparkSession, source: str, target: str, rows: int, fmt: str = "parquet") -> None:
    """The notes of a report table for a whole copy of it; they are made anew if the table has none or they are not of so many rows."""
    notes = read_text(spark, f"{source}/{NOTES}")
    if notes and json.loads(notes)["rows"] == rows:
        write_text(spark, f"{target}/{NOTES}", notes)
    else:
        note_types(spark, target, fmt)


def read_kpi(spark: SparkSession, name: str, base: str, fallback: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A report table from its main place, else from the fallback, else an empty frame; numbers kept as text are converted.

    As in dashboards, a table that is there but empty also falls back. With the notes of `note_types` no job runs here; a table without them is
    looked through once.
    """
    for place in (f"{base}/gold/batch_kpis/{name}", f"{fallback}/{name}.parquet" if fallback else None):
        if not place or not path_exists(spark, place):
            continue
        notes = read_text(spark, f"{place}/{NOTES}")
        if notes:
            known = json.loads(notes)
            if known["rows"]:
                return as_doubles(read_table(spark, place, fmt, StructType.fromJson(known["schema"])), known["numbers"])
            continue
        table = read_table(spark, place, fmt)
        if not table.isEmpty():
            return coerce_numeric(table)
    return spark.createDataFrame([], StructType([]))
