"""Writing layer tables: partitioned, repeatable, merged, compacted, exported."""

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from creaseline.operators.flatten import revision_of, slim_info
from creaseline.operators.upsert import MOST_KEYS, count_known, latest_per_key, merge_rows, only_new_rows
from creaseline.sinks.loads import LOAD
from creaseline.sources.kpi_tables import copy_notes, read_table
from creaseline.workspace import delete_path, literal_path, path_exists, path_of_uri, read_text, replace_path, scratch_dir, write_text

MB = 1024 * 1024


MOST_LITERALS = 2_000


def touched_by(rows: DataFrame, partition_by: Sequence[str]) -> Column | None:
    """The partitions that some rows fall into, as a condition of literals, so that no other partition is listed or read; None if they are too
    many for one expression."""
    values = rows.select(*partition_by).distinct().limit(MOST_LITERALS + 1).collect()
    if len(values) > MOST_LITERALS:
        return None
    *outer, inner = partition_by
    groups: dict[tuple, list] = {}
    for value in values:
        groups.setdefault(tuple(value)[:-1], []).append(value[-1])

    def one(key: tuple, found: list) -> Column:
        given = [v for v in found if v is not None]
        last = F.col(inner).isin(given) if given else F.lit(False)
        if len(given) < len(found):
            last = last | F.col(inner).isNull()
        return reduce(and_, [F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in zip(outer, key)], last)

    return reduce(or_, [one(key, found) for key, found in groups.items()], F.lit(False))


def in_partitions_of(stored: DataFrame, rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Stored rows of the partitions that `rows` fall into."""
    wanted = touched_by(rows, partition_by)
    return stored.join(rows.select(*partition_by).distinct(), list(partition_by), "left_semi") if wanted is None else stored.where(wanted)


def append_new(spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str],
               partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Append the rows whose key the table does not have yet, so a repeated load changes nothing.

    The rows keep their keys' duplicates among themselves (all balls of a new match, say). A key always falls into
    the same partition, so only partitions that the rows touch are searched; the number of a load is no part of a key's place.
    The keys alone are compared first: whole rows are joined, and shuffled for it, only if some keys are new and some are not.
    """
    if path_exists(spark, path):
        stored = read_table(spark, path, fmt, _stored(rows.schema, partition_by))
        places = [c for c in partition_by if c != LOAD]
        if places:
            stored = in_partitions_of(stored, rows, places)
        new, old = count_known(rows, stored, keys)
        if not new:
            return
        if old:
            rows = only_new_rows(rows, stored, keys, MOST_KEYS)
    rows.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def _stored(schema: StructType, partition_by: Sequence[str]) -> StructType:
    return StructType([*[f for f in schema if f.name not in partition_by], *[schema[c] for c in partition_by]])


def write_raw_documents(spark: SparkSession, documents: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Raw table by match type and season, and by load where there is one, without squads and registry. A document with a higher revision is a new row."""
    rows = (slim_info(documents).withColumns({
        "match_type": F.col("info.match_type"), "season": F.col("info.season"), "revision": revision_of(documents)}))
    append_new(spark, rows, path, ["match_id", "revision"], [c for c in ("match_type", "season", LOAD) if c in rows.columns], fmt)


def write_clean_balls(spark: SparkSession, balls: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Clean balls by match type, season and load where there are. A revision of a match is loaded once."""
    keys = [c for c in ("match_id", "revision") if c in balls.columns]
    append_new(spark, balls, path, keys, [c for c in ("match_type", "season", LOAD) if c in balls.columns], fmt)


HASHED = "key_bucket"


def _bucket_count(spark: SparkSession, path: str, buckets: int) -> int:
    """How many hash buckets a merged table has: fixed when it is made, and kept in its folder."""
    notes = f"{path}/_{HASHED}s"
    kept = read_text(spark, notes)
    if kept is None:
        if path_exists(spark, path):
            raise ValueError(f"the table at {path} has no hash buckets; name its partitions")
        write_text(spark, notes, str(buckets))
        return buckets
    return int(kept)


def upsert_table(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (),
                 version: Sequence[str] = (), fmt: str = "parquet", buckets: int = 16) -> None:
    """Merge rows into a stored table: same key updates, other rows are added.

    With `partition_by`, a key must always fall into the same partition. Without, the table is split by a hash of the key, into as many `buckets` as it was made
    with. Either way only partitions that the source touches are read and replaced, all when the job commits. `version`
    picks the newest of several source rows with one key; `read_merged` reads the table without the buckets.
    """
    if version:
        source = latest_per_key(source, keys, version)
    if not partition_by:
        count = _bucket_count(spark, path, buckets)
        source, partition_by = source.withColumn(HASHED, F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")), [HASHED]
    current = read_table(spark, path, fmt, _stored(source.schema, partition_by)) if path_exists(spark, path) else None
    merged = source if current is None else merge_rows(in_partitions_of(current, source, partition_by), source, keys)
    # Dealt by partition, so that a task writes few files; Spark splits a large partition at run time.
    (merged.hint("rebalance", *partition_by).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).save(path))


def read_merged(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, fmt).drop(HASHED)


def table_stats(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row: rows, files, bytes and time of the last change. Reads file footers only."""
    files = (read_table(spark, path, fmt)
             .groupBy("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
             .agg(F.count("*").alias("n")))
    return files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("*").alias("file_count"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_bytes"), F.max("file_modification_time").alias("last_modified"))


def _file_count(stats: DataFrame, target_bytes: int) -> int:
    return max(1, -(-stats.first()["total_bytes"] // target_bytes))


def small_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], target_bytes: int = 256 * MB, fmt: str = "parquet") -> DataFrame:
    """Partitions with several files that would fit into fewer of the target size: their values, folder (as a URI) and bytes. Reads file footers only."""
    files = (read_table(spark, path, fmt, _with_text(read_table(spark, path, fmt), partition_by))
             .select(*partition_by, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct())
    sizes = files.groupBy(*partition_by, F.regexp_extract("file", "^(.*)/[^/]*$", 1).alias("folder")).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    return sizes.where(F.col("files") > F.ceil(F.col("bytes") / target_bytes)).select(*partition_by, "folder", "bytes")


def _with_text(rows: DataFrame, partition_by: Sequence[str]) -> StructType:
    """The schema with partition values as text, or '007' would come back as 7."""
    return StructType([StructField(f.name, StringType()) if f.name in partition_by else f for f in rows.schema])


#: Partitions of this size are rewritten by a job each, smaller ones together by one job with a shuffle.
APART_BYTES = 16 * MB


def _rewrite(spark: SparkSession, folder: str, schema: StructType, file_count: int, aside: str, fmt: str) -> None:
    """Write the files of one folder as `file_count` files and put these in their place. A task joins some of the files as they stand, so
    nothing is shuffled or sorted. `aside` gets the new and the old files for the time being."""
    staged = f"{aside}/{uuid.uuid4().hex}"
    (read_table(spark, literal_path(folder), fmt, schema).coalesce(file_count).write.format(fmt)
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").save(staged))
    replace_path(spark, staged, folder, aside)


def compact_table(spark: SparkSession, path: str, partition_by: Sequence[str] = (), target_bytes: int = 256 * MB,
                  fmt: str = "parquet", apart_bytes: int = APART_BYTES) -> None:
    """Rewrite small files into files of about the target size. Of a partitioned table, only partitions that have too many
    files are read and replaced, those of some size one by one as soon as they are written; a table without partitions is written aside and put in place."""
    rows = read_table(spark, path, fmt, _with_text(read_table(spark, path, fmt), partition_by))
    if not partition_by:
        staged = scratch_dir(spark, "compact")
        rows.coalesce(_file_count(table_stats(spark, path, fmt), target_bytes)).write.format(fmt).save(staged)
        replace_path(spark, staged, path)
        return
    small = small_partitions(spark, path, partition_by, target_bytes, fmt).collect()
    little = [p for p in small if p["bytes"] < apart_bytes]
    if little:
        # Replaced when the job commits. Spark splits large and joins small partitions by size at run time (advisoryPartitionSizeInBytes).
        places = spark.createDataFrame([tuple(p[c] for c in partition_by) for p in little], StructType([rows.schema[c] for c in partition_by]))
        (in_partitions_of(rows, places, partition_by).hint("rebalance", *partition_by).write.format(fmt).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path))
    schema = StructType([f for f in rows.schema if f.name not in partition_by])
    aside = f"{path}/.compact-{uuid.uuid4().hex}"  # no reader sees a folder with such a name
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda p: _rewrite(spark, path_of_uri(spark, p["folder"]), schema, -(-p["bytes"] // target_bytes), aside, fmt),
                      [p for p in small if p["bytes"] >= apart_bytes]))
    delete_path(spark, aside)


BUCKETS = 16


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    """The hash bucket of a key; a null key has one too."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def append_update(rows: DataFrame, path: str, batch: int, bucket_key: str, partition_by: Sequence[str], buckets: int = BUCKETS, fmt: str = "parquet") -> None:
    """Add changed rows under their batch number, split by `partition_by`, a hash bucket of a key and the batch.

    Nothing stored before is read or replaced. A batch that comes again replaces only its own files.
    """
    rows = rows.withColumns({"bucket": bucket_of(bucket_key, buckets), "batch": F.lit(batch).cast("bigint")})
    (rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by, "bucket", "batch").save(path))


def read_updates(spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """The latest row of each key of a table of updates."""
    return latest_per_key(read_table(spark, path, fmt), keys, ["batch"]).drop("bucket")


def merge_updates(spark: SparkSession, path: str, target: str, keys: Sequence[str], partition_by: Sequence[str], buckets: int = BUCKETS,
                  fmt: str = "parquet") -> None:
    """The scheduled merge: the latest rows as a new version of the table, in a folder of its own, for readers and writers to switch to."""
    rows = latest_per_key(read_table(spark, path, fmt), keys, ["batch"])
    rows.write.format(fmt).partitionBy(*partition_by, "bucket", "batch").save(target)


def export_tables(spark: SparkSession, names: Sequence[str], source: str, target: str, fmt: str = "parquet") -> DataFrame:
    """Copy report tables to Parquet; one result row (kpi, row_count, status) per table. A failing table does not stop the others.

    Tables larger than one file's target size keep several files.
    """
    def export(name: str) -> tuple[str, int | None, str]:
        try:
            table = read_table(spark, f"{source}/{name}", fmt)
            stats = table_stats(spark, f"{source}/{name}", fmt).first()
            table.coalesce(max(1, -(-stats["total_bytes"] // (256 * MB)))).write.mode("overwrite").parquet(f"{target}/{name}.parquet")
            copy_notes(spark, f"{source}/{name}", f"{target}/{name}.parquet", stats["row_count"])
            return name, stats["row_count"], "ok"
        except Exception as e:
            return name, None, f"failed: {type(e).__name__}"

    with ThreadPoolExecutor(4) as pool:
        return spark.createDataFrame(list(pool.map(export, names)), "kpi STRING, row_count BIGINT, status STRING")
