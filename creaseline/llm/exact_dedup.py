"""Exact de-duplication against a persistent digest index.

The index is a table bucketed and sorted by digest, with one row for each digest ever seen. New data is reduced to
one row per digest (combined before the shuffle), anti-joined with the index by sort-merge on the buckets, and what is
left is appended. The index itself is never shuffled or rewritten.

Defined results: a null text counts as empty, and so equals every other empty one. A null id is larger than any other;
if a group has no other id, the row with the null id stays. Rows that repeat both id and text are one document and share
its fate. An empty table gives an empty result. Columns other than id and text are neither read nor needed.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.llm.common import fresh_name, null_as_empty, partitions, staged
from creaseline.workspace import path_exists, scratch_dir


def normalised(text: Column) -> Column:
    """Each run of white space as one blank. Plain replacements first: few texts then need the regular expression."""
    flat = null_as_empty(text)
    for mark in "\t\n\x0b\x0c\r":
        flat = F.replace(flat, F.lit(mark), F.lit(" "))
    return F.when(F.contains(flat, F.lit("  ")), F.regexp_replace(flat, " {2,}", " ")).otherwise(flat)


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


class DigestIndex:
    """Digests seen so far, in the folder `path`; reopening a path finds what earlier sessions added.

    The number of buckets and the type of the ids are kept in the folder beside the digests. A session that opens the folder takes them from there,
    however many shuffle partitions it has itself, and an argument that differs from them is refused.
    """

    ABOUT = "buckets INT, id_type STRING"

    def __init__(self, spark: SparkSession, path: str, id_type: str | None = None, buckets: int | None = None):
        """`buckets` (as many as shuffle partitions: each load then writes one file a bucket) and `id_type` (BIGINT) count when the index is created."""
        self.spark, self.path = spark, f"{path}/digests"
        about = f"{path}/about"
        if path_exists(spark, about):
            kept = spark.read.schema(self.ABOUT).json(about).first()
            for name, given in (("buckets", buckets), ("id_type", id_type and id_type.lower())):
                if given is not None and given != kept[name]:
                    raise ValueError(f"the index at {path} has {name} {kept[name]}, not {given}")
            buckets, id_type = kept["buckets"], kept["id_type"]
        else:
            buckets, id_type = buckets or partitions(spark), (id_type or "bigint").lower()
            spark.createDataFrame([(buckets, id_type)], self.ABOUT).coalesce(1).write.json(about)
        # The catalog may hold another session's idea of the folder; the table is external, so only its entry goes.
        self.name = "digest_index_" + hashlib.md5(f"{path} {uuid.uuid4().hex}".encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE {self.name} (text_sha256 STRING, keep_id {id_type}, first_size BIGINT) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {buckets} BUCKETS LOCATION '{self.path}'")

    def close(self) -> None:
        """Take the entry out of the catalog; the digests stay in their folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Groups (one row per digest) whose digest the index lacks: sort-merge on the buckets."""
        known = self.rows().select("text_sha256").hint("merge")
        return groups.join(known, "text_sha256", "left_anti")

    def load(self, digests: DataFrame, id_col: str = "doc_id") -> None:
        """Add the digests of `digests` (id, text_sha256) that are new."""
        groups = digests.groupBy("text_sha256").agg(F.min(id_col).alias("keep_id"), F.count(F.lit(1)).alias("first_size"))
        groups = staged(groups, "digest-groups")  # else the optimizer puts the anti-join below the aggregate, and copies are not combined first
        self.unseen(groups).select("text_sha256", "keep_id", "first_size").write.insertInto(self.name)

    def lookup(self, digests: DataFrame) -> DataFrame:
        """Each row with the keeper of its digest. Both sides are shuffled, not bucketed, so that a digest with a large
        share of all rows is split at run time."""
        plain = self.spark.read.schema(self.rows().schema).parquet(self.path)
        return digests.join(plain.hint("merge"), "text_sha256")


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, keep_id, group_size (equal texts of the load that first brought the text), kept, text_sha256.

    With an index of earlier loads, a text it knows is not kept again.
    """
    spark = docs.sparkSession
    digests = staged(docs.select(F.col(id_col), text_digest(F.col(text_col)).alias("text_sha256")), "digests")
    own = index is None
    if own:
        index = DigestIndex(spark, scratch_dir(spark, "digest-index"), digests.schema[id_col].dataType.simpleString())
    index.load(digests, id_col)
    found = index.lookup(digests)
    if own:
        index.close()
    return found.select(
        F.col(id_col), "keep_id", F.col("first_size").alias("group_size"),
        F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, whose text no row with a smaller id has."""
    marked = fresh_name(docs, "kept_digest")
    kept = deduplicate(docs, id_col=id_col, text_col=text_col).where("kept").select(
        F.col(id_col).alias("kept_id"), F.col("text_sha256").alias("kept_sha256")).distinct()
    kept = staged(kept, "kept-ids")
    left = docs.withColumn(marked, text_digest(F.col(text_col)))
    same = left[id_col].eqNullSafe(kept["kept_id"]) & (left[marked] == kept["kept_sha256"])
    return left.join(kept, same, "left_semi").drop(marked)
