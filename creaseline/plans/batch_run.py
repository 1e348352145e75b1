"""Batch run: documents to raw, clean and report tables.

All layers only grow. A match that comes again with a higher revision is loaded again under it; readers take the
latest revision of each match from the table of matches, which has one row per match and revision. Raw documents and clean balls are
partitioned by the number of their load as well, and each layer keeps the numbers it has taken, so a run opens new files and reads new partitions only.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.operators.flatten import documents_of_event, flatten_matches, matches_of, not_loaded, not_loaded_revisions, stamp_batch
from creaseline.operators.quality import clean_balls, rejected_balls
from creaseline.plans.match_data import MatchData, ReportInputs
from creaseline.plans.reports import write_reports
from creaseline.sinks import loads
from creaseline.sinks.tables import append_new, write_clean_balls, write_raw_documents
from creaseline.sources.documents import changed_files, read_changed_documents
from creaseline.sources.kpi_tables import read_table
from creaseline.workspace import path_exists, scratch_dir

REVISION = ["match_id", "revision"]


def new_documents(spark: SparkSession, documents_path: str, base: str, year: str, event: str, one_per_file: bool = True) -> DataFrame:
    """Documents of an event that the raw table does not have yet; nothing is written. Only files that no load has seen are opened."""
    files = changed_files(spark, documents_path, f"{base}/bronze/files")
    wanted = documents_of_event(read_changed_documents(spark, documents_path, files, one_per_file), year, event)
    raw = f"{base}/bronze/matches"
    return not_loaded(wanted, read_table(spark, raw)) if path_exists(spark, raw) else wanted


def load_raw(spark: SparkSession, documents: DataFrame, base: str) -> None:
    """A numbered load of documents. The number is written last: a load that fails is done again under the same number."""
    number = loads.next_number(spark, f"{base}/bronze/loads")
    write_raw_documents(spark, loads.with_load(stamp_batch(documents), number), f"{base}/bronze/matches")
    loads.mark(spark, f"{base}/bronze/loads", {number})


def load_files(spark: SparkSession, documents_path: str, base: str, one_per_file: bool = True) -> int:
    """Load the documents of files that are new or were written again, and note the files last. Returns how many files were read."""
    staged = scratch_dir(spark, "new-files")
    seen = f"{base}/bronze/files"
    changed_files(spark, documents_path, seen).write.parquet(staged)
    files = spark.read.parquet(staged)
    count = files.count()
    if count:
        load_raw(spark, read_changed_documents(spark, documents_path, files, one_per_file), base)
        files.write.mode("append").parquet(seen)
    return count


def _fresh(spark: SparkSession, base: str, reader: str) -> set[int]:
    """Loads of raw documents that a reader has not taken yet."""
    return loads.numbers(spark, f"{base}/bronze/loads") - loads.numbers(spark, f"{base}/{reader}/loads")


def _fresh_documents(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Raw documents of the loads that the clean layer has not taken, and the matches and revisions that it has."""
    raw, done = read_table(spark, f"{base}/bronze/matches"), f"{base}/silver/matches"
    raw = loads.of_loads(raw.withColumn("season", F.col("season").cast("string")), _fresh(spark, base, "silver"))
    return raw, read_table(spark, done).select(*REVISION) if path_exists(spark, done) else raw.select(*REVISION).filter(F.lit(False))


def pending_documents(spark: SparkSession, base: str) -> DataFrame:
    """Raw documents of the loads that the clean layer has not taken, where it does not have the match in their revision or a later one."""
    return not_loaded_revisions(*_fresh_documents(spark, base))


def _pending_table(spark: SparkSession, base: str) -> DataFrame:
    """The pending documents to be read several times: the raw table itself if all of its new loads are pending, which their keys tell, or else a copy of those that are."""
    raw, known = _fresh_documents(spark, base)
    keys = raw.select(*REVISION)
    if keys.count() == not_loaded_revisions(keys, known).count():
        return raw
    staged = scratch_dir(spark, "pending")
    pending_documents(spark, base).write.parquet(staged)
    return spark.read.parquet(staged)


def load_clean(spark: SparkSession, base: str) -> None:
    """Clean balls, rejected balls and one row per match and revision, of the pending documents only.

    The matches come after the balls, and the numbers of the loads last: a run that fails before has marked nothing as done, and what it wrote is found and
    left out by the next.
    """
    taken = _fresh(spark, base, "silver")
    pending = _pending_table(spark, base)  # three tables are made of them
    kept = ["season", "revision", loads.LOAD]
    balls = flatten_matches(pending, keep=kept)
    write_clean_balls(spark, clean_balls(balls), f"{base}/silver/deliveries")
    append_new(spark, rejected_balls(balls), f"{base}/silver/quarantine", REVISION, ["match_type", "season"])
    append_new(spark, matches_of(pending, keep=kept), f"{base}/silver/matches", REVISION)
    loads.mark(spark, f"{base}/silver/loads", taken)


def latest_matches(spark: SparkSession, base: str) -> DataFrame:
    """One row per match: its latest revision."""
    matches = read_table(spark, f"{base}/silver/matches")
    newest = matches.groupBy("match_id").agg(F.max("revision").alias("revision"))
    return matches.join(newest, REVISION, "left_semi").drop(loads.LOAD)


def latest_balls(spark: SparkSession, base: str, table: str = "deliveries") -> DataFrame:
    """Balls of the latest revision of each match."""
    balls = read_table(spark, f"{base}/silver/{table}").withColumn("season", F.col("season").cast("string")).drop(loads.LOAD)  # season is a partition value
    return balls.join(latest_matches(spark, base).select(*REVISION), REVISION, "left_semi")


def compute_reports(spark: SparkSession, base: str, variant: str = "sql") -> list[tuple[str, str]]:
    """Add the balls of new loads to the kept inputs, and write the reports from these alone."""
    inputs = ReportInputs(spark, f"{base}/gold/inputs")
    taken = loads.numbers(spark, f"{base}/silver/loads") - loads.numbers(spark, f"{base}/gold/loads")
    inputs.add(loads.of_loads(read_table(spark, f"{base}/silver/deliveries"), taken).drop(loads.LOAD))
    loads.mark(spark, f"{base}/gold/loads", taken)
    data = inputs.data(latest_matches(spark, base))
    return write_reports(spark, data, f"{base}/gold/batch_kpis", None, variant)


def run_batch(spark: SparkSession, documents_path: str, base: str, one_per_file: bool = True) -> list[tuple[str, str]]:
    load_files(spark, documents_path, base, one_per_file)
    load_clean(spark, base)
    return compute_reports(spark, base)


def match_data_of(spark: SparkSession, base: str) -> MatchData:
    """Reports straight from the clean layer."""
    return MatchData(latest_balls(spark, base), latest_matches(spark, base))
