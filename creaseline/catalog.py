"""Every operator as a query over the test tables: name -> function(spark, sf_dir)."""

from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.functions.labels import pair_label, status_badge, team_flag, team_short, toss_advantage, with_flag
from creaseline.functions.pressure import pressure_band, pressure_per_over, with_pressure
from creaseline.functions.rates import flag_int, is_wicket, percent
from creaseline.operators import flatten, innings, live_balls, quality, scorecards, squads, upsert
from creaseline.plans import batch_run, batting, explore, live, reports, serving, teams, trends
from creaseline.plans.match_data import MatchData, matches_of_balls
from creaseline.plans.shaping import top, desc, asc
from creaseline.schemas import MATCH_COLUMNS
from creaseline.sinks import tables
from creaseline.sources import bridge
from creaseline.sources.documents import read_match_documents
from creaseline.sources.kpi_tables import coerce_numeric, note_types, read_kpi, read_table
from creaseline.sources.live import LIVE_BALLS_TOPIC, LIVE_MATCHES_TOPIC, of_topic, read_envelopes
from creaseline.streaming import ball_table
from creaseline.streaming import queries as streams
from creaseline.workspace import path_exists, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def match_data(spark: SparkSession, sf_dir: str) -> MatchData:
    return MatchData(bridge.balls(spark, sf_dir), bridge.matches(spark, sf_dir))


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, for comparison with engines that have none."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz")
                           for f in df.schema.fields if f.dataType.simpleString() == "timestamp"})


# --- the thirty reports, their larger thresholds and their other readings ---

def _add_reports() -> None:
    for number, name in enumerate(reports.REPORTS, start=1):
        key = f"kpi{number:02d}_{name}"
        QUERIES[key] = lambda spark, d, n=name: reports.report(n, match_data(spark, d))
        if name in reports.NOTEBOOK_PARAMS:
            QUERIES[f"{key}__notebook"] = lambda spark, d, n=name: reports.report(n, match_data(spark, d), "notebook")
        if name in reports.FRAME_REPORTS:
            QUERIES[f"{key}__frame"] = lambda spark, d, n=name: reports.report(n, match_data(spark, d), "frame")


_add_reports()


@query
def kpi01x_batting_summary(spark, d):
    return batting.batting_summary(match_data(spark, d))


@query
def kpi19x_partnership_pairs(spark, d):
    return batting.partnership_pairs(match_data(spark, d))


@query
def kpi24x_cumulative_run_rate(spark, d):
    return trends.cumulative_run_rate(match_data(spark, d))


# --- sources ---

def _document_bundle(spark, d) -> DataFrame:
    """The bridged documents written as packed JSON lines and read back by the document reader."""
    path = scratch_dir(spark, "documents")
    bridge.match_documents(spark, d).select("match_id", "info", "innings").write.json(path, compression="gzip")
    return read_match_documents(spark, path, one_per_file=False)


@query
def src_match_documents(spark, d):
    flat = flatten.flatten_matches(_document_bundle(spark, d))
    return flat.groupBy("match_id", "match_type", "venue", "winner").agg(
        F.count("*").alias("balls"), F.sum("runs_total").alias("runs"), F.count("wicket_kind").alias("wickets"),
        F.count_distinct("inning_no").alias("innings"))


MOST_FILES = 50_000


@query
def src_match_documents__files(spark, d):
    """One file per match: a folder per match here, and the match's name taken from the document.

    The driver lists files before it reads them, so they are written in parts of about `MOST_FILES` matches, and one part is read at a time. A task
    takes many files.
    """
    path, found = scratch_dir(spark, "document-files"), scratch_dir(spark, "document-sums")
    parts = -(-bridge.matches(spark, d).count() // MOST_FILES)
    (bridge.match_documents(spark, d).select("info", "innings", "match_id", tables.bucket_of("match_id", parts).alias("part"), F.col("match_id").alias("file"))
     .write.partitionBy("part", "file").json(path, compression="gzip"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for part in range(parts):
        if not path_exists(spark, f"{path}/part={part}"):
            continue
        flat = flatten.flatten_matches(read_match_documents(spark, f"{path}/part={part}/*")).coalesce(tasks)
        flat.groupBy("match_id", "match_type", "venue", "winner").agg(
            F.count("*").alias("balls"), F.sum("runs_total").alias("runs"), F.count("wicket_kind").alias("wickets"),
            F.count_distinct("inning_no").alias("innings")).write.mode("append").parquet(found)
    return spark.read.parquet(found)


@query
def src_table(spark, d):
    path = scratch_dir(spark, "silver")
    tables.write_clean_balls(spark, bridge.balls(spark, d), path)
    return read_table(spark, path).filter(F.col("match_type") == "T20").groupBy("venue").agg(
        F.count("*").alias("balls"), F.sum("runs_total").alias("runs"))


def _envelope_files(spark, d) -> str:
    """Messages of two topics, as files a stream can follow."""
    path = scratch_dir(spark, "envelopes")
    balls = bridge.envelopes(spark, d)
    events = bridge.read_events(spark, d)
    other = events.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("status"))).alias("value"),
        F.lit(LIVE_MATCHES_TOPIC).alias("topic"))
    balls.unionByName(other).write.parquet(path)
    return path


def _drained(spark, rows: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(spark, label)
    streams.start_append(rows, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/table")


@query
def src_live_envelope(spark, d):
    rows = read_envelopes(spark, "parquet", _envelope_files(spark, d))
    return _drained(spark, rows, "live-envelope").groupBy("key").agg(F.count("*").alias("messages"))


@query
def src_multi_topic(spark, d):
    rows = read_envelopes(spark, "parquet", _envelope_files(spark, d), topics=(LIVE_BALLS_TOPIC, LIVE_MATCHES_TOPIC))
    kept = _drained(spark, rows, "topics")
    parts = [of_topic(kept, t).groupBy("topic").agg(F.count("*").alias("messages"), F.count_distinct("key").alias("keys"))
             for t in (LIVE_BALLS_TOPIC, LIVE_MATCHES_TOPIC)]
    return parts[0].unionByName(parts[1])


@query
def src_stream_table(spark, d):
    path = scratch_dir(spark, "layer")
    bridge.live_balls(spark, d).write.parquet(path)
    rows = streams.read_table_stream(spark, path, bridge.live_balls(spark, d).schema)
    return _drained(spark, rows, "followed").groupBy("match_id").agg(
        F.count("*").alias("balls"), F.sum("runs_total").alias("runs"))


@query
def src_kpi_table(spark, d):
    """A report kept as text, found in the second place, with its numbers converted."""
    base = scratch_dir(spark, "kpi")
    report = teams.highest_team_totals(match_data(spark, d), limit=None)
    report.select(*[F.col(c).cast("string").alias(c) for c in report.columns]).write.parquet(f"{base}/data/highest_team_totals.parquet")
    note_types(spark, f"{base}/data/highest_team_totals.parquet")
    return read_kpi(spark, "highest_team_totals", f"{base}/missing", f"{base}/data")


@query
def src_coerce_numeric(spark, d):
    """Text columns of which all, most, half and no rows are numbers."""
    lines = bridge.read_lines(spark, d)
    qty = F.col("l_quantity").cast("int")
    texts = lines.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        qty.cast("string").alias("every_row"),
        F.when(qty % 5 > 0, qty.cast("string")).otherwise("n/a").alias("most_rows"),
        F.when(qty % 5 > 2, qty.cast("string")).otherwise("n/a").alias("few_rows"),
        F.col("l_returnflag").alias("no_row"))
    return coerce_numeric(texts)


def _loaded_matches(spark, d) -> DataFrame:
    return bridge.matches(spark, d).filter(F.col("match_date") < "2024-07-01").select("match_id")


@query
def src_incremental_matches(spark, d):
    wanted = flatten.documents_of_event(bridge.match_headers(spark, d), "2024", "Cup 1")
    return flatten.not_loaded(wanted, _loaded_matches(spark, d)).select(
        "match_id", F.col("info.event.name").alias("event"))


@query
def src_load_counts(spark, d):
    return flatten.load_counts(bridge.match_headers(spark, d), _loaded_matches(spark, d))


# --- sinks and table operations ---

@query
def snk_raw_partitioned(spark, d):
    """Loaded twice; the second load adds nothing."""
    path = scratch_dir(spark, "raw")
    documents = flatten.stamp_batch(bridge.match_headers(spark, d))
    for _ in range(2):
        tables.write_raw_documents(spark, documents, path)
    return read_table(spark, path).groupBy("match_type", F.col("season").cast("string").alias("season")).agg(
        F.count("*").alias("documents"), F.count_distinct("match_id").alias("matches"))


@query
def snk_clean_partitioned(spark, d):
    path = scratch_dir(spark, "clean")
    for _ in range(2):
        tables.write_clean_balls(spark, bridge.balls(spark, d), path)
    return read_table(spark, path).groupBy("match_type").agg(
        F.count("*").alias("balls"), F.sum("runs_total").alias("runs"), F.count("wicket_kind").alias("wickets"))


def _revised_documents(spark, d) -> tuple[DataFrame, DataFrame]:
    """Documents of a first load, where some matches are half played, and of a second one with all matches, those complete in a higher revision."""
    half = F.regexp_extract("match_id", r"(\d+)$", 1).cast("bigint") % 10 == 3
    early = F.get("info.dates", F.lit(0)) < "2024-07-01"

    def meta(revision):
        return F.struct(F.lit("1.0").alias("data_version"), F.lit("2024").alias("created"), revision.cast("int").alias("revision"))

    whole = bridge.match_documents(spark, d)
    first = whole.filter(early).withColumn("innings", F.when(half, F.slice("innings", 1, 1)).otherwise(F.col("innings"))).withColumn("meta", meta(F.lit(1)))
    return first, whole.withColumn("meta", meta(F.when(half & early, 2).otherwise(1)))


def _loaded_twice(spark, d) -> str:
    base = scratch_dir(spark, "lake")
    for documents in _revised_documents(spark, d):
        batch_run.load_raw(spark, documents, base)
        batch_run.load_clean(spark, base)
    return base


@query
def snk_clean_incremental(spark, d):
    """The second load holds old, new and corrected matches; each counts once, in its latest revision."""
    return batch_run.latest_balls(spark, _loaded_twice(spark, d)).groupBy("match_id", "match_type", "season", "revision").agg(
        F.count("*").alias("balls"), F.sum("runs_total").alias("runs"), F.count("wicket_kind").alias("wickets"))


@query
def dq_quarantine(spark, d):
    """Deliveries with a missing bowler or runs beyond the limit, as documents: rejected balls are kept with the rule they break."""
    base = scratch_dir(spark, "quarantine")

    def broken(ball):
        none = ball["runs"]["batter"] == 3
        return (ball.withField("bowler", F.when(none, F.lit(None)).otherwise(ball["bowler"]))
                    .withField("runs", ball["runs"].withField("total", F.when(ball["runs"]["batter"] == 2, 37).otherwise(ball["runs"]["total"]))))

    def overs(innings):
        return F.transform(innings["overs"], lambda o: o.withField("deliveries", F.transform(o["deliveries"], broken)))

    documents = bridge.match_documents(spark, d).withColumn("innings", F.transform("innings", lambda i: i.withField("overs", overs(i))))
    for _ in range(2):
        batch_run.load_raw(spark, documents, base)
        batch_run.load_clean(spark, base)
    return batch_run.latest_balls(spark, base, "quarantine").groupBy("match_id", "season", "failed_rule").agg(F.count("*").alias("balls"))


@query
def snk_kpi_tables__incremental(spark, d):
    """All thirty reports from inputs kept over two loads; rows per table."""
    base = scratch_dir(spark, "lake-reports")
    for documents in _revised_documents(spark, d):
        batch_run.load_raw(spark, documents, base)
        batch_run.load_clean(spark, base)
        failed = batch_run.compute_reports(spark, base)
        if failed:
            raise RuntimeError(f"reports failed: {failed}")
    return tables.export_tables(spark, list(reports.REPORTS), f"{base}/gold/batch_kpis", f"{base}/export")


@query
def snk_kpi_tables(spark, d):
    """All thirty reports written from the shared inputs; rows per table."""
    path = scratch_dir(spark, "gold")
    data = match_data(spark, d).stage(spark, scratch_dir(spark, "report-inputs"))
    failed = reports.write_reports(spark, data, path)
    if failed:
        raise RuntimeError(f"reports failed: {failed}")
    return tables.export_tables(spark, list(reports.REPORTS), path, f"{path}-export")


@query
def snk_export_parquet(spark, d):
    """Two report tables and one that is not there."""
    path = scratch_dir(spark, "gold")
    data = match_data(spark, d)
    reports.write_reports(spark, data, path, ["most_wins_by_team", "run_rate_progression"])
    return tables.export_tables(spark, ["most_wins_by_team", "run_rate_progression", "no_such_report"], path, f"{path}-export")


def _in_batches(spark, d, path: str, parts: int = 3) -> Iterator[int]:
    """Adds clean live balls to a folder in order of time, a part of the time at each step."""
    events = bridge.read_events(spark, d)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(micros), F.max(micros)).first()
    share = F.floor((micros - first) * parts / (last - first + 1))
    for n in range(parts):
        bridge.live_from_events(events.filter(share == n)).write.mode("append").parquet(path)
        yield n


@query
def snk_stream_append(spark, d):
    """Three runs over what has come in, and a restart that finds nothing new."""
    path, base = scratch_dir(spark, "append-in"), scratch_dir(spark, "append-out")
    schema = bridge.live_balls(spark, d).schema

    def run() -> None:
        streams.start_append(streams.read_table_stream(spark, path, schema), f"{base}/table", f"{base}/checkpoint").awaitTermination()

    for _ in _in_batches(spark, d, path):
        run()
    run()
    return spark.read.parquet(f"{base}/table").groupBy("match_id").agg(F.count("*").alias("balls"), F.sum("runs_total").alias("runs"))


@query
def snk_stream_update(spark, d):
    """Windows over three micro-batches in order of time; later batches change windows of earlier ones."""
    path, base = scratch_dir(spark, "update-in"), scratch_dir(spark, "update-out")
    schema = bridge.live_balls(spark, d).schema
    for _ in _in_batches(spark, d, path):
        rows = streams.read_table_stream(spark, path, schema)
        streams.start_window_upsert(rows, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return _plain_times(streams.read_windows(spark, f"{base}/table"))


def _ball_states(spark, d) -> DataFrame:
    """Each live event as a new state of one of a few hundred (match, over, ball) slots."""
    return bridge.live_balls(spark, d).select(
        "match_id", "over_num", "ball_num", "batsman", "runs_total", "inning", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


SLOT = ["match_id", "over_num", "ball_num"]
CUT = "2024-01-15"


def _old_and_new(spark, d) -> tuple[DataFrame, DataFrame]:
    states = _ball_states(spark, d)
    newest = ["event_time", "inning"]
    old = upsert.latest_per_key(states.filter(F.col("event_time") < CUT), SLOT, newest)
    new = upsert.latest_per_key(states.filter(F.col("event_time") >= CUT), SLOT, newest)
    return old, new


@query
def tbl_upsert(spark, d):
    """A stored table of slot states before a date, merged with the states after it."""
    old, new = _old_and_new(spark, d)
    path = scratch_dir(spark, "slots")
    tables.upsert_table(spark, old, path, SLOT)
    tables.upsert_table(spark, new, path, SLOT)
    return tables.read_merged(spark, path)


@query
def tbl_upsert_partitioned(spark, d):
    old, new = _old_and_new(spark, d)
    path = scratch_dir(spark, "slots")
    for rows in (old, new, new):
        tables.upsert_table(spark, rows, path, SLOT, ["match_id"])
    return read_table(spark, path)


@query
def jn_upsert(spark, d):
    return upsert.merge_rows(*_old_and_new(spark, d), SLOT)


@query
def tbl_compact(spark, d):
    """The small files, some 120, are cut by their number of rows as the table is read, so that no ball is shuffled to make them."""
    path = scratch_dir(spark, "small-files")
    balls = bridge.balls(spark, d)
    balls.write.partitionBy("match_type").option("maxRecordsPerFile", balls.count() // 120 + 1).parquet(path)
    tables.compact_table(spark, path, ["match_type"])
    return read_table(spark, path).groupBy("match_type").agg(F.count("*").alias("balls"), F.sum("runs_total").alias("runs"))


@query
def tbl_stats(spark, d):
    path = scratch_dir(spark, "stats")
    bridge.balls(spark, d).write.parquet(path)
    return tables.table_stats(spark, path).select("row_count", (F.col("total_bytes") > 0).alias("has_bytes"),
                                                  F.col("last_modified").isNotNull().alias("has_time"))


# --- projections and data quality ---

@query
def prj_enrich_batch(spark, d):
    stamped = flatten.stamp_batch(bridge.match_headers(spark, d))
    return stamped.select("match_id", F.col("bronze_ingestion_time").isNotNull().alias("has_time"),
                          (F.col("batch_date") == F.to_date("bronze_ingestion_time")).alias("same_day"))


@query
def prj_enrich_stream(spark, d):
    rows = live_balls.enrich_envelope(bridge.envelopes(spark, d))
    return rows.select(F.get_json_object("raw_json", "$.matchId").alias("match_id"), F.get_json_object("raw_json", "$.inning").alias("inning"),
                       F.get_json_object("raw_json", "$.over").cast("int").alias("over_num"),
                       F.get_json_object("raw_json", "$.ball").cast("int").alias("ball_num"),
                       F.col("ingestion_time").isNotNull().alias("has_time"))


@query
def prj_rebuild_struct(spark, d):
    slim = flatten.slim_info(bridge.match_headers(spark, d))
    kept = ",".join(slim.select("info.*").columns)
    return slim.select("match_id", F.col("info.venue").alias("venue"), F.col("info.season").alias("season"), F.lit(kept).alias("fields"))


@query
def prj_flatten_match(spark, d):
    return flatten.flatten_matches(bridge.match_documents(spark, d))


@query
def prj_flatten_match__frame(spark, d):
    """Defaults instead of NULLs."""
    flat = flatten.flatten_matches(bridge.match_documents(spark, d), fill_defaults=True)
    return flat.select("match_id", "winner", "toss_decision", "inning", "over_num", "batsman", "bowler", "runs_total", "wicket_kind")


@query
def prj_flatten_all_wickets(spark, d):
    flat = flatten.flatten_matches(bridge.match_documents(spark, d), all_wickets=True)
    return flat.filter(F.col("wicket_kind").isNotNull()).groupBy("match_id", "inning", "wicket_kind").agg(F.count("*").alias("wickets"))


@query
def prj_parse_live(spark, d):
    raw = live_balls.enrich_envelope(bridge.envelopes(spark, d))
    return _plain_times(live_balls.parse_live_balls(raw).drop("ingestion_time"))


def _ball_responses(spark, d) -> DataFrame:
    """One response per event; some failed, some without bowler, ball number or innings name."""
    ball = bridge.live_balls(spark, d)
    wickets = F.when(F.col("is_wicket"), F.array(F.struct(F.col("wicket_kind").alias("kind"), F.col("wicket_player_out").alias("player_out"))))
    delivery = F.struct(
        F.when(F.col("runs_total") != 5, F.col("ball_num")).alias("ball"), F.concat("batsman", F.lit(' "x"')).alias("batsman"),
        F.when(F.col("runs_total") != 4, F.col("bowler")).alias("bowler"),
        F.struct(F.col("runs_batsman").alias("batsman"), F.col("runs_extras").alias("extras"), F.col("runs_total").alias("total")).alias("runs"),
        wickets.alias("wickets"))
    card = F.array(F.struct(
        F.when(F.col("runs_total") != 3, F.col("inning")).alias("inning"),
        F.array(F.struct(F.col("over_num").alias("over"), F.array(delivery).alias("deliveries"))).alias("overs")))
    body = F.to_json(F.struct(F.when(F.col("runs_total") == 6, "failure").otherwise("success").alias("status"),
                              F.struct(F.col("match_id").alias("id"), card.alias("scorecard")).alias("data")))
    return ball.select("match_id", "event_time", body.alias("body"))


@query
def prj_scorecard_balls(spark, d):
    messages = scorecards.scorecard_balls(_ball_responses(spark, d), F.col("event_time"))
    return _plain_times(live_balls.parse_live_balls(messages.select(F.col("value").alias("raw_json"))))


def _score_responses(spark, d) -> DataFrame:
    """One response per event: one or two score lines and an innings card."""
    e = bridge.read_events(spark, d).withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    overs = (F.col("k") % 20) + F.col("k") % 6 / 10.0
    line = lambda name, r: F.struct(r.alias("r"), (F.col("k") % 10).alias("w"), overs.alias("o"), F.concat(F.lit(name), "event_type").alias("inning"))
    first = line("1st ", F.col("k") * 2)
    score = (F.when(F.col("event_type") == "signup", F.array().cast("array<struct<r:int,w:int,o:double,inning:string>>"))
             .when(F.col("event_type") == "view", F.array(first)).otherwise(F.array(first, line("2nd ", F.col("k")))))
    bat = F.struct(F.struct(F.concat(F.lit("P"), (F.col("user_id") % 11).cast("string")).alias("name")).alias("batsman"),
                   F.when(F.col("k") % 3 == 0, "b. B").alias("dismissal-text"), F.col("k").alias("r"), (F.col("k") + 1).alias("b"),
                   (F.col("k") % 4).alias("4s"), (F.col("k") % 3).alias("6s"), F.round("value", 1).alias("sr"))
    bowl = F.struct(F.struct(F.concat(F.lit("B"), (F.col("event_id") % 11).cast("string")).alias("name")).alias("bowler"),
                    overs.alias("o"), (F.col("k") % 2).alias("m"), F.col("k").alias("r"),
                    F.when(F.col("k") % 5 > 0, F.col("k") % 5).alias("w"), F.round("value", 1).alias("eco"))
    data = F.struct(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("status"), F.lit("t20").alias("matchType"),
        F.array(F.lit("India"), F.lit("Oman")).alias("teams"), F.lit("India").alias("tossWinner"), F.lit("bat").alias("tossChoice"),
        score.alias("score"), F.array(F.struct(F.lit("1st").alias("inning"), F.array(bat).alias("batting"), F.array(bowl).alias("bowling"))).alias("scorecard"))
    status = F.when(F.col("event_type") == "error", "failure").otherwise("success")
    return e.select(F.to_json(F.struct(status.alias("status"), data.alias("data"))).alias("body"))


@query
def prj_score_cards(spark, d):
    return scorecards.score_headers(_score_responses(spark, d))


@query
def prj_score_cards__overs_and_balls(spark, d):
    return scorecards.innings_scores(_score_responses(spark, d), overs_and_balls=True)


@query
def prj_innings_scores(spark, d):
    return scorecards.innings_scores(_score_responses(spark, d))


@query
def prj_batting_cards(spark, d):
    return scorecards.batting_cards(_score_responses(spark, d))


@query
def prj_bowling_cards(spark, d):
    return scorecards.bowling_cards(_score_responses(spark, d))


def _list_responses(spark, d) -> DataFrame:
    """One list of one match per event; conditions of the events give type, state and score."""
    e = bridge.read_events(spark, d)
    score = F.struct(F.get_json_object("props", "$.k").cast("int").alias("r"), (F.col("event_id") % 10).cast("int").alias("w"),
                     F.when(F.col("event_type") != "click", F.lit(20.0)).alias("o"), F.lit("1st").alias("inning"))
    kind = F.expr("element_at(array('T20', 't20i', 'ODI', 'Test', 'T10', 'odi'), CAST(event_id % 6 AS INT) + 1)")
    match = F.struct(F.col("event_id").cast("string").alias("id"), F.concat(F.lit("Game "), F.col("event_id").cast("string")).alias("name"),
                     F.col("event_type").alias("status"), kind.alias("matchType"), F.array(F.lit("India"), F.lit("Oman")).alias("teams"),
                     F.array(score).alias("score"), F.when(F.col("event_type") != "view", F.col("user_id") % 3 > 0).alias("matchStarted"),
                     (F.col("user_id") % 3 == 2).alias("matchEnded"))
    body = F.to_json(F.struct(F.lit("success").alias("status"), F.array(match).alias("data")))
    return e.select(body.alias("body"))


@query
def prj_match_list(spark, d):
    return scorecards.match_list(_list_responses(spark, d))


@query
def prj_match_list_scores(spark, d):
    return scorecards.match_list_scores(_list_responses(spark, d))


STATUS_TEXTS = {"click": "India WON by 7 runs", "error": "Match in Progress", "signup": "Starts at 14:00", "purchase": "Innings BREAK", "view": "No Result"}


@query
def prj_status_badge(spark, d):
    texts = F.create_map(*[F.lit(x) for pair in STATUS_TEXTS.items() for x in pair])
    rows = bridge.read_events(spark, d).select("event_id", F.try_element_at(texts, F.col("event_type")).alias("status"))
    return rows.withColumn("badge", status_badge("status"))


def _dirty_balls(spark, d) -> DataFrame:
    """All balls, with faults where the delivery has certain values."""
    b = bridge.numbered_balls(spark, d)
    return (b.withColumn("batsman", F.when(F.col("runs_extras") + F.col("runs_batsman") != 7, F.col("batsman")))
            .withColumn("bowler", F.when(F.coalesce("wicket_kind", F.lit("")) != "lbw", F.col("bowler")))
            .withColumn("runs_total", F.when(F.col("runs_batsman") == 3, F.lit(None)).when(F.col("runs_batsman") == 2, 37).otherwise(F.col("runs_total")))
            .withColumn("runs_extras", F.when(F.col("runs_batsman") != 1, F.col("runs_extras")))
            .withColumn("over_num", F.when(F.coalesce("wicket_kind", F.lit("")) == "stumped", -1).otherwise(F.col("over_num"))))


BALL_OUT = ["match_id", "inning", "over_num", "ball_num", "batsman", "bowler", "runs_batsman", "runs_extras", "runs_total"]


@query
def dq_clean_balls(spark, d):
    return quality.clean_balls(_dirty_balls(spark, d)).select(*BALL_OUT)


@query
def dq_rejected_balls(spark, d):
    return quality.rejected_balls(_dirty_balls(spark, d)).select(*BALL_OUT, "failed_rule")


@query
def dq_null_counts(spark, d):
    return quality.null_counts(_dirty_balls(spark, d))


@query
def flt_predicates(spark, d):
    b = bridge.balls(spark, d)
    kept = b.filter(F.col("winner").isNotNull() & ~F.col("wicket_kind").isin("run out", "retired hurt")
                    & F.col("match_type").isin("T20", "ODI") & F.col("over_num").between(3, 17)
                    & (F.col("venue").like("T1%") | ~F.col("venue").like("%2x%")) & (F.col("toss_winner") != F.col("winner")))
    return kept.groupBy("match_type", "venue", "wicket_kind").agg(F.count("*").alias("balls"))


# --- joins ---

@query
def jn_balls_matches(spark, d):
    """Balls are added up per batsman and match before they meet the matches."""
    b = bridge.balls(spark, d).drop(*[c for c in MATCH_COLUMNS if c != "match_id"])
    per = b.groupBy("match_id", "inning", "batsman").agg(F.sum("runs_batsman").alias("runs"))
    joined = per.join(bridge.matches(spark, d), "match_id")
    return joined.groupBy("batsman", "match_type").agg(
        F.sum(F.when(F.col("winner") == F.col("inning"), F.col("runs")).otherwise(0)).alias("winning_runs"),
        F.sum("runs").alias("total_runs"))


@query
def jn_chase_theta(spark, d):
    b = bridge.balls(spark, d).groupBy("match_id", "inning").agg(F.sum("runs_total").alias("total")).alias("b")
    m = bridge.matches(spark, d).alias("m")
    return b.join(m, (F.col("b.match_id") == F.col("m.match_id")) & (F.col("b.inning") == F.col("m.winner"))).select(
        "b.match_id", F.col("b.inning").alias("team"), "m.match_type", "m.venue", "b.total")


@query
def jn_left_fill(spark, d):
    """Dismissals of every batsman, 0 for none: one conditional aggregate in the place of a left join."""
    data = match_data(spark, d)
    return data.batting_innings.groupBy("batsman").agg(
        F.count("*").alias("innings"), F.sum("dismissed").alias("dismissals"))


@query
def jn_composite(spark, d):
    """Innings of each batsman with the dismissal in it, on three keys."""
    b = bridge.balls(spark, d)
    keys = ["batsman", "match_id", "inning"]
    scores = b.groupBy(*keys).agg(F.sum("runs_batsman").alias("score"))
    outs = (b.filter(F.col("wicket_player_out") == F.col("batsman")).groupBy(*keys).agg(F.count("*").alias("outs")))
    return scores.join(outs, keys, "left").select(*keys, "score", F.col("outs").isNull().alias("not_out"))


@query
def jn_first_innings(spark, d):
    """Totals of the teams that did not bat first."""
    data = MatchData(bridge.balls(spark, d), bridge.matches(spark, d))
    totals = teams.innings_totals(data).join(teams.first_batting_team(data), "match_id")
    return totals.filter(F.col("inning") != F.col("batting_first")).select("match_id", "inning", "innings_total")


@query
def jn_player_team(spark, d):
    b = bridge.balls(spark, d)
    best = batting.top_run_scorers(match_data(spark, d), limit=None)
    return squads.enrich_players(best, squads.teams_from_balls(b)).select(
        "batsman", "total_runs", "team", "flag", "player_display")


COUNTRIES = ["India", "South Africa", "Sri Lanka", "United Arab Emirates", "Elsewhere"]


@query
def jn_team_labels(spark, d):
    names = F.array(*[F.lit(c) for c in COUNTRIES])
    rows = spark.read.parquet(f"{d}/customer.parquet").select(
        "c_custkey", F.element_at(names, (F.col("c_nationkey") % 5 + 1).cast("int")).alias("team"))
    flag = team_flag("team")
    return rows.withColumn("flag", flag).withColumn("short", team_short("team")).withColumn("display", with_flag(flag, "team"))


@query
def jn_new_matches(spark, d):
    return flatten.not_loaded(bridge.match_headers(spark, d), _loaded_matches(spark, d)).select("match_id")


# --- aggregates outside the thirty ---

@query
def agg_matches_distinct(spark, d):
    return matches_of_balls(bridge.balls(spark, d))


@query
def agg_toss_impact(spark, d):
    return teams.toss_impact(bridge.matches(spark, d))


@query
def agg_toss_summary(spark, d):
    return teams.toss_summary(bridge.matches(spark, d))


@query
def agg_over_run_rate(spark, d):
    return innings.over_run_rate(bridge.balls(spark, d))


@query
def agg_match_batsman_totals(spark, d):
    return innings.batsman_totals(bridge.balls(spark, d))


@query
def agg_count_by_type(spark, d):
    return explore.documents_by_type(bridge.match_headers(spark, d))


@query
def agg_runs_histogram(spark, d):
    return explore.runs_histogram(bridge.balls(spark, d))


@query
def agg_top_venues(spark, d):
    return explore.top_venues(bridge.match_headers(spark, d))


@query
def agg_row_counts(spark, d):
    return explore.row_counts(bridge.balls(spark, d))


@query
def agg_player_team(spark, d):
    return flatten.latest_team_of_players(bridge.match_headers(spark, d))


@query
def agg_overview_rr(spark, d):
    return trends.overview_run_rate(match_data(spark, d))


@query
def agg_home_away_total(spark, d):
    return serving.home_away_total(teams.home_away_win_pct(match_data(spark, d), limit=None))


@query
def agg_chasing_pct(spark, d):
    return serving.chasing_pct(teams.win_batting_first(match_data(spark, d)))


@query
def agg_headline(spark, d):
    return explore.headline(match_data(spark, d))


# --- window functions ---

@query
def win_rolling_avg_runs(spark, d):
    return innings.rolling_avg_runs(bridge.numbered_balls(spark, d)).select(
        "match_id", "inning", "over_num", "ball_num", "runs_total", "rolling_avg_runs")


@query
def win_cumulative_runs(spark, d):
    return innings.cumulative_runs(bridge.numbered_balls(spark, d)).select(
        "match_id", "inning", "over_num", "ball_num", "runs_total", "cumulative_runs")


@query
def win_momentum(spark, d):
    return innings.momentum_shifts(innings.over_run_rate(bridge.balls(spark, d)))


@query
def win_rank_batsmen(spark, d):
    return innings.rank_batsmen(bridge.balls(spark, d))


@query
def win_cumsum_team(spark, d):
    return trends.cumulative_run_rate(match_data(spark, d), half_even=False)


@query
def win_cumcount(spark, d):
    per = match_data(spark, d).overs.groupBy("match_type", "over_num").agg(F.sum("runs").alias("runs"))
    return innings.cumulative_means(per, "match_type", "runs", "mean_so_far").withColumn("mean_so_far", F.round("mean_so_far", 4))


@query
def win_first_per_group(spark, d):
    """Best innings of each batsman and the team that batted first in each match, each by one aggregate."""
    data = match_data(spark, d)
    best = F.min_by(F.struct("match_id", "inning", "runs"), F.struct(-F.col("runs"), "match_id", "inning"))
    return (data.batting_innings.groupBy("batsman").agg(best.alias("best"))
            .join(teams.first_batting_team(data).withColumnRenamed("match_id", "m"), F.col("best.match_id") == F.col("m"))
            .select("batsman", "best.match_id", "best.inning", F.col("best.runs").alias("score"), "batting_first"))


# --- sorts, limits, sets ---

@query
def top_k(spark, d):
    return top(explore.runs_histogram(bridge.balls(spark, d)), [desc("count")], ["runs_total"], 5)


@query
def sort_multi(spark, d):
    per = bridge.balls(spark, d).groupBy("bowler").agg(
        F.sum(flag_int(is_wicket())).alias("wickets"), F.sum("runs_total").alias("runs"))
    return top(per, [desc("wickets"), asc("runs")], ["bowler"], 20)


@query
def sort_full(spark, d):
    return reports.report("pressure_index_per_over", match_data(spark, d), ordered=True)


@query
def serve_team_filter(spark, d):
    rows = teams.extras_analysis(match_data(spark, d), limit=None)
    return squads.team_rows(rows, "T3x XI")


@query
def serve_rank_index(spark, d):
    return serving.ranked(batting.top_run_scorers(match_data(spark, d)), "balls_faced", ["batsman"], 10)


@query
def set_distinct(spark, d):
    return squads.team_names(bridge.balls(spark, d), "inning")


# --- pressure and verdicts ---

@query
def fn_pressure_index(spark, d):
    """Match state from every line item, with zero rates and zero balls among it."""
    lines = bridge.read_lines(spark, d)
    qty = F.col("l_quantity").cast("int")
    state = lines.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        (F.round(F.col("l_tax") * 100) + 4.0).alias("required_rr"), ((qty % 13) / 1.0).alias("current_rr"),
        (qty % 10).alias("wickets_lost"), (qty * 2).alias("balls_remaining"), F.when(qty == 7, 0).otherwise(120).alias("total_balls"))
    return with_pressure(state)


@query
def fn_pressure_apply(spark, d):
    return fn_pressure_index(spark, d).groupBy("pressure_level").agg(
        F.count("*").alias("n"), F.min("pressure_index").alias("lowest"), F.max("pressure_index").alias("highest"))


@query
def fn_pressure_per_over(spark, d):
    return pressure_per_over(bridge.balls(spark, d))


@query
def fn_pressure_band(spark, d):
    return trends.pressure_index_per_over(match_data(spark, d)).select(
        "match_id", "inning", "over_num", pressure_band("pressure_index").alias("band"))


@query
def fn_toss_advantage(spark, d):
    rows = teams.win_by_toss_decision(match_data(spark, d))
    return rows.select("toss_decision", "match_type", "win_pct", toss_advantage("win_pct").alias("verdict"))


# --- streaming ---

def _clean(spark, d, stream=True) -> DataFrame:
    return streams.clean_stream(live_balls.enrich_envelope(bridge.envelopes(spark, d, stream)))


@query
def st_raw(spark, d):
    rows = _drained(spark, live_balls.enrich_envelope(bridge.envelopes(spark, d, stream=True)), "raw")
    return rows.select(F.get_json_object("raw_json", "$.matchId").alias("match_id"), F.get_json_object("raw_json", "$.inning").alias("inning"),
                       F.get_json_object("raw_json", "$.over").cast("int").alias("over_num"),
                       F.get_json_object("raw_json", "$.ball").cast("int").alias("ball_num"))


@query
def st_clean(spark, d):
    return _plain_times(_drained(spark, _clean(spark, d), "clean").drop("ingestion_time"))


def _two_polls(balls: DataFrame) -> DataFrame:
    """Every ball sent again half a minute later."""
    return (balls.withColumn("poll", F.explode(F.array(F.lit(0), F.lit(30))))
            .withColumn("event_time", F.col("event_time") + F.make_dt_interval(secs=F.col("poll"))).drop("poll"))


@query
def st_dedup(spark, d):
    kept = _drained(spark, streams.once_per_ball(_two_polls(_clean(spark, d))), "dedup")
    return kept.drop("ingestion_time", "event_time")


@query
def st_dedup_upsert(spark, d):
    path = scratch_dir(spark, "balls")
    balls = _two_polls(_clean(spark, d)).drop("ingestion_time")
    for run in ("first", "again"):
        streams.start_ball_upsert(balls, f"{path}/table", f"{path}/{run}").awaitTermination()
    return _plain_times(ball_table.read_balls(spark, f"{path}/table"))


@query
def st_live_kpis(spark, d):
    kept = _drained(spark, streams.live_kpi_stream(_clean(spark, d)), "live-kpis")
    return _plain_times(kept.drop("computed_at"))


@query
def st_live_kpis_batch(spark, d):
    """The same windows from the stored balls, open ones too."""
    return _plain_times(live.live_windows(_clean(spark, d, stream=False)))


@query
def st_tumbling(spark, d):
    kept = _drained(spark, streams.live_kpi_stream(_clean(spark, d), slide=None), "tumbling")
    return _plain_times(kept.select("match_id", "window_start", "window_end", "window_runs", "balls_bowled", "wickets_in_window"))


@query
def st_update_windows(spark, d):
    path = scratch_dir(spark, "windows")
    streams.start_window_upsert(_clean(spark, d), f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return _plain_times(streams.read_windows(spark, f"{path}/table"))


@query
def st_late_drop(spark, d):
    """All balls arrive, then all of them again as if bowled 40 days earlier; the second load is too late to count."""
    path = scratch_dir(spark, "late")
    balls = _clean(spark, d, stream=False)
    for days in (0, 40):
        rows = balls.withColumn("event_time", F.col("event_time") - F.make_dt_interval(days=F.lit(days)))
        rows.write.mode("append").parquet(f"{path}/in")
        stream = streams.live_kpi_stream(streams.read_table_stream(spark, f"{path}/in", balls.schema), dedup=False)
        streams.start_append(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    kept = spark.read.parquet(f"{path}/out")
    return _plain_times(kept.select("match_id", "window_start", "window_end", "window_runs", "balls_bowled"))


@query
def st_chain(spark, d):
    base = scratch_dir(spark, "chain")
    streams.run_chain(spark, bridge.envelopes(spark, d, stream=True), base)
    return _plain_times(spark.read.parquet(f"{base}/live_kpis").drop("computed_at"))


def _polled_again(spark, d) -> str:
    """Messages of three batches in order of time; each comes again in later runs, a quarter of an hour and a day after
    it was first sent, with the poll's own time. The chain runs after each; the folder of its tables is returned."""
    base = scratch_dir(spark, "repolled")
    events = bridge.read_events(spark, d)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(micros), F.max(micros)).first()
    share = F.floor((micros - first) * 3 / (last - first + 1))

    def send(part: int, minutes: int) -> None:
        rows = events.filter(share == part).withColumn("ts", F.col("ts") + F.make_dt_interval(mins=F.lit(minutes)))
        bridge.envelopes_from_events(rows).write.mode("append").parquet(f"{base}/in")

    for sent in ([(0, 0)], [(1, 0), (0, 15)], [(2, 0), (1, 15), (0, 1440)], [(2, 15), (1, 1440)], [(2, 1440)]):
        for part, minutes in sent:
            send(part, minutes)
        streams.run_chain(spark, read_envelopes(spark, "parquet", f"{base}/in"), f"{base}/lake")
    return f"{base}/lake"


@query
def st_chain__repolled(spark, d):
    return _plain_times(spark.read.parquet(f"{_polled_again(spark, d)}/live_kpis").drop("computed_at"))


@query
def st_live_rates__repolled(spark, d):
    base = _polled_again(spark, d)
    batsmen = streams.read_rates(spark, f"{base}/batsman_rates", "batsman").select("match_id", "inning", F.col("batsman").alias("player"), "runs", "balls", F.col("strike_rate").alias("rate"))
    bowlers = streams.read_rates(spark, f"{base}/bowler_rates", "bowler").select("match_id", "inning", F.col("bowler").alias("player"), "runs", "balls", F.col("economy").alias("rate"))
    return batsmen.unionByName(bowlers)


@query
def st_partnership(spark, d):
    return live.current_partnership(bridge.live_balls(spark, d))


@query
def st_partnership_stands(spark, d):
    return innings.stands(bridge.live_balls(spark, d))


@query
def st_batsman_sr(spark, d):
    return live.live_batsmen(bridge.live_balls(spark, d))


@query
def st_bowler_econ(spark, d):
    return live.live_bowlers(bridge.live_balls(spark, d))


def _rates_table(spark, d, player) -> DataFrame:
    path = scratch_dir(spark, f"{player}-rates")
    balls = bridge.live_from_events(bridge.read_events(spark, d, stream=True))
    streams.start_ball_upsert(balls, f"{path}/balls", f"{path}/checkpoints/balls").awaitTermination()
    streams.start_rates_upsert(f"{path}/balls", f"{path}/table", f"{path}/checkpoints/rates", player, spark).awaitTermination()
    return streams.read_rates(spark, f"{path}/table", player)


@query
def st_batsman_sr_stream(spark, d):
    return _rates_table(spark, d, "batsman")


@query
def st_bowler_econ_stream(spark, d):
    return _rates_table(spark, d, "bowler")


@query
def st_last5_wkts(spark, d):
    return live.wickets_in_last_overs(bridge.live_balls(spark, d))


# --- serving ---

NOW = datetime(2024, 1, 31)


def _live_table(spark, d) -> DataFrame:
    # The end of a window stands for the time its row was computed.
    return live.live_windows(bridge.live_balls(spark, d)).withColumn("computed_at", F.col("window_end"))


@query
def serve_live_latest(spark, d):
    return _plain_times(serving.live_latest(_live_table(spark, d), NOW, within="2 hours"))


@query
def serve_live_latest_per_match(spark, d):
    return _plain_times(serving.latest_per_match(_live_table(spark, d))).select("match_id", "window_start", "window_runs", "balls_bowled")


@query
def serve_rr_trend(spark, d):
    return _plain_times(serving.run_rate_trend(_live_table(spark, d)))


@query
def serve_top_batsmen(spark, d):
    return serving.top_batsmen(batting.top_run_scorers(match_data(spark, d)))


@query
def serve_top_bowlers(spark, d):
    from creaseline.plans.bowling import top_wicket_takers
    return serving.top_bowlers(top_wicket_takers(match_data(spark, d)))


@query
def serve_pressure_match(spark, d):
    return serving.pressure_of_match(trends.pressure_index_per_over(match_data(spark, d)))


@query
def serve_rr_progression(spark, d):
    return serving.run_rate_progression(trends.run_rate_progression(match_data(spark, d)))


@query
def serve_phase(spark, d):
    return serving.boundary_phases(trends.boundary_pct_per_phase(match_data(spark, d)))


@query
def serve_toss(spark, d):
    return serving.toss_wins(teams.win_by_toss_decision(match_data(spark, d)))


@query
def serve_h2h(spark, d):
    return serving.head_to_head(teams.head_to_head(match_data(spark, d), limit=None), match_type="T20")


@query
def serve_partnerships(spark, d):
    return serving.partnerships(batting.partnership_analysis(match_data(spark, d)))


@query
def serve_pairs(spark, d):
    rows = batting.partnership_pairs(match_data(spark, d), limit=None)
    return rows.select("match_id", "inning", pair_label("player_a", "player_b", "&").alias("pair"), "partnership_runs")
