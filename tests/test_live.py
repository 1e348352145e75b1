"""Live messages, cards, and streams with repeated and late balls."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from creaseline.operators import live_balls, scorecards
from creaseline.plans import live
from creaseline.streaming import ball_table
from creaseline.streaming import queries as streams

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def message(minute, ball=1, over=0, runs=1, wicket=None, match="M", seconds=0, **extra):
    at = START + timedelta(minutes=minute, seconds=seconds)
    return json.dumps({"matchId": match, "inning": "I", "over": over, "ball": ball, "batsman": f"b{minute}", "bowler": "w",
                       "runs": {"batsman": runs, "extras": 0, "total": runs}, "wicket": wicket, "eventTime": at.isoformat(), **extra})


def raw(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "raw_json string")


def test_wicket_shapes_and_gaps(spark):
    rows = live_balls.parse_live_balls(raw(
        spark, message(0, wicket={"kind": "bowled", "player_out": "x"}), message(0, wicket=[{"kind": "lbw", "player_out": "y"}]),
        message(0), message(0, wicket=[]), '{"matchId": "M", "eventTime": "2024-01-01T00:00:00Z"}', "not json", message(0, eventTime="yesterday"), None)).collect()
    assert [(r.wicket_kind, r.is_wicket) for r in rows[:4]] == [("bowled", True), ("lbw", True), (None, False), (None, False)]
    assert rows[4].match_id == "M" and rows[4].runs_total is None and rows[4].is_wicket is False and rows[4].event_time == datetime(2024, 1, 1)
    assert rows[5].match_id is None and rows[6].event_time is None and rows[7].match_id is None


def test_enrich_envelope(spark):
    rows = live_balls.enrich_envelope(spark.createDataFrame([("k", "v")], "key string, value string"))
    assert set(rows.columns) == {"ingestion_time", "raw_json"} and rows.first().raw_json == "v"


def test_scorecard_balls_defaults_and_quotes(spark):
    ok = {"status": "success", "data": {"scorecard": [{"overs": [{"deliveries": [
        {"batsman": 'A "x"', "wickets": [{"kind": "bowled", "player_out": "A"}]}, {"ball": 2, "runs": {"total": 4}}]}]}]}}
    bodies = [json.dumps(ok), json.dumps({**ok, "status": "failure"}), json.dumps({"status": "success", "data": {}}), "broken"]
    df = spark.createDataFrame([("M", b) for b in bodies], "match_id string, body string")
    got = [json.loads(r.value) for r in scorecards.scorecard_balls(df, F.lit(START)).collect()]
    assert [(g["inning"], g["over"], g["ball"], g["batsman"], g["bowler"]) for g in got] == [("unknown", 0, 0, 'A "x"', ""), ("unknown", 0, 2, "", "")]
    assert got[0]["wicket"]["kind"] == "bowled" and got[1]["runs"] == {"total": 4}


def test_score_header(spark):
    body = json.dumps({"status": "success", "data": {"id": "1", "teams": ["A", "B"], "tossWinner": "A", "tossChoice": "bat",
                                                      "score": [{"r": 150, "w": 3, "o": 19.3, "inning": "A 1"}, {"r": 9, "w": 0, "o": 0}]}})
    df = spark.createDataFrame([(body,)], "body string")
    head = scorecards.score_headers(df).first()
    assert (head.current_score, head.current_rr, head.toss, head.teams) == ("150/3 (19.3 ov)", 7.77, "A elected to bat", "A vs B")
    assert scorecards.score_headers(df, overs_and_balls=True).first().current_rr == 7.69
    assert [r.run_rate for r in scorecards.innings_scores(df).orderBy("line").collect()] == [7.77, 0.0]


def feed(spark, folder, texts):
    spark.createDataFrame([("k", t, "live-balls") for t in texts], "key string, value string, topic string").write.mode("append").json(f"{folder}/in")


def source(spark, folder):
    from creaseline.sources.live import read_envelopes
    return read_envelopes(spark, "json", f"{folder}/in")


def run_metrics(spark, folder, **options):
    balls = streams.clean_stream(live_balls.enrich_envelope(source(spark, folder)))
    q = streams.start_append(streams.live_kpi_stream(balls, **options), f"{folder}/out", f"{folder}/cp")
    q.awaitTermination()
    return q


def windows(rows):
    return {(r.match_id, r.window_start): (r.window_runs, r.balls_bowled, r.current_batsman) for r in rows.collect()}


def test_stream_equals_batch_with_repeats_and_late_balls(spark, folder):
    texts = [message(m, ball=m, runs=m % 7, seconds=m) for m in range(60)]
    feed(spark, folder, texts + texts)  # every ball twice
    run_metrics(spark, folder)
    balls = live_balls.parse_live_balls(raw(spark, *texts))
    closed = windows(live.closed_windows(live.live_windows(balls), balls))
    assert windows(spark.read.parquet(f"{folder}/out")) == closed and len(closed) > 40
    # A ball 30 minutes behind comes too late; a fresh one moves the watermark on.
    feed(spark, folder, [message(20, ball=99, runs=6), message(120, ball=98)])
    q = run_metrics(spark, folder)
    assert streams.late_rows(q) >= 1
    got = windows(spark.read.parquet(f"{folder}/out"))
    everything = windows(live.live_windows(live_balls.parse_live_balls(raw(spark, *texts, message(120, ball=98)))))
    assert got == {k: v for k, v in everything.items() if k[1] < datetime(2024, 1, 1, 1, 50)}


def test_ball_table_keeps_first_sight(spark, folder):
    first, again = message(1, ball=1), message(300, ball=1)
    for texts in ([first, message(2, ball=2)], [again, message(301, ball=3)]):
        feed(spark, folder, texts)
        balls = streams.clean_stream(live_balls.enrich_envelope(source(spark, folder))).drop("ingestion_time")
        streams.start_ball_upsert(balls, f"{folder}/balls", f"{folder}/cp").awaitTermination()
    rows = {r.ball_num: r.event_time for r in spark.read.parquet(f"{folder}/balls").collect()}
    assert rows == {1: datetime(2024, 1, 1, 0, 1), 2: datetime(2024, 1, 1, 0, 2), 3: datetime(2024, 1, 1, 5, 1)}


def test_update_windows_are_replaced(spark, folder):
    for texts in ([message(0, ball=1, runs=4)], [message(0, ball=2, runs=6, seconds=3)]):
        feed(spark, folder, texts)
        balls = streams.clean_stream(live_balls.enrich_envelope(source(spark, folder)))
        streams.start_window_upsert(balls, f"{folder}/w", f"{folder}/cp").awaitTermination()
    rows = streams.read_windows(spark, f"{folder}/w")
    assert rows.count() == rows.select("match_id", "window_start").distinct().count()
    assert rows.filter(F.col("window_start") == "2024-01-01 00:00:00").first().window_runs == 10


def test_chain_runs_again_without_repeating(spark, folder):
    feed(spark, folder, [message(m, ball=m) for m in range(30)])
    for _ in range(2):
        streams.stop_chain(streams.run_chain(spark, source(spark, folder), f"{folder}/lake"))
    assert spark.read.parquet(f"{folder}/lake/raw").count() == 30
    rows = spark.read.parquet(f"{folder}/lake/live_kpis")
    assert rows.count() == rows.select("match_id", "window_start").distinct().count() > 0


def test_chain_running_continuously(spark, folder):
    feed(spark, folder, [message(m, ball=m) for m in range(30)])
    queries = streams.run_chain(spark, source(spark, folder), f"{folder}/lake", every="1 second")
    try:
        for q in queries * 2:  # the second time, the watermark of the first has closed its windows
            q.processAllAvailable()
    finally:
        streams.stop_chain(queries)
    assert spark.read.parquet(f"{folder}/lake/clean").count() == 30
    assert spark.read.parquet(f"{folder}/lake/live_kpis").count() > 0


def lake_tables(spark, base):
    """Windows and both rates, without the time they were computed."""
    tables = [spark.read.parquet(f"{base}/live_kpis").drop("computed_at"), streams.read_rates(spark, f"{base}/batsman_rates"),
              streams.read_rates(spark, f"{base}/bowler_rates", "bowler")]
    return [sorted(map(str, t.collect())) for t in tables]


def test_chain_started_on_an_empty_lake_equals_one_run_to_the_end(spark, folder):
    """The same messages, once before the chain and once while it runs from an empty feed on."""
    texts = [message(m, ball=m % 6, over=m // 6, runs=m % 5, match=f"M{m % 3}") for m in range(90)]
    feed(spark, f"{folder}/a", texts)
    streams.run_chain(spark, source(spark, f"{folder}/a"), f"{folder}/a/lake")
    streams.run_chain(spark, source(spark, f"{folder}/a"), f"{folder}/a/lake")
    feed(spark, f"{folder}/b", [])
    queries = streams.run_chain(spark, source(spark, f"{folder}/b"), f"{folder}/b/lake", every="1 second")
    try:
        for part in (texts[:40], texts[40:]):
            feed(spark, f"{folder}/b", part)
            for q in queries * 2:
                q.processAllAvailable()
    finally:
        streams.stop_chain(queries)
    once, running = lake_tables(spark, f"{folder}/a/lake"), lake_tables(spark, f"{folder}/b/lake")
    assert once == running and all(len(t) > 20 for t in once[:2])


def test_batches_read_only_their_partitions(spark, folder):
    """Ten matches on ten days; a later batch of one of them lists and reads its own partition, also days after."""
    schema = ball_table.ball_schema()

    def balls(match, day, ball):
        return spark.createDataFrame([(match, "I", 0, ball, "x", "y", 1, 0, 1, None, None, False, START + timedelta(days=day))], schema)

    for day in range(10):
        ball_table.add_balls(balls(f"m{day}", day, 1), f"{folder}/balls", day)
    ball_table.add_balls(balls("m3", 7, 1), f"{folder}/balls", 10)  # polled again four days later
    ball_table.add_balls(balls("m3", 7, 2), f"{folder}/balls", 11)
    stored = ball_table.read_balls(spark, f"{folder}/balls").where("match_id = 'm3'").collect()
    assert sorted((r.ball_num, r.event_time.day) for r in stored) == [(1, 4), (2, 8)]
    m3 = spark.read.schema(ball_table.stored_schema()).parquet(f"{folder}/balls").where("match_id = 'm3'")
    beside = ball_table.balls_beside(spark, m3, f"{folder}/balls")
    assert {r.match_day.day for r in beside.collect()} == {4}
    plan = beside._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "match_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(beside.inputFiles()) >= 10 and len(set(r.f for r in beside.select(F.input_file_name().alias("f")).collect())) == 2


def test_ball_table_takes_a_batch_twice_and_null_matches(spark, folder):
    rows = [("m1", "I", 0, 1, "x", "y", 1, 0, 1, None, None, False, START), ("m2", "I", 0, 1, "x", "y", 1, 0, 1, None, None, False, None)]
    batch = spark.createDataFrame(rows + rows[:1], ball_table.ball_schema())
    for _ in range(2):
        ball_table.add_balls(batch, f"{folder}/balls", 0)
    assert sorted(r.match_id for r in ball_table.read_balls(spark, f"{folder}/balls").collect()) == ["m1", "m2"]
    ball_table.add_balls(batch.limit(0), f"{folder}/balls", 1)
    assert ball_table.read_balls(spark, f"{folder}/balls").count() == 2


def test_live_windows_stream_adds_up_panes_first(spark, folder):
    feed(spark, folder, [message(m, ball=m) for m in range(3)])
    balls = streams.clean_stream(live_balls.enrich_envelope(source(spark, folder)))
    plan = streams.live_kpi_stream(balls, dedup=False)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Aggregate [") == 2 and plan.count("Expand [") == 1
    lower = plan[plan.rindex("Aggregate ["):]
    assert "Expand" not in lower  # a ball is not copied into its five windows


def test_current_partnership(spark):
    texts = [message(i, over=i // 6, ball=i % 6 + 1, runs=i, wicket={"kind": "bowled", "player_out": "x"} if i == 7 else None) for i in range(12)]
    row = live.current_partnership(live_balls.parse_live_balls(raw(spark, *texts))).first()
    assert (row.partnership_runs, row.partnership_balls) == (8 + 9 + 10 + 11, 4)


def test_rates_are_replaced(spark, folder):
    rows = [("M", "I", 0, 1, "x", "y", 4), ("M", "I", 0, 2, "x", "y", 1)]
    for row in rows:
        match, inning, over, ball, batsman, bowler, runs = row
        ball_table.add_balls(spark.createDataFrame(
            [(match, inning, over, ball, batsman, bowler, runs, 0, runs, None, None, False, START)], ball_table.ball_schema()), f"{folder}/balls", ball)
        for player in ("batsman", "bowler"):
            streams.start_rates_upsert(f"{folder}/balls", f"{folder}/{player}", f"{folder}/cp-{player}", player, spark).awaitTermination()
    assert [(r.runs, r.balls, r.strike_rate) for r in streams.read_rates(spark, f"{folder}/batsman").collect()] == [(5, 2, 250.0)]
    assert [(r.runs, r.balls, r.economy) for r in streams.read_rates(spark, f"{folder}/bowler", "bowler").collect()] == [(5, 2, 15.0)]


def test_polls_repeated_after_the_watermark_count_once(spark, folder):
    """The same ten balls in four runs of the chain, twenty minutes apart."""
    for poll in range(4):
        feed(spark, folder, [message(20 * poll, ball=b, runs=2, seconds=b) for b in range(1, 11)] + [message(20 * poll + 15, ball=90 + poll)])
        streams.run_chain(spark, source(spark, folder), f"{folder}/lake")
    rows = spark.read.parquet(f"{folder}/lake/live_kpis").collect()
    assert {r.window_start.minute for r in rows if r.balls_bowled == 10} == {0, 56, 57, 58, 59}
    assert sum(r.balls_bowled == 10 for r in rows) == 5


def test_a_batch_leaves_other_buckets_alone(spark, folder):
    import glob
    import os

    from creaseline.sinks.tables import append_update, merge_updates, read_updates
    rows = spark.createDataFrame([(f"m{k}", 1) for k in range(40)], "match_id string, v int")
    append_update(rows, f"{folder}/t", 0, "match_id", [], 8)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/t/bucket=*/batch=0/*.parquet")}
    for _ in range(2):  # a batch that comes again replaces only itself
        append_update(spark.createDataFrame([("m3", 2)], "match_id string, v int"), f"{folder}/t", 1, "match_id", [], 8)
    assert {f: os.stat(f).st_mtime_ns for f in before} == before and len(glob.glob(f"{folder}/t/bucket=*/batch=1")) == 1
    merge_updates(spark, f"{folder}/t", f"{folder}/merged", ["match_id"], [])
    for table in ("t", "merged"):
        got = {r.match_id: r.v for r in read_updates(spark, f"{folder}/{table}", ["match_id"]).collect()}
        assert got == {**{f"m{k}": 1 for k in range(40)}, "m3": 2}
