"""Reading and flattening documents, data quality, incremental and repeated loads."""

import json
import os

import pytest
from pyspark.sql import functions as F

from creaseline.operators import flatten, quality
from creaseline.plans import batch_run
from creaseline.plans.reports import REPORTS, report
from creaseline.sources import bridge
from creaseline.sources.documents import read_match_documents


def delivery(total, **extra):
    return {"batter": "A", "bowler": "B", "non_striker": "C", "runs": {"batter": total, "extras": 0, "total": total}, **extra}


def document(season="2024", date="2024-06-01", winner="India", event="World Cup", innings=None):
    innings = innings if innings is not None else [
        {"team": "India", "overs": [
            {"over": 0, "deliveries": [delivery(4), delivery(0, wickets=[{"kind": "run out", "player_out": "C"}, {"kind": "bowled", "player_out": "A"}])]},
            {"over": 1, "deliveries": [delivery(6)]}]},
        {"team": "Oman", "overs": [{"over": 0, "deliveries": [delivery(1)]}]}]
    return {"meta": {"data_version": "1.0", "created": date, "revision": 1},
            "info": {"match_type": "T20", "season": season, "teams": ["India", "Oman"], "dates": [date], "venue": "MCG", "event": {"name": event, "group": 1},
                     "outcome": {"winner": winner, "by": {"runs": 5}}, "toss": {"winner": "Oman", "decision": "bat"},
                     "players": {"India": ["V K", "R S"], "Oman": ["A I"]}, "registry": {"people": {"V K": "1"}}},
            "innings": innings}


@pytest.fixture
def documents(folder):
    def write(**docs):
        import os
        os.makedirs(f"{folder}/docs", exist_ok=True)
        for name, doc in docs.items():
            with open(f"{folder}/docs/{name}.json", "w") as f:
                json.dump(doc, f, indent=1)
        return f"{folder}/docs"
    return write


def test_flatten(spark, documents):
    path = documents(m1=document(season=2024), m2=document(innings=[]), m3={"info": {"match_type": "ODI"}, "innings": [
        {"team": "X", "overs": [{"over": 0, "deliveries": [{"batter": "A", "bowler": "B"}]}]}]})
    docs = read_match_documents(spark, path)
    assert docs.count() == 3
    rows = flatten.flatten_matches(docs).orderBy("match_id", "inning_no", "over_num", "ball_num").collect()
    assert [(r.match_id, r.inning, r.inning_no, r.over_num, r.ball_num, r.runs_total, r.wicket_kind) for r in rows] == [
        ("m1", "India", 1, 0, 1, 4, None), ("m1", "India", 1, 0, 2, 0, "run out"), ("m1", "India", 1, 1, 1, 6, None),
        ("m1", "Oman", 2, 0, 1, 1, None), ("m3", "X", 1, 0, 1, None, None)]
    assert flatten.flatten_matches(docs, all_wickets=True).filter("wicket_kind is not null").count() == 2
    filled = flatten.flatten_matches(docs, fill_defaults=True).filter("match_id = 'm3'").first()
    assert (filled.team1, filled.winner, filled.runs_total, filled.match_type) == ("", "", 0, "ODI")


def test_slim_info_and_squads(spark, documents):
    docs = read_match_documents(spark, documents(m1=document(), m2=document()))
    slim = flatten.slim_info(docs)
    assert "players" not in slim.select("info.*").columns and "venue" in slim.select("info.*").columns
    assert {r.player: r.team for r in flatten.latest_team_of_players(docs).collect()} == {"V K": "India", "R S": "India", "A I": "Oman"}


QUALITY = "batsman string, bowler string, runs_batsman int, runs_extras int, runs_total int, over_num int, wicket_kind string"


@pytest.mark.parametrize("rows, kept", [
    ([("A", "B", 1, 0, 1, 0, None), (None, "B", 1, 0, 1, 0, None), ("C", "B", 0, 0, 0, 1, None)], 2),
    ([("A", None, 1, 0, 1, 0, None), ("A", "B", 1, 0, 1, 0, None)], 1),
    ([("A", "B", 37, 0, 37, 0, None), ("A", "B", 36, 0, 36, 0, None)], 1),
    ([("A", "B", 1, 0, 1, 0, None), ("A", "B", None, None, 0, 5, None), ("C", "D", 6, 0, 6, 19, "bowled")], 3),
])
def test_quality_rules(spark, rows, kept):
    df = spark.createDataFrame(rows, QUALITY)
    clean = quality.clean_balls(df)
    assert clean.count() == kept and quality.rejected_balls(df).count() == len(rows) - kept
    assert clean.filter("runs_batsman is null or runs_extras is null").count() == 0


def test_batch_run_twice_and_incrementally(spark, documents, folder):
    path = documents(m1=document(), m2=document(winner=None), m3=document(season="2023/24"))
    base = f"{folder}/lake"
    assert batch_run.run_batch(spark, path, base) == []
    first = {n: spark.read.parquet(f"{base}/{n}").count() for n in ("bronze/matches", "silver/deliveries", "silver/matches")}
    assert first == {"bronze/matches": 3, "silver/deliveries": 12, "silver/matches": 3}
    documents(m4=document(date="2026-02-10", event="T20 World Cup"), m5=document(date="2026-02-10", event="Other"))
    assert [r.match_id for r in batch_run.new_documents(spark, path, base, "2026", "World Cup").collect()] == ["m4"]
    assert batch_run.run_batch(spark, path, base) == []
    assert spark.read.parquet(f"{base}/silver/deliveries").count() == 20
    assert batch_run.run_batch(spark, path, base) == []
    assert spark.read.parquet(f"{base}/silver/deliveries").count() == 20
    top = spark.read.parquet(f"{base}/gold/batch_kpis/top_run_scorers").first()
    assert (top.batsman, top.total_runs, top.balls_faced, top.matches) == ("A", 55, 20, 5)


def test_corrected_matches_replace_and_rejected_balls_stay(spark, documents, folder):
    """A half-played match, then its whole document; a ball without a bowler goes to quarantine."""
    base = f"{folder}/lake"
    half = document()
    half["innings"] = half["innings"][:1]
    path = documents(m1=half, m2=document())
    assert batch_run.run_batch(spark, path, base) == []
    whole = document(winner="Oman")
    whole["meta"]["revision"] = 2
    whole["innings"][1]["overs"][0]["deliveries"].append(delivery(3, bowler=None))
    documents(m1=whole)
    assert batch_run.run_batch(spark, path, base) == []
    balls = {r.match_id: (r["count"], r.revision) for r in batch_run.latest_balls(spark, base).groupBy("match_id", "revision").count().collect()}
    assert balls == {"m1": (4, 2), "m2": (4, 1)}
    assert [(r.match_id, r.failed_rule, r.season) for r in batch_run.latest_balls(spark, base, "quarantine").collect()] == [("m1", "no_bowler", "2024")]
    wins = {r.team: r.wins for r in spark.read.parquet(f"{base}/gold/batch_kpis/most_wins_by_team").collect()}
    assert wins == {"Oman": 1, "India": 1}
    direct = batch_run.match_data_of(spark, base)
    for name in REPORTS:
        kept = spark.read.parquet(f"{base}/gold/batch_kpis/{name}")
        assert sorted(map(str, kept.collect())) == sorted(map(str, report(name, direct).collect())), name


def test_anti_join_is_below_the_first_generator(spark, documents, folder):
    path = documents(m1=document(), m2=document())
    base = f"{folder}/lake"
    batch_run.run_batch(spark, path, base)
    documents(m3=document())
    batch_run.load_files(spark, path, base)
    plan = flatten.flatten_matches(batch_run.pending_documents(spark, base), keep=["season", "revision"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.rindex("LeftAnti")  # the plan prints from the top


def opened(documents):
    return {r.f.rsplit("/", 1)[1] for r in documents.select(F.col("source_file").alias("f")).collect()}


def test_a_second_run_opens_only_new_and_changed_files(spark, folder):
    from creaseline.sources.documents import changed_files, read_changed_documents
    base, path = f"{folder}/lake", f"{folder}/docs"
    os.makedirs(path)
    for k in range(1000):
        with open(f"{path}/m{k}.json", "w") as out:
            json.dump(document(), out)
    assert batch_run.load_files(spark, path, base) == 1000
    for name, found in {"n 1": document(), "n[2]": document(), "m7": {**document(), "meta": {"data_version": "1", "created": "2024", "revision": 2}}}.items():
        with open(f"{path}/{name}.json", "w") as out:
            json.dump(found, out)
    files = changed_files(spark, path, f"{base}/bronze/files")
    documents = read_changed_documents(spark, path, files)
    assert len(documents.inputFiles()) == 3 and opened(documents) == {"n%201.json", "n%5B2%5D.json", "m7.json"}
    assert batch_run.load_files(spark, path, base) == 3 and batch_run.load_files(spark, path, base) == 0
    raw = spark.read.parquet(f"{base}/bronze/matches")
    assert raw.count() == 1003 and {r.revision for r in raw.where("match_id = 'm7'").collect()} == {document()["meta"]["revision"], 2}
    assert read_changed_documents(spark, path, files.limit(0)).count() == 0


def test_runs_read_only_new_loads(spark, documents, folder):
    base = f"{folder}/lake"
    path = documents(m1=document(), m2=document())
    batch_run.run_batch(spark, path, base)
    documents(m3=document(winner=None))
    batch_run.load_files(spark, path, base)
    pending = batch_run.pending_documents(spark, base)
    plan = pending._jdf.queryExecution().executedPlan().toString()
    assert any("load#" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]) and {r.match_id for r in pending.collect()} == {"m3"}
    batch_run.load_clean(spark, base)
    assert batch_run.pending_documents(spark, base).count() == 0
    assert sorted(r.load for r in spark.read.parquet(f"{base}/silver/loads").collect()) == [1, 2]
    balls = spark.read.parquet(f"{base}/silver/deliveries")
    assert {(r.match_id, r.load) for r in balls.select("match_id", "load").distinct().collect()} == {("m1", 1), ("m2", 1), ("m3", 2)}
    assert batch_run.compute_reports(spark, base) == []
    assert spark.read.parquet(f"{base}/gold/batch_kpis/top_run_scorers").first().matches == 3


@pytest.fixture
def lines(spark, folder):
    """A table of lines with null and repeated keys, over three matches and the lines without a key."""
    import random
    rnd = random.Random(5)
    maybe = lambda value: None if rnd.random() < 0.1 else value
    rows = [(maybe(rnd.randrange(180)), maybe(rnd.randrange(1, 90)), maybe(rnd.randrange(1, 30)), maybe(rnd.randrange(1, 5)), maybe(float(rnd.randrange(1, 51))), float(k),
             maybe(rnd.choice([0.0, 0.09])), maybe(rnd.choice([0.0, 0.07])), maybe(rnd.choice("NRA")), maybe(rnd.choice("FO"))) for k in range(900)]
    spark.createDataFrame(rows + rows[:40], bridge.LINES).repartition(5).write.parquet(f"{folder}/lines/lineitem.parquet")
    return f"{folder}/lines"


def test_bridged_documents_deal_out_lines_once(spark, lines):
    documents = bridge.match_documents(spark, lines)
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "AS batsman" not in plan[plan.index("Exchange "):]
    facts = ["match_id", "match_type", "venue", "winner", "toss_decision", "inning", "inning_no", "over_num", "ball_num", "batsman", "bowler", "non_striker",
             "runs_batsman", "runs_extras", "runs_total", "wicket_kind", "wicket_player_out"]
    found = sorted(map(str, flatten.flatten_matches(documents).select(facts).collect()))
    assert found == sorted(map(str, bridge.numbered_balls(spark, lines).select(facts).collect())) and len(found) == 940
    assert {r.match_id: [i.team for i in r.innings] for r in documents.collect()} == {
        "match_0": ["India", "Sri Lanka"], "match_1": ["Sri Lanka", "Oman"], "match_2": ["Oman", "T3x XI"], None: [None, None]}


def test_packed_documents(spark, folder):
    spark.createDataFrame([(json.dumps(document()),)], "value string").coalesce(1).write.text(f"{folder}/packed", compression="gzip")
    name, = [f for f in os.listdir(f"{folder}/packed") if f.startswith("part-")]
    os.rename(f"{folder}/packed/{name}", f"{folder}/packed/m1.json.gz")
    for one_per_file in (True, False):
        assert flatten.flatten_matches(read_match_documents(spark, f"{folder}/packed", one_per_file)).select("match_id").distinct().collect() == [("m1",)]


def test_pending_documents_are_copied_only_if_some_are_not(spark, documents, folder):
    import glob
    base, copies = f"{folder}/lake", spark.conf.get("spark.checkpoint.dir") + "/creaseline/pending-*"
    before = len(glob.glob(copies))
    path = documents(m1=document(), m2=document())
    batch_run.load_files(spark, path, base)
    batch_run.load_clean(spark, base)
    assert len(glob.glob(copies)) == before and spark.read.parquet(f"{base}/silver/deliveries").count() == 8
    later = {**document(), "meta": {"data_version": "1", "created": "2024", "revision": 2}}
    documents(m1=later)
    batch_run.load_files(spark, path, base)
    documents(m1={**later, "meta": {**later["meta"], "revision": 3}}, m3=document())
    batch_run.load_files(spark, path, base)
    batch_run.load_clean(spark, base)  # of m1 only the last revision
    found = spark.read.parquet(f"{base}/silver/deliveries").groupBy("match_id", "revision").count().collect()
    assert sorted(map(tuple, found)) == [("m1", 1, 4), ("m1", 3, 4), ("m2", 1, 4), ("m3", 1, 4)] and len(glob.glob(copies)) == before + 1


def test_reports_join_their_inputs_only_if_a_revision_is_out_of_date(spark, documents, folder):
    from creaseline.plans.match_data import INPUTS, ReportInputs
    base = f"{folder}/lake"

    def inputs():
        data = ReportInputs(spark, f"{base}/gold/inputs").data(batch_run.latest_matches(spark, base))
        assert all("Join" not in getattr(data, frame)._jdf.queryExecution().optimizedPlan().toString() for frame in [*INPUTS.values(), "matches"])
        return data

    assert batch_run.run_batch(spark, documents(m1=document(), m2=document()), base) == []
    assert inputs().batting_innings.agg(F.sum("balls")).first()[0] == 8
    later = {**document(), "meta": {"data_version": "1", "created": "2024", "revision": 2}}
    later["innings"] = later["innings"][:1]
    assert batch_run.run_batch(spark, documents(m1=later, m3=document()), base) == []
    assert {r.match_id: r.b for r in inputs().batting_innings.groupBy("match_id").agg(F.sum("balls").alias("b")).collect()} == {"m1": 3, "m2": 4, "m3": 4}
    # Rows of a run that failed before it listed its matches do not count.
    stored = spark.read.parquet(f"{base}/gold/inputs/batting")
    stored.where("match_id = 'm2'").withColumn("match_id", F.lit("m9")).write.mode("append").parquet(f"{base}/gold/inputs/batting")
    assert inputs().batting_innings.agg(F.sum("balls")).first()[0] == 11
    direct = batch_run.match_data_of(spark, base)
    assert sorted(map(str, report("partnership_analysis", inputs()).collect())) == sorted(map(str, report("partnership_analysis", direct).collect()))


def test_document_files_are_packed_and_read_in_parts(spark, lines, monkeypatch):
    import glob
    from creaseline import catalog
    monkeypatch.setattr(catalog, "MOST_FILES", 1)
    made, asked = spark.conf.get("spark.checkpoint.dir") + "/creaseline/document-files-*", []
    before, read = set(glob.glob(made)), catalog.read_match_documents
    monkeypatch.setattr(catalog, "read_match_documents", lambda spark, path, *rest: asked.append(path) or read(spark, path, *rest))
    found = catalog.src_match_documents__files(spark, lines).collect()
    path, = set(glob.glob(made)) - before
    assert len(glob.glob(f"{path}/part=*/file=*/*.json.gz")) == 4 and len(asked) == len(glob.glob(f"{path}/part=*")) > 1
    flat = bridge.numbered_balls(spark, lines).groupBy("match_id").agg(F.count("*"), F.sum("runs_total"), F.count("wicket_kind"), F.count_distinct("inning_no"))
    named = lambda r: (r[0] if r[0] and r[0].startswith("match_") else None, *r[-4:])  # a document without a name has its file's
    assert sorted(map(named, found), key=str) == sorted(map(named, flat.collect()), key=str)


def test_job_modes(spark, documents, folder):
    from creaseline import job
    base = f"{folder}/lake"
    assert job.main(["batch", "--base", base, "--documents", documents(m1=document())], spark) == 0
    assert job.main(["reports", "--base", base, "--variant", "frame"], spark) == 0
    assert spark.read.parquet(f"{base}/gold/batch_kpis/top_run_scorers").first().batsman == "A"
    envelope = spark.createDataFrame([("k", json.dumps({"matchId": "M", "inning": "I", "over": 0, "ball": 1, "eventTime": "2024-01-01T00:00:00Z"}), "live-balls")], "key string, value string, topic string")
    envelope.write.parquet(f"{folder}/messages")
    assert job.main(["streaming", "--base", f"{folder}/live", "--messages", f"{folder}/messages"], spark) == 0
    assert spark.read.parquet(f"{folder}/live/balls").count() == 1
    with pytest.raises(SystemExit):
        job.main(["batch", "--base", base], spark)
