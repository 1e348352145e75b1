"""Upserts, appends, compaction, statistics, exports, reading back."""

import json
import random

import pytest
from pyspark.sql import functions as F

from creaseline.functions.labels import team_short
from creaseline.operators import squads, upsert
from creaseline.sinks import tables
from creaseline.sources.kpi_tables import coerce_numeric, note_types, read_kpi, read_table
from creaseline.workspace import read_text, write_text


def test_upsert_is_a_dictionary_update(spark, folder):
    rnd = random.Random(3)
    schema = "p string, k int, v int, t int"
    state = {}
    for step in range(3):
        rows = [(str(k % 3), k, rnd.randint(0, 99), t) for t, k in enumerate(rnd.choices(range(30), k=40))]
        source = spark.createDataFrame(rows, schema)
        tables.upsert_table(spark, source, f"{folder}/plain", ["k"], version=["t"])
        tables.upsert_table(spark, source, f"{folder}/split", ["k"], ["p"], version=["t"])
        state.update({k: (v, t) for _, k, v, t in rows})
    for name in ("plain", "split"):
        assert {r.k: (r.v, r.t) for r in read_table(spark, f"{folder}/{name}").collect()} == state
        assert read_table(spark, f"{folder}/{name}").count() == len(state)


def test_a_merge_replaces_only_its_own_bucket(spark, folder):
    import glob
    import os
    path = f"{folder}/slots"
    tables.upsert_table(spark, spark.range(200).selectExpr("id AS k", "0 AS v"), path, ["k"], buckets=8)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*.parquet")}
    tables.upsert_table(spark, spark.createDataFrame([(7, 1)], "k long, v int"), path, ["k"], buckets=32)  # the table keeps its own count
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*.parquet")}
    gone = {os.path.dirname(f) for f in before if f not in after}
    assert len(gone) == 1 and all(after[f] == t for f, t in before.items() if os.path.dirname(f) not in gone)
    got = {r.k: r.v for r in tables.read_merged(spark, path).collect()}
    assert got == {**{k: 0 for k in range(200)}, 7: 1}
    spark.range(3).write.parquet(f"{folder}/plain")
    with pytest.raises(ValueError):
        tables.upsert_table(spark, spark.range(3), f"{folder}/plain", ["id"])


def test_read_kpi_starts_no_job(spark, folder):
    rows = spark.createDataFrame([("1", "x", 3), ("2.5", "y", None)], "a string, `b.c` string, n int")
    rows.write.parquet(f"{folder}/gold/batch_kpis/k")
    note_types(spark, f"{folder}/gold/batch_kpis/k")
    rows.limit(0).write.parquet(f"{folder}/gold/batch_kpis/e")
    note_types(spark, f"{folder}/gold/batch_kpis/e")
    tables.export_tables(spark, ["k"], f"{folder}/gold/batch_kpis", f"{folder}/data")
    spark.sparkContext.setJobGroup("read-kpi", "")
    try:
        found, empty = read_kpi(spark, "k", folder), read_kpi(spark, "e", folder, f"{folder}/data")
        copy = read_kpi(spark, "k", f"{folder}/none", f"{folder}/data")
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("read-kpi")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert dict(found.dtypes) == {"a": "double", "b.c": "string", "n": "int"} and empty.columns == []
    assert sorted(map(str, found.collect())) == sorted(map(str, copy.collect())) and found.count() == 2


def test_merge_matches_null_keys(spark):
    schema = "k string, v int"
    merged = upsert.merge_rows(spark.createDataFrame([(None, 1), ("a", 1)], schema), spark.createDataFrame([(None, 2), ("b", 2)], schema), ["k"])
    assert sorted(map(tuple, merged.collect()), key=str) == [("a", 1), ("b", 2), (None, 2)]


def test_append_new_keeps_season_as_text(spark, folder):
    rows = spark.createDataFrame([("m1", "2024"), ("m2", "2023/24")], "match_id string, season string")
    for _ in range(2):
        tables.append_new(spark, rows, folder + "/t", ["match_id", "season"], ["season"])
    assert read_table(spark, folder + "/t").count() == 2


def test_append_reads_whole_rows_only_if_some_are_new(spark, folder):
    path, schema = folder + "/t", "k string, r int, v int"
    tables.append_new(spark, spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 1, 3)], schema), path, ["k", "r"])
    again = spark.createDataFrame([("b", 1), ("a", 1)], "k string, r int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with tables of some size
    try:
        tables.append_new(spark, again.withColumn("v", F.when(F.rand() >= 0, F.raise_error(F.lit("a whole row was read"))).cast("int")), path, ["k", "r"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tables.append_new(spark, spark.createDataFrame([("c", 1, 4), ("c", 1, 4), ("b", 2, 5)], schema), path, ["k", "r"])
    tables.append_new(spark, spark.createDataFrame([("c", 1, 6), ("d", 1, 7), (None, 1, 8)], schema), path, ["k", "r"])
    tables.append_new(spark, spark.createDataFrame([(None, 1, 9)], schema), path, ["k", "r"])  # a null key is never known
    assert sorted((r.v, r.k) for r in read_table(spark, path).collect()) == [
        (1, "a"), (2, "a"), (3, "b"), (4, "c"), (4, "c"), (5, "b"), (7, "d"), (8, None), (9, None)]


def test_rows_stay_where_they_are_if_the_known_keys_are_few(spark):
    source, target = spark.range(50).selectExpr("id AS k", "id % 3 AS v"), spark.range(20).selectExpr("id AS k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for most, join in ((20, "BroadcastHashJoin"), (19, "SortMergeJoin")):
            new = upsert.only_new_rows(source, target, ["k"], most)
            assert join in new._jdf.queryExecution().executedPlan().toString() and {r.k for r in new.collect()} == {*range(20, 50)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_compact_and_stats(spark, folder):
    path = folder + "/t"
    spark.range(1000).withColumn("p", F.col("id") % 2).repartition(20).write.partitionBy("p").parquet(path)
    before = tables.table_stats(spark, path).first()
    tables.compact_table(spark, path, ["p"])
    after = tables.table_stats(spark, path).first()
    assert (before.row_count, after.row_count) == (1000, 1000) and after.file_count < before.file_count
    seasons = folder + "/s"
    spark.createDataFrame([("007", 1), ("007", 2)], "season string, v int").repartition(2).write.partitionBy("season").parquet(seasons)
    tables.compact_table(spark, seasons, ["season"])
    assert read_table(spark, seasons, schema="v int, season string").first().season == "007"
    plain = folder + "/u"
    spark.range(100).repartition(10).write.parquet(plain)
    tables.compact_table(spark, plain)
    assert tables.table_stats(spark, plain).first().file_count == 1 and read_table(spark, plain).count() == 100


@pytest.mark.parametrize("apart_bytes", [0, 1 << 40])
def test_compact_keeps_no_copy_and_takes_odd_partitions(spark, folder, apart_bytes):
    import glob
    import os
    path, kept = folder + "/a b", spark.conf.get("spark.checkpoint.dir") + "/creaseline/compact-*"
    odd = F.element_at(F.array(F.lit("x y"), F.lit("a:b"), F.lit("007"), F.lit(None)), (F.col("id") % 4 + 1).cast("int"))
    spark.range(400).withColumn("p", odd).repartition(5).write.partitionBy("p").parquet(path)
    rows = lambda: sorted(map(str, read_table(spark, path, schema="id bigint, p string").collect()))
    before, copies = rows(), len(glob.glob(kept))
    tables.compact_table(spark, path, ["p"], apart_bytes=apart_bytes)
    assert rows() == before and len(glob.glob(kept)) == copies and glob.glob(f"{path}/.compact-*") == []
    assert tables.table_stats(spark, path).first().file_count == 4
    stamps = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*.parquet")}
    tables.compact_table(spark, path, ["p"], apart_bytes=apart_bytes)  # nothing is too small any more
    assert {f: os.stat(f).st_mtime_ns for f in stamps} == stamps


def test_compacted_files_have_about_the_target_size(spark, folder):
    path = folder + "/t"
    spark.range(60000).selectExpr("id", "xxhash64(id) AS v", "id % 2 AS p").repartition(10).write.partitionBy("p").parquet(path)
    before = tables.table_stats(spark, path).first()
    tables.compact_table(spark, path, ["p"], target_bytes=before.total_bytes // 5, apart_bytes=0)
    after = tables.table_stats(spark, path).first()
    assert (before.file_count, after.file_count, after.row_count) == (20, 6, 60000)


def test_export_goes_on_after_a_failure(spark, folder):
    spark.range(3).write.parquet(folder + "/in/a")
    rows = tables.export_tables(spark, ["missing", "a"], folder + "/in", folder + "/out").collect()
    assert [(r.kpi, r.row_count, r.status.split(":")[0]) for r in rows] == [("missing", None, "failed"), ("a", 3, "ok")]
    assert spark.read.parquet(folder + "/out/a.parquet").count() == 3


def test_export_takes_over_the_notes_of_a_table(spark, folder):
    for name, text in (("a", "1"), ("b", "x"), ("c", "2")):
        spark.createDataFrame([(text,)], "v string").write.parquet(f"{folder}/in/{name}")
    write_text(spark, f"{folder}/in/a/_types.json", read_noted(spark, f"{folder}/in/a").replace('"numbers": ["v"]', '"numbers": []'))
    write_text(spark, f"{folder}/in/c/_types.json", read_noted(spark, f"{folder}/in/c").replace('"rows": 1', '"rows": 7'))  # not of this table
    tables.export_tables(spark, ["a", "b", "c"], folder + "/in", folder + "/out")
    notes = {name: json.loads(read_text(spark, f"{folder}/out/{name}.parquet/_types.json")) for name in "abc"}
    assert [(n["rows"], n["numbers"]) for n in notes.values()] == [(1, []), (1, []), (1, ["v"])]


def read_noted(spark, path):
    note_types(spark, path)
    return read_text(spark, f"{path}/_types.json")


def test_coerce_and_fallback(spark, folder):
    df = spark.createDataFrame([("1", "x", "1"), ("2.5", "y", None), ("z", "1", "2")], "a string, b string, c string")
    out = coerce_numeric(df)
    assert dict(out.dtypes) == {"a": "double", "b": "string", "c": "double"}
    df.write.parquet(folder + "/data/k.parquet")
    assert read_kpi(spark, "k", folder + "/none", folder + "/data").count() == 3
    assert read_kpi(spark, "other", folder + "/none", folder + "/data").columns == []
    df.limit(0).write.parquet(folder + "/base/gold/batch_kpis/k")
    assert read_kpi(spark, "k", folder + "/base", folder + "/data").count() == 3


def test_player_labels(spark):
    rows = spark.createDataFrame([("V Kohli",), ("Nobody",)], "batsman string")
    team_map = spark.createDataFrame([("V Kohli", "India")], "player string, team string")
    got = {r.batsman: (r.team, r.player_display) for r in squads.enrich_players(rows, team_map).collect()}
    assert got == {"V Kohli": ("India", "🇮🇳 V Kohli"), "Nobody": ("", "Nobody")}
    assert spark.range(1).select(team_short(F.lit("South Africa"))).first()[0] == "SA"
