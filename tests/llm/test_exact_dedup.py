import hashlib
import re

import pytest

from creaseline.llm import exact_dedup
from tests.llm import cases


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[normal(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_brute_force_with_edge_cases(spark):
    got = exact_dedup.deduplicate(cases.documents(spark)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(cases.DOCS)


def test_empty_table(spark):
    assert exact_dedup.deduplicate(cases.nothing(spark)).collect() == []
    assert exact_dedup.keep_first(cases.nothing(spark)).collect() == []


def test_later_loads_find_what_earlier_ones_added(spark, folder):
    path = f"{folder}/index"
    first = exact_dedup.DigestIndex(spark, path, buckets=4)
    exact_dedup.deduplicate(cases.documents(spark, [(10, "a b"), (11, "c")]), first).collect()
    again = exact_dedup.DigestIndex(spark, path, buckets=4)
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.deduplicate(cases.documents(spark, [(1, "a  b"), (2, "d"), (3, "d")]), again).collect()}
    assert got == {1: (10, False), 2: (2, True), 3: (2, False)}
    assert sorted(r["keep_id"] for r in again.rows().collect()) == [2, 10, 11]


def test_index_reopened_with_other_shuffle_partitions(spark, folder):
    """400 texts loaded by sessions with 8, 4 and 16 shuffle partitions: no digest is added or kept twice."""
    path, before = f"{folder}/index", spark.conf.get("spark.sql.shuffle.partitions")
    rows = [(k, f"text {k}") for k in range(400)]
    try:
        for number, width in enumerate((8, 4, 16)):
            spark.conf.set("spark.sql.shuffle.partitions", str(width))
            index = exact_dedup.DigestIndex(spark, path)
            load = [*((k + 1000 * number, t) for k, t in rows), (9000 + number, f"new {number}")]
            got = exact_dedup.deduplicate(cases.documents(spark, load), index).where("kept").collect()
            assert len(got) == (401 if number == 0 else 1)
            assert index.rows().count() == 401 + number
            index.close()
        digests = exact_dedup.DigestIndex(spark, path).rows()
        assert digests.select("text_sha256").distinct().count() == digests.count() == 403
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_index_refuses_other_properties_and_leaves_no_table(spark, folder):
    tables = {t.name for t in spark.catalog.listTables()}
    exact_dedup.deduplicate(cases.documents(spark)).collect()
    exact_dedup.DigestIndex(spark, f"{folder}/index", buckets=4).close()
    assert {t.name for t in spark.catalog.listTables()} == tables
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, f"{folder}/index", buckets=8)
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, f"{folder}/index", id_type="string")


def test_index_is_not_shuffled_for_the_anti_join(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = exact_dedup.DigestIndex(spark, f"{folder}/index", buckets=4)
        index.load(spark.createDataFrame([(1, "x"), (2, "y")], "doc_id bigint, text_sha256 string"))
        groups = spark.createDataFrame([("x", 5)], "text_sha256 string, keep_id bigint")
        plan = index.unseen(groups)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keep_first_keeps_columns_and_one_document_of_each_text(spark):
    docs = cases.documents(spark)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([1, 4, 4, 5, 7, 8, 9, 10, 11, None, 12, 13, 14], key=repr)
