import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from creaseline.llm import warc_archive

PAGES = [(3, "http://a/1", "<p>x</p>"), (1, "http://a/2", "<p>x</p>"), (2, None, "é" * 50_000), (4, "http://a/\r\nX: y", None), (5, "u", ""), (6, "u", "<p>x</p>"),
         (6, "u", "<p>x</p>"), (None, "n", "alone"), (None, "n", "<p>x</p>")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit("extra") for c in ("payload", "header", "address", "digest", "record")})


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data, keep = (h or "").encode(), first.get(h or "")
        kind = "response" if i == keep else "revisit"
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, keep if kind == "revisit" else None))
    return sorted(out, key=repr)


def test_round_trip_with_edge_cases(spark, folder):
    warc_archive.write_archive(pages(spark), f"{folder}/a")
    back = warc_archive.read_archive(spark, f"{folder}/a").collect()
    assert sorted(((r["record"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back), key=repr) == brute(PAGES)
    assert sorted((r["record"], bytes(r["payload"]).decode()) for r in back if r["record"] is not None) == sorted((i, h or "") for i, _, h in PAGES if i is not None)
    assert spark.read.parquet(f"{folder}/a/payloads").count() == len({h or "" for _, _, h in PAGES})
    assert {r["url"] for r in back if r["record"] == 4} == {"http://a/%0D%0AX: y"} and {r["url"] for r in back if r["record"] == 2} == {None}


def test_small_payloads_do_not_revisit(spark, folder):
    warc_archive.write_archive(pages(spark), f"{folder}/a", min_bytes=9)
    assert all(r["record_type"] == "response" for r in warc_archive.read_archive(spark, f"{folder}/a").collect())


def test_bytes_of_records(spark, folder):
    warc_archive.write_archive(pages(spark, [(1, "u", "abc"), (2, "u", "abc")]), f"{folder}/a")
    records = sorted(bytes(r["record"]) for r in warc_archive.warc_bytes(warc_archive.restore(spark, f"{folder}/a")).collect())
    response = next(r for r in records if b"WARC-Type: response" in r)
    assert response.startswith(b"WARC/1.1\r\n") and response.endswith(b"Content-Length: 3\r\n\r\nabc\r\n\r\n")
    assert next(r for r in records if b"WARC-Type: revisit" in r).endswith(b"Content-Length: 0\r\n\r\n\r\n\r\n")


def test_damage_is_an_error(spark, folder):
    warc_archive.write_archive(pages(spark, [(1, "u", "abc")]), f"{folder}/a")
    heads = spark.read.parquet(f"{folder}/a/headers").collect()
    spark.createDataFrame([(heads[0]["address"], bytearray(b"abd"))], "address string, payload binary").write.mode("overwrite").parquet(f"{folder}/a/payloads")
    with pytest.raises(Exception, match="does not match its header"):
        warc_archive.restore(spark, f"{folder}/a").collect()


def test_empty_table(spark, folder):
    warc_archive.write_archive(pages(spark, []), f"{folder}/a")
    assert warc_archive.read_archive(spark, f"{folder}/a").collect() == []
