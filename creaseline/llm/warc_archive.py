"""Content-addressed WARC archive.

Payload bytes are stored once, under their SHA-256; record headers are kept exactly, in a table of their own; the original
records come back by a join of both, and each is verified against the length and SHA-1 that its header states.

Defined results: a null payload is empty; equal payloads of at least `min_bytes` bytes share one response (the smallest
record id; a null id is larger than any other), the others revisit it. Rows that repeat id and payload are records of the same
kind. A null URL leaves out WARC-Target-URI; line breaks in a URL are percent-encoded. Other columns are not archived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.llm.common import null_as_empty, staged

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Digits of base 32 as `conv` writes them, and the letters of RFC 4648 in the same order.
CONV_DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """RFC 4648 base 32 of the SHA-1: twenty bits, five hex digits, make four letters."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32)


def header_text(kind: Column, record: Column, url: Column, refers_to: Column, digest: Column, length: Column, date: str) -> Column:
    """The header block of a record up to and with its empty line."""
    safe = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    uri = F.when(url.isNotNull(), F.concat(F.lit("WARC-Target-URI: "), safe, F.lit(CRLF))).otherwise("")
    revisit = F.when(kind == "revisit", F.concat(
        F.lit(f"WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: <urn:record:"), null_as_empty(refers_to.cast("string")), F.lit(f">{CRLF}"))).otherwise("")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), kind, F.lit(f"{CRLF}WARC-Record-ID: <urn:record:"), null_as_empty(record.cast("string")),
        F.lit(f">{CRLF}WARC-Date: {date}{CRLF}"), uri, revisit, F.lit("WARC-Payload-Digest: sha1:"), digest,
        F.lit(f"{CRLF}WARC-Payload-Length: "), length.cast("string"), F.lit(f"{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.when(kind == "revisit", F.lit("0")).otherwise(length.cast("string")), F.lit(CRLF + CRLF))


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write `folder`/payloads (address, payload) and `folder`/headers (address, header)."""
    payload = F.encode(null_as_empty(F.col(payload_col)), "UTF-8")
    records = pages.select(F.col(id_col).alias("record"), F.col(url_col).alias("url"), payload.alias("payload"))
    records = records.withColumn("address", F.sha2("payload", 256))
    # One payload of an address for each task at most goes over the network, however many copies there are.
    records.groupBy("address").agg(F.any_value("payload").alias("payload")).write.parquet(f"{folder}/payloads")
    heads = staged(records.select("record", "url", "address", base32_sha1(F.col("payload")).alias("digest"),
                                  F.octet_length("payload").cast("bigint").alias("length")), "warc-heads")
    firsts = staged(heads.groupBy("address").agg(F.min("record").alias("first")), "warc-firsts")
    known = heads.join(firsts.hint("merge"), "address")
    again = (F.col("length") >= min_bytes) & ~F.col("record").eqNullSafe(F.col("first"))
    kind = F.when(again, "revisit").otherwise("response")
    known.select("address", header_text(kind, F.col("record"), F.col("url"), F.col("first"), F.col("digest"), F.col("length"), date).alias("header")) \
         .write.parquet(f"{folder}/headers")


def restore(spark: SparkSession, folder: str) -> DataFrame:
    """Original records: header, payload (also of revisits), joined by address; a record that fails its check is an error.

    Neither side is pre-aggregated in the join's own stage, so an address with a large share of all records is split.
    """
    headers, payloads = spark.read.parquet(f"{folder}/headers"), spark.read.parquet(f"{folder}/payloads")
    joined = headers.join(payloads.hint("merge"), "address", "left")
    stated = F.regexp_extract("header", r"\r\nWARC-Payload-Digest: sha1:([A-Z2-7]+)\r\n", 1)
    length = F.regexp_extract("header", r"\r\nWARC-Payload-Length: (\d+)\r\n", 1).cast("bigint")
    sound = (base32_sha1(F.col("payload")) == stated) & (F.octet_length("payload") == length)
    checked = F.when(F.coalesce(sound, F.lit(False)), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its header: "), F.col("header"))).cast("binary"))
    return joined.select("header", checked.alias("payload"))


def read_archive(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """Per record: record, url, payload_bytes, payload_digest, record_type, refers_to, payload, taken from the restored record."""
    def field(name: str, pattern: str) -> Column:
        found = F.regexp_extract("header", rf"\r\n{name}: {pattern}\r\n", 1)
        return F.when(found != "", found)
    return restore(spark, folder).select(
        field("WARC-Record-ID", "<urn:record:([^>]*)>").cast(id_type).alias("record"), field("WARC-Target-URI", r"([^\r\n]*)").alias("url"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"),
        field("WARC-Type", "([a-z]+)").alias("record_type"), field("WARC-Refers-To", "<urn:record:([^>]*)>").cast(id_type).alias("refers_to"), "payload")


def warc_bytes(records: DataFrame) -> DataFrame:
    """A column `record` with the bytes of each restored record as a WARC file has them (a revisit carries no payload)."""
    body = F.when(F.contains("header", F.lit(f"{CRLF}WARC-Type: revisit{CRLF}")), F.lit(b"")).otherwise(F.col("payload"))
    return records.select(F.concat(F.encode("header", "UTF-8"), body, F.lit(b"\r\n\r\n")).alias("record"))
