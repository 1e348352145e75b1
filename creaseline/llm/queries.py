"""The dealt operators as queries over whole tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.llm import (decontaminate, exact_dedup, html_text, line_dedup, merkle, mixing, near_dup, packing, periodic_runs, pii, toxicity,
                            url_filter, warc_archive)
from creaseline.llm.common import table
from creaseline.workspace import scratch_dir

#: The rules of the URL query.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

PII_KEY = "key of the registered query"
MIX_SEED = "mix-1:"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    warc_archive.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc_archive.read_archive(spark, folder).select(
        F.col("record").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.matches(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.tag(docs, model, keep=["doc_id"])
    score = F.col("toxicity.score")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= 0.7).cast("int").alias("predicted"),
                         F.col("toxicity.spans").alias("spans"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link(table(spark, sf_dir, "documents"), width=2)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "leaks.n_words", "leaks.n_hit", F.size("leaks.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("leaks.items", ","), 256).alias("items_sha256"), (F.col("leaks.n_hit") > 0).alias("contaminated"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, merkle.ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return merkle.manifest(docs, altered={"text": text}).drop("path")


def with_repeats(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document as the contract of op12 has them: one in ten repeats its words from some place on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    runs = F.col("found.runs")
    longest = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("q"))))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic_runs.find(docs, ["doc_id"], prepare=with_repeats).withColumn("longest", longest)
    length, period = -F.col("longest.l"), F.col("longest.q")
    return found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), F.col("longest.s").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed"), 256).alias("collapsed_sha256"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), seed=MIX_SEED)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_warc": op2_warc,
    "op3_line_dedup": op3_line_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_html_text": op6_html_text,
    "op7_toxicity": op7_toxicity,
    "op8_near_dup": op8_near_dup,
    "op9_pii": op9_pii,
    "op10_decontaminate": op10_decontaminate,
    "op11_merkle": op11_merkle,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_mixing": op13_mixing,
}
