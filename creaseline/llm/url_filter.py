"""URL filter: explicit host and path rules, and gradient-boosted trees on lexical features for what no rule covers.

The trees are trained on labelled URLs (here those that a rule decides) and see only the URL's form: lengths, depth, digit
ratio, entropy, parameter counts, and how often labelled URLs of other hosts with the same suffix or first path segment were blocked.

Defined results: a null URL, or one without `://`, has an empty host and path, matches no rule and is judged by the trees on
its empty form. With only one class of labels (or none), the trees are left out and every other URL gets that class (allow).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import null_as_empty, staged

LETTERS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FORM = ["url_length", "host_length", "path_length", "host_labels", "depth", "digit_ratio", "entropy", "host_entropy", "hyphens", "parameters", "fragment"]
FEATURES = [*FORM, "suffix_blocked", "suffix_weight", "segment_blocked"]
MOST_WEIGHT = 16  # copies of a URL that count in the fit


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(null_as_empty(url), r"(?s)^.*?://([^/?#]*)", 1), LETTERS, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(null_as_empty(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_verdict(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does. A rule is host + path, e.g. ("block", "net/")."""
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # a longer rule comes later and wins
        site, _, rest = text.partition("/")
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, action).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.length(text).cast("double")
    share = F.transform(F.array_distinct(F.split(text, "")), lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size)
    bits = F.aggregate(share, F.lit(0.0), lambda total, p: total + F.when(p > 0, -p * F.log2(p)).otherwise(0.0))
    return F.when(size > 0, bits).otherwise(0.0)


def with_form(urls: DataFrame, url_col: str) -> DataFrame:
    url = null_as_empty(F.col(url_col))
    size = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    return urls.select(
        "*", F.length(url).cast("double").alias("url_length"), F.length("host").cast("double").alias("host_length"), F.length("path").cast("double").alias("path_length"),
        F.size(labels).cast("double").alias("host_labels"), F.size(F.filter(F.split("path", "/"), lambda s: s != "")).cast("double").alias("depth"),
        (F.length(F.regexp_replace(url, "[^0-9]", "")) / size).alias("digit_ratio"), entropy(url).alias("entropy"), entropy(F.col("host")).alias("host_entropy"),
        (F.length("host") - F.length(F.replace("host", F.lit("-"), F.lit("")))).cast("double").alias("hyphens"),
        F.size(F.filter(F.split(query, "&"), lambda s: s != "")).cast("double").alias("parameters"), F.contains(url, F.lit("#")).cast("double").alias("fragment"),
        F.substring_index("host", ".", -1).alias("suffix"), F.get(F.filter(F.split("path", "/"), lambda s: s != ""), F.lit(0)).alias("first_segment"))


def sample_of(labelled: DataFrame, rows: int) -> DataFrame:
    """At most about `rows` distinct labelled URLs with how often each is there, chosen by the hash of the URL, the same in every run. Copies are added
    up before, so that a frequent URL is one row, with a bounded weight."""
    distinct = staged(labelled.groupBy("url", "label", "suffix", "host", "first_segment", *FORM).agg(F.count(F.lit(1)).alias("copies")), "url-distinct")
    share = min(1.0, rows / max(distinct.count(), 1))
    chosen = distinct.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    return chosen.withColumn("weight", F.least(F.col("copies"), F.lit(MOST_WEIGHT)).cast("double"))


class Shares:
    """How often labelled URLs with a suffix, and with a first path segment, are blocked, smoothed towards one half.

    A URL that is learnt from does not see its own host's labels: they are taken out of its shares, which else would give its label away.
    """

    KEYS = {"suffix": "suffix_blocked", "first_segment": "segment_blocked"}

    def __init__(self, labelled: DataFrame):
        by_host = staged(labelled.groupBy(*self.KEYS, "host").agg(F.sum("label").alias("b"), F.count(F.lit(1)).alias("n")), "url-shares")
        self.whole, self.own = {}, {}
        for key in self.KEYS:
            self.whole[key] = staged(by_host.groupBy(key).agg(F.sum("b").alias("b"), F.sum("n").alias("n")), f"url-{key}")
            self.own[key] = by_host.groupBy(key, "host").agg(F.sum("b").alias("own_b"), F.sum("n").alias("own_n"))

    def describe(self, urls: DataFrame, learning: bool = False) -> DataFrame:
        for key, share in self.KEYS.items():
            urls = urls.join(self.whole[key], key, "left")
            if learning:
                urls = urls.join(self.own[key], [key, "host"], "left")
            b, n = (F.coalesce(c, F.lit(0)) - (F.coalesce(f"own_{c}", F.lit(0)) if learning else 0) for c in ("b", "n"))
            urls = urls.withColumn(share, (b + 1.0) / (n + 2.0))
            if key == "suffix":
                urls = urls.withColumn("suffix_weight", F.log1p(n.cast("double")))
            urls = urls.drop("b", "n", "own_b", "own_n")
        return urls


def described_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str, url_col: str) -> DataFrame:
    url = F.col(url_col)
    parts = pages.select(F.col(id_col), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_verdict(F.col("host"), F.col("path"), rules)
    formed = with_form(parts.select("*", rule.alias("rule"), verdict.alias("ruled")), "url")
    return staged(formed.withColumn("label", (F.col("ruled") == "block").cast("double")), "url-features")


def fit(labelled: DataFrame, train_rows: int, trees: int, depth: int) -> tuple[PipelineModel | float, Shares]:
    """(trees, or the only label there is, and 0 without any; the shares they need)."""
    shares = Shares(labelled)
    train = staged(shares.describe(sample_of(labelled, train_rows), learning=True).select("label", "weight", *FEATURES), "url-training")
    classes = [r["label"] for r in train.select("label").distinct().collect()]  # at most two rows
    if len(classes) < 2:
        return (classes or [0.0])[0], shares
    stages = [VectorAssembler(inputCols=FEATURES, outputCol="features"),
              GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=trees, maxDepth=depth, seed=7, stepSize=0.3)]
    return Pipeline(stages=stages).fit(train), shares


def scored(model: PipelineModel, shares: Shares, urls: DataFrame) -> DataFrame:
    return model.transform(shares.describe(urls)).withColumn("block_score", vector_to_array("probability")[1])


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
          train_rows: int = 20_000, trees: int = 8, depth: int = 4, threshold: float = 0.5) -> DataFrame:
    """Per row: id, host, path, rule, verdict, block_score (null where a rule decides).

    `train_rows` bounds the distinct labelled URLs the trees are fitted on; suffix and segment statistics count all labelled URLs.
    """
    formed = described_urls(pages, rules, id_col, url_col)
    model, shares = fit(formed.where("ruled IS NOT NULL"), train_rows, trees, depth)
    named = [id_col, "host", "path", "rule"]
    ruled = formed.where("ruled IS NOT NULL").select(*named, F.col("ruled").alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    others = formed.where("ruled IS NULL")
    if isinstance(model, float):
        free = others.select(*named, F.lit("block" if model else "allow").alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    else:
        verdict = F.when(F.col("block_score") >= threshold, "block").otherwise("allow").alias("verdict")
        free = scored(model, shares, others).select(*named, verdict, "block_score")
    return ruled.unionByName(free)


def held_out_quality(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", parts: int = 5,
                     train_rows: int = 20_000, trees: int = 8, depth: int = 4, threshold: float = 0.5) -> dict[str, float]:
    """How well the trees tell what the rules say of hosts they have not seen: one in `parts` of the hosts with a rule is held out, shares included."""
    labelled = described_urls(pages, rules, id_col, url_col).where("ruled IS NOT NULL")
    held = F.pmod(F.xxhash64("host"), F.lit(parts)) == 0
    model, shares = fit(labelled.where(~held), train_rows, trees, depth)
    if isinstance(model, float):
        raise ValueError("labels of both classes are needed")
    rows = staged(scored(model, shares, labelled.where(held)).select("label", "block_score"), "url-held-out")
    found = rows.agg(F.count("*").alias("urls"), F.avg(((F.col("block_score") >= threshold).cast("double") == F.col("label")).cast("double")).alias("accuracy"),
                     F.avg("label").alias("blocked")).first().asDict()
    return {**found, "auc": BinaryClassificationEvaluator(rawPredictionCol="block_score", labelCol="label").evaluate(rows)}
