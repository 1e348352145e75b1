"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled by a keyed digest of their id and served one after the other, the whole list again when
it is used up, at most `repeats` times. A document's virtual finish time is the number of words its source has served with it, divided by the
source's target weight, which is its share of the budget in words. All sources are served at the rates of their weights, so at time 1 every source
has served its target and the budget is spent. What is served is range-sorted by virtual finish time over all sources; running totals give
each document its place in the mix, and the list is cut at the budget. The document that a source is serving at that time is cut there, so
a source misses its target by less than a word.

Targets: the budget is dealt by weight; a source cannot give more than `repeats` times its size, and what it cannot give is dealt again among
the others.

Defined results: a null text has no words; a document without words takes no part and gets 0. Null is a source of its own, after all others. Rows that
repeat an id are shuffled side by side and count each by itself. A table without words has targets of 0; an empty table gives no rows. Columns other than id,
source and text are not read. Results do not depend on partitions or the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import SPACE_CLASS, null_as_empty, staged
from creaseline.llm.ordering import with_running_total

WEIGHTS = (5, 2, 1)
REPEATS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(null_as_empty(text), F.lit(SPACE_CLASS.replace("[", "[^") + "+")).cast("long")


def _key(source: Column) -> Column:
    """A source as a string without nulls that sorts as sources do: by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def targets(sizes: DataFrame, budget: int, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """`sizes` (key, source_size) with weight and target.

    Each turn deals what is left of the budget by weight and closes the sources that reach what they can give, until none is above it. Only three
    totals of a turn come to the driver; the sources stay a table.
    """
    rows = sizes.withColumns({"all": F.lit(""), "one": F.lit(1).cast("long")})
    rows = with_running_total(rows, "all", [F.col("key")], "one", "mix-sources", "rank").select("key", "source_size", "rank")
    weight = F.element_at(F.array(*[F.lit(w).cast("double") for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = staged(rows.withColumns({"weight": weight, "most": F.col("source_size") * repeats}), "mix-weights")
    each, closed = 0.0, -1
    while True:
        full = F.col("most") <= F.col("weight") * F.lit(each)
        now = rows.agg(F.count_if(full).alias("closed"), F.sum(F.when(full, F.col("most"))).alias("given"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if now["closed"] == closed or not now["open"]:
            break
        closed, each = now["closed"], (budget - (now["given"] or 0)) / now["open"]
    share = F.col("weight") * F.lit(each)
    return rows.withColumn("target", F.when(F.col("most") <= share, F.col("most").cast("double")).otherwise(share)).drop("rank", "most")


def measured(docs: DataFrame, seed: str, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """One row per document: row number, id, key of its source, place in the shuffle, words. The texts are read once."""
    place = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    return staged(docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(id_col).alias("id"), _key(F.col(source_col)).alias("key"), place.alias("shuffled"),
        word_count(F.col(text_col)).alias("size")), "mix-documents")


def schedule(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: str = "", id_col: str = "doc_id",
             source_col: str = "source", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(the mix, all documents).

    The mix has one row per served copy in the order of its virtual finish time: row_no, turn (0 for the first copy), finish, words (fewer than the
    document has where the budget cuts it) and first_word, its place. The documents have row_no, id, size, source_size and target.
    """
    rows = measured(docs, seed, id_col, source_col, text_col)
    sizes = staged(rows.groupBy("key").agg(F.sum("size").alias("source_size")), "mix-sizes")
    budget = sizes.agg(F.sum("source_size")).first()[0] or 0
    aims = staged(targets(sizes, budget, weights, repeats), "mix-targets")

    order = [F.col("shuffled"), F.col("id").asc_nulls_last(), F.col("size"), F.col("row_no")]
    lined = with_running_total(rows, "key", order, "size", "mix-lines", "before", "source_size")
    lined = staged(lined.join(aims.select("key", "target"), "key"), "mix-lined")

    turns = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    served = lined.where("size > 0").withColumn("turn", turns).withColumn("start", F.col("turn") * F.col("source_size") + F.col("before"))
    words = F.least(F.col("size"), F.floor("target") - F.col("start"))
    finish = (F.col("start") + F.col("size")) / F.col("target")
    served = served.withColumns({"words": words, "finish": finish, "all": F.lit("")}).where("words > 0")
    served = staged(served.select("row_no", "id", "key", "turn", "finish", "words", "all"), "mix-served")
    order = [F.col("finish"), F.col("key"), F.col("id").asc_nulls_last(), F.col("row_no"), F.col("turn")]
    mix = with_running_total(served, "all", order, "words", "mix-order", "first_word", "total").where(F.col("first_word") < budget)
    mix = mix.withColumn("words", F.least(F.col("words"), budget - F.col("first_word")))
    return mix.select("row_no", "turn", "finish", "words", "first_word"), lined.select("row_no", "id", "size", "source_size", "target")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: str = "", id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, size, source_size, target, taken (words that the mix takes, over all copies), first_word (its first place)."""
    served, rows = schedule(docs, weights, repeats, seed, id_col, source_col, text_col)
    taken = served.groupBy("row_no").agg(F.sum("words").alias("taken"), F.min("first_word").alias("first_word"))
    return rows.join(taken, "row_no", "left").select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_word")
