"""Merkle manifest of a dataset: a hash tree per group of documents, a tree over the groups, and a proof for each document.

Each tree is built by slot pivots. Nodes are numbered in their group; the node with number i is child i % fanout of parent
i / fanout. Conditional aggregates spread the children of a parent into `fanout` columns; the hash of the columns, joined, is the
parent's node, and the columns other than a child's own are its siblings. Every level is one hash aggregate over (group, parent), so
no task holds more than a few children of a parent, however large the group is. Paths go back down by joining each level of pivots with
the paths of its parents.

Defined results: a null field counts as `-` in a leaf, and a null group is a group of its own, before all others. Documents of a group are in
order of their id, nulls first; rows that repeat an id are in order of their leaf, so rows that are wholly equal are leaves side
by side. A group with one leaf has that leaf as its root; an empty table gives no rows. Texts of any length are hashed whole.
Columns that are no field of a leaf are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import staged
from creaseline.llm.ordering import with_running_total

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A field as it is hashed: its size in bytes and its value, so that no two rows of values run together alike."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _key(group: Column) -> Column:
    """A group as a string without nulls that sorts as the groups do: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _slots(fanout: int) -> list[str]:
    return [f"c{k}" for k in range(fanout)]


def _pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """One row per parent of the nodes (key, at, n, node): key, at, n of the parent's level, and its children in columns."""
    slot = F.col("at") % fanout
    children = [F.max(F.when(slot == k, F.col("node"))).alias(name) for k, name in enumerate(_slots(fanout))]
    parent = F.floor(F.col("at") / fanout).alias("at")
    return nodes.where("n > 1").groupBy("key", parent, F.ceil(F.col("n") / fanout).alias("n")).agg(*children)


def _parents(pivot: DataFrame, fanout: int) -> DataFrame:
    digests = [F.col(f"{name}.digest") for name in _slots(fanout)]
    return pivot.select("key", "at", "n", F.struct(F.sha2(F.concat_ws("", *digests), 256).alias("digest")).alias("node"))


def _children(pivot: DataFrame, fanout: int, carried: list[str]) -> DataFrame:
    """One row per child: key, at, node, the siblings on either side of it, and the columns `carried` of its parent."""
    names = _slots(fanout)

    def side(slots: list[str]) -> Column:
        return F.concat_ws("", *[F.col(f"{c}.digest") for c in slots]) if slots else F.lit("")

    rows = [F.when(F.col(name).isNotNull(), F.struct(
        (F.col("at") * fanout + k).alias("at"), F.col(name).alias("node"), side(names[:k]).alias("left"), side(names[k + 1:]).alias("right")))
        for k, name in enumerate(names)]
    return pivot.select("key", *carried, F.explode(F.array_compact(F.array(*rows))).alias("child")).select("key", *carried, "child.*")


def tree(leaves: DataFrame, label: str, fanout: int = FANOUT) -> tuple[DataFrame, list[DataFrame]]:
    """(root of each group: key, node; pivots of each level from the leaves up) of numbered leaves (key, at, n, node)."""
    largest = leaves.agg(F.max("n")).first()[0] or 0
    roots, pivots, nodes = [leaves.where("n = 1")], [], leaves
    while largest > 1:
        pivots.append(staged(_pivot(nodes, fanout), f"{label}-pivot-{len(pivots)}"))
        nodes = _parents(pivots[-1], fanout)
        roots.append(nodes.where("n = 1"))
        largest = -(-largest // fanout)
    return reduce(DataFrame.unionByName, [r.select("key", F.struct("node.digest").alias("node")) for r in roots]), pivots


def paths(leaves: DataFrame, pivots: list[DataFrame], above: DataFrame, label: str, fanout: int = FANOUT) -> DataFrame:
    """The leaves as (key, at, node, path and the columns of `above`); a path lists the siblings from the leaf up, as (left, right).

    `above` has the root of each group by key: the path from the root on (empty, if the tree ends there) and columns that every leaf of
    the group gets.
    """
    carried = [c for c in above.columns if c not in ("key", "path")]
    found = None  # paths of the parents of the level at hand, of groups that have not ended above it
    for level in range(len(pivots) - 1, -1, -1):
        pivot = pivots[level]
        ended = pivot.where("n = 1").join(above, "key")
        known = ended if found is None else ended.unionByName(pivot.where("n > 1").join(found, ["key", "at"]))
        found = _children(known, fanout, ["path", *carried]).select(
            "key", "at", "node", F.concat(F.array(F.struct("left", "right")), F.col("path")).alias("path"), *carried)
        if level:
            found = staged(found.drop("node"), f"{label}-paths-{level}")
    single = leaves.where("n = 1").select("key", "at", "node").join(above, "key")
    return single if found is None else found.unionByName(single)


def fold(digest: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, digest, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", id_col: str = "doc_id", altered: dict[str, Column] | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """Per row of `docs`: id, leaf, subroot (root of its group), root, proof_sha256, folded_root, verified, path.

    The hash of a leaf joins `fields`; those in `altered` are replaced when the root is recomputed, as for a copy that was received and is to be
    checked against the manifest (none: the rows themselves).
    """
    columns = [F.col(c) for c in fields]
    received = [(altered or {}).get(c, F.col(c)) for c in fields]
    leaves = docs.select(
        _key(F.col(group)).alias("key"), F.monotonically_increasing_id().alias("row_no"), F.lit(1).cast("long").alias("one"),
        F.col(id_col).alias("id"), leaf(*columns).alias("digest"), leaf(*received).alias("received"))
    leaves = staged(leaves, "merkle-leaves")  # the texts are read once
    ordered = with_running_total(leaves, "key", [F.col("id").asc_nulls_first(), F.col("digest"), F.col("row_no")], "one", "merkle-order", "at", "n")
    leaves = ordered.select("key", "at", "n", F.struct("digest", "received", "id").alias("node"))

    roots, pivots = tree(leaves, "merkle", fanout)
    roots = staged(roots.select("key", F.lit("").alias("all"), F.lit(1).cast("long").alias("one"), F.col("node.digest").alias("subroot")), "merkle-roots")
    ordered = with_running_total(roots, "all", [F.col("key")], "one", "merkle-root-order", "at", "n")
    tops = ordered.select(F.col("all").alias("key"), "at", "n", F.struct(F.col("subroot").alias("digest"), F.col("key").alias("group")).alias("node"))
    top, top_pivots = tree(tops, "merkle-top", fanout)
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    above = top.select("key", no_path.alias("path"), F.col("node.digest").alias("root"))  # one row: the root of the manifest
    above = paths(tops, top_pivots, above, "merkle-top", fanout).select(
        F.col("node.group").alias("key"), "path", "root", F.col("node.digest").alias("subroot"))
    above = staged(above, "merkle-above")

    out = paths(leaves, pivots, above, "merkle", fanout)
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["left"], step["right"])), "")
    folded = fold(F.col("node.received"), F.col("path"))
    return out.select(
        F.col("node.id").alias(id_col), F.col("node.digest").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"), "path").withColumn("verified", F.col("folded_root") == F.col("root"))
