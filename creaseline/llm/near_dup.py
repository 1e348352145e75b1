"""Near-duplicates by an inverted join on signature coordinates.

A document is its set of word shingles; equal sets form a class. Each class is posted under its coordinate-value pairs. Two
signatures of `coordinates` values that agree in `agree` of them share one of any `coordinates - agree + 1`, so a class
is posted only under that many, its rarest (the prefix); the long lists it also belongs to are skipped, and the agreement
is counted on the signatures.

No group is expanded into its pairs. A list hands on only enough edges to connect the classes that agree at or above the match threshold;
the connected families are then confirmed on the full sets, where they are: first each block of a family with itself and with the family's
smallest members, which connects dense families, then, for families that are not one component yet, all blocks with each other. Again only
edges that connect leave the task. A long list is first compared with its first class; what does not agree with that, and large families, are cut into
blocks, so they are shared by many tasks. Every pair of a family is decided or already connected; nothing is capped.

Defined results: a null or wordless text has no shingles and is linked with nothing. Fewer words than a shingle has are one shingle. A null id is larger than any
other. Rows that share an id and a set have the same result. Extra columns are ignored, and kept by `keep_one`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creaseline.llm.common import fresh_name, partitions, ship_package, staged

COORDINATES, AGREE = 32, 16  # a pair at 0.8 agrees in 25.6 on average; below 16 once in about 20,000
LIST_BLOCK, BLOCK = 1024, 256
EDGE = "a bigint, b bigint"
FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    return (x ^ (x >> np.uint64(27))) * M2


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    folded = [(t or "").encode("utf-8", "surrogatepass").translate(FOLD) for t in texts]
    data = np.frombuffer(b"\n".join(folded) + b"\n", np.uint8)
    offsets = np.cumsum([0, *[len(t) + 1 for t in folded]])
    word = ~SPACE[data]
    edge = np.diff(word.view(np.int8), prepend=np.int8(0))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return [np.zeros(0, np.uint64) for _ in texts]
    size = stop - start
    first = np.cumsum(size) - size
    inside = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
    powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(size.max()), M2 | np.uint64(1)))))
    words = mixed(np.add.reduceat((data[word].astype(np.uint64) + np.uint64(1)) * powers[inside], first) + size.astype(np.uint64))
    doc = np.searchsorted(offsets, start, "right") - 1
    n = len(words) - width + 1
    joined = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        joined = mixed(joined + words[k:k + n] + np.uint64(k)) if n > 0 else joined
    whole = doc[:max(n, 0)] == doc[width - 1:] if n > 0 else np.zeros(0, bool)
    joined, owner = joined[whole], doc[:max(n, 0)][whole]
    begin = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = [np.unique(joined[a:b]) for a, b in zip(begin[:-1], begin[1:])]
    counts = np.bincount(doc, minlength=len(texts))
    for at in np.flatnonzero((counts > 0) & (counts < width)).tolist():
        text = b" ".join(folded[at].translate(bytes(32 if SPACE[c] else c for c in range(256))).split())
        out[at] = np.frombuffer(hashlib.blake2b(text, digest_size=8, salt=b"short").digest(), np.uint64)
    return out


def signature(shingles: np.ndarray, seed: int = 11) -> np.ndarray:
    draw = np.random.default_rng(seed).integers(1, 2**63, (2, COORDINATES), dtype=np.uint64)
    out = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for low in range(0, len(shingles), 4096):
        part = (shingles[low:low + 4096, None] * (draw[0] | np.uint64(1)) + draw[1]) >> np.uint64(32)
        out = np.minimum(out, part.min(0).astype(np.uint32))
    return out


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def described(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, n_shingles, set_key (null for an empty set), signature."""
    ship_package(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], T.StructField("n_shingles", T.LongType()), T.StructField("set_key", T.BinaryType()),
                           T.StructField("sig", T.ArrayType(T.IntegerType()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                sets = shingle_sets(part.column(text_col).to_pylist(), width)
                yield pa.RecordBatch.from_arrays([
                    part.column(id_col), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s).view(np.int32) if len(s) else None for s in sets], pa.list_(pa.int32()))], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(read, schema)


def streamed(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key of a partition that is sorted by the keys; a group may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            now = tuple(c[a] for c in columns)
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def by_group(rows: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """fn on the rows of each key, in one pass over partitions dealt and sorted by the keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in streamed(batches, keys):
            yield from fn(group)

    return rows.repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.stack(column.to_numpy()).reshape(len(column), width)


def stars(cid: np.ndarray, root: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The components of a group as edges from their smallest member. cid is sorted; root is a place in it."""
    moved = np.flatnonzero(root != np.arange(len(cid)))
    if len(moved):
        yield pa.RecordBatch.from_arrays([pa.array(cid[root[moved]]), pa.array(cid[moved])], names=["a", "b"])


def agreeing(group: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Edges that connect the classes of a list (or of two of its blocks) whose signatures agree often enough."""
    if group.num_rows < 2:
        return
    cid, at = np.unique(group.column("cid").to_numpy(), return_index=True)
    sig, n, side = matrix(group.column("sig"), COORDINATES)[at], group.column("n_shingles").to_numpy()[at], group.column("side").to_numpy()[at]
    root = np.arange(len(cid))
    for i in range(len(cid) - 1):
        some = np.flatnonzero((root[i + 1:] != root[i]) & ((side[i + 1:] != side[i]) | (side[i] == 2))) + i + 1
        some = some[100 * np.minimum(n[some], n[i]) >= percent * np.maximum(n[some], n[i])]
        some = some[(sig[some] == sig[i]).sum(1) >= AGREE]
        if len(some):
            joined = np.unique(np.append(root[some], root[i]))
            root[np.isin(root, joined)] = joined[0]
    yield from stars(cid, root)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets share: products of 0-1 rows, a range of values at a time."""
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = counts[inverse] > 1  # a value of one set alone adds to no overlap
    number = np.cumsum(counts > 1) - 1
    row, column = row[shared], number[inverse[shared]]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for low in range(0, int((counts > 1).sum()), 4096):
        some = (column >= low) & (column < low + 4096)
        ones = np.zeros((len(sets), min(4096, int(column.max()) + 1 - low)), np.float32)
        ones[row[some], column[some] - low] = 1
        out += (ones @ ones.T).astype(np.int64)
    out[np.arange(len(sets)), np.arange(len(sets))] = [len(s) for s in sets]
    return out


def confirmed(group: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Edges that connect what is linked on the full sets, within a block of a family or two of its blocks."""
    cid, at = np.unique(group.column("cid").to_numpy(), return_index=True)
    if len(cid) < 2:
        return
    raw = group.column("shingles").to_pylist()
    sets = [np.frombuffer(raw[k], np.uint64) for k in at]
    n = np.array([len(s) for s in sets])
    both = overlaps(sets)
    linked = 100 * both >= percent * (n[:, None] + n[None, :] - both)
    root = np.arange(len(cid))
    while True:
        least = np.where(linked, root[None, :], len(cid)).min(1)
        if (least == root).all():
            break
        root = least
    yield from stars(cid, root)


def in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """Rows of a key dealt to blocks; block i meets block j once, as side 0 and 1 of (low, high), or itself (side 2)."""
    held = rows.withColumn("block", F.pmod(F.xxhash64("cid"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
    return held.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other"), "side": side}).drop("block", "other")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes of `edges` (a, b): root is the smallest node reachable.

    Each turn links every larger neighbour of a node to the smallest of its neighbourhood, then every smaller one,
    until all edges point at roots. Turns grow with the logarithm of the longest path.
    """
    def turn(pairs: DataFrame, larger: bool) -> DataFrame:
        around = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if larger:
            around = around.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            around = around.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = staged(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "component-least")
        moved = around.where("v > u") if larger else around
        out = moved.join(least.hint("merge"), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not larger:
            out = out.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return staged(out.where("a <> b").distinct(), "component-edges")

    def settled(pairs: DataFrame) -> bool:
        """Whether all edges are stars: a node that points at a root points at one only, and is no root itself."""
        ends = pairs.select(F.col("a").alias("x"), F.lit(1).alias("points"), F.lit(0).alias("root")).unionByName(
            pairs.select(F.col("b").alias("x"), F.lit(0).alias("points"), F.lit(1).alias("root")))
        seen = ends.groupBy("x").agg(F.sum("points").alias("points"), F.max("root").alias("root"))
        return seen.where((F.col("points") > 1) | ((F.col("points") > 0) & (F.col("root") > 0))).isEmpty()

    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "component-edges")
    while not settled(now):
        now = turn(turn(now, larger=True), larger=False)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(cid, shingles) of the wanted classes, from the text of one document each."""
    wanted = staged(classes.join(wanted.select("cid").distinct(), "cid").select("cid", "rep", "set_key"), "wanted-sets")
    ids = wanted.select(F.col("rep").alias("rep_id")).distinct()
    texts = docs.select(F.col(id_col), F.col(text_col)).join(ids, docs[id_col].eqNullSafe(F.col("rep_id")), "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                sets = [s for s in shingle_sets(batch.slice(low, 500).column(text_col).to_pylist(), width) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["set_key", "shingles"])

    found = texts.mapInArrow(read, "set_key binary, shingles binary")
    # Rows that repeat an id may bring a set twice.
    return staged(found.join(wanted, "set_key").select("cid", "shingles").dropDuplicates(["cid"]), "sets")


def long_lists(prefix: DataFrame, sizes: DataFrame, classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Edges and rows for `agreeing` of the lists in `sizes` (list, head), which are too long for one task.

    The head, a list's first class, is compared with every class where that stands; those that agree with it are connected at once and need no comparison with each
    other. The others are dealt to blocks, which meet each other and blocks of those that agree. A list that agrees makes no rows.
    """
    heads = sizes.select("list", F.col("head").alias("cid")).join(classes, "cid").select("list", F.col("cid").alias("head"), F.col("sig").alias("head_sig"), F.col("n_shingles").alias("head_n"))
    same = F.size(F.filter(F.zip_with("sig", "head_sig", lambda x, y: x == y), lambda x: x))
    n, m = F.col("n_shingles"), F.col("head_n")
    near = (same >= AGREE) & (100 * F.least(n, m) >= percent * F.greatest(n, m))
    rows = prefix.join(heads.hint("merge"), "list").join(classes, "cid").select("list", "head", "cid", "sig", "n_shingles", near.alias("near"))
    rows = staged(rows, "long-lists")
    edges = rows.where("near AND cid <> head").select(F.col("head").alias("a"), F.col("cid").alias("b"))

    counts = rows.groupBy("list").agg(F.count_if(~F.col("near")).alias("others"), F.count_if("near").alias("nears")).where("others > 0")
    blocks = staged(counts.select("list", *((F.floor(F.col(c) / LIST_BLOCK) + 1).alias(c) for c in ("others", "nears"))), "long-list-blocks")
    open_ = rows.drop("head").join(blocks.hint("merge"), "list")
    among = in_blocks(open_.where("NOT near"), F.col("others"))
    # Block i of those that agree meets block j of the others as (-1 - i, j).
    own = F.pmod(F.xxhash64("cid"), F.when(F.col("near"), F.col("nears")).otherwise(F.col("others")))
    met = open_.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(F.col("near"), F.col("others")).otherwise(F.col("nears")) - 1)))
    across = met.withColumns({"low": -1 - F.when(F.col("near"), F.col("own")).otherwise(F.col("met")), "high": F.when(F.col("near"), F.col("met")).otherwise(F.col("own")),
                              "side": F.when(F.col("near"), 0).otherwise(1)})
    return edges, among.select(*LISTED).unionByName(across.select(*LISTED))


LISTED = ["list", "low", "high", "cid", "side", "sig", "n_shingles"]


def family_edges(prefix: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect the classes of each list of `prefix` (cid, list) that agree; classes: cid, sig, n_shingles."""
    sizes = staged(prefix.groupBy("list").agg(F.count(F.lit(1)).alias("size"), F.min("cid").alias("head")).where("size > 1"), "list-sizes")
    short = prefix.join(sizes.where(F.col("size") < LIST_BLOCK).select("list").hint("merge"), "list").join(classes, "cid")
    rows = short.withColumns({"low": F.lit(0).cast("bigint"), "high": F.lit(0).cast("bigint"), "side": F.lit(2)}).select(*LISTED)
    long = sizes.where(F.col("size") >= LIST_BLOCK)
    edges = None
    if not long.isEmpty():
        edges, more = long_lists(prefix, long, classes, percent)
        rows = rows.unionByName(more)
    found = by_group(rows, ["list", "low", "high"], lambda group: agreeing(group, percent), EDGE)
    return found if edges is None else found.unionByName(edges)


def link(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable by links), kept (whether that is the row's own)."""
    facts = staged(described(docs, width, id_col, text_col), "shingle-facts")
    grouped = facts.where("n_shingles > 0").groupBy("set_key").agg(F.min(id_col).alias("rep"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("sig").alias("sig"))
    classes = staged(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")

    # Sets so small that one shingle more or less is below the threshold have no links.
    able = classes.where(F.col("n_shingles") * (100 - percent) >= percent)
    posts = able.select("cid", F.posexplode("sig").alias("c", "v")).select("cid", (F.shiftleft(F.col("c").cast("bigint"), 32) + F.col("v").cast("bigint").bitwiseAND(0xFFFFFFFF)).alias("list"))
    shared = staged(posts.groupBy("list").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "lists")
    placed = posts.join(shared.hint("merge"), "list").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("size", "list"))).alias("lists"))
    # Coordinates that no other class has are the rarest, and need no posting.
    rare = F.lit(COORDINATES - AGREE + 1) - (F.lit(COORDINATES) - F.size("lists"))
    prefix = staged(placed.where(rare > 0).select("cid", F.explode(F.slice("lists", 1, F.greatest(rare, F.lit(1)))).alias("at")).select("cid", F.col("at.list").alias("list")), "prefixes")

    edges = family_edges(prefix, classes.select("cid", "sig", "n_shingles"), percent)
    families = components(staged(edges.distinct(), "family-edges"))
    families = staged(families.unionByName(families.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "cid"), "families")

    sets = sets_of(docs, classes, families, width, id_col, text_col)
    counted = staged(families.groupBy("root").agg((F.floor(F.count(F.lit(1)) / BLOCK) + 1).alias("blocks")), "family-sizes")
    members = staged(families.join(counted.hint("merge"), "root"), "family-members")
    # The smallest member stands in each block; it is the root itself.
    blocks = members.select("root", F.pmod(F.xxhash64("cid"), "blocks").alias("block"), "cid").unionByName(
        counted.select("root", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), F.col("root").alias("cid")))
    links = staged(by_group(blocks.distinct().join(sets.hint("merge"), "cid"), ["root", "block"], lambda group: confirmed(group, percent), EDGE), "links")
    roots = components(links)

    # Families of several blocks that are not one component yet: all their blocks meet.
    known = members.where("blocks > 1").join(roots.select(F.col("node").alias("cid"), F.col("root").alias("comp")), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    known = staged(known, "family-components")
    open_ = known.groupBy("root").agg((F.min("comp") != F.max("comp")).alias("open")).where("open").select("root")
    open_ = staged(known.select("root", "cid", "blocks").join(staged(open_, "open-families"), "root"), "open-members")
    if not open_.isEmpty():
        met = in_blocks(open_, F.col("blocks")).where("low < high").select("root", "low", "high", "cid")
        more = by_group(met.join(sets.hint("merge"), "cid"), ["root", "low", "high"], lambda group: confirmed(group, percent), EDGE)
        roots = components(links.unionByName(staged(more, "more-links")))

    placed = classes.select("cid", "set_key", "rep").join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("set_key", "rep", F.coalesce("root", "cid").alias("root"))
    placed = staged(placed, "class-roots")
    least = staged(placed.groupBy("root").agg(F.min("rep").alias("component_id")), "root-ids")
    named = staged(placed.join(least.hint("merge"), "root").select("set_key", "component_id"), "class-components")
    out = facts.select(id_col, "n_shingles", "set_key").join(named.hint("merge"), "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(id_col))
    return out.select(F.col(id_col), "n_shingles", component.alias("component_id"), F.col(id_col).eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, without the ids that are not the smallest of their component.

    Anti-joined with the ids to drop, which are far fewer than those to keep: where Spark finds them small, no text is shuffled.
    An id goes if none of its rows stays. A null id names no row, so rows without an id always stay.
    """
    gone = link(docs, width, percent, id_col, text_col).groupBy(F.col(id_col).alias("gone_id")).agg(F.max("kept").alias("kept"))
    gone = staged(gone.where(F.col("gone_id").isNotNull() & ~F.col("kept")).select("gone_id"), "near-gone")
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
