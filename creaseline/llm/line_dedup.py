"""Line de-duplication by an exact set-similarity join.

A line is the set of its words; equal sets form a class, and a class is compared with others at a Jaccard similarity of `percent` per cent or
more. Words are ordered by rarity. A pair must share a word among the first n - ceil(t n) + 1 of either line (the prefix), so a line
is posted under these only. In each list, pairs pass the length filter, the positional filter (words left after the shared one) and a filter on
128-bit maps of the words, whose difference never exceeds that of the sets. A list hands on no pairs, only enough of
them to connect what passed; a large family is parted by maps of 2,048 bits, then each family is compared on its full word sets, block against block, and counted
where it is compared. Lists and families of any size are cut into blocks shared by many tasks.

Rarity comes from counts of the words of all word sets in a table of a fixed number of hashed counters; words that share a counter are only ordered
less well, so the join stays exact. A word whose counter is 1 is in one set, and needs no posting. The pass that counts also writes the lines.

A line goes if an earlier line (by id, then by number) matches it; the first of each family stays. Defined results: a null text is one empty line; a line
without words is never matched and stays. A null id is larger than any other. Repeated rows are repeated lines; of lines with the same id and number, all count as the
first. Extra columns are ignored by `matches` and kept by `remove_later`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creaseline.llm.common import fresh_name, partitions, ship_package, staged
from creaseline.llm.near_dup import FOLD, M2, by_group, components, in_blocks, mixed, overlaps, streamed

COUNTER_BITS, SIEVE_BITS = 23, 26
KEY = ["cid", "rest"]
POSTING = ["list", "posts"]  # a number that stands for many lists, and postings of these: PARTS numbers each
PARTS = 5
CHUNK = 1 << 14  # counters in one row of the table
LIST_BLOCK, FAMILY_BLOCK, SKETCH_BLOCK = 2048, 256, 2048
SKETCH_BITS, WIDE = 2048, 800  # from WIDE words on, a quarter of the map tells lines apart badly
ROWS = 200_000  # postings that are compared at once, about; a list is never parted
PLACE_BITS, LIST_BITS, POSTED = 28, 40, 300_000
SLICE = 1 << 19  # bytes of text that are parsed at once: their arrays stay in the processor's cache
BASE = M2 | np.uint64(1)
BLANK = bytes(c == 32 or 9 <= c <= 13 for c in range(256))
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
LONG_WORD = 1024  # bytes; longer words are hashed one by one
PACKED = "zstd"


def line_words(texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document of each line, number of the line in it, line of each word, hash of each word)."""
    texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), "\n")[0].as_buffer()
    held = (joined.to_pybytes() + b"\n" + bytes(8)).translate(FOLD)
    length = len(held) - 8
    breaks = np.flatnonzero(np.frombuffer(held, np.uint8, length) == 10)
    begin = np.append(0, breaks[:-1] + 1)
    offsets = np.append(0, np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1))
    doc = np.searchsorted(offsets, begin, "right") - 1
    number = np.arange(len(begin)) - np.searchsorted(begin, offsets[doc])
    blank = np.frombuffer(held.translate(BLANK), np.bool_, length)
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.append(0, edge)
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return doc, number, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    size = stop - start
    eight = np.ndarray(length, "<u8", held, strides=(1,))  # the eight bytes from each place on
    hashes = mixed(mixed(eight[start] & FIRST_BYTES[np.minimum(size, 8)]) + size.astype(np.uint64))
    more = np.flatnonzero((size > 8) & (size <= LONG_WORD))
    at, left = start[more] + 8, size[more] - 8
    while len(more):
        hashes[more] = mixed(hashes[more] * BASE + (eight[at] & FIRST_BYTES[np.minimum(left, 8)]))
        on = left > 8
        more, at, left = more[on], at[on] + 8, left[on] - 8
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        hashes[k] = np.frombuffer(hashlib.blake2b(held[start[k]:stop[k]], digest_size=8).digest(), "<u8")[0]
    return doc, number, np.repeat(np.arange(len(begin)), np.diff(np.searchsorted(start, breaks), prepend=0)), hashes


def slices(batch: pa.RecordBatch, text_col: str) -> Iterator[pa.RecordBatch]:
    """Rows of about SLICE bytes of text; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    number = (np.cumsum(size) - 1) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(low, high - low)


def rarity(parsed: DataFrame) -> np.ndarray:
    """The counters of all tasks added up."""
    def add(group: pa.Table) -> Iterator[pa.RecordBatch]:
        total = sum(np.frombuffer(pa.decompress(b, 4 * CHUNK, PACKED), np.uint32).astype(np.uint64) for b in group.column("counters").to_pylist())
        total = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([group.column("chunk").combine_chunks().slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=["chunk", "counters"])

    out = np.zeros((1 << COUNTER_BITS) // CHUNK * CHUNK, np.uint32).reshape(-1, CHUNK)
    chunks = parsed.where("counters IS NOT NULL").select(F.col("line").alias("chunk"), "counters")
    for row in by_group(chunks, ["chunk"], add, "chunk bigint, counters binary").collect():
        out[row["chunk"]] = np.frombuffer(row["counters"], np.uint32)
    return out.ravel()


def maps_of(line: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """Two 64-bit maps for each line: a bit for each of its words. line is sorted."""
    bit = words >> np.uint64(57)
    one, upper = np.uint64(1) << (bit & np.uint64(63)), bit > 63
    out = np.zeros((n, 2), np.uint64)
    size = np.bincount(line, minlength=n)
    full = np.flatnonzero(size)
    if len(full):
        begin = (np.cumsum(size) - size)[full]
        for half, mine in enumerate((~upper, upper)):
            out[full, half] = np.bitwise_or.reduceat(one * mine, begin)
    return out


def in_order(line: np.ndarray, value: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The order by line, then by the upper bits of value, at least `bits` of the 64, then by place, and which of its rows tie with the one before in line and these bits.

    The three stand in one number, which is sorted; None if they do not fit. line is sorted.
    """
    lows, highs = len(line).bit_length(), int(line[-1]).bit_length() if len(line) else 0
    rest = 64 - lows - highs
    if rest < bits:
        return None
    key = (line.astype(np.uint64) << np.uint64(64 - highs) if highs else 0) | value >> np.uint64(64 - rest) << np.uint64(lows) | np.arange(len(line), dtype=np.uint64)
    key.sort()
    tie = np.zeros(len(key), bool)
    tie[1:] = (key[1:] ^ key[:-1]) >> np.uint64(lows) == 0
    return (key & np.uint64((1 << lows) - 1)).astype(np.int64), tie


def distinct_words(line: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by line, each word of a line once. One sort by the line and the upper bits of the word does, unless different words of a line share these. line is sorted."""
    found = in_order(line, words, 32)
    if found is not None:
        order, tie = found
        held = words[order]
        if not (held[1:] != held[:-1])[tie[1:]].any():
            return line[order[~tie]], held[~tie]
    order = np.lexsort((words, line))
    line, words = line[order], words[order]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (words[1:] != words[:-1])
    return line[new], words[new]


def by_rarity(line: np.ndarray, words: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The order by line, then by count, then by word, of words in the order of `distinct_words`."""
    found = in_order(line, seen.astype(np.uint64) << np.uint64(32), 32)
    return np.lexsort((words, seen, line)) if found is None else found[0]


def keyed(line: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each line, and the two halves of the 128-bit key of its word set: sums of two hashes of each word). line and words are sorted by line and distinct."""
    size = np.bincount(line, minlength=n)
    full = np.flatnonzero(size)
    halves = np.zeros((2, n), np.uint64)
    if len(full):
        begin = (np.cumsum(size) - size)[full]
        for half, hashes in zip(halves, (words, mixed(words))):
            half[full] = np.add.reduceat(hashes, begin)
    return size, halves[0].view(np.int64), halves[1].view(np.int64)


def unseen(short: np.ndarray, posted: set[int]) -> np.ndarray:
    """The first line of each word set that this task has not had lately. `posted` is bounded."""
    ids, begin = np.unique(short, return_index=True)
    new = np.zeros(len(short), bool)
    new[begin] = [c not in posted for c in ids.tolist()]
    if len(posted) > POSTED:
        posted.clear()
    posted.update(ids.tolist())
    return new


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per line: id, line, n_words, the two halves of the key of the word set (null without words).

    At its end a task adds rows of its counters (number of the chunk as line): words of all its word sets, copies counted once, in a table of one fixed size, whatever the corpus.
    """
    schema = T.StructType([docs.schema[id_col], *[T.StructField(c, T.LongType()) for c in ("line", "n_words", *KEY)], T.StructField("counters", T.BinaryType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, held, n, posted, id_type = np.zeros(1 << COUNTER_BITS, np.uint32), [], 0, set(), None
        for batch in batches:
            id_type = batch.schema.field(id_col).type
            for part in slices(batch, text_col):
                doc, number, line, words = line_words(part.column(text_col))
                line, words = distinct_words(line, words)
                size, cid, rest = keyed(line, words, len(doc))
                yield pa.RecordBatch.from_arrays([
                    part.column(id_col).take(pa.array(doc)), pa.array(number.astype(np.int64)), pa.array(size.astype(np.int64)), *[pa.array(k, mask=size == 0) for k in (cid, rest)],
                    pa.nulls(len(doc), pa.binary())], names=schema.names)
                held.append((words[unseen(cid, posted)[line]] >> np.uint64(64 - COUNTER_BITS)).astype(np.int32))
                n += len(held[-1])
                if n > 6_000_000:
                    counters += np.bincount(np.concatenate(held), minlength=len(counters)).astype(np.uint32)
                    held, n = [], 0
        if held:
            counters += np.bincount(np.concatenate(held), minlength=len(counters)).astype(np.uint32)
        chunks = counters.reshape(-1, CHUNK)
        for at in np.flatnonzero(chunks.any(1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.array([at], pa.int64()), *[pa.nulls(1, pa.int64()) for _ in range(3)],
                                              pa.array([pa.compress(chunks[at].tobytes(), PACKED, asbytes=True)], pa.binary())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(read, schema)


def postings(docs: DataFrame, counters: np.ndarray, percent: int, text_col: str) -> DataFrame:
    """A posting for each prefix word of each line: list, cid, two maps, facts (size and place in one number, with the side of the block).

    A list is named by 40 bits, in the upper part of the number; words that share them are compared, which the filters and the full sets undo. The lower part has bits of
    the line, so that a sort by this one number brings copies of a line together.
    The list of a frequent word is cut into blocks; block i meets block j once, as side 0 and 1 of a list of their own, or itself (side 2).
    Lists are dealt to groups of about ROWS postings, by the sum of the counters; what a task has for a group goes out in few rows, not one a posting.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counters)
    dealt = partitions(docs.sparkSession)
    groups = -(-(int(counters.sum(dtype=np.int64)) * (100 - percent) // (100 * ROWS) + 1) // dealt) * dealt

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, posted = shared.value, set()  # lines that this task has posted: of a frequent line, a task sends one copy
        held, n_held = [], 0
        for batch in batches:
            for part in slices(batch, text_col):
                doc, _, line, words = line_words(part.column(text_col))
                line, words = distinct_words(line, words)
                size, short, _ = keyed(line, words, len(doc))
                new = unseen(short, posted)
                mine = new[line]
                line, words, size = line[mine], words[mine], np.where(new, size, 0)
                maps = maps_of(line, words, len(doc)).view(np.int64)
                seen = counts[(words >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
                order = by_rarity(line, words, seen)
                line, words, seen = line[order], words[order], seen[order]
                place = np.arange(len(line)) - (np.cumsum(size) - size)[line]
                n = size[line]
                at = np.flatnonzero((place < n - -(-percent * n // 100) + 1) & (seen > 1))  # a word seen once is in no other line
                blocks = seen[at].astype(np.int64) // LIST_BLOCK + 1
                own = (short[line[at]].view(np.uint64) % blocks.astype(np.uint64)).astype(np.int64)
                copies = np.repeat(np.arange(len(at)), blocks)
                other = np.arange(len(copies)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                low, high = np.minimum(own[copies], other), np.maximum(own[copies], other)
                side = np.where(low == high, 2, np.where(own[copies] == low, 0, 1))
                at = at[copies]
                lists = mixed(words[at] + mixed((low * (1 << 31) + high).astype(np.uint64))) >> np.uint64(64 - LIST_BITS) << np.uint64(64 - LIST_BITS)
                lists |= short[line[at]].view(np.uint64) & np.uint64((1 << 64 - LIST_BITS) - 1)
                facts = (n[at] << (PLACE_BITS + 2)) | (place[at] << 2) | side
                held.append(np.stack([lists.view(np.int64), short[line[at]], maps[line[at], 0], maps[line[at], 1], facts], 1))
                n_held += len(at)
                if n_held >= POSTED:
                    yield from grouped_posts(np.concatenate(held), groups)
                    held, n_held = [], 0
        if n_held:
            yield from grouped_posts(np.concatenate(held), groups)

    return docs.select(text_col).mapInArrow(read, "list bigint, posts binary")


def grouped_posts(posts: np.ndarray, groups: int) -> Iterator[pa.RecordBatch]:
    """Rows (group of lists, its postings as bytes). The list numbers are hashes, so groups are alike in size."""
    for low in range(0, len(posts), 2 * POSTED):
        some = posts[low:low + 2 * POSTED]
        group = (some[:, 0].view(np.uint64) >> np.uint64(64 - LIST_BITS)) % np.uint64(groups)
        order = np.argsort(group.astype(np.uint16) if groups <= 1 << 16 else group, kind="stable")  # short numbers are sorted by counting
        group = group[order].astype(np.int64)
        begin = np.flatnonzero(np.diff(group, prepend=-1))
        offsets = (np.append(begin, len(group)) * (8 * PARTS)).astype(np.int32)
        held = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(some[order])])
        yield pa.RecordBatch.from_arrays([pa.array(group[begin]), held], names=POSTING)


def filtered(lists: np.ndarray, cid: np.ndarray, facts: np.ndarray, maps: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the lines of each list between which all filters leave a match possible. Rows are sorted by list and size.

    All lists at once: each row is compared with the next of its list, then with the one after it, and so on while the sizes are near enough.
    """
    n, place, side = facts >> (PLACE_BITS + 2), (facts >> 2) & ((1 << PLACE_BITS) - 1), facts & 3
    left = n - place
    root = np.arange(len(lists))
    active, step = np.arange(len(lists)), 0
    first: list[np.ndarray] = []
    second: list[np.ndarray] = []
    while True:
        step += 1
        active = active[active + step < len(lists)]
        j = active + step
        near = (lists[j] == lists[active]) & (100 * n[active] >= percent * n[j])
        active = active[near]
        if not len(active):
            break
        i, j = active, active + step
        good = (cid[i] != cid[j]) & ((side[i] != side[j]) | (side[i] == 2))
        i, j = i[good], j[good]
        both = n[i] + n[j]
        good = np.minimum(left[i], left[j]) >= -(-percent * both // (100 + percent))  # words that a matching pair shares
        apart = sum(np.bitwise_count(m[i] ^ m[j]).astype(np.int64) for m in maps)
        good &= apart * (100 + percent) <= (100 - percent) * both
        first.append(i[good])
        second.append(j[good])
        if sum(map(len, first)) > 4 * ROWS:
            root = rooted(root, np.concatenate(first), np.concatenate(second))
            first, second = [], []
    if first:
        root = rooted(root, np.concatenate(first), np.concatenate(second))
    moved = np.flatnonzero((root != np.arange(len(root))) & (cid[root] != cid))
    return cid[root[moved]], cid[moved]


def rooted(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Places with the edges (i, j) joined: each points at the smallest of its component."""
    root = root.copy()
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not (root[root] == root).all():
            root = root[root]


def candidate_edges(posts: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) over all lists. The numbers of the groups of lists count from 0, so partitions take them in turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in streamed(batches, ["list"]):
            yield edges(np.frombuffer(b"".join(group.column("posts").to_pylist()), np.int64).reshape(-1, PARTS))

    def edges(rows: np.ndarray) -> pa.RecordBatch:
        lists = rows[:, 0].view(np.uint64)
        order = np.argsort(lists)
        lists, cid = lists[order], rows[order, 1]
        new = np.ones(len(lists), bool)  # copies of a line stand next to each other; one is enough
        new[1:] = (lists[1:] != lists[:-1]) | (cid[1:] != cid[:-1])
        lists, order = lists[new] >> np.uint64(64 - LIST_BITS), order[new]
        number = np.cumsum(np.diff(lists, prepend=lists[0]) != 0)
        size = rows[order, 4] >> (PLACE_BITS + 2)
        sized = np.argsort((number << 40) | size)  # by list and size
        order = order[sized]
        a, b = filtered(number[sized], rows[order, 1], rows[order, 4], [rows[order, k].view(np.uint64) for k in (2, 3)], percent)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    dealt = posts.repartitionById(partitions(posts.sparkSession), F.col("list").cast("int")).sortWithinPartitions("list")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def counted(group: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Links of each class of a family (or of two of its blocks), and whether one of them begins earlier: exact, on the full sets."""
    side = group.column("side").to_numpy()
    if len(side) < 2:
        return
    first = list(zip(*(group.column(c).to_pylist() for c in ("first_null", "first_id", "first_line"))))
    place = {v: k for k, v in enumerate(sorted(set(first)))}
    rank = np.array([place[v] for v in first])
    sets = [np.frombuffer(b, np.uint64) for b in group.column("words").to_pylist()]
    n = np.array([len(s) for s in sets])
    both = overlaps(sets)
    match = 100 * both >= percent * (n[:, None] + n[None, :] - both)
    match &= (side[:, None] != side[None, :]) | (side[:, None] == 2)
    np.fill_diagonal(match, False)
    links = match.sum(1)
    earlier = (match & (rank[None, :] < rank[:, None])).any(1)
    at = np.flatnonzero(links)
    if len(at):
        keys = [group.column(c).combine_chunks().take(pa.array(at)) for c in KEY]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(links[at].astype(np.int64)), pa.array(earlier[at])], names=[*KEY, "links", "earlier"])


def counted_pair(group: pa.Table, percent: int) -> list[tuple]:
    """What `counted` gives for a group of two classes, as rows."""
    (side, other), (a, b) = group.column("side").to_pylist(), (np.frombuffer(x, np.uint64) for x in group.column("words").to_pylist())
    both = len(np.intersect1d(a, b, assume_unique=True))
    if side == other != 2 or 100 * both < percent * (len(a) + len(b) - both):
        return []
    keys = zip(*(group.column(c).to_pylist() for c in KEY))
    first, second = zip(*(group.column(c).to_pylist() for c in ("first_null", "first_id", "first_line")))
    return [(*key, 1, earlier) for key, earlier in zip(keys, (second < first, first < second))]


def family_links(full: DataFrame, percent: int) -> DataFrame:
    """`counted` over all groups; most groups are pairs, whose rows go out together."""
    keys, names = ["root", "low", "high"], [*KEY, "links", "earlier"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for group in streamed(batches, keys):
            if group.num_rows != 2:
                yield from counted(group, percent)
                continue
            held += counted_pair(group, percent)
            if len(held) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=names)

    return full.repartition(partitions(full.sparkSession), *keys).sortWithinPartitions(*keys).mapInArrow(run, "cid bigint, rest bigint, links bigint, earlier boolean")


def sieve_of(wanted: DataFrame) -> np.ndarray:
    """A bit for where each class of a family occurs first (a hash of the id, xor the line): a table of one fixed size, whatever the corpus."""
    place = wanted.select(F.xxhash64("first_id").bitwiseXOR(F.col("first_line")).alias("place"))
    rows = place.select(F.expr(f"shiftright(place & {(1 << SIEVE_BITS) - 1}L, 6)").alias("at"), F.expr("shiftleft(1L, CAST(place & 63 AS INT))").alias("bits"))
    out = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    for row in rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        out[row["at"]] = row["bits"]
    return out.view(np.uint64)


def sieved(batch: pa.RecordBatch, sieve: np.ndarray) -> list[str]:
    """The lines of (hash of the id, text) that the sieve lets pass."""
    lines, counts = [], []
    for text in batch.column(1).to_pylist():
        held = (text or "").split("\n")
        lines += held
        counts.append(len(held))
    number = np.arange(len(lines)) - np.repeat(np.cumsum(counts) - counts, counts)
    low = (np.repeat(batch.column(0).to_numpy(), counts) ^ number) & ((1 << SIEVE_BITS) - 1)
    return [lines[k] for k in np.flatnonzero((sieve[low >> 6] >> (low & 63).astype(np.uint64)) & np.uint64(1)).tolist()]


def words_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cid, rest, words) of the lines where a class of a family occurs first, and of others that the sieve lets pass; only these are parsed, and a task sends a line once."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve_of(wanted))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, sent = shared.value, set()
        for batch in batches:
            for part in slices(batch, text_col):
                lines = sieved(part, sieve)
                if not lines:
                    continue
                doc, _, line, words = line_words(lines)
                line, words = distinct_words(line, words)
                size, short, rest = keyed(line, words, len(doc))
                ends = np.cumsum(size)
                found = []
                for k in np.flatnonzero(size).tolist():
                    key = (int(short[k]), int(rest[k]))
                    if key not in sent:
                        sent.add(key)
                        found.append(k)
                if len(sent) > POSTED:
                    sent.clear()
                yield pa.RecordBatch.from_arrays([pa.array(short[found]), pa.array(rest[found]),
                                                  pa.array([words[ends[k] - size[k]:ends[k]].tobytes() for k in found], pa.binary())], names=[*KEY, "words"])

    return docs.select(F.xxhash64(id_col).alias(fresh_name(docs, "place")), text_col).mapInArrow(read, "cid bigint, rest bigint, words binary")


def sketches(sets: DataFrame) -> DataFrame:
    """Per class: root, cid, n, and a map of SKETCH_BITS bits of its words."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, sizes = [], []
            for held in batch.column("words").to_pylist():
                words = np.frombuffer(held, np.uint64)
                bits = np.zeros(SKETCH_BITS, np.uint8)
                bits[(words % np.uint64(SKETCH_BITS)).astype(np.int64)] = 1
                maps.append(np.packbits(bits).tobytes())
                sizes.append(len(words))
            yield pa.RecordBatch.from_arrays([batch.column("root"), batch.column("cid"), pa.array(sizes, pa.int64()), pa.array(maps, pa.binary())], names=["root", "cid", "n", "sketch"])

    return sets.select("root", "cid", "words").mapInArrow(read, "root bigint, cid bigint, n bigint, sketch binary")


def near_sketches(group: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Edges that connect the classes of a group (or of two of its blocks) which sizes and sketches leave possible matches.

    Classes of the next band are larger, and meet each other in a group of their own: here they are only compared with the classes of this band.
    """
    n = group.column("n").to_numpy()
    order = np.argsort(n, kind="stable")
    n, cid, side = n[order], group.column("cid").to_numpy()[order], group.column("side").to_numpy()[order]
    own = group.column("own").to_numpy(zero_copy_only=False)[order]
    maps = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint64).reshape(len(n), -1)[order].T.copy()
    stop = np.searchsorted(n, 100 * n // percent, "right")
    first: list[np.ndarray] = []
    second: list[np.ndarray] = []
    for i in np.flatnonzero(own).tolist():
        low, high = i + 1, int(stop[i])
        most = (100 - percent) * (n[i] + n[low:high]) // (100 + percent)  # words in which a matching pair differs
        part = len(maps) // (4 if n[i] < WIDE else 2)  # a look at part of the map does for most
        apart = np.bitwise_count(maps[:part, low:high] ^ maps[:part, i, None]).sum(0, dtype=np.uint16)
        near = apart <= most
        if side[i] != 2:
            near &= side[low:high] != side[i]
        some = np.flatnonzero(near)
        rest = np.bitwise_count(maps[part:, low + some] ^ maps[part:, i, None]).sum(0, dtype=np.uint16)  # the distance only grows
        j = low + some[apart[some] + rest <= most[some]]
        first.append(np.full(len(j), i))
        second.append(j)
        if len(first) == 256:
            first, second = linked(first, second, len(n))
    i, j = linked(first, second, len(n))
    if len(i) and len(i[0]):
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(cid[i[0]], cid[j[0]])), pa.array(np.maximum(cid[i[0]], cid[j[0]]))], names=["a", "b"])


def linked(first: list[np.ndarray], second: list[np.ndarray], n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """As few edges that connect the same places."""
    if not first:
        return [], []
    root = rooted(np.arange(n), np.concatenate(first), np.concatenate(second))
    moved = np.flatnonzero(root != np.arange(n))
    return [root[moved]], [moved]


def parted(sets: DataFrame, percent: int) -> DataFrame:
    """`sets` with families of FAMILY_BLOCK classes or more parted by sketches; a class that is near no other goes.

    The maps of postings tell long lines apart only badly (from about 180 words on), so these chain. Sizes in bands a matching pair is at most one apart
    keep each class to two groups, and groups are compared in blocks.
    """
    bands = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent + 1e-9)))
    small, large = sets.where("blocks = 1"), sets.where("blocks > 1")
    band = F.array(F.struct(bands.alias("band"), F.lit(True).alias("own")), F.struct((bands - 1).alias("band"), F.lit(False).alias("own")))
    grouped = sketches(large).select("*", F.inline(band))
    grouped = staged(grouped, "line-sketches")
    sizes = grouped.groupBy("root", "band").agg((F.floor(F.count(F.lit(1)) / SKETCH_BLOCK) + 1).alias("parts"))
    dealt = in_blocks(grouped.join(sizes, ["root", "band"]), F.col("parts")).drop("parts")
    edges = by_group(dealt, ["root", "band", "low", "high"], lambda group: near_sketches(group, percent), "a bigint, b bigint")
    family = components(staged(edges.distinct(), "line-sketch-edges")).select(F.col("node").alias("cid"), F.col("root").alias("part"))
    family = family.unionByName(family.select(F.col("part").alias("cid"), "part").distinct())
    sizes = family.groupBy("part").agg((F.floor(F.count(F.lit(1)) / FAMILY_BLOCK) + 1).alias("blocks"))
    large = large.drop("root", "blocks").join(staged(family.join(sizes, "part"), "line-parts"), "cid").withColumnRenamed("part", "root")
    return small.unionByName(large)


def matches(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per line: id, line (from 0), n_words, class_id and class_line (where its word set occurs first), n_links (other sets that match it), kept."""
    ship_package(docs.sparkSession)
    parsed = staged(described(docs, id_col, text_col), "lines")
    counters, lines = rarity(parsed), parsed.where("counters IS NULL").drop("counters")
    first = F.min(F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"), F.col("line").alias("line"))).alias("first")
    classes = lines.where("n_words > 0").groupBy(*KEY).agg(first).select(*KEY, F.col("first.id").alias("first_id"), F.col("first.line").alias("first_line"))
    classes = staged(classes, "line-classes")

    edges = staged(candidate_edges(postings(docs, counters, percent, text_col), percent).distinct(), "line-edges")
    family = staged(components(edges).select(F.col("node").alias("cid"), "root"), "line-nodes")
    family = staged(family.unionByName(family.select(F.col("root").alias("cid"), "root").distinct()), "line-families")
    blocks = family.groupBy("root").agg((F.floor(F.count(F.lit(1)) / FAMILY_BLOCK) + 1).alias("blocks"))
    wanted = staged(family.join(classes, "cid").join(blocks, "root"), "line-wanted")
    sets = staged(words_of(docs, wanted, id_col, text_col).join(wanted.hint("merge"), KEY).dropDuplicates(KEY), "line-sets")
    full = in_blocks(parted(sets, percent), F.col("blocks")).select(
        "root", "low", "high", *KEY, "side", F.col("first_id").isNull().alias("first_null"), F.coalesce("first_id", F.lit(0)).alias("first_id"), "first_line", "words")
    links = staged(family_links(full, percent).groupBy(*KEY).agg(F.sum("links").alias("n_links"), F.max("earlier").alias("earlier")), "line-links")
    judged = classes.join(links, KEY, "left").select(*KEY, "first_id", "first_line", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("earlier", F.lit(False)).alias("earlier"))
    judged = staged(judged, "line-judged")
    out = lines.join(judged.hint("merge"), KEY, "left")
    stays = F.col("first_line").isNull() | (~F.col("earlier") & F.col(id_col).eqNullSafe(F.col("first_id")) & (F.col("line") == F.col("first_line")))
    return out.select(F.col(id_col), "line", "n_words", F.col("first_id").alias("class_id"), F.col("first_line").alias("class_line"), F.coalesce("n_links", F.lit(0)).alias("n_links"), stays.alias("kept"))


def remove_later(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the lines of `text_col` that match an earlier line removed; a document of which nothing stays has the text ""."""
    gone = staged(matches(docs, percent, id_col, text_col).where(~F.col("kept")).groupBy(F.col(id_col).alias("gone_id")).agg(F.collect_set("line").alias("gone_lines")), "gone-lines")
    text, gone_id, gone_lines = F.col(text_col), *(fresh_name(docs, c) for c in ("gone_id", "gone_lines"))
    gone = gone.select(F.col("gone_id").alias(gone_id), F.col("gone_lines").alias(gone_lines))
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone[gone_id]), "left")
    kept = F.filter(F.split(text, "\n", -1), lambda line, at: ~F.array_contains(F.col(gone_lines), at.cast("bigint")))
    return joined.withColumn(text_col, F.when(F.col(gone_lines).isNull(), text).otherwise(F.array_join(kept, "\n"))).drop(gone_id, gone_lines)
