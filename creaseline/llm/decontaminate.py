"""Benchmark decontamination with one Aho-Corasick automaton.

Items (questions with their answers) are normalised to words; every run of ten consecutive words is a window, and an item of
fewer words is one window. One automaton over all windows reads each normalised text once; every occurrence is mapped
back to words of the document and to offsets in the original text.

Words are runs of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased. The automaton works on UTF-8
bytes: every ASCII character that is no letter or digit separates words, so the byte form has the same words.

The automaton's size follows the benchmark, never the corpus. A benchmark of more than `block_bytes` of window text is dealt to several
automata. Each of them reads the texts in a pass of its own, and what it found is written with the texts before the next begins: the driver holds one
block of items at a time and a worker one automaton; results are the same.

Defined results: a null or wordless text has no words and no hits; items without words are never found; repeated items count once by
id; a null item id is left out of the list of ids but its windows still hit. Other columns are kept by `drop_contaminated` and ignored otherwise.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creaseline.llm.common import fresh_name, ship_package, staged

#: ASCII to its normal form: letters in small, digits, everything else a blank; bytes beyond ASCII stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
SCAN_TYPE = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                          T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(SPAN))])
SCAN_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])

_AUTOMATA: dict[str, ahocorasick.Automaton] = {}  # of this worker, by content


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def windows_of(text: str | None, width: int) -> list[str]:
    """Windows as patterns with a blank on either side, one character for each byte."""
    words = words_of(text)
    starts = range(max(len(words) - width, 0) + 1) if words else ()
    return [" " + b" ".join(words[i:i + width]).decode("latin-1") + " " for i in starts]


def automaton(items: list[tuple[str | None, str]], width: int) -> ahocorasick.Automaton:
    """Values are (words in the window, ids of the items with it). Built once for each worker."""
    key = hashlib.sha256(repr((width, items)).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _AUTOMATA:
        found: dict[str, set] = {}
        for item, text in items:
            for window in windows_of(text, width):
                found.setdefault(window, set()).add(item)
        made = ahocorasick.Automaton()
        for window, ids in found.items():
            made.add_word(window, (window.count(" ") - 1, len(window), ids - {None}))
        made.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[key] = made
    return _AUTOMATA[key]


def scan(text: str | None, patterns: ahocorasick.Automaton) -> tuple[int, int, list[str], list[tuple[int, int]]]:
    """(words, words hit, ids of items found, hit spans as character offsets of the original text)."""
    words = words_of(text)
    if not words or not len(patterns):
        return len(words), 0, [], []
    flat = " " + b" ".join(words).decode("latin-1") + " "
    hits = list(patterns.iter(flat))
    if not hits:
        return len(words), 0, [], []
    blanks = np.flatnonzero(np.frombuffer(flat.encode("latin-1"), np.uint8) == 32)
    change = np.zeros(len(words) + 1, np.int64)
    items: set[str] = set()
    for end, (count, size, ids) in hits:
        first = int(np.searchsorted(blanks, end - size + 1))  # the blank before the first word has the word's number
        change[first] += 1
        change[first + count] -= 1
        items |= ids
    hit = np.cumsum(change)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    places = [(m.start(), m.end()) for m in WORD.finditer(text)]
    spans = [(places[a][0], places[b - 1][1]) for a, b in zip(edges[::2], edges[1::2])]
    return len(words), int(hit.sum()), sorted(items), spans


def merged(a: list, b: list) -> list[tuple[int, int]]:
    """The union of two lists of spans that begin and end at words."""
    out: list[list[int]] = []
    for start, stop in sorted([*map(tuple, a), *map(tuple, b)]):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(x) for x in out]


def item_blocks(benchmark: DataFrame, width: int, block_bytes: int, item_col: str, text_col: str) -> Iterator[list[tuple[str | None, str]]]:
    """Items in blocks of about `block_bytes` bytes of windows at most; each is fetched when it is asked for.

    A word is in `width` windows at most, so the bytes of the texts bound those of the windows. Items are dealt to blocks by their hash; more than one
    block are made half as large as they may be, for a hash deals unevenly.
    """
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("body")).where(F.col(text_col).isNotNull()).distinct()
    rows = staged(rows, "benchmark-items")
    total = (rows.agg(F.sum(F.octet_length("body") + 1)).first()[0] or 0) * width
    blocks = 1 if total <= block_bytes else -(-2 * total // block_bytes)
    for k in range(blocks):
        block = [(r["item"], r["body"]) for r in rows.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == k).collect()]
        if block or not k:
            yield sorted(block, key=repr)


def find(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 64 << 20, text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", out_col: str = "leaks", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all, if none are given) with `out_col`, a struct of n_words, n_hit, items, spans."""
    ship_package(docs.sparkSession)
    out, items = docs, None
    for turn, block in enumerate(item_blocks(benchmark, width, block_bytes, item_col, item_text_col)):
        if turn:  # written before the next block is fetched: the driver holds one block, a worker one automaton
            out = staged(scanned(out, items, width, text_col, out_col, docs.columns, turn > 1), f"scanned-{turn}")
        later, items = turn > 0, block
    return scanned(out, items, width, text_col, out_col, docs.columns if keep is None else keep, later)


def scanned(docs: DataFrame, items: list[tuple[str | None, str]], width: int, text_col: str, out_col: str, names: list[str], later: bool) -> DataFrame:
    """The columns `names` of `docs` with `out_col`: what one block of items finds, added to what earlier blocks found if `later`."""
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField(out_col, SCAN_TYPE)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = automaton(items, width)
        for batch in batches:
            found = []
            before = batch.column(out_col).to_pylist() if later else []
            for at, text in enumerate(batch.column(text_col).to_pylist()):
                n_words, n_hit, ids, spans = scan(text, patterns)
                if later and before[at]["n_hit"]:
                    spans = merged([(s["start"], s["stop"]) for s in before[at]["spans"]], spans)
                    ids = sorted({*before[at]["items"], *ids})
                    n_hit = sum(len(words_of(text[a:b])) for a, b in spans)
                found.append({"n_words": n_words, "n_hit": n_hit, "items": ids, "spans": [{"start": a, "stop": b} for a, b in spans]})
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found, SCAN_ARROW)], names=[*names, out_col])

    return docs.mapInArrow(read, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, with all their columns, in which no window of an item occurs."""
    mark = fresh_name(docs, "leaks")
    return find(docs, benchmark, text_col=text_col, out_col=mark, **options).where(F.col(f"{mark}.n_hit") == 0).select(*[f"`{c}`" for c in docs.columns])
