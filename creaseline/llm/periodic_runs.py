"""Periodic runs of words in a text, found by recompression.

A run is a longest stretch of words with smallest period q whose length is at least max(least, exponent * q): a phrase repeated over and over.

Candidates come from a harmonic grid: for each period p, only words at multiples of p are looked at. A run of period p holds at least `exponent`
grid points in a row with equal words, so there are n/p of them to test for each p, n log n in all. How far such a candidate reaches
to either side is asked from a grammar: the words are compressed in turns, blocks of one symbol into a symbol with a count, then pairs of
neighbouring symbols of two classes into one symbol. Equal stretches of words get equal symbols but for a few at their ends, so the longest common
extension of two places is found by climbing the levels while symbols agree and descending where they do not, in steps that grow with the logarithm
of the length. No suffix array is built. All candidates of a batch are extended together, as arrays. Equal extents with several periods are
one run, with the smallest.

Defined results: a null, empty or blank text has no words and no runs; words are compared by their bytes. Texts of any length are taken whole; a task
holds one batch of about `BATCH_WORDS` words, or one text. Each row is read by itself, so repeated rows get equal results; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from creaseline.llm.common import ship_package

LEAST, EXPONENT = 6, 4
BATCH_WORDS = 200_000
CHUNK = 1 << 18  # candidates extended at a time
ROUNDS = 200  # a bound for the loop only; a batch needs about 3 log2(words)


def words_of(text: str | None) -> list[bytes]:
    """Words between blanks, tabs, line feeds, vertical tabs, form feeds and carriage returns: just what bytes.split() splits at."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _classes(symbols: np.ndarray, turn: int) -> np.ndarray:
    """A bit for each symbol, by a fixed multiplicative hash that differs from turn to turn."""
    mixed = (symbols.astype(np.uint64) + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(40 + turn % 16)) & np.uint64(1) == 1


def _named(first: np.ndarray, second: np.ndarray, start: int) -> np.ndarray:
    """One new symbol, from `start` on, for each distinct pair of numbers."""
    pairs = np.stack([first, second], axis=1)
    order = np.lexsort((second, first))
    ranked = pairs[order]
    change = np.concatenate(([0], np.any(ranked[1:] != ranked[:-1], axis=1).cumsum()))
    names = np.empty(len(first), np.int64)
    names[order] = change + start
    return names


class Grammar:
    """A run-length grammar of several words sequences, joined with a separator of its own after each.

    Level k has `symbols[k]`; `parent[k]` is the symbol of level k + 1 that holds each of them, `first[k]` the first symbol of level k in each symbol
    of level k + 1, and `is_block[k]` tells how level k + 1 was made. Both end with an entry for the end of the sequence.
    """

    def __init__(self, words: np.ndarray, separator: np.ndarray):
        self.symbols, self.parent, self.first, self.is_block = [words], [], [], []
        fixed, fresh = separator, int(words.max(initial=0)) + 1
        turn, idle = 0, 0
        while idle < 12 and turn < ROUNDS and not self._short(fixed):
            now = self.symbols[-1]
            if turn % 2 == 0:
                starts = np.concatenate(([True], now[1:] != now[:-1]))
            else:
                left = _classes(now, turn) & ~fixed
                joined = left[:-1] & ~left[1:] & ~fixed[1:]
                starts = np.concatenate(([True], ~joined))
            first = np.flatnonzero(starts)
            size = np.diff(np.append(first, len(now)))
            if len(first) == len(now):
                turn, idle = turn + 1, idle + 1
                continue
            idle = 0
            made, grown = now[first].copy(), np.flatnonzero(size > 1)
            second = size[grown] if turn % 2 == 0 else now[first[grown] + 1]
            made[grown] = _named(now[first[grown]], second, fresh)
            fresh = int(made.max()) + 1 if len(grown) else fresh
            self.is_block.append(turn % 2 == 0)
            self.parent.append(np.append(np.cumsum(starts) - 1, len(first)))
            self.first.append(np.append(first, len(now)))
            self.symbols.append(made)
            fixed, turn = fixed[first], turn + 1

    @staticmethod
    def _short(fixed: np.ndarray) -> bool:
        """Every sequence is down to a few symbols."""
        return int(np.diff(np.flatnonzero(np.concatenate(([True], fixed)))).max(initial=0)) <= 3

    def extend(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        """How many words agree from `a` and `b` on (back: before them), a < b. The separators end every extension."""
        a, b, start = a.copy(), b.copy(), b.copy()
        top = len(self.parent)
        ended = np.full(len(a), top)  # the level at which symbols first differ
        going = np.arange(len(a))
        for level in range(top):
            going = self._agree(level, a, b, going, back, ended, climb=True)
            up = self.parent[level]
            a[going], b[going] = up[a[going]], up[b[going]]
        self._agree(top, a, b, going, back, ended, climb=False)
        for level in range(top - 1, -1, -1):
            down = np.flatnonzero(ended > level)
            first = self.first[level]
            a[down], b[down] = first[a[down]], first[b[down]]
            self._agree(level, a, b, np.flatnonzero(ended >= level), back, None, climb=False)
        return start - b if back else b - start

    def _agree(self, level: int, a: np.ndarray, b: np.ndarray, going: np.ndarray, back: bool, ended: np.ndarray | None, climb: bool) -> np.ndarray:
        """Move `a` and `b` past equal symbols of a level, in place; with `climb`, only up to where both are at the edge of a symbol of the next level.
        Returns those that got there; for the others `ended` is set."""
        symbols, inner = self.symbols[level], level < len(self.parent)
        arrived = []
        while len(going):
            x, y = a[going], b[going]
            if climb:
                up, first = self.parent[level], self.first[level]
                edge = (first[up[x]] == x) & (first[up[y]] == y)
                arrived.append(going[edge])
                going, x, y = going[~edge], x[~edge], y[~edge]
            inside = x > 0 if back else y < len(symbols)
            same = inside.copy()
            same[inside] = symbols[x[inside] - back] == symbols[y[inside] - back]
            if ended is not None:
                ended[going[~same]] = level
            going, x, y = going[same], x[same], y[same]
            if inner and self.is_block[level]:
                up, first = self.parent[level], self.first[level]
                if back:
                    step = np.minimum(x - first[up[x - 1]], y - first[up[y - 1]])
                else:
                    step = np.minimum(first[up[x] + 1] - x, first[up[y] + 1] - y)
            else:
                step = 1
            a[going] += -step if back else step
            b[going] += -step if back else step
        return np.concatenate(arrived) if arrived else going


def _candidates(words: np.ndarray, ends: np.ndarray, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, periods) of the grid points that are followed by `exponent` - 1 equal words at distance p. Sequences are in order of falling length."""
    lengths = np.diff(np.concatenate(([0], ends)))
    longest = int(lengths.max(initial=0))
    reach = np.searchsorted(-lengths, -np.maximum(exponent * np.arange(longest // exponent + 2), least), side="right")  # sequences long enough for p
    places, periods = [], []
    for p in range(1, longest // exponent + 1):
        stop = ends[reach[p] - 1] if reach[p] else 0
        if not stop:
            break
        grid = words[0:stop:p]
        if len(grid) < exponent:
            continue
        same = grid[1:] == grid[:-1]
        kept = same[:len(same) - exponent + 2].copy()
        for k in range(1, exponent - 1):
            kept &= same[k:len(same) - exponent + 2 + k]
        found = np.flatnonzero(kept)
        if len(found):
            places.append(found * p)
            periods.append(np.full(len(found), p))
    none = np.zeros(0, np.int64)
    return (np.concatenate(places), np.concatenate(periods)) if places else (none, none)


def find_runs(texts: list[np.ndarray], least: int = LEAST, exponent: int = EXPONENT) -> list[np.ndarray]:
    """For each sequence of word numbers its runs as rows (start, length, period), by start, then period."""
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(texts)
    order = sorted((k for k in range(len(texts)) if len(texts[k]) >= least), key=lambda k: -len(texts[k]))
    if not order:
        return out
    words, ends = _joined([texts[k] for k in order])
    place, _ = _candidates(words, ends, exponent, least)
    hit = np.unique(np.searchsorted(ends, place, side="right"))
    if not len(hit):
        return out
    order = [order[k] for k in hit]  # only these sequences need a grammar
    words, ends = _joined([texts[k] for k in order])
    place, period = _candidates(words, ends, exponent, least)
    separator = np.zeros(len(words), bool)
    separator[ends - 1] = True
    grammar = Grammar(words, separator)
    found = []
    for at in range(0, len(place), CHUNK):
        i, p = place[at:at + CHUNK], period[at:at + CHUNK]
        after, before = grammar.extend(i, i + p, back=False), grammar.extend(i, i + p, back=True)
        length = after + before + p
        long = length >= np.maximum(least, exponent * p)
        found.append(np.unique(np.stack([(i - before)[long], length[long], p[long]], axis=1), axis=0))
    runs = np.unique(np.concatenate(found), axis=0)  # by start, length, period
    smallest = np.concatenate(([True], np.any(runs[1:, :2] != runs[:-1, :2], axis=1))) if len(runs) else np.zeros(0, bool)
    runs = runs[smallest]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = np.searchsorted(ends, runs[:, 0], side="right")
    begins = np.concatenate(([0], ends[:-1]))
    runs[:, 0] -= begins[owner]
    edges = np.searchsorted(owner, np.arange(len(order) + 1))
    for k, text in enumerate(order):
        out[text] = runs[edges[k]:edges[k + 1]]
    return out


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sequences one after the other, each followed by a number that occurs nowhere else; where each ends, with that number."""
    fresh = max(int(t.max(initial=0)) for t in texts) + 1
    words = np.concatenate([part for k, t in enumerate(texts) for part in (t, np.array([fresh + k], np.int64))])
    return words, np.cumsum([len(t) + 1 for t in texts])


def collapse(n_words: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: all but those that some run holds after its first period."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


RUN_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FOUND_TYPE = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN_TYPE)), T.StructField("collapsed", T.StringType())])
_FOUND_ARROW = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN_TYPE.fields]))), ("collapsed", pa.string())])


def batches_of(texts: list[list[bytes]]) -> Iterator[slice]:
    """Slices of about BATCH_WORDS words; a longer text is one by itself."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > BATCH_WORDS:
            yield slice(start, k)
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def _read(words: list[list[bytes]], least: int, exponent: int) -> list[dict]:
    numbers = _Numbers()
    coded = [np.fromiter(map(numbers.__getitem__, text), np.int64, len(text)) for text in words]
    out = []
    for text, runs in zip(words, find_runs(coded, least, exponent)):
        if len(runs):
            text_left = [w for w, kept in zip(text, collapse(len(text), runs).tolist()) if kept]
        else:
            text_left = text
        out.append({"n_words": len(text), "runs": [{"start": s, "length": n, "period": q} for s, n, q in runs.tolist()],
                    "collapsed": b" ".join(text_left).decode("utf-8", "surrogatepass")})
    return out


def find(docs: DataFrame, keep: list[str], text_col: str = "text", out_col: str = "found", least: int = LEAST, exponent: int = EXPONENT,
         prepare: Callable[..., list[bytes]] | None = None) -> DataFrame:
    """The columns `keep` of `docs` with `out_col`: number of words, the runs by start and period, and the text with each run's repeats dropped and
    its words joined by single blanks. `prepare(words, *values of keep)` may change the words first."""
    ship_package(docs.sparkSession)
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField(out_col, FOUND_TYPE)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col)
            at = 0
            while at < len(texts):  # few texts are words at a time
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size < 8 * BATCH_WORDS):
                    size += len(texts[stop].as_py() or "")
                    stop += 1
                words = [words_of(t) for t in texts[at:stop].to_pylist()]
                if prepare:
                    words = [prepare(*row) for row in zip(words, *(batch.column(c)[at:stop].to_pylist() for c in keep))]
                found = [row for part in batches_of(words) for row in _read(words[part], least, exponent)]
                columns = [batch.column(c)[at:stop] for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, _FOUND_ARROW)], names=[*keep, out_col])
                at = stop

    return docs.mapInArrow(read, schema)
