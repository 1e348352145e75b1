"""Toxic spans and document scores from a linear-chain conditional random field.

Tokens are words; a chain is a sentence. The two labels' scores come from hashed features of a word (the word and its
beginnings) and from the transitions. The field is fitted on labelled tokens: in a bounded sample of labelled documents, a word of a
toxic document is toxic if one of its features is far more frequent in toxic than in clean documents; all other words are clean.
Forward-backward marginals give offending offsets and, added up, the score of a document, calibrated by a logistic
model that is weighted to the class shares of all labelled documents.

The fit uses at most `train_docs` documents of each class, of at most `train_chars` characters, chosen by the hash of their ids.
Scoring reads every whole text.

Defined results: a null or wordless text has no tokens and the score of a text without findings. Without labels of both classes every score is the
share of toxic labels (0 without any). Ids labelled repeatedly are toxic if any label says so; null labels and ids are left out. Labels without
a document count nowhere. Other columns of the documents are never features.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creaseline.llm.common import fresh_name, ship_package, staged

BITS = 18
BEGINNINGS = (3, 4, 5, 6, 7, 8)  # bytes of a word's beginning that are a feature
#: 0 other, 1 part of a word, 2 end of a sentence; by byte.
KIND = np.array([1 if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 2 if chr(c) in ".!?\n" else 0 for c in range(256)], np.int8)
BASE, MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("p", T.DoubleType())])
RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("n_toxic", T.DoubleType()), T.StructField("spans", T.ArrayType(SPAN))])
RESULT_ARROW = pa.struct([("score", pa.float64()), ("n_toxic", pa.float64()),
                          ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())])))])


def small(text: str) -> str:
    """Lower case, character by character, so that offsets stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@dataclass
class Tokens:
    """Words of a batch of texts: document, chain, byte range in the joined texts, and feature numbers (one column for each kind)."""
    doc: np.ndarray
    chain: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    features: np.ndarray


def tokens_of(texts: list[bytes]) -> Tokens:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])
    kind = KIND[data]
    word = (kind == 1).view(np.int8)
    edge = np.diff(word, prepend=np.int8(0))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = stop - start
    features = np.zeros((len(start), len(BEGINNINGS) + 1), np.int32)
    value = np.zeros(len(start), np.uint64)
    shift = np.uint64(64 - BITS)
    last = len(data) - 1
    for k in range(max(BEGINNINGS)):
        value = value * BASE + data[np.minimum(start + k, last)] + np.uint64(1)
        if k + 1 in BEGINNINGS:
            number = ((value ^ (value >> np.uint64(29)) ^ np.uint64(k + 1)) * MIX) >> shift
            features[:, BEGINNINGS.index(k + 1)] = np.where(size > k, number.astype(np.int32), 0)  # number 0 is "none"
    if len(start):
        inside = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(np.cumsum(size) - size, size)
        powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(size.max()), BASE))))
        whole = np.add.reduceat((data[word == 1].astype(np.uint64) + np.uint64(1)) * powers[inside], np.cumsum(size) - size)
        features[:, -1] = (((whole ^ (whole >> np.uint64(31))) * MIX) >> shift).astype(np.int32)
    ends = np.cumsum(kind == 2)
    chain = np.cumsum(np.diff(ends[start], prepend=-1) > 0) - 1 if len(start) else np.zeros(0, np.int64)
    return Tokens(np.searchsorted(offsets, start, "right") - 1, chain, start, stop, features)


def scores_of(weights: np.ndarray, tokens: Tokens) -> np.ndarray:
    out = np.zeros(len(tokens.doc))
    for column in tokens.features.T:
        out += weights[column]
    return out


def joined(parts: list[Tokens], docs: list[int]) -> Tokens:
    """Batches of texts as one, with their numbers of documents; byte ranges stay those of the batches."""
    firsts = np.cumsum([0, *docs[:-1]])
    chains = np.cumsum([0, *[int(t.chain[-1]) + 1 if len(t.chain) else 0 for t in parts[:-1]]])
    return Tokens(np.concatenate([t.doc + d for t, d in zip(parts, firsts)]), np.concatenate([t.chain + c for t, c in zip(parts, chains)]),
                  np.concatenate([t.start for t in parts]), np.concatenate([t.stop for t in parts]), np.concatenate([t.features for t in parts]))


def marginals(score: np.ndarray, chain: np.ndarray, trans: np.ndarray, first: float, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """P(toxic) of each token and, if asked for, for each token but a chain's first the four joint probabilities with the one before.

    Ratios of the two labels' forward and backward sums, for all chains of the batch in step; `trans` and `first` are log scores.
    """
    n = len(score)
    if not n:
        return np.zeros(0), np.zeros((0, 2, 2))
    begin = np.flatnonzero(np.diff(chain, prepend=-1))
    size = np.diff(np.append(begin, n))
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    steps = [int(k) for k in np.searchsorted(-size, -np.arange(int(size[0])), "left")]  # chains longer than step j
    psi, move = np.exp(np.clip(score, -30, 30)), np.exp(trans)
    ahead, behind = np.zeros(n), np.ones(n)
    ahead[begin] = psi[begin] * np.exp(first)
    for j in range(1, len(steps)):
        at = begin[:steps[j]] + j
        before = ahead[at - 1]
        ahead[at] = psi[at] * (move[0, 1] + before * move[1, 1]) / (move[0, 0] + before * move[1, 0])
    for j in range(len(steps) - 1, 0, -1):
        at = begin[:steps[j]] + j
        after = psi[at] * behind[at]
        behind[at - 1] = (move[1, 0] + move[1, 1] * after) / (move[0, 0] + move[0, 1] * after)
    odds = ahead * behind
    p = odds / (1 + odds)
    if not pairs:
        return p, None
    joint = np.zeros((n, 2, 2))
    later = np.ones(n, bool)
    later[begin] = False
    at = np.flatnonzero(later)
    joint[at, 0, 0] = move[0, 0]
    joint[at, 0, 1] = move[0, 1] * psi[at] * behind[at]
    joint[at, 1, 0] = ahead[at - 1] * move[1, 0]
    joint[at, 1, 1] = ahead[at - 1] * move[1, 1] * psi[at] * behind[at]
    joint[at] /= joint[at].sum((1, 2))[:, None, None]
    return p, joint


@dataclass
class Model:
    weights: np.ndarray
    trans: np.ndarray
    first: float
    logistic: np.ndarray  # of the document's figures
    base: float | None = None  # the score of every text, if nothing could be learnt

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, Tokens, np.ndarray, np.ndarray]:
        """(P of each token, tokens, P added up by document, score of each document)."""
        tokens = tokens_of([small(t or "").encode("utf-8", "surrogatepass") for t in texts])
        if self.base is not None:
            return np.zeros(len(tokens.doc)), tokens, np.zeros(len(texts)), np.full(len(texts), self.base)
        p, _ = marginals(scores_of(self.weights, tokens), tokens.chain, self.trans, self.first)
        figures = document_figures(p, tokens.doc, len(texts))
        return p, tokens, np.bincount(tokens.doc, p, len(texts)), 1 / (1 + np.exp(-np.clip(figures @ self.logistic, -30, 30)))


def document_figures(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Constant, largest log-odds, log of the expected toxic words, and log of their rate."""
    odds = np.log(np.clip(p, 1e-6, 1 - 1e-6) / (1 - np.clip(p, 1e-6, 1 - 1e-6)))
    top = np.full(n, -14.0)
    np.maximum.at(top, doc, odds)
    expected, words = np.bincount(doc, p, n), np.bincount(doc, minlength=n)
    return np.column_stack([np.ones(n), top / 4, np.log(expected + 0.05), np.log((expected + 0.05) / (words + 20.0))])


def toxic_tokens(tokens: Tokens, toxic: np.ndarray, ratio: float, least_docs: int) -> np.ndarray:
    """Labels of tokens from labels of documents: a word of a toxic document with a feature that is `ratio` times as frequent
    among the words of toxic documents as among those of clean ones, half of that by documents, in at least `least_docs` toxic documents."""
    buckets = 1 << BITS
    of_toxic = toxic[tokens.doc]
    n_toxic, n_clean = max(int(of_toxic.sum()), 1), max(int((~of_toxic).sum()), 1)
    flagged = np.zeros(len(tokens.doc), bool)
    for column in tokens.features.T:
        seen = np.bincount(column[of_toxic], minlength=buckets)
        clean = np.bincount(column[~of_toxic], minlength=buckets)
        pairs = np.unique(tokens.doc[of_toxic].astype(np.int64) * buckets + column[of_toxic])
        docs = np.bincount(pairs % buckets, minlength=buckets)
        other = np.bincount(np.unique(tokens.doc[~of_toxic].astype(np.int64) * buckets + column[~of_toxic]) % buckets, minlength=buckets)
        lift = (seen / n_toxic) / ((clean + 1.0) / n_clean)
        wide = (docs / max(int(toxic.sum()), 1)) / ((other + 1.0) / max(int((~toxic).sum()), 1))  # repetition in one text is no evidence
        good = (lift >= ratio) & (wide >= ratio / 2) & (docs >= least_docs)
        good[0] = False
        flagged |= good[column]
    return flagged & of_toxic


def fit_field(tokens: Tokens, label: np.ndarray, turns: int, l2: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Maximum likelihood by AdaGrad over all chains of the sample."""
    buckets, n = 1 << BITS, len(label)
    weights, trans, first = np.zeros(buckets), np.zeros((2, 2)), 0.0
    weights_sum, rest_sum = np.full(buckets, 1e-8), np.full(5, 1e-8)
    begin = np.diff(tokens.chain, prepend=-1) > 0
    pair = np.flatnonzero(~begin)
    true = np.zeros((2, 2))
    np.add.at(true, (label[pair - 1].astype(int), label[pair].astype(int)), 1)
    columns = list(tokens.features.T)
    for _ in range(turns):
        p, joint = marginals(scores_of(weights, tokens), tokens.chain, trans, first, pairs=True)
        error = label - p
        slope = sum(np.bincount(c, error, buckets) for c in columns) - l2 * weights
        slope[0] = 0.0
        weights_sum += slope**2
        weights += 0.5 * slope / np.sqrt(weights_sum)
        rest = np.append((true - joint[pair].sum(0)).ravel(), error[begin].sum()) - l2 * np.append(trans.ravel(), first)
        rest_sum += rest**2
        move = 0.5 * rest / np.sqrt(rest_sum)
        trans, first = trans + move[:4].reshape(2, 2), first + move[4]
    return weights, trans, first


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1.0, turns: int = 30) -> np.ndarray:
    """Weighted logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - l2 * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(id_column: Column) -> Column:
    """Rows whose label must not be learnt. A null id is not held out, and has no label."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_docs: int = 1000,
        train_chars: int = 30_000, ratio: float = 5.0, least_docs: int = 4, turns: int = 40, l2: float = 0.5) -> Model:
    """Fit on labelled documents that are not held out. Labels count only where `docs` has the document, not longer than `train_chars`: the sample is
    drawn among these, also when a stage gets few of the labelled documents."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    usable = docs.where(F.length(text_col) <= train_chars).select(id_col)
    known = known.groupBy(id_col).agg((F.max(label_col) == 1).alias("is_toxic")).join(usable, id_col, "left_semi")
    known = staged(known, "toxic-labels")
    totals = {r["is_toxic"]: r["count"] for r in known.groupBy("is_toxic").count().collect()}  # two rows
    wanted = None
    for kind in (True, False):  # ids of a bounded sample
        some = known.where(F.col("is_toxic") == kind).orderBy(F.xxhash64(id_col), id_col).limit(train_docs)
        wanted = some if wanted is None else wanted.unionByName(some)
    texts = docs.select(F.col(id_col), F.col(text_col).alias("text")).where(F.length("text") <= train_chars)
    found = staged(texts.join(F.broadcast(wanted), id_col), "toxic-sample")  # at most 2 * train_docs rows on the broadcast side
    rows = []
    for kind in (True, False):
        rows += found.where(F.col("is_toxic") == kind).orderBy(F.xxhash64(id_col), id_col, "text").limit(train_docs).collect()
    toxic = np.array([r["is_toxic"] for r in rows], bool)
    if not len(toxic) or toxic.all() or not toxic.any():
        share = totals.get(True, 0) / max(sum(totals.values()), 1)
        if totals:
            warnings.warn(f"labels of one class only ({totals}): every document scores {share}", stacklevel=2)
        return Model(np.zeros(0), np.zeros((2, 2)), 0.0, np.zeros(4), base=float(share))
    slices = [rows[k:k + 100] for k in range(0, len(rows), 100)]
    tokens = joined([tokens_of([small(r["text"]).encode("utf-8", "surrogatepass") for r in part]) for part in slices], [len(part) for part in slices])
    label = toxic_tokens(tokens, toxic, ratio, least_docs)
    weights, trans, first = fit_field(tokens, label.astype(float), turns, l2)
    p, _ = marginals(scores_of(weights, tokens), tokens.chain, trans, first)
    per_row = np.where(toxic, totals[True] / toxic.sum(), totals[False] / (~toxic).sum())
    logistic = fit_logistic(document_figures(p, tokens.doc, len(rows)), toxic.astype(float), per_row / per_row.mean())
    return Model(weights.astype(np.float32), trans, first, logistic)


def tag(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "toxicity", least: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (all, if none are given) with `out_col`: score, expected toxic words, spans with P of at least `least`."""
    ship_package(docs.sparkSession)
    names = keep if keep is not None else docs.columns
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField(out_col, RESULT)])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one weight for each of 2 ** BITS buckets, whatever the corpus

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                texts = part.column(text_col).to_pylist()
                p, tokens, expected, scores = shared.value.read(texts)
                spans: list[list[dict]] = [[] for _ in texts]
                found = np.flatnonzero(p >= least)
                if len(found):
                    encoded = [small(t or "").encode("utf-8", "surrogatepass") for t in texts]
                    offsets = np.cumsum([0, *[len(t) + 1 for t in encoded]])
                    for at in found.tolist():
                        doc = int(tokens.doc[at])
                        a, b = int(tokens.start[at] - offsets[doc]), int(tokens.stop[at] - offsets[doc])
                        first = len(encoded[doc][:a].decode("utf-8", "surrogatepass"))
                        spans[doc].append({"start": first, "stop": first + len(encoded[doc][a:b].decode("utf-8", "surrogatepass")), "p": float(p[at])})
                result = pa.array([{"score": float(s), "n_toxic": float(e), "spans": x} for s, e, x in zip(scores, expected, spans)], RESULT_ARROW)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], result], names=[*names, out_col])

    return docs.mapInArrow(read, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, with all their columns, that score less than `threshold`."""
    model = fit(docs, labels, id_col, text_col, **options)
    mark = fresh_name(docs, "toxicity")
    return tag(docs, model, text_col, mark).where(F.col(f"{mark}.score") < threshold).select(*[f"`{c}`" for c in docs.columns])
