import hashlib
import random
import zlib

import numpy as np
import pytest

from creaseline.llm import periodic_runs
from creaseline.llm.common import table
from creaseline.llm.queries import op12_periodic_runs
from tests.conftest import SF_SMALL
from tests.llm import cases


def brute(w, least=6, exponent=4):
    """Every maximal stretch of each period, the smallest period of each extent."""
    n, out = len(w), {}
    for q in range(1, n // exponent + 1):
        k = 0
        while k < n - q:
            if w[k] != w[k + q]:
                k += 1
                continue
            start = k
            while k < n - q and w[k] == w[k + q]:
                k += 1
            if k + q - start >= max(least, exponent * q):
                out.setdefault((start, k + q - start), q)
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def runs(texts):
    return [[tuple(r) for r in found.tolist()] for found in periodic_runs.find_runs([np.array(t, np.int64) for t in texts])]


def random_texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        text = []
        while len(text) < rng.choice([0, 3, 20, 80, 200]):
            unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 9))]
            text += unit * rng.randrange(1, 12) + unit[:rng.randrange(len(unit) + 1)]
            if rng.random() < 0.3:
                text += text[-rng.randrange(1, len(text) + 1):] * rng.randrange(1, 5)
        yield text[:600]


@pytest.mark.parametrize("seed", range(12))
def test_batches_against_brute_force(seed):
    texts = list(random_texts(seed, 40))
    assert runs(texts) == [brute(t) for t in texts]


def test_known_runs():
    assert runs([[7] * 6, [7] * 5, [1, 2] * 4, [1, 2, 1, 2, 1, 2, 1], [], [1, 2, 3] * 4 + [1]]) == [[(0, 6, 1)], [], [(0, 8, 2)], [], [], [(0, 13, 3)]]


def test_extensions_against_word_by_word_comparison():
    rng = random.Random(5)
    words = [rng.randrange(2) for _ in range(300)] * 3 + [0] * 200 + [0, 1] * 100
    joined, ends = periodic_runs._joined([np.array(words, np.int64), np.array([0, 1, 1], np.int64)])
    fixed = np.zeros(len(joined), bool)
    fixed[ends - 1] = True
    grammar = periodic_runs.Grammar(joined, fixed)
    assert len(grammar.symbols[-1]) < 12
    a = np.array([rng.randrange(len(words) - 1) for _ in range(3000)])
    b = np.array([rng.randrange(x + 1, len(words)) for x in a])
    after, before = grammar.extend(a, b, back=False), grammar.extend(a, b, back=True)
    for x, y, f, g in zip(a, b, after, before):
        k = 0
        while y + k < len(words) and words[x + k] == words[y + k]:
            k += 1
        assert f == k
        k = 0
        while x - k > 0 and words[x - k - 1] == words[y - k - 1]:
            k += 1
        assert g == k


def test_long_texts():
    one = [3] * 100_000
    nested = (([1, 2] * 6 + [5]) * 40 + [9]) * 60
    assert runs([one, nested, list(range(150_000))])[0] == [(0, 100_000, 1)]
    got = runs([nested])[0]
    assert (0, len(nested), 13 * 40 + 1) in got and sum(1 for r in got if r[2] == 2) == 2400


def want(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    found = brute(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in found), default=None)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest()
    first = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *first, digest, hashlib.sha256(kept).hexdigest())


def test_query_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF_SMALL, "documents").collect()}
    got = op12_periodic_runs(spark, SF_SMALL).collect()
    short = {i for i, t in docs.items() if len((t or "").split()) < 1500}
    assert len(got) == len(docs) and len(short) > 150
    assert any(r["n_runs"] for r in got)
    for r in got:
        if r["doc_id"] in short:
            assert tuple(r) == want(r["doc_id"], docs[r["doc_id"]])


def test_edge_cases(spark):
    rows = [*cases.DOCS, (20, "go " * 50), (20, "go " * 50), (21, "a\x1cb " * 9), (22, "x y z\n" * 7), (23, "no no no no no"), (24, "é " * 6)]
    got = periodic_runs.find(cases.documents(spark, rows), ["doc_id", "kept"]).collect()
    assert len(got) == len(rows) and {r["kept"] for r in got} == {"extra kept"}
    texts = {}
    for i, t in rows:
        w = (t or "").encode().split()
        texts.setdefault(i, []).append((len(w), brute(w) if len(w) < 5000 else []))
    seen = {}
    for r in got:
        seen.setdefault(r["doc_id"], []).append((r["found"]["n_words"], [tuple(x) for x in r["found"]["runs"]]))
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in texts.items()}
    by_id = {r["doc_id"]: r["found"]["collapsed"] for r in got}
    assert by_id[20] == "go" and by_id[21] == "a\x1cb" and by_id[23] == "no no no no no" and by_id[5] == "" and by_id[22] == "x y z"
    assert periodic_runs.find(cases.nothing(spark), ["doc_id"]).collect() == []
