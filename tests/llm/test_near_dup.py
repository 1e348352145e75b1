import re

import numpy as np
from pyspark.sql import functions as F

from creaseline.llm import near_dup
from tests.llm import cases


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute(rows, width):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    out = []
    for k, (i, _) in enumerate(rows):
        least = min((rows[j][0] for j in range(len(rows)) if root[j] == root[k] and rows[j][0] is not None), default=None) if sets[k] else i
        out.append((i, len(sets[k]), least, i == least))
    return sorted(out, key=repr)


def check(spark, rows, width):
    got = near_dup.link(cases.documents(spark, rows), width=width).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, width)


def test_edge_cases_against_brute_force(spark):
    check(spark, cases.DOCS, 2)


def test_chains_stars_and_small_sets_against_brute_force(spark, monkeypatch):
    """Chains whose ends do not match, families larger than a block, sets of four and five shingles."""
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rng = np.random.default_rng(1)
    rows = []
    words = [f"v{k}" for k in range(300)]
    text = [words[k] for k in rng.integers(0, 300, 60)]
    for k in range(40):  # each differs from the one before by one word
        text = list(text)
        text[int(rng.integers(0, 60))] = f"new{k}"
        rows.append((100 + k, " ".join(text)))
    base = [words[k] for k in rng.integers(0, 300, 80)]
    for k in range(40):  # each differs from the base by three words
        own = list(base)
        for at in rng.integers(0, 80, 3):
            own[int(at)] = f"star{k}x{at}"
        rows.append((int(1000 - k), " ".join(own)))
    rows += [(2000, "a b c d e"), (2001, "a b c d e f"), (2002, "a b c d"), (2003, "b c d e f"), (2004, "A B C D E"), (2005, "of the x"), (2006, "of the y")]
    check(spark, rows, 2)


def test_long_lists_against_brute_force(spark, monkeypatch):
    """Lists of classes that agree with the first one, with each other only, through a chain, and not at all; blocks of three."""
    monkeypatch.setattr(near_dup, "LIST_BLOCK", 3)
    rng = np.random.default_rng(5)
    rows = []
    for family in range(3):
        base = [f"f{family}w{k}" for k in range(90)]
        for k in range(25):
            own = list(base)
            for at in rng.integers(0, 90, int(rng.integers(0, 14))):
                own[int(at)] = f"f{family}x{k}y{at}"
            rows.append((family * 100 + k, " ".join(own)))
    text = [f"c{k}" for k in range(70)]
    for k in range(30):
        text = list(text)
        text[int(rng.integers(0, 70))] = f"new{k}"
        rows.append((500 + k, " ".join(text)))
    check(spark, rows, 2)


def test_a_long_list_that_agrees_makes_no_rows(spark, monkeypatch):
    """And with m classes beside n that agree, n and m rows a block of the others, not n * n / block."""
    monkeypatch.setattr(near_dup, "LIST_BLOCK", 50)
    made = {}
    for others in (0, 40):
        sigs = [(k, [1] * near_dup.COORDINATES, 100) for k in range(1000)] + [(1000 + k, [1] * 8 + [100 + k] * 24, 100) for k in range(others)]
        classes = spark.createDataFrame(sigs, "cid bigint, sig array<int>, n_shingles bigint")
        prefix = classes.select("cid", F.lit(7).cast("bigint").alias("list"))
        edges, rows = near_dup.long_lists(prefix, spark.createDataFrame([(7, 0)], "list bigint, head bigint"), classes, 80)
        assert {(r["a"], r["b"]) for r in edges.collect()} == {(0, k) for k in range(1, 1000)}
        made[others] = rows.count()
        found = near_dup.family_edges(prefix, classes, 80)
        assert near_dup.components(found).count() == 999
    assert made == {0: 0, 40: 40 + 1000 + 40 * 21}


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(20)] + [(50, 40), (40, 45), (60, 60)], "a bigint, b bigint")
    assert dict(map(tuple, near_dup.components(edges).collect())) == {**{k: 0 for k in range(1, 21)}, 45: 40, 50: 40}


def test_keep_one_keeps_columns(spark):
    docs = cases.documents(spark)
    kept = near_dup.keep_one(docs, width=2)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {1, 4, 5, 6, 7, 8, 10, 12, 14, 15, None} <= ids and not ids & {2, 3, 9, 11, 13}


def test_empty_table(spark):
    assert near_dup.link(cases.nothing(spark)).collect() == []


def test_stream_groups_span_batches():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"k": k, "v": k}) for k in ([1, 1, 2], [2], [], [2, 3])]
    assert [t.column("v").to_pylist() for t in near_dup.streamed(iter(batches), ["k"])] == [[1, 1], [2, 2, 2], [3]]
