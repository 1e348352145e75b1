import hashlib
import re
from collections import defaultdict
from math import floor

import pytest
from pyspark.sql import functions as F

from creaseline.llm import mixing
from tests.llm import cases


def aims(sizes, weights=(5, 2, 1), repeats=3):
    """Deal, close what is over, deal the rest again."""
    total = sum(sizes.values())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[k % len(weights)]) for k, s in enumerate(names)}
    closed = set()
    while True:
        free = [s for s in names if s not in closed]
        each = (total - sum(repeats * sizes[s] for s in closed)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if repeats * sizes[s] <= weight[s] * each}
        if not over:
            return {s: float(repeats * sizes[s]) if s in closed else weight[s] * each for s in names}
        closed |= over


def brute(rows, seed=""):
    docs = defaultdict(list)
    for i, source, text in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        docs[source].append((hashlib.md5((seed + ("null" if i is None else str(i))).encode()).hexdigest(), i is None, i or 0, size))
    sizes = {s: sum(d[3] for d in found) for s, found in docs.items()}
    target = aims(sizes)
    out = []
    for source, found in docs.items():
        done = 0
        for _, none, i, size in sorted(found):
            taken = sum(min(size, max(0, floor(target[source]) - turn * sizes[source] - done)) for turn in range(3))
            out.append((None if none else i, size, sizes[source], target[source], taken))
            done += size
    return sorted(out, key=repr)


def run(spark, rows, seed="", parts=5):
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(parts)
    docs = docs.withColumns({c: F.lit("x") for c in [*cases.CLASHING, "key", "size", "row_no", "target", "id"]})
    return mixing.mix(docs, seed=seed)


def sources(n, seed):
    return [(k, [None, "a", "b", "ß", "Z", "aa", ""][(k * k + seed) % 7 if k % 3 else 1], cases.sentence(k, (k * 37 + seed) % 60)) for k in range(n)]


@pytest.mark.parametrize("n", [1, 40, 400])
def test_against_brute_force(spark, n):
    rows = sources(n, 3)
    got = run(spark, rows, "s").select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, "s")


def test_targets_are_met_and_places_have_no_gap(spark):
    rows = sources(400, 5) + [(1000 + k, "tiny", "just three words") for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = mixing.mix(docs).collect()
    by_source, target = defaultdict(int), {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        source = next(s for i, s, _ in rows if i == r["doc_id"])
        by_source[source] += r["taken"]
        target[source] = r["target"]
    assert all(abs(by_source[s] - target[s]) < 1 for s in target) and by_source["tiny"] == 18
    served = sorted(map(tuple, mixing.schedule(docs)[0].select("first_word", "words", "finish").collect()))
    assert all(a[0] + a[1] == b[0] and a[2] <= b[2] for a, b in zip(served, served[1:]))
    assert sum(r["size"] for r in got) - len(target) < served[-1][0] + served[-1][1] <= sum(r["size"] for r in got)
    half = len(served) // 2  # at any time the sources are served at their rates
    assert served[half][0] == pytest.approx(served[half][2] * served[-1][0], rel=0.05)


def test_reruns_and_partitions_agree(spark):
    rows = sources(300, 1)
    assert sorted(run(spark, rows, parts=1).collect(), key=repr) == sorted(run(spark, rows, parts=7).collect(), key=repr)


def test_edge_cases(spark):
    rows = [(i, ["a", None, "b"][n % 3], t) for n, (i, t) in enumerate(cases.DOCS)]
    got = run(spark, rows).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert run(spark, []).collect() == []
    empty = run(spark, [(1, "a", None), (2, None, " ")]).collect()
    assert sorted(tuple(r) for r in empty) == [(1, 0, 0, 0.0, 0, None), (2, 0, 0, 0.0, 0, None)]
