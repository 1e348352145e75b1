import re

import numpy as np
import pyarrow as pa

from creaseline.llm import line_dedup
from tests.llm import cases


def brute(rows):
    lines = []
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            words = frozenset(re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in line)))
            lines.append(((i is None, i or 0, k), i, k, words))
    first = {}
    for at, *_, w in sorted(lines, key=lambda x: x[0]):
        if w:
            first.setdefault(w, at)
    sets = list(first)
    match = {w: [v for v in sets if v != w and 100 * len(v & w) >= 80 * len(v | w)] for w in sets}
    out = []
    for at, i, k, w in lines:
        f = first.get(w)
        kept = f is None or (at == f and not any(first[v] < f for v in match[w]))
        out.append((i, k, len(w), None if f is None or f[0] else f[1], f[2] if f else None, len(match.get(w, [])), kept))
    return sorted(out, key=repr)


def check(spark, rows):
    got = line_dedup.matches(cases.documents(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_edge_cases_against_brute_force(spark):
    check(spark, cases.DOCS)


def test_families_and_common_words_in_blocks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LIST_BLOCK", 6)
    monkeypatch.setattr(line_dedup, "FAMILY_BLOCK", 8)
    monkeypatch.setattr(line_dedup, "SKETCH_BLOCK", 16)
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(12)]
    rows = [(k, "\n".join(" ".join(words[j] for j in rng.permutation(12)[:rng.integers(1, 12)]) for _ in range(3))) for k in range(25)]
    base = [f"b{k}" for k in range(40)]
    for k in range(30):
        own = list(base)
        for at in rng.integers(0, 40, 3):
            own[int(at)] = f"z{k}"
        rows.append((100 - k, " ".join(own)))
    check(spark, rows)


def test_long_lines_that_share_a_rare_word_are_parted(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FAMILY_BLOCK", 8)
    rng = np.random.default_rng(7)
    rows = []
    for k in range(24):
        words = [f"v{j}" for j in rng.choice(4000, 300 + 4 * k, replace=False)] + ["rare"]
        rows.append((2 * k, " ".join(words)))
        if k % 3 == 0:
            rows.append((2 * k + 1, " ".join([*words[30:], "more"])))
    check(spark, rows)


def test_remove_later_keeps_columns(spark):
    docs = cases.documents(spark, [(2, "same line of words\n\nown"), (1, "Same  line OF words\nother"), (3, "own\nother"), (4, None)])
    out = line_dedup.remove_later(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "Same  line OF words\nother", 2: "\nown", 3: "", 4: None}


def test_empty_table(spark):
    assert line_dedup.matches(cases.nothing(spark)).collect() == []


def test_each_pair_of_sketches_is_compared_once():
    """Classes of the next band meet in a group of their own, not also in that of the band before."""
    def edges(own, side):
        sketch = np.packbits(np.arange(line_dedup.SKETCH_BITS) % 20 == 0).tobytes()
        group = pa.table({"cid": [1, 2, 3], "n": [100, 101, 102], "side": side, "sketch": [sketch] * 3, "own": own})
        return sorted((a, b) for out in line_dedup.near_sketches(group, 80) for a, b in zip(*(out.column(c).to_pylist() for c in "ab")))

    assert edges([False] * 3, [2] * 3) == [] and edges([True, False, False], [2] * 3) == edges([True] * 3, [2] * 3) == [(1, 2), (1, 3)]
    assert edges([True] * 3, [0, 0, 1]) == [(1, 2), (1, 3)]
    assert edges([True] * 3, [0] * 3) == []


def test_lists_are_sorted_by_one_number(spark):
    posts = spark.createDataFrame([], ", ".join(f"{c} bigint" for c in line_dedup.POSTING))
    plan = line_dedup.candidate_edges(posts, 80)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Sort \[list#\d+L ASC NULLS FIRST\], false", plan), plan


def test_words_have_one_hash_and_one_key_wherever_they_stand():
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in [*range(1, 40), 1023, 1024, 1025, 5000]] + ["a\0", "a\0\0", "\0", "x" * 8, "x" * 8 + "\0", "x" * 16, "é", "è"]
    _, number, line, one = line_dedup.line_words([" ".join(words) + "\n" + "\t".join(reversed(words)), *words])
    k = len(words)
    assert len(set(one[:k].tolist())) == k and one[:k].tolist() == one[k:2 * k].tolist()[::-1] == one[2 * k:].tolist()
    assert number.tolist() == [0, 1] + [0] * k
    line, one = line_dedup.distinct_words(line, one)
    size, cid, rest = line_dedup.keyed(line, one, k + 2)
    assert size.tolist() == [k, k] + [1] * k and cid[0] == cid[1] and rest[0] == rest[1] and len(set(cid.tolist())) == k + 1


def test_distinct_words_against_numpy():
    """Words that share their upper 48 bits, and lines beyond 16 bits."""
    rng = np.random.default_rng(5)
    for lines, top in ((50, 48), (50, 8), (70_000, 8)):
        line = np.sort(rng.integers(0, lines, 4000))
        words = (rng.integers(0, 3, 4000).astype(np.uint64) << np.uint64(top)) + rng.integers(0, 2, 4000).astype(np.uint64)
        got = line_dedup.distinct_words(line, words)
        assert sorted(set(zip(line.tolist(), words.tolist()))) == sorted(zip(got[0].tolist(), got[1].tolist())) and (np.diff(got[0]) >= 0).all()


def test_pairs_are_counted_like_other_groups():
    rng = np.random.default_rng(6)
    for k in range(200):
        a = np.unique(rng.integers(0, 12, 10)).astype(np.uint64)
        b = a[int(rng.integers(0, 3)):] if k % 2 else np.unique(rng.integers(0, 12, 10)).astype(np.uint64)
        side = [[2, 2], [0, 1], [1, 0], [0, 0]][k % 4]
        group = pa.table({"cid": [1, 2], "rest": [3, 4], "side": side, "first_null": [False, k % 5 == 0], "first_id": [k % 3, 1], "first_line": [0, k % 2], "words": [a.tobytes(), b.tobytes()]})
        want = [row for out in line_dedup.counted(group, 80) for row in zip(*(c.to_pylist() for c in out.columns))]
        if group.select(["first_null", "first_id", "first_line"]).to_pylist()[0] != group.select(["first_null", "first_id", "first_line"]).to_pylist()[1]:
            assert line_dedup.counted_pair(group, 80) == want


def test_postings_travel_in_few_rows(spark):
    """One row for each group of lists that a task has, not one a posting; groups hold whole lists, and their numbers are dealt in turn."""
    rows = [(k, "\n".join(" ".join(f"w{(k * 7 + j * 3 + m) % 50}" for m in range(12)) for j in range(5))) for k in range(40)]
    docs = cases.documents(spark, rows).coalesce(1)
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = line_dedup.postings(docs, np.full(1 << line_dedup.COUNTER_BITS, 2, np.uint32), 80, "text").collect()
    posts = [np.frombuffer(r["posts"], np.int64).reshape(-1, line_dedup.PARTS) for r in out]
    groups = -(-((2 << line_dedup.COUNTER_BITS) * 20 // (100 * line_dedup.ROWS) + 1) // dealt) * dealt
    assert len({r["list"] for r in out}) == len(out) and max(r["list"] for r in out) < groups and sum(map(len, posts)) > 5 * len(out)
    where = {}
    for r, held in zip(out, posts):
        for name in (held[:, 0] >> (64 - line_dedup.LIST_BITS)).tolist():
            assert where.setdefault(name, r["list"]) == r["list"]


def test_only_lines_where_a_class_occurs_first_are_parsed(spark):
    docs = cases.documents(spark, [(k, "\n".join(f"line {j} of {k}" for j in range(20))) for k in range(20)] + [(None, "no id\nat all")])
    wanted = spark.createDataFrame([(3, 4), (7, 0), (None, 1)], "first_id bigint, first_line bigint")
    sieve = line_dedup.sieve_of(wanted)
    assert int(np.bitwise_count(sieve).sum()) == 3
    ids = docs.selectExpr("xxhash64(doc_id) AS place", "text").toArrow().combine_chunks().to_batches()[0]
    assert sorted(line_dedup.sieved(ids, sieve)) == ["at all", "line 0 of 7", "line 4 of 3"]
    assert line_dedup.words_of(docs, wanted, "doc_id", "text").count() == 3


def test_ids_that_repeat_with_other_texts(spark):
    """Where a class occurs first may name lines of several rows."""
    words = [f"w{k}" for k in range(20)]
    near = [" ".join(words[:20 - k]) for k in range(4)]
    check(spark, [(1, near[0] + "\nx"), (1, near[1] + "\ny\n" + near[2]), (None, near[3]), (None, "z " + near[0]), (2, near[3] + "\n\n" + near[0]), (2, None)])


def test_orders_and_maps_against_numpy():
    rng = np.random.default_rng(8)
    for lines, n in ((1, 50), (40, 3000), (70_000, 3000), (1 << 40, 3000), (5, 0)):
        line, words = line_dedup.distinct_words(np.sort(rng.integers(0, lines, n)), rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        seen = rng.integers(0, 3, len(line)).astype(np.uint32)
        got = line_dedup.by_rarity(line, words, seen)
        assert (got == np.lexsort((words, seen, line))).all()
    line = np.sort(rng.integers(0, 40, 300)) * 2
    words = rng.integers(0, 2**63, 300).astype(np.uint64) * np.uint64(2)
    want = np.zeros((90, 2), np.uint64)
    for at, word in zip(line.tolist(), words.tolist()):
        want[at, word >> 63] |= np.uint64(1 << (word >> 57 & 63))
    assert (line_dedup.maps_of(line, words, 90) == want).all()


def test_wide_and_narrow_sketches_against_all_pairs():
    rng = np.random.default_rng(9)
    n = np.sort(rng.integers(line_dedup.WIDE - 60, line_dedup.WIDE + 60, 60))
    base = rng.random((6, line_dedup.SKETCH_BITS)) < 0.3
    bits = base[rng.integers(0, 6, 60)] ^ (rng.random((60, line_dedup.SKETCH_BITS)) < rng.choice([0.02, 0.04, 0.06, 0.1], 60)[:, None])
    group = pa.table({"cid": np.arange(60), "n": n, "side": [2] * 60, "sketch": [np.packbits(b).tobytes() for b in bits], "own": [True] * 60})
    got = [e for out in line_dedup.near_sketches(group, 80) for e in zip(*(out.column(c).to_pylist() for c in "ab"))]
    pairs = [(i, j) for i in range(60) for j in range(i + 1, 60) if 80 * n[j] <= 100 * n[i] and 180 * (bits[i] ^ bits[j]).sum() <= 20 * (n[i] + n[j])]

    def parts(edges):
        root = list(range(60))
        for a, b in edges:
            old, new = root[b], root[a]
            root = [new if r == old else r for r in root]
        return [root.index(r) for r in root]

    assert pairs and parts(got) == parts(pairs)
