import hashlib

from pyspark.sql import functions as F

from creaseline.llm import merkle
from tests.llm import cases


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """(root, path of (left, right) for each node)."""
    ways = [[] for _ in nodes]
    under = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, up_under = [], []
        for s in range(0, len(nodes), 8):
            run = nodes[s:s + 8]
            for k in range(len(run)):
                for d in under[s + k]:
                    ways[d].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(H(*run))
            up_under.append([d for k in range(len(run)) for d in under[s + k]])
        nodes, under = up, up_under
    return nodes[0], ways


def brute(rows, changed):
    """rows of (doc_id, source, lang, n_chars, text) -> sorted expected rows."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row, leaf(row), leaf(changed(row))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda e: (e[0][0] is not None, e[0][0] or 0, e[1]))
    trees = {g: tree([e[1] for e in groups[g]]) for g in names}
    root, tops = tree([trees[g][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for (row, digest, received), way in zip(groups[g], trees[g][1]):
            way, node = way + tops[at], received
            for left, right in way:
                node = H(left, node, right)
            out.append((row[0], digest, trees[g][0], root, H(*[a + b for a, b in way]), node, node == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def run(spark, rows, parts=5):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumns({c: F.lit("x") for c in [*cases.CLASHING, "key", "at", "n", "node", "path", "id"]})
    odd = F.col("doc_id") % 3 == 0
    text = F.when(odd, merkle.ascii_lower(F.col("text"))).otherwise(F.col("text"))
    got = merkle.manifest(docs, altered={"text": text}).drop("path")
    return sorted(map(tuple, got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def lowered(row):
    if row[0] is None or row[0] % 3 or row[4] is None:
        return row
    return (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))


def test_groups_of_all_sizes_against_brute_force(spark):
    sizes = {None: 1, "": 8, "a": 9, "é": 65, "z": 130, "Z": 2, "d": 1, "e": 64, "f": 3, "g": 10}
    rows = [(n * 1000 + k, f"s{k % 3}", lang, k if k % 5 else None, f"Text {k} ÄÉ Big" if k % 7 else None)
            for n, (lang, size) in enumerate(sizes.items()) for k in range(size)]
    want = brute(rows, lowered)
    assert run(spark, rows) == want
    assert {w[6] for w in want} == {True, False}
    assert run(spark, rows, parts=1) == want


def test_edge_cases_against_brute_force(spark):
    rows = [(i, "s", "en" if n % 2 else None, n, t) for n, (i, t) in enumerate(cases.DOCS)]
    rows += [(4, "s", "en", 1, "Same")] * 20 + [(None, None, None, None, None)] * 3 + [(4, "s", "en", 1, "Other")]
    assert run(spark, rows) == brute(rows, lowered)


def test_small_tables(spark):
    assert run(spark, []) == []
    one = [(3, None, None, 1, "One")]
    assert run(spark, one) == brute(one, lowered)
    two = [(1, "a", "x", 1, "One"), (2, "a", "y", 1, "Two")]
    assert run(spark, two) == brute(two, lowered)


def test_proofs_find_any_changed_field(spark):
    rows = [(k, "s", "en", k, f"text {k}") for k in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    same = merkle.manifest(docs)
    assert same.where("verified").count() == 30
    for name, value in {"n_chars": F.lit(5).cast("bigint"), "source": F.lit(None).cast("string")}.items():
        got = {r["doc_id"]: r["verified"] for r in merkle.manifest(docs, altered={name: value}).collect()}
        assert got == {k: name == "n_chars" and k == 5 for k in range(30)}
