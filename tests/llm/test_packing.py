import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from creaseline.llm import packing
from tests.llm import cases

TEXTS = [*cases.DOCS, (20, "a <|endoftext|> b"), (21, "two  blanks   three\n\n end "), (22, " lead"), (23, " odd space \u0085x"), (24, "it's 1234 they'll"), (25, "x" * 5000)]


@pytest.fixture(scope="module")
def ids():
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*exact.encode(text or "", add_special_tokens=False).ids, 2]


def test_pieces_have_the_tokenizers_ids(spark, ids):
    rows = packing.pack_documents(cases.documents(spark, TEXTS), with_ids=True).collect()
    want = []
    for i, text in TEXTS:
        tokens = ids(text)
        cuts = [0, *range(len(tokens) % 1024 or 1024, len(tokens) + 1, 1024)]
        want += [(i, k, a, b - a, tokens[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], list(r["ids"])) for r in rows), key=repr) == sorted(want, key=repr)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)


def test_sequences_are_gapless_and_within_capacity(spark, ids):
    packed = packing.pack_documents(cases.documents(spark, TEXTS), with_ids=True, partition_pieces=5).cache()
    by_sequence = {}
    for r in packed.collect():
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], list(r["ids"])))
    for parts in by_sequence.values():
        parts.sort()
        assert [p[0] for p in parts] == [0, *np.cumsum([p[1] for p in parts])[:-1]] and sum(p[1] for p in parts) <= 1024
    whole = {r["sequence_id"]: list(r["ids"]) for r in packing.sequences(packed).collect()}
    assert whole == {k: [t for p in v for t in p[2]] for k, v in by_sequence.items()}


def test_empty_table(spark):
    assert packing.pack_documents(cases.nothing(spark)).collect() == []


def test_partitions_with_gaps_exchange_pieces(spark):
    """The exchange saves sequences, and the total comes near the bound of all pieces."""
    docs = spark.range(8000).selectExpr("id AS doc_id", "repeat(' a', int(20 + pmod(hash(id), 900))) AS text")
    pieces = packing.tokenize(docs).cache()
    made = {rounds: packing.pack(pieces, partition_pieces=2000, rounds=rounds).toPandas() for rounds in (1, 4)}
    used = {rounds: p["sequence_id"].nunique() for rounds, p in made.items()}
    bound = packing.lower_bound(np.bincount(made[4]["length"], minlength=1025), 1024)
    assert bound <= used[4] < used[1] and used[4] <= 1.005 * bound
    placed = made[4].sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id")["length"].cumsum() - placed["length"] == placed["offset"]).all() and len(placed) == 8000


def test_small_partitions_and_certificates(spark):
    """Partitions of 400 pieces; each sequence has the gap of the partition that closed it, as counted again from its pieces."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat(' a', int(20 + pmod(hash(id), 900))) AS text")
    packed = packing.pack_documents(docs, partition_pieces=400).cache()
    pieces = packed.toPandas()
    used, needed = packing.certificate(packed)
    bound = packing.lower_bound(np.bincount(pieces["length"], minlength=1025), 1024)
    assert used == pieces["sequence_id"].nunique() and needed == math.ceil(bound - 1e-6) and needed <= used <= 1.015 * needed
    assert pieces.groupby("sequence_id")[["round", "part", "gap"]].nunique(dropna=False).max().max() == 1
    last = pieces[pieces["round"] == pieces["round"].max()]
    assert len(last)
    for _, rows in last.groupby("part"):  # a last round keeps all its pieces
        again = rows["sequence_id"].nunique() - packing.lower_bound(np.bincount(rows["length"], minlength=1025), 1024)
        assert abs(again - rows["gap"].iloc[0]) < 1e-6 and rows["gap"].nunique() == 1


def test_whole_pieces_are_certified_and_an_empty_table_needs_nothing(spark):
    long = packing.pack_documents(spark.createDataFrame([(1, " a" * 2047)], "doc_id bigint, text string"))
    assert {(r["round"], r["part"], r["gap"]) for r in long.collect()} == {(0, None, 0.0)} and packing.certificate(long) == (2, 2)
    assert packing.certificate(packing.pack_documents(cases.nothing(spark))) == (0, 0)


def best(lengths, capacity):
    """The smallest number of bins, by trying all."""
    def search(rest, bins, top):
        if len(bins) >= top:
            return top
        if not rest:
            return len(bins)
        for k in range(len(bins)):
            if bins[k] + rest[0] <= capacity and bins[k] not in bins[:k]:
                top = min(top, search(rest[1:], [*bins[:k], bins[k] + rest[0], *bins[k + 1:]], top))
        return min(top, search(rest[1:], [*bins, rest[0]], top))
    return search(sorted(lengths, reverse=True), [], len(lengths) + 1)


def test_bound_never_exceeds_the_best_packing():
    rng = np.random.default_rng(3)
    tight = 0
    for _ in range(150):
        lengths = rng.integers(1, 21, rng.integers(1, 10))
        bound = packing.lower_bound(np.bincount(lengths, minlength=21), 20)
        least = best(lengths.tolist(), 20)
        assert math.ceil(bound - 1e-9) <= least <= len(packing.best_fit(lengths, 20)[2])
        tight += math.ceil(bound - 1e-9) == least
    assert tight > 130
    assert packing.lower_bound(np.bincount([11] * 6, minlength=21), 20) == 6  # the sum alone says 4
