import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from creaseline.llm import toxicity
from creaseline.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm import cases, test_decontaminate, test_exact_dedup, test_near_dup


def test_stages_against_brute_force(spark):
    """Each stage on what the one before kept; the model's decisions are taken from the model itself."""
    docs, items = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark").collect()
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)

    model = toxicity.fit(docs, table(spark, SF_SMALL, "labels"))
    scores = model.read(list(rows.values()))[3]
    want = {i for i, s in zip(rows, scores) if s < 0.7}
    kept = stage["toxicity"](spark, docs, SF_SMALL).cache()
    assert {r["doc_id"] for r in kept.collect()} == want and kept.columns == docs.columns

    want = {r[0] for r in test_exact_dedup.brute([(i, rows[i]) for i in want]) if r[3]}
    kept = stage["exact_dedup"](spark, kept, SF_SMALL).cache()
    assert {r["doc_id"] for r in kept.collect()} == want

    want = {r[0] for r in test_near_dup.brute([(i, rows[i]) for i in sorted(want)], 5) if r[3]}
    kept = stage["near_dedup"](spark, kept, SF_SMALL).cache()
    assert {r["doc_id"] for r in kept.collect()} == want

    grams = set()
    for item in items:
        w = test_decontaminate.words(item["text"])
        grams |= {tuple(w[k:k + 10]) for k in range(max(len(w) - 10, 0) + 1)} if w else set()
    sizes = {len(g) for g in grams}
    words = {i: test_decontaminate.words(rows[i]) for i in want}
    want = {i for i, w in words.items() if not any(tuple(w[k:k + n]) in grams for n in sizes for k in range(len(w) - n + 1))}
    kept = stage["decontamination"](spark, kept, SF_SMALL).cache()
    assert {r["doc_id"] for r in kept.collect()} == want and kept.columns == docs.columns

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = stage["packing"](spark, kept, SF_SMALL).toPandas()
    assert pieces.groupby("doc_id")["length"].sum().to_dict() == {i: len(exact.encode(rows[i] or "", add_special_tokens=False).ids) + 1 for i in want}


def test_edge_cases_pass_all_stages(spark):
    rows = cases.documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = rows.columns
        rows = stage(spark, rows, SF_SMALL).cache()
        assert rows.columns == columns
    assert {r["doc_id"] for r in rows.collect()} >= {1, 4, 5, 12, 14}
    assert corpus_pipeline.STAGES[-1][1](spark, rows, SF_SMALL).count() > rows.count()


def test_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, cases.nothing(spark), SF_SMALL).collect() == []
