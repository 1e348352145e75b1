import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from creaseline.llm import toxicity
from creaseline.llm.queries import op7_toxicity
from tests.llm import cases

SF_LEARN = "/root/testdata/sf0.01"


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(5)
    for sizes in ([4], [1, 3, 2], [5, 1]):
        chain = np.repeat(np.arange(len(sizes)), sizes)
        score, trans, first = rng.normal(size=len(chain)), rng.normal(size=(2, 2)), float(rng.normal())
        p, joint = toxicity.marginals(score, chain, trans, first, pairs=True)
        for c in range(len(sizes)):
            at = np.flatnonzero(chain == c)
            total, hit, pair = 0.0, np.zeros(len(at)), np.zeros((len(at), 2, 2))
            for y in itertools.product((0, 1), repeat=len(at)):
                w = np.exp(first * y[0] + sum(score[a] * v for a, v in zip(at, y)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
                total += w
                hit += w * np.array(y)
                for k in range(1, len(at)):
                    pair[k, y[k - 1], y[k]] += w
            assert np.allclose(p[at], hit / total) and np.allclose(joint[at[1:]], pair[1:] / total)


def test_gradient_of_the_field_rises_the_likelihood():
    texts = [b"good words here. bad badness there", b"fine. bad bad"] * 5
    tokens = toxicity.tokens_of(texts)
    label = np.array([texts[d][a - 0:b].startswith(b"bad") if d == 0 else 0 for d, a, b in zip(tokens.doc, tokens.start, tokens.stop)], float)
    weights, trans, first = toxicity.fit_field(tokens, label, 60, 0.01)
    p, _ = toxicity.marginals(weights[tokens.features].sum(1), tokens.chain, trans, first)
    assert np.abs(p - label)[tokens.doc == 0].mean() < 0.35


def test_tokens_and_offsets():
    tokens = toxicity.tokens_of(["é1 b".encode(), b"", b"c. d\ne"])
    assert tokens.doc.tolist() == [0, 0, 2, 2, 2] and tokens.chain.tolist() == [0, 0, 1, 2, 3]
    assert toxicity.small("İX") == "İx"


@pytest.fixture(scope="module")
def learnt(spark):
    docs, labels = spark.read.parquet(f"{SF_LEARN}/documents.parquet"), spark.read.parquet(f"{SF_LEARN}/labels.parquet")
    return toxicity.fit(docs, labels)


def test_held_out_accuracy(spark):
    got = op7_toxicity(spark, SF_LEARN).join(spark.read.parquet(f"{SF_LEARN}/labels.parquet"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert ((held["predicted"] == 1) == (held["toxic"] == 1)).mean() > 0.94
    assert held.loc[held["toxic"] == 1, "score"].mean() > 5 * held.loc[held["toxic"] == 0, "score"].mean()


def test_edge_cases_and_columns(spark, learnt):
    docs = cases.documents(spark, [*cases.DOCS, (30, "An idiot and a MORON, scum. Ça! trash")])
    got = toxicity.tag(docs, learnt, out_col="found")
    rows = got.collect()
    assert got.columns == [*docs.columns, "found"] and len(rows) == len(cases.DOCS) + 1 and all(0 <= r["found"]["score"] <= 1 for r in rows)
    assert len({round(r["found"]["score"], 12) for r in rows if r["text"] in (None, "", " \n\t ")}) == 1
    toxic = next(r for r in rows if r["doc_id"] == 30)
    assert {toxic["text"][s["start"]:s["stop"]] for s in toxic["found"]["spans"]} <= {"idiot", "MORON", "scum", "trash", "An", "and", "a"} and toxic["found"]["score"] > 0.7


def test_few_of_the_labelled_documents(spark):
    """A shard holds forty of many thousands of labelled documents, none of them first in the order of the sample."""
    words = {True: "idiot scum trash", False: "fine day sun"}
    rows = [(k, f"{words[k % 2 == 0]} and more. {cases.sentence(k, 12)}") for k in range(100_000, 100_080)]
    labels = spark.range(100_080).selectExpr("id AS doc_id", "CAST(id % 2 = 0 AS INT) AS toxic")
    kept = {r["doc_id"] for r in toxicity.drop_toxic(cases.documents(spark, rows), labels, train_docs=50, least_docs=2).collect()}
    assert kept == {k for k, _ in rows if k % 2}


def test_without_labels(spark):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    docs = cases.documents(spark)
    assert toxicity.drop_toxic(docs, labels).count() == docs.count()
    assert toxicity.drop_toxic(cases.nothing(spark), labels).collect() == []


def test_held_out_rows_are_never_learnt(spark):
    """Labels of held-out rows do not change the model."""
    docs, labels = spark.read.parquet(f"{SF_LEARN}/documents.parquet"), spark.read.parquet(f"{SF_LEARN}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, x, train_docs=40, turns=3) for x in (labels, turned))
    assert np.array_equal(a.weights, b.weights) and np.allclose(a.logistic, b.logistic)
