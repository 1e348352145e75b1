"""Rows that every operator must bear: nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""

from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + k * k + k * seed) % len(WORDS)] + str((seed * 31 + k) % 97) for k in range(n))


LONG = " ".join(f"w{k}" for k in range(40_000))
DOCS = [
    (1, sentence(1, 40)), (2, sentence(1, 40)), (3, sentence(1, 40).replace(" ", "\n\t", 3)), (4, sentence(2, 40)), (4, sentence(2, 40)),
    (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "One"), (10, LONG), (11, LONG + " end"), (None, sentence(3, 30)), (None, sentence(1, 40)),
    (12, "Ünïcode straße 東京 \U0001f600 " + sentence(4, 20)), (13, sentence(1, 38) + " other words"), (14, "only. marks! ... ???"), (15, None),
]
#: Names that the operators use themselves.
CLASHING = ["kept_digest", "kept", "leaks", "toxicity", "keep_id", "text_sha256", "component_id", "private_values", "gone_lines", "cid", "slot", "part"]


def documents(spark, rows=None, extra=True):
    out = spark.createDataFrame(DOCS if rows is None else rows, "doc_id bigint, text string")
    return out.withColumns({c: F.lit(f"extra {c}") for c in CLASHING}) if extra else out


def nothing(spark, extra=True):
    return documents(spark, [], extra)
