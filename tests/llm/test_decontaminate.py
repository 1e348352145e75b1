import re

from creaseline.llm import decontaminate
from tests.llm import cases

ITEMS = [(1, " ".join(cases.WORDS[:12])), (2, "Short, item!"), (3, None), (4, "..."), (2, "Short, item!"), (None, "hidden item words"), (5, " ".join(cases.WORDS[4:14]))]
TEXTS = [(1, "x " + ", ".join(w.upper() for w in cases.WORDS[:11]) + " y"), (2, "a short item, shorty item; SHORT ITEM"), (3, " ".join(cases.WORDS)), (4, None), (5, ""), (6, "hidden-item-words"),
         (7, "straße short\u00a0item short item"), (8, " ".join(cases.WORDS[:9])), (2, "repeated id short item"), (None, "no id"), (9, cases.LONG + " short item")]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    w, hit, items = words(text), set(), set()
    for item, body in ITEMS:
        v = words(body)
        k = min(len(v), 10)
        for s in range(len(v) - k + 1) if v else ():
            for at in range(len(w) - k + 1):
                if w[at:at + k] == v[s:s + k]:
                    hit |= set(range(at, at + k))
                    items |= {str(item)} - {"None"}
    return len(w), len(hit), sorted(items)


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_against_brute_force_with_one_automaton_and_with_several(spark):
    docs = cases.documents(spark, TEXTS)
    for size in (1 << 20, 60):
        got = decontaminate.find(docs, items(spark), block_bytes=size, out_col="found").collect()
        assert sorted(((r["doc_id"], r["found"]["n_words"], r["found"]["n_hit"], list(r["found"]["items"])) for r in got), key=repr) == \
            sorted(((i, *brute(t)) for i, t in TEXTS), key=repr)


def test_blocks_hold_every_item_once_and_stay_small(spark):
    rows = [(k, cases.sentence(k, 30)) for k in range(200)]
    made = list(decontaminate.item_blocks(spark.createDataFrame([*rows, *rows[:5], (None, None)], "item_id bigint, text string"), 10, 20_000, "item_id", "text"))
    assert sorted(x for block in made for x in block) == sorted((str(k), t) for k, t in rows)
    sizes = [sum(len(w) for _, t in block for w in decontaminate.windows_of(t, 10)) for block in made]
    assert len(made) > 10 and max(sizes) <= 20_000


def test_offsets_are_of_the_original_text(spark):
    text = "Näh! “Short,\n item” and more"
    found = decontaminate.find(cases.documents(spark, [(1, text)]), items(spark), out_col="found").first()["found"]
    assert [text[s["start"]:s["stop"]] for s in found["spans"]] == []  # the quotation marks belong to words
    text = "Näh! (Short,\n item) and more"
    found = decontaminate.find(cases.documents(spark, [(1, text)]), items(spark), out_col="found").first()["found"]
    assert [text[s["start"]:s["stop"]] for s in found["spans"]] == ["Short,\n item"]


def test_drop_keeps_columns_and_empty_tables(spark):
    docs = cases.documents(spark, TEXTS)
    kept = decontaminate.drop_contaminated(docs, items(spark))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [4, 5, 8]
    assert decontaminate.drop_contaminated(cases.nothing(spark), items(spark)).collect() == []
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.drop_contaminated(docs, none).count() == len(TEXTS)
