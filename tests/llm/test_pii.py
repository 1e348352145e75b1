import datetime
import hashlib
import random
import re

from creaseline.llm import pii
from creaseline.llm.queries import op9_pii
from tests.conftest import SF_SMALL
from tests.llm import cases

CARD, CARD2 = "4845168114407329", "7536784127813050"
TEXTS = [(1, f"a {CARD}, b"), (2, f"{CARD[:4]} {CARD[4:8]}-{CARD[8:12]} {CARD[12:]}"), (3, CARD[:-1] + "8"), (4, "at 97.51.17.173."), (5, "300.1.1.1 1.2.3 1.2.3.4.5"), (6, "+1 (017) 555-7713 x"),
         (7, "und.34@mail7.example.com und.34@mail8.example.com"), (8, "1999-12-31, 31.12.1999 12/31/1999 25/12/2001"), (9, "2024-02-30 1850-01-01 2099-12-31"), (10, 'k="04dbebab91ab85687d33eeaaf9ac699e1188f962"'),
         (11, "123-45-6789 000-12-3456"), (12, f"{CARD2} {CARD} {CARD2}"), (13, "no numbers"), (14, "7 apples 1234 5678"), (15, None), (16, ""), (17, "x" * 200_000 + f" {CARD} " + "y" * 200_000)]


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return (sum(d[::2]) + sum(2 * x - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def run(spark, rows, key="k"):
    return {r["doc_id"]: (r["text"], r["n_private"]) for r in pii.pseudonymise(cases.documents(spark, rows), key).collect()}


def test_values_and_formats(spark):
    got = run(spark, TEXTS)
    new = re.sub(r"\D", "", got[1][0])
    assert new != CARD and luhn(new) and len(new) == 16 and got[1][0] == f"a {new}, b"
    assert got[2][0] == f"{new[:4]} {new[4:8]}-{new[8:12]} {new[12:]}"  # linked, in its own format
    assert got[3] == (TEXTS[2][1], 0) and got[5] == (TEXTS[4][1], 0) and got[13] == ("no numbers", 0) and got[14] == (TEXTS[13][1], 0)
    octets = re.fullmatch(r"at (\d+)\.(\d+)\.(\d+)\.(\d+)\.", got[4][0]).groups()
    assert all(int(o) < 256 for o in octets) and "97.51.17.173" not in got[4][0]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4} x", got[6][0]) and "555-7713" not in got[6][0]
    a, b = got[7][0].split()
    assert a.split("@")[0] == b.split("@")[0] != "und.34" and re.fullmatch(r"[a-z]{3}\.\d\d@mail7\.example\.com", a)
    iso, dotted, american, european = re.split("[ ,]+", got[8][0])
    day = datetime.date.fromisoformat(iso)
    assert day.strftime("%d.%m.%Y") == dotted and day.strftime("%m/%d/%Y") == american and got[8][1] == 4 and re.fullmatch(r"\d\d/\d\d/\d{4}", european)
    assert got[9] == (TEXTS[8][1], 0)
    assert re.fullmatch('k="[0-9a-f]{40}"', got[10][0]) and "04dbebab" not in got[10][0]
    assert got[11][0].endswith(" 000-12-3456") and got[11][1] == 1
    assert got[12][0].split()[1] == new and got[12][0].split()[0] == got[12][0].split()[2] and got[12][1] == 3
    assert got[15] == (None, 0) and got[16] == ("", 0)
    assert got[17][0] == "x" * 200_000 + f" {new} " + "y" * 200_000


def mod97(s):
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def test_clean_numbers_stay(spark):
    clean = ["12.345.678 people", "10 000 000", "1 234 567 890 and 12 345 678 901", "+12 345 678", "+10.000.000", "(12) 10 000 000", "(2024) 12.345.678", "1.234.567,89", "EUR 123.456.789",
             "2024.13.45", "GB82 WEST 1234 5698 7654 33", "DE00370400440532013000", "May 2024", "31 February 2024", "07.30 12.30", "12 34 56 78 90 12"]
    got = run(spark, list(enumerate(clean)))
    assert [got[k] for k in range(len(clean))] == [(c, 0) for c in clean]


def test_other_forms_are_replaced_in_their_form(spark):
    values = {"2024-05-01T10:00:00": r"\d{4}-\d\d-\d\dT10:00:00", "2024/05/01": r"\d{4}/\d\d/\d\d", "2024.05.01": r"\d{4}\.\d\d\.\d\d", "31-12-1999": r"\d\d-\d\d-\d{4}",
              "DE89370400440532013000": r"DE\d{20}", "GB82 WEST 1234 5698 7654 32": r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d",
              "BE68 5390 0754 7034 IS": r"BE\d\d \d{4} \d{4} \d{4} IS", "+34 912 345 678": r"\+34 \d{3} \d{3} \d{3}", "+33 1 23 45 67 89": r"\+33 \d \d\d \d\d \d\d \d\d", "212-555-0123": r"\d{3}-\d{3}-\d{4}",
              "(030) 1234567": r"\(\d{3}\) \d{7}", "01.23.45.67.89": r"\d\d(\.\d\d){4}", "020 7946 0958": r"\d{3} \d{4} \d{4}", "612 34 56 78": r"\d{3} \d\d \d\d \d\d", "20 30 40 50": r"\d\d( \d\d){3}"}
    got = run(spark, list(enumerate(f"on {v}, x" for v in values)))
    for k, (value, form) in enumerate(values.items()):
        text, n = got[k]
        assert n == 1 and re.fullmatch(f"on {form}, x", text) and value not in text, (value, text)
        if re.match("DE|GB|BE", value):
            assert mod97(re.sub("[ ]|IS", "", text[3:-3])) == 1, text
    days = {datetime.date.fromisoformat(got[0][0][3:13]), datetime.datetime.strptime(got[1][0], "on %Y/%m/%d, x").date(), datetime.datetime.strptime(got[2][0], "on %Y.%m.%d, x").date()}
    assert len(days) == 1  # the same day in three forms stays linked


def drawn(key, kind, turn, other):
    return hashlib.sha256(f"{key}|{kind}|{turn}|{other}".encode()).hexdigest()


def plain_numbers(key, kind, left, right, a, b):
    for turn in range(1, 9):
        by = int(drawn(key, kind, turn, right if turn % 2 else left)[:12], 16)
        left, right = ((left + by) % a, right) if turn % 2 else (left, (right + by) % b)
    return left, right


def plain_characters(key, kind, text, letters=26):
    def moved(part, stream):
        out = ""
        for at, c in enumerate(part):
            by = int(stream[(at % 31) * 2:(at % 31) * 2 + 3], 16)
            size, base = (10, 48) if c.isdigit() else (letters, 97) if c.islower() else (letters, 65)
            out += chr(base + (ord(c) - base + by) % size) if c.isalnum() else c
        return out

    left, right = text[:len(text) // 2], text[len(text) // 2:]
    for turn in range(1, 9):
        left, right = (moved(left, drawn(key, kind, turn, right)), right) if turn % 2 else (left, moved(right, drawn(key, kind, turn, left)))
    return left + right


def test_values_against_a_plain_feistel_network(spark):
    """Cards, addresses, e-mail names, social security numbers and tokens of a few hundred texts."""
    rng = random.Random(9)
    rows, want = [], {}
    for k in range(300):
        body = "".join(rng.choices("0123456789", k=15))
        card = next(body + c for c in "0123456789" if luhn(body + c))
        octets = [rng.randrange(256) for _ in range(4)]
        name = "".join(rng.choices("abcXYZ019._", k=rng.randrange(1, 12))).strip("._") or "q"
        token = "".join(rng.choices("0123456789abcdef", k=40)) if k % 2 else "f" * 32
        social = f"{rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}"
        rows.append((k, f"{card}; {'.'.join(map(str, octets))}; {name}@a.example; {token}; {social}"))
        new = plain_characters("k", "card", body)
        new = next(new + c for c in "0123456789" if luhn(new + c))
        left, right = plain_numbers("k", "ip", octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], 65536, 65536)
        number = plain_characters("k", "ssn", social.replace("-", ""))
        want[k] = (f"{new}; {left // 256}.{left % 256}.{right // 256}.{right % 256}; {plain_characters('k', 'email', name)}@a.example; "
                   f"{plain_characters('k', 'token', token, 6)}; {number[:3]}-{number[3:5]}-{number[5:]}")
    got = run(spark, rows)
    assert {k: got[k][0] for k in want} == want


def test_permutations_are_one_to_one(spark):
    """All values of a small format map onto all values."""
    rows = spark.range(1000).selectExpr("lpad(cast(id AS string), 3, '0') AS v", "id")
    out = {r[0] for r in rows.select(pii.characters("k", "phone", rows.v)).collect()}
    assert len(out) == 1000
    pairs = spark.range(1000).selectExpr("floor(id / 25) AS l", "id % 25 AS r")
    got = {(r["p"]["l"], r["p"]["r"]) for r in pairs.select(pii.numbers("k", "x", pairs.l, pairs.r, (40, 25)).alias("p")).collect()}
    assert len(got) == 1000 and all(0 <= a < 40 and 0 <= b < 25 for a, b in got)


def test_key_changes_all(spark):
    assert run(spark, TEXTS[:1], "k")[1] != run(spark, TEXTS[:1], "other")[1]


def test_columns_edge_cases_and_empty_table(spark):
    docs = cases.documents(spark)
    out = pii.pseudonymise(docs, "k")
    assert out.columns == [*docs.columns, "n_private"] and sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(cases.DOCS, key=repr)
    assert pii.pseudonymise(cases.nothing(spark), "k").collect() == []


def test_no_planted_value_is_left_and_no_python_runs(spark):
    old = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    query = op9_pii(spark, SF_SMALL)
    assert not re.search("Python|Pandas|Arrow", query._jdf.queryExecution().executedPlan().toString())
    for r in query.collect():
        values = re.findall(r"(?<!\d)\d{16}(?!\d)|\+\d \(\d{3}\) \d{3}-\d{4}|[a-z]+\.\d+@mail\d\.example\.com|(?<![\d.])\d+\.\d+\.\d+\.\d+(?![\d.])|[0-9a-f]{40}", old[r["doc_id"]] or "")
        values = [v for v in values if not re.fullmatch(r"\d{16}", v) or luhn(v)]  # other numbers are no cards and stay
        assert all(v not in r["text"] for v in values) and r["n_private"] >= len(set(values))
        assert r["n_private"] or r["text"] == old[r["doc_id"]]
