"""Format-preserving pseudonyms for private numbers, dates, addresses and tokens.

Every value found is validated, then permuted by a keyed Feistel network over the values of its own format, so equal values get equal pseudonyms in every
document, different ones stay different. Cards, bank accounts, addresses and dates stay valid:

* numbers of payment cards: all digits but the last, which is then the check digit again (Luhn);
* international bank account numbers of the registered lengths: all but the country, and the check digits (mod 97) made anew;
* IPv4 addresses: the pairs of octets; dates from 1900 on: the day's number in 73,000 days, written in the same form;
* telephone numbers, social security numbers, local parts of e-mail addresses, hexadecimal tokens: the two halves of the string, each character
  moved within its class (digit, small letter, capital letter); blanks, brackets, dashes and an international prefix stay.

Digits are permuted without their separators, so a card written with and without blanks stays linked. All is built from Spark's own functions.

Defined results: a null text stays null and counts 0. Values that fail validation stay as they are. Texts are read whole. Extra columns pass through.
The key is a parameter; with another key all pseudonyms differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import fresh_name

ROUNDS = 8
#: Forms of private values; earlier ones win where several fit.
EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"
IP = r"(?<![\p{L}\p{N}.])\d{1,3}(?:\.\d{1,3}){3}(?![\p{L}\p{N}]|\.\d)"
DATE = (r"(?<![\p{L}\p{N}.\-/])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{1,2}/\d{1,2}|\d{4}\.\d{1,2}\.\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4})"
        r"(?:(?=[Tt]\d{2})|(?![\p{L}\p{N}\-/]|\.\d))")
#: The countries of each length of an IBAN; the groups of four may be apart.
IBAN_COUNTRIES = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
                  24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
                  31: "MT SC", 32: "LC", 33: "RU"}
IBAN = r"(?<![\p{L}\p{N}])(?:" + "|".join(
    rf"(?:{c.replace(' ', '|')})\d{{2}}(?:[ \-]?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf"[ \-]?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBAN_COUNTRIES.items()) + r")(?![\p{L}\p{N}])"
TOKEN = r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\p{L}\p{N}])"
CARD = r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){2,3}(?:[ \-]\d{1,3})?|\d{4}[ \-]\d{6}[ \-]\d{4,5})(?![\p{L}\p{N}])"
SSN = r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])"
#: Telephone numbers have a plus, a bracket or a national grouping. Grouped thousands (12.345.678, 10 000 000, also signed) are none.
END = r"(?![\p{L}\p{N}]|-\d)"
THOUSANDS = r"(?![\p{N}]|[ .\-]\d)"
NATIONAL = (r"(?:1[ .\-])?\d{3}[ .\-]\d{3}[ .\-]\d{4}"  # North America
            r"|0\d{1,4}[ /\-]\d{2,8}(?:[ \-]\d{2,8}){0,4}|0\d{1,4}(?:\.\d{2,4}){2,4}"  # with the trunk prefix 0, or 00 and the country
            r"|1[3-9]\d[ \-]\d{4}[ \-]\d{4}|\d{3}-\d{3}-\d{3}")  # China; Poland
SHORT_GROUPS = r"[2-9]\d(?:[ \-]\d{2}){3}|\d{2}[ .\-]\d{3}[ .\-]\d{2}[ .\-]\d{2}|[4-9]\d{2}[ \-]\d{2}[ \-]\d{2}[ \-]\d{2}|\d{3}[ \-]\d{3}[ \-]\d{2}[ \-]\d{2}"  # Scandinavia; Spain, Poland; Spain; Russia, Turkey
PHONE = (rf"(?<![\p{{L}}\p{{N}}+])(?:(?!\+(?:\d{{2}}(?:[ .]\d{{3}}){{2}}|1(?:[ .]\d{{3}}){{3}}){THOUSANDS})"
         rf"\+\d{{1,3}}[ .\-]?(?:\(\d{{1,5}}\)[ .\-]?|\d{{1,5}}[ .\-])\d{{2,8}}(?:[ .\-]\d{{2,4}}){{0,4}}{END}|\+\d{{8,15}}(?![\p{{L}}\p{{N}}])"
         rf"|(?!\(\d{{2,5}}\) \d{{1,3}}(?:[ .]\d{{3}}){{2,}}{THOUSANDS})\(\d{{2,5}}\)[ .\-]?\d{{2,4}}(?:[ .\-]\d{{2,4}}){{1,3}}{END}|\(0\d{{1,4}}\)[ .\-]?\d{{5,8}}{END}"
         rf"|(?<!\d[.\-])(?:{NATIONAL}){END}|(?<!\d[ .\-])(?:{SHORT_GROUPS})(?![\p{{L}}\p{{N}}]|[ .\-]\d))")
ANY = "|".join([EMAIL, IP, IBAN, DATE, TOKEN, CARD, SSN, PHONE])
FIRST_DAY, YEARS, DAYS = "1900-01-01", 200, 365


def drawn(key: str, kind: str, turn: Column, other: Column) -> Column:
    """The 64 hex digits that a round takes from the key and the half it leaves alone."""
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), turn.cast("string"), F.lit("|"), other.cast("string")), 256)


def numbers(key: str, kind: str, left: Column, right: Column, sizes: tuple) -> Column:
    """A permutation of pairs below `sizes`: odd rounds add to the left number, even ones to the right."""
    a, b = (s if isinstance(s, Column) else F.lit(s).cast("bigint") for s in sizes)

    def some(turn: Column, other: Column) -> Column:
        return F.conv(F.substring(drawn(key, kind, turn, other), 1, 12), 16, 10).cast("bigint")

    def step(now: Column, turn: Column) -> Column:
        odd = turn % 2 == 1
        return F.struct(
            F.when(odd, F.pmod(now["l"] + some(turn, now["r"]), a)).otherwise(now["l"]).alias("l"),
            F.when(odd, now["r"]).otherwise(F.pmod(now["r"] + some(turn, now["l"]), b)).alias("r"))

    begin = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, step)


def moved(text: Column, stream: Column, letters: int) -> Column:
    """Each digit and letter moved on within its class by the numbers of the stream; other characters stay."""
    def one(c: Column, at: Column) -> Column:
        by = F.conv(F.substring(stream, (at % 31) * 2 + 1, 3), 16, 10).cast("int")
        code = F.ascii(c)
        return (F.when(c.between("0", "9"), F.chr(F.pmod(code - 48 + by, F.lit(10)) + 48))
                .when(c.between("a", "z"), F.chr(F.pmod(code - 97 + by, F.lit(letters)) + 97))
                .when(c.between("A", "Z"), F.chr(F.pmod(code - 65 + by, F.lit(letters)) + 65)).otherwise(c))

    return F.when(text == "", text).otherwise(F.array_join(F.transform(F.split(text, ""), one), ""))


def characters(key: str, kind: str, text: Column, letters: int = 26) -> Column:
    """A permutation of the strings that have the same classes in the same places. A single character is moved by the key alone."""
    cut = F.floor(F.length(text) / 2).cast("int")

    def step(now: Column, turn: Column) -> Column:
        odd = turn % 2 == 1
        return F.struct(
            F.when(odd, moved(now["l"], drawn(key, kind, turn, now["r"]), letters)).otherwise(now["l"]).alias("l"),
            F.when(odd, now["r"]).otherwise(moved(now["r"], drawn(key, kind, turn, now["l"]), letters)).alias("r"))

    begin = F.struct(F.substr(text, F.lit(1), cut).alias("l"), F.substr(text, cut + 1).alias("r"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, step)
    return F.concat(done["l"], done["r"])


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def put_back(template: Column, digits: Column, replaced: str = "[0-9]") -> Column:
    """`template` with its digits (or other characters to be replaced) replaced by `digits`, in order."""
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

    def step(now: Column, c: Column) -> Column:
        number = F.rlike(c, F.lit(replaced))
        return F.struct(F.concat(now["out"], F.when(number, F.substr(digits, now["n"] + 1, F.lit(1))).otherwise(c)).alias("out"),
                        (now["n"] + number.cast("int")).alias("n"))

    return F.aggregate(F.split(template, ""), begin, step)["out"]


def check_digit(body: Column) -> Column:
    """The Luhn digit that makes `body` followed by it valid."""
    def part(c: Column, at: Column) -> Column:
        doubled = c.cast("int") * 2
        return F.when(at % 2 == 0, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(c.cast("int"))

    total = F.aggregate(F.transform(F.split(F.reverse(body), ""), part), F.lit(0), lambda s, x: s + x)
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def card(key: str, value: Column) -> Column:
    digits = digits_of(value)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    new = characters(key, "card", body)
    return F.when(check_digit(body) == F.right(digits, F.lit(1)), put_back(value, F.concat(new, check_digit(new)))).otherwise(value)


def address(key: str, value: Column) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("bigint"))
    pair = numbers(key, "ip", F.element_at(octets, 1) * 256 + F.element_at(octets, 2), F.element_at(octets, 3) * 256 + F.element_at(octets, 4), (65536, 65536))
    text = F.transform(F.array(pair), lambda p: F.concat_ws(".", F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256))[0]
    return F.when(F.forall(octets, lambda x: x <= 255), text).otherwise(value)


def date(key: str, value: Column) -> Column:
    """Year first; day.month.year and day-month-year; month/day/year. Slashes and dashes have the other order where only that is valid."""
    parts = F.transform(F.split(value, r"[./\-]"), lambda x: x.cast("int"))
    separator, year_first = F.regexp_extract(value, r"[./\-]", 0), F.rlike(value, F.lit(r"^\d{4}"))

    def made(y: int, m: int, d: int) -> Column:
        return F.try_to_date(F.concat_ws("-", F.lpad(F.element_at(parts, y).cast("string"), 4, "0"), F.lpad(F.element_at(parts, m).cast("string"), 2, "0"),
                                         F.lpad(F.element_at(parts, d).cast("string"), 2, "0")), "yyyy-MM-dd")

    month_first = (separator == "/") & made(3, 1, 2).isNotNull() | (separator == "-") & made(3, 2, 1).isNull()
    day = F.when(year_first, made(1, 2, 3)).when(month_first, made(3, 1, 2)).otherwise(made(3, 2, 1))
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("bigint")
    pair = numbers(key, "date", F.floor(number / DAYS), number % DAYS, (YEARS, DAYS))
    # One form for each way of writing, so that a pseudonym is read as the date it is: slashes and dashes with the order that the old value had.
    new = F.transform(F.array(pair), lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * DAYS + p["r"]).cast("int")))[0]
    form = F.when(year_first, "yyyy-MM-dd").when(month_first, "MM-dd-yyyy").otherwise("dd-MM-yyyy")
    return F.when(number.between(0, YEARS * DAYS - 1), F.replace(F.call_function("date_format", new, form), F.lit("-"), separator)).otherwise(value)


def iban(key: str, value: Column) -> Column:
    """The country stays, the characters after the check digits move within their classes, and the check digits (mod 97) are made anew."""
    plain = F.regexp_replace(value, "[ \\-]", "")
    country, account = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5))

    def step(rest: Column, c: Column) -> Column:
        return F.pmod(rest * F.when(c <= "9", 10).otherwise(100) + F.ascii(c) - F.when(c <= "9", 48).otherwise(55), F.lit(97))

    def checked(account: Column) -> Column:
        rest = F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), step)
        return F.lpad((98 - rest).cast("string"), 2, "0")

    new = characters(key, "iban", account)
    return F.when(checked(account) == F.substr(plain, F.lit(3), F.lit(2)), put_back(value, F.concat(country, checked(new), new), "[A-Z0-9]")).otherwise(value)


def telephone(key: str, value: Column) -> Column:
    prefix = F.regexp_extract(value, r"^\+\d{1,3}(?=[ .\-(])", 0)
    rest = F.substr(value, F.length(prefix) + 1)
    digits = digits_of(rest)
    return F.when(F.length(digits_of(value)).between(8, 15), F.concat(prefix, put_back(rest, characters(key, "phone", digits)))).otherwise(value)


def security_number(key: str, value: Column) -> Column:
    valid = ~F.rlike(value, F.lit("^(000|666|9)|-00-|-0000$"))
    return F.when(valid, put_back(value, characters(key, "ssn", digits_of(value)))).otherwise(value)


def email(key: str, value: Column) -> Column:
    return F.concat(characters(key, "email", F.substring_index(value, "@", 1)), F.lit("@"), F.substring_index(value, "@", -1))


def pseudonym(key: str, value: Column) -> Column:
    """The pseudonym of one value that `ANY` found."""
    def whole(pattern: str) -> Column:
        return F.rlike(value, F.lit(f"^(?:{pattern})$"))

    return (F.when(F.contains(value, F.lit("@")), email(key, value)).when(whole(IP), address(key, value)).when(whole(IBAN), iban(key, value))
            .when(whole(DATE), date(key, value))
            .when(whole(TOKEN), characters(key, "token", value, letters=6)).when(whole(CARD), card(key, value)).when(whole(SSN), security_number(key, value))
            .otherwise(telephone(key, value)))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str = "n_private") -> DataFrame:
    """`docs` with private values in `text_col` replaced, and the number of values replaced."""
    old, new = fresh_name(docs, "private_values"), fresh_name(docs, "private_pseudonyms")
    text = F.col(text_col)
    some = F.rlike(text, F.lit("[0-9@]"))  # most texts have neither, and need no search
    # As generators, the search and the permutations run once per text, however often their results are used.
    found = docs.select("*", F.explode(F.array(F.when(some, F.regexp_extract_all(text, F.lit(ANY), 0)))).alias(old))
    found = found.select("*", F.explode(F.array(F.transform(old, lambda v: pseudonym(key, v)))).alias(new))
    any_found = F.size(F.coalesce(old, F.array().cast("array<string>"))) > 0
    # The text between the values, and the pseudonyms, in turn; there is one more of the former.
    woven = F.zip_with(F.split(text, ANY, -1), F.concat(new, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    changed = F.size(F.filter(F.zip_with(old, new, lambda a, b: a != b), lambda x: x)).cast("bigint")
    out = found.withColumn(count_col, F.when(any_found, changed).otherwise(F.lit(0).cast("bigint")))
    return out.withColumn(text_col, F.when(any_found, F.array_join(woven, "")).otherwise(text)).drop(old, new)
