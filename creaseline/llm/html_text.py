"""Main text of web pages: nearest-URL page differencing, with the page's own structure.

Pages of a host with equal lines form a group, and the first of them stands for it. These are sorted by host, path and id and dealt over
partitions in ranges of that order, so a large host is spread over many; each range also gets the page before and the page after it. A page is paired
with the neighbour of its host whose path shares more segments with its own. The text lines of both, as 64-bit numbers, are aligned by longest common
subsequence; what both have is the site's template. Every page of a host takes part, whatever its structure.

Differencing alone gives wrong results here (README has the figures): adverts differ from page to page, and articles may share sentences
with their neighbours. So the structure decides where it speaks: blocks inside navigation, page header and footer, asides, forms and the like, by
element, role or class, go; where a page has an article or main element, only blocks inside it are shown. Of a page without these, lines that structure leaves
open go if the paired page has them. Inside an article or main element, one pair is too little: a line goes if at least half of the pairs of the host, and at least
LEAST_PAIRS, share it there. Pairs that share half of their content or more do not count, since they may be versions of one article.

Defined results: a null or empty page has the text "". A page whose host has no page with other lines is not
differenced; equal pages of a host get equal texts. Null URLs form a host of their own, without pairs. Repeated rows each give a row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creaseline.llm.common import partitions, ship_package, staged
from creaseline.llm.url_filter import host_of, path_of

#: What follows the name of a tag. Quotes count after an equals sign only: an apostrophe in a bare value or between attributes opens nothing.
VALUE = r"=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+|(?=>))"
REST = rf"(?:[^=>]++|{VALUE})*+"
MARK = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|noscript|template|iframe|textarea|title)\b{REST}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>{REST})>"
    r"|<[!?][^>]*+>", re.S | re.I)
BROKEN, QUOTED = re.compile(rf"</?[a-z][^\s/>]*+{REST}", re.I), re.compile(VALUE)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|style)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
#: Elements that begin and end a block, that have no content, and that hold no main text.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
                   "hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
APART = frozenset("nav header footer aside form dialog menu search button select head".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
APART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr header login masthead menu modal "
    "nav navbar navigation newsletter notice notices pager pagination popup promo promotion recommended related share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toolbar widget widgets".split())
SPACE = re.compile(r"\s+")
OPEN, CONTENT, TEMPLATE, HIDDEN = 0, 1, 2, 3
SHOWN, APART_KINDS = (OPEN, CONTENT), (TEMPLATE, HIDDEN)
#: Elements that no class or id makes a template.
WHOLE = frozenset("html body main article".split())
#: Fixed value: pairs of a host that must share a line inside their content before it can be the site's.
LEAST_PAIRS = 5
HOST_PIECE = 1000  # groups of a host that are joined with its lines in one piece, about


def named_apart(value: str, words: frozenset) -> bool:
    """Whether a class or id among `value` is one of the words, or made of nothing but such words (nav-menu; not has-sidebar)."""
    return any(words.issuperset(re.findall("[a-z0-9]+", one)) and one.strip("-_") for one in value.split())


def kind_of(name: str, rest: str, above: int) -> int:
    """Whether an element holds content, template or neither, given what is around it. A body and a main element begin anew also inside
    a template (a form around the page, a head without end); nothing inside a hidden element is shown."""
    if above == HIDDEN or name == "svg":
        return HIDDEN
    kind = above
    if name == "main":
        kind = CONTENT
    elif name == "body":
        kind = OPEN
    elif above != TEMPLATE and name in APART and not (name == "header" and above == CONTENT):  # the header of an article has its headline
        kind = TEMPLATE
    elif above != TEMPLATE and name == "article":
        kind = CONTENT
    template = False
    for key, value in ATTRIBUTE.findall(rest) if rest.strip() else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "style" and "display:none" in value.replace(" ", ""):
            return HIDDEN
        if key in ("class", "id") and name not in WHOLE and named_apart(value, APART_WORDS - {"header"} if above == CONTENT else APART_WORDS):
            template = True
        if key == "role" and value in APART_ROLES:
            template = True
        if kind != TEMPLATE and (key == "role" and value == "main" or key == "itemprop" and value == "articlebody"):
            kind = CONTENT
    return TEMPLATE if template else kind


def marks_of(page: str) -> Iterator[re.Match]:
    """Tags, comments and elements of raw text, in one pass over the page.

    A `<` with no `>` after it begins no tag. A tag whose value is never closed is none either; what its own attributes run through is not tried
    again, only what lies inside its quoted values.
    """
    last, at = page.rfind(">"), page.find("<")
    while at >= 0:
        found = MARK.match(page, at) if at < last or page.startswith("<!--", at) else None
        if found:
            yield found
            at = page.find("<", found.end())
            continue
        broken = BROKEN.match(page, at) if at < last else None
        after = at + 1
        if broken:
            inside = (page.find("<", value.start(), value.end()) for value in QUOTED.finditer(page, at, broken.end()))
            after = next((k for k in inside if k >= 0), max(broken.end(), at + 1))
        at = page.find("<", after)


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """The page's text blocks in order, each with its kind. What is not shown or belongs to the template within a line of a block does not part the block."""
    page = page or ""
    lines: list[tuple[str, int]] = []
    parts: list[tuple[str, int]] = []
    around: list[tuple[str, int]] = [("", OPEN)]  # open elements and their kinds

    def flush() -> None:
        if not parts:
            return
        shown = [kind for _, kind in parts if kind in SHOWN]
        for kinds, kind in ((SHOWN, shown[-1] if shown else OPEN), (APART_KINDS, TEMPLATE)):
            text = SPACE.sub(" ", html.unescape("".join(text for text, k in parts if k in kinds))).strip()
            if text:
                lines.append((text, kind))
        parts.clear()

    def turn(kind: int, new: int) -> None:
        if kind != new and kind in SHOWN and new in SHOWN:
            flush()

    at = 0
    for mark in marks_of(page):
        if mark.start() > at:
            parts.append((page[at:mark.start()], around[-1][1]))
        at = mark.end()
        name = (mark["name"] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            flush()
        elif name == "br":
            parts.append((" ", around[-1][1]))
        if name in EMPTY or name == "svg" and mark["rest"].endswith("/"):
            continue
        if name in BLOCKS and not mark["close"]:  # a drawing that is not closed ends where the next block begins
            level = next((k for k in range(len(around) - 1, 0, -1) if around[k][0] in ("svg", "foreignobject")), 0)
            if level and around[level][0] == "svg":
                del around[level:]
        if mark["close"]:
            level = len(around) - 1
            while level and around[level][0] != name:
                level -= 1
            if level:
                turn(around[-1][1], around[level - 1][1])
                del around[level:]
            continue
        if name in BLOCKS:  # a paragraph ends where the next block begins
            level = len(around) - 1
            while level and around[level][0] not in BLOCKS and around[level][0] != "foreignobject":
                level -= 1
            if around[level][0] == "p" or around[level][0] == name == "li":
                del around[level:]
        kind = kind_of(name, mark["rest"], around[-1][1])
        turn(around[-1][1], kind)
        around.append((name, kind))
    parts.append((page[at:], around[-1][1]))
    flush()
    return lines


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in `a` of a longest common subsequence with `b`, in linear memory: the halves of `a` are aligned with the
    parts of `b` between which the sum of both lengths is largest."""
    def lengths(x: list[int], y: np.ndarray) -> np.ndarray:
        row = np.zeros(len(y) + 1, np.int32)
        for v in x:
            step = row.copy()
            step[1:] = np.maximum(row[1:], np.where(y == v, row[:-1] + 1, 0))
            row = np.maximum.accumulate(step)
        return row

    out: list[int] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        present = set(b[b0:b1])
        rows = [i for i in range(a0, a1) if a[i] in present]
        if not rows:
            continue
        if len(rows) == 1:
            out.append(rows[0])
            continue
        cut = rows[len(rows) // 2]
        y = np.array(b[b0:b1])
        ahead = lengths([a[i] for i in rows if i < cut], y)
        behind = lengths([a[i] for i in reversed(rows) if i >= cut], y[::-1])[::-1]
        middle = b0 + int((ahead + behind).argmax())
        work += [(a0, cut, b0, middle), (cut, a1, middle, b1)]
    return sorted(out)


def main_text(lines: list[tuple[str, int]], removed: set[int]) -> str:
    marked = any(kind == CONTENT for _, kind in lines)
    return "\n".join(text for at, (text, kind) in enumerate(lines) if kind == (CONTENT if marked else OPEN) and at not in removed)


def nearness(path: str, other: str) -> int:
    """Leading segments that two paths share."""
    n = 0
    for x, y in zip(path.split("/"), other.split("/")):
        if x != y:
            break
        n += 1
    return n


def neighbours(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(row, paired row or None) of rows (host, path, ...) that come in order: the nearer of the two around it."""
    before = here = None
    for after in with_end(rows):
        if here is not None:
            sides = [x for x in (before, after) if x is not None and here[0] and x[0] == here[0]]
            yield here, max(sides, key=lambda x: nearness(here[1], x[1]), default=None)
        before, here = here, after


def with_end(rows: Iterator[tuple]) -> Iterator[tuple | None]:
    yield from rows
    yield None


KEY = ("host", "path", "id_text", "digest")


def ranges(keys: DataFrame, parts: int, each: int = 30) -> list:
    """At most parts - 1 keys that cut the sorted keys into ranges of about equal size, from a sample of about parts * each rows."""
    total = keys.count()
    share = min(1_000_000, int(1_000_000 * parts * each / max(total, 1)) + 1)
    sample = keys.where(F.pmod(F.xxhash64(*KEY), F.lit(1_000_000)) < share).orderBy(*KEY).collect()
    step = max(1, len(sample) // parts)
    return [tuple(r) for r in sample[step::step]]


def digest_of(lines: list[tuple[str, int]]) -> str:
    return hashlib.blake2b("\n".join(text for text, _ in lines).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def prints_of(lines: list[tuple[str, int]]) -> bytes:
    """64 bits for each line; lines are compared by these."""
    return b"".join(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest() for text, _ in lines)


def is_marked(kinds: bytes) -> bool:
    return CONTENT in kinds


def evidence(kinds: bytes, other: list[bytes], shared: list[int]) -> list[int] | None:
    """Places of the content that a marked page shares with its pair. None if the pair says nothing: half of the content or more is shared, or is
    all of the other's content, so the two may be versions of one article."""
    content = [at for at, kind in enumerate(kinds) if kind == CONTENT]
    found = sorted(set(content).intersection(shared))
    sizes = [len(content), *(n for k in other if (n := k.count(CONTENT)))]
    return found if 2 * len(found) < min(sizes) else None


def removed_from(kinds: bytes, prints: list[int], shared: list[int], site: set[int]) -> list[int]:
    """Places of the lines that a page shows by its structure and that differencing removes."""
    if is_marked(kinds):
        return [at for at, kind in enumerate(kinds) if kind == CONTENT and prints[at] in site]
    near = set(shared)
    return [at for at, kind in enumerate(kinds) if kind == OPEN and (at in near or prints[at] in site)]


def parsed(slim: DataFrame, schema: T.StructType, row_of) -> DataFrame:
    """Rows of `schema` from every page: row_of(host, lines, removed) has the columns that are not in `slim`, or is None for no row."""
    kept = [c for c in schema.names if c in slim.columns]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                removed = part.column("removed").to_pylist() if "removed" in part.schema.names else [None] * part.num_rows
                found = [row_of(host, lines_of(page), gone) for host, page, gone in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), removed)]
                part = part.select(kept).filter(pa.array([x is not None for x in found], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*part.columns, *columns_of([x for x in found if x is not None], schema.fields[len(kept):])], names=schema.names)

    return slim.mapInArrow(read, schema)


def columns_of(rows: list[tuple], fields: list[T.StructField]) -> list[pa.Array]:
    return [pa.array([x[i] for x in rows], ARROW[f.dataType.simpleString()]) for i, f in enumerate(fields)]


ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "array<bigint>": pa.list_(pa.int64())}


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


def aligned(chosen: DataFrame) -> DataFrame:
    """Per group of pages: host, digest, variants, prints, the places it shares with the nearest page, and those of them that count as evidence
    (null where the pair gives none)."""
    spark = chosen.sparkSession
    key = F.struct(*KEY)
    cuts = ranges(chosen.select(*KEY), 4 * partitions(spark))  # several ranges for each task, so that tasks are alike
    limits = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(KEY, cut)]) for cut in cuts]) if cuts else None
    part = F.size(F.filter(limits, lambda limit: limit <= key)).cast("bigint") if cuts else F.lit(0).cast("bigint")
    placed = chosen.withColumns({"part": part, "guest": F.lit(False)})
    # The first and last page of each range also go to the range before and after: two rows for each range on the driver.
    edges = sorted((r["part"], r["least"], r["most"]) for r in placed.groupBy("part").agg(F.min(key).alias("least"), F.max(key).alias("most")).collect())
    visits: dict[tuple, list[int]] = {}
    for (left, _, most), (right, least, _) in zip(edges, edges[1:]):
        visits.setdefault(tuple(least), []).append(left)
        visits.setdefault(tuple(most), []).append(right)
    if visits:
        listed = spark.createDataFrame([(*k, v) for k, v in visits.items()], ", ".join(f"{c} string" for c in KEY) + ", guest_of array<bigint>")
        guests = chosen.join(F.broadcast(listed), list(KEY)).withColumn("part", F.explode("guest_of")).withColumn("guest", F.lit(True))
        placed = placed.unionByName(guests.select(placed.columns))
    made = T.StructType([field("host", T.StringType()), field("digest", T.StringType()), field("variants", T.ArrayType(T.BinaryType())), field("prints", T.BinaryType()),
                         field("shared", T.ArrayType(T.LongType())), field("evidence", T.ArrayType(T.LongType()))])
    names = (*KEY, "part", "guest", "variants", "prints")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for host, path, _, digest, here, guest, variants, prints in zip(*(batch.column(c).to_pylist() for c in names)):
                    yield (here, host), path, np.frombuffer(prints, np.int64).tolist(), guest, digest, variants, prints

        out: list[tuple] = []
        for ((_, host), _, lines, guest, digest, variants, prints), pair in neighbours(rows()):
            if guest:
                continue
            shared = common_lines(lines, pair[2]) if pair else []
            counted = [evidence(kinds, pair[5], shared) for kinds in variants if is_marked(kinds)] if pair else []
            told = None if not counted or None in counted else sorted({lines[at] for one in counted for at in one})
            out.append((host, digest, variants, prints, shared, told))
            if len(out) >= 500:
                yield pa.RecordBatch.from_arrays(columns_of(out, made.fields), names=made.names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays(columns_of(out, made.fields), names=made.names)

    return placed.repartition(partitions(spark), "part").sortWithinPartitions("part", *KEY).mapInArrow(read, made)


def site_lines(pairs: DataFrame) -> DataFrame:
    """Per host, the lines that at least half of its pairs share inside their content, and at least LEAST_PAIRS."""
    told = pairs.where(F.col("evidence").isNotNull())
    total = told.groupBy("host").agg(F.count(F.lit(1)).alias("pairs"))
    times = told.select("host", F.explode("evidence").alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= LEAST_PAIRS)
    return times.join(total, "host").where(2 * F.col("times") >= F.col("pairs")).groupBy("host").agg(F.collect_list("line").alias("site"))


def removals(pairs: DataFrame) -> DataFrame:
    """Per host, digest and kinds with any: the places of the lines that differencing removes."""
    made = T.StructType([field("host", T.StringType()), field("digest", T.StringType()), field("kinds", T.BinaryType()), field("removed", T.ArrayType(T.LongType()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, digest, variants, prints, shared, site in zip(*(batch.column(c).to_pylist() for c in ("host", "digest", "variants", "prints", "shared", "site"))):
                lines = np.frombuffer(prints, np.int64).tolist()
                found = ((kinds, removed_from(kinds, lines, shared, set(site or ()))) for kinds in variants)
                out += [(host, digest, kinds, gone) for kinds, gone in found if gone]
            yield pa.RecordBatch.from_arrays(columns_of(out, made.fields), names=made.names)

    # A large host is joined in pieces; of such hosts there is at most one for HOST_PIECE groups.
    large = F.broadcast(pairs.groupBy("host").agg((F.floor(F.count(F.lit(1)) / HOST_PIECE) + 1).alias("pieces")).where("pieces > 1"))
    pieces = F.coalesce("pieces", F.lit(1))
    site = site_lines(pairs).join(large, "host", "left").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)))
    dealt = pairs.join(large, "host", "left").withColumn("piece", F.pmod(F.xxhash64("digest"), pieces)).drop("pieces")
    joined = dealt.join(site.drop("pieces"), ["host", "piece"], "left")
    return joined.select("host", "digest", "variants", "prints", "shared", "site").mapInArrow(read, made)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, url, text, n_chars."""
    ship_package(pages.sparkSession)
    slim = pages.select(F.col(id_col), F.col(url_col).alias("url"), F.col(html_col).alias("html")).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url")), "id_text": F.coalesce(F.lpad(F.col(id_col).cast("string"), 20, "0"), F.lit("")),
         "page": F.unhex(F.sha2(F.col("html"), 256))})
    schema = T.StructType([pages.schema[id_col], field("url", T.StringType()), field("text", T.StringType()), field("n_chars", T.LongType())])
    place = [field("host", T.StringType()), field("path", T.StringType()), field("id_text", T.StringType()), field("page", T.BinaryType())]

    # Every page of a host takes part: its lines as numbers, and their kinds, since copies may mark up the same lines in different ways.
    lines = staged(parsed(slim, T.StructType([*place, field("digest", T.StringType()), field("kinds", T.BinaryType()), field("prints", T.BinaryType())]), lambda host, lines, _: (
        digest_of(lines), bytes(kind for _, kind in lines), prints_of(lines)) if host and lines else None), "page-lines")

    # One page stands for all pages of its host that have its lines.
    groups = lines.groupBy("host", "digest").agg(F.min(F.struct("path", "id_text", "prints")).alias("first"), F.collect_set("kinds").alias("variants"))
    chosen = staged(groups.select("host", "first.path", "first.id_text", "digest", "variants", "first.prints"), "page-groups")
    pairs = staged(aligned(chosen), "page-pairs")
    gone = staged(removals(pairs), "page-removals")

    def text_of(host: str | None, lines: list[tuple[str, int]], removed: list[int] | None) -> tuple[str, int]:
        text = main_text(lines, set(removed or ()))
        return text, len(text)

    if gone.isEmpty():
        return parsed(slim, schema, text_of)
    # The same html on the same host has the same lines and kinds, so it loses the same places.
    gone = lines.select("host", "page", "digest", "kinds").distinct().join(gone, ["host", "digest", "kinds"]).select("host", "page", "removed")
    return parsed(slim.join(staged(gone, "page-places"), ["host", "page"], "left"), schema, text_of)
