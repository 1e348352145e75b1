import html
import re
import time

import numpy as np
from pyspark.sql import functions as F

from creaseline.llm import html_text
from creaseline.llm.queries import op6_html_text
from tests.conftest import SF_SMALL

MENU, END = "<div><span>Home</span></div><div>News</div>", "<div>All rights</div>"


def text_of(page, shared=()):
    return html_text.main_text(html_text.lines_of(page), set(shared))


def test_structure():
    assert text_of("<nav>m</nav><article><h1>T &amp; t</h1><p>a\n b<p>c<br>d<script>x<y</script></article><footer>f</footer>") == "T & t\na b\nc d"
    assert text_of("<main><p>x</p><div class='post comments'><p>no</p></div><aside>no</aside><form>no</form><p>y</main>z") == "x\ny"
    assert text_of("<article><p>a<!-- <p>no --> b</p><div style='display: none'>no</div><div class=advert>no</div><b>c</b>") == "a b\nc"
    assert text_of("plain text &lt;1&gt;") == "plain text <1>" and text_of(None) == text_of("") == text_of("<p> </p>") == ""
    assert text_of('<p title="a>b">x</p><p title="open>y') == 'x\n<p title="open>y'
    assert text_of("<div role=navigation>n</div><div id=main><p>x</p></div><ul><li>a<li>b</ul>") == "x\na\nb"
    assert len(text_of("<article>" + "<p>word</p>" * 30_000)) == 5 * 30_000 - 1


def test_drawings_and_quotes_lose_no_text():
    assert text_of('<article><p>a <svg width="1"/> b</p><p>c</p></article>') == "a b\nc"
    assert text_of("<article><p>a <svg><path d='x'/><text>no</text></svg> b</p><p>c</p></article>") == "a b\nc"
    assert text_of("<article><p>a <span class=ad>no <b>no</b></span> b<i hidden>no</i> c</p><p>d</p></article>") == "a b c\nd"
    assert text_of("<article><div>a <span class=ad>no<div>no</div>no</span> b</div></article>") == "a\nb"
    assert text_of("<article><p>a<svg><g>no<p>b</p><p>c</p></article>") == "a\nb\nc"
    assert text_of("<article><p>a<svg><foreignObject><div>no</div></foreignObject></svg></p><p>c</p></article>") == "a\nc"
    assert text_of("<p>One <a href=x title=Tom's>link</a> two. It's <b>bold</b>") == "One link two. It's bold"
    assert text_of("<p 'odd' title = \"a>b\" x=/q?a=\"1>one</p><p>it's</p>") == "one\nit's"
    assert text_of("<p>5 < 6 and <b>7</b> > 2 <") == "5 < 6 and 7 > 2 <"


def test_odd_pages_of_a_megabyte_take_linear_time():
    n = 350_000
    for page in ("<a " * n, "<a " * n + ">", "<a " * n + '=">', "<!x" * n, "<a b='" * n, '<a b="<i c=\'' * (n // 3), "<" * n, "<svg>" * (n // 5) + "x", "<!--" * n, "<a x=y" * n + "='>"):
        start = time.process_time()
        html_text.lines_of(page)
        assert time.process_time() - start < 4, page[:20]


def test_no_class_or_id_makes_a_whole_page_template():
    for page in ("<html class='no-header'><body class='has-sidebar'><p>x</p></body></html>", "<body class='no-header'><article><p>x</p></article>", "<article class='post comments-open'><p>x</p></article>",
                 "<main id='social-history'><p>x</p></main>", "<body class='sidebar' id=widget><p>x</p>", "<html id=nav><article class=share><p>x</p></article>", "<main class='comments'><p>x</p></main>",
                 "<div class='has-sidebar comments-open' id=no-footer><p>x</p></div>", "<form id=page class=nav><main class=header><p>x</p></main></form>", "<head><meta charset=x><body class=footer><p>x</p>"):
        assert text_of(page) == "x", page
    assert text_of("<article><header class='header entry-header'><h1>T</h1></header><p>x</p><footer>no</footer></article>") == "T\nx"
    assert text_of("<header><h1>no</h1></header><div class='nav-menu'>no</div><div class='post sidebar'>no</div><p id=comments>no</p><div>x</div><aside><article>no</article></aside>") == "x"
    assert text_of("<body><div hidden><main>no</main></div><main style='display:none'>no</main><main>x</main>") == "x"


def test_common_lines_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(0, 12)).tolist(), rng.integers(0, 4, rng.integers(0, 12)).tolist()
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        got = html_text.common_lines(a, b)
        rest = iter(b)
        assert len(got) == table[-1, -1] and got == sorted(set(got)) and all(any(a[k] == v for v in rest) for k in got)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit(1) for c in ("host", "part", "guest", "text")})


def plain(k):
    return f"{MENU}<div>Story {k} begins.</div><div>It ends {k}.</div>{END}"


def test_pages_without_structure_lose_what_the_nearest_page_has(spark):
    """Over several ranges of the sorted pages: each page meets its neighbours also across the ends of ranges."""
    rows = [(k, f"http://big.host/a/{k % 7}/{k}", plain(k)) for k in range(60)] + [(100, "http://lone.host/", plain(100)), (101, None, None), (None, "http://big.host/a/0/x", plain(7777)), (3, "http://big.host/a/3/3", plain(3))]
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract(pages(spark, rows)).collect()), key=repr)
    want = [(i, f"Story {7777 if i is None else i} begins.\nIt ends {7777 if i is None else i}.") for i, u, _ in rows if u and "big" in u]
    want += [(100, "Home\nNews\nStory 100 begins.\nIt ends 100.\nAll rights"), (101, "")]
    assert got == sorted(((i, t, len(t)) for i, t in want), key=repr)


def test_equal_neighbours_and_empty_table(spark):
    same = [(k, "http://h/x", plain(1)) for k in range(3)]
    assert {r["text"] for r in html_text.extract(pages(spark, same)).collect()} == {"Home\nNews\nStory 1 begins.\nIt ends 1.\nAll rights"}
    assert html_text.extract(pages(spark, [])).collect() == []


def test_copies_are_differenced_alike(spark):
    """A run of equal pages between others, copies far apart, copies whose mark-up differs, and marked pages beside open ones."""
    rows = [(k, f"http://h/a/{k}", plain(1)) for k in range(1, 6)] + [(9, "http://h/z/9", plain(9)), (10, "http://h/zz/10", plain(1))]
    rows += [(k, f"http://one/a/{k}", plain(1)) for k in range(20, 23)] + [(23, "http://one/a/21", plain(1).replace("<div>News</div>", "<nav>News</nav>"))]
    rows += [(30, "http://m/a/1", plain(30)), (31, "http://m/a/1", f"{MENU}<article>Other</article>{END}")]
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages(spark, rows)).collect()}
    want = {k: "Story 1 begins.\nIt ends 1." for k in (1, 2, 3, 4, 5, 10)} | {9: "Story 9 begins.\nIt ends 9."}
    want |= {k: "Home\nNews\nStory 1 begins.\nIt ends 1.\nAll rights" for k in (20, 21, 22)} | {23: "Home\nStory 1 begins.\nIt ends 1.\nAll rights"}
    assert got == want | {30: "Story 30 begins.\nIt ends 30.", 31: "Other"}


def test_lines_of_the_site_inside_articles_are_differenced(spark, monkeypatch):
    """Marked pages are paired and aligned too: what most pairs of a host share inside their articles goes, what few share or what versions of one article share stays."""
    def page(k, *more):
        return f"<nav>Home</nav><article><h1>Title {k}</h1><p>One {k}</p><p>Two {k}</p>{''.join(f'<div>{x}</div>' for x in more)}</article>"

    monkeypatch.setattr(html_text, "HOST_PIECE", 3)
    rows = [(k, f"http://h/a/{k}", page(k, "Read our other stories", *["They said so"] * (k < 12))) for k in range(10, 20)]
    rows += [(k, f"http://few/a/{k}", page(k, "Read our other stories")) for k in range(20, 24)]
    rows += [(k, f"http://one/a/{k}", page(1, "Three", f"Version {k}")) for k in range(30, 40)]
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages(spark, rows)).collect()}
    want = {k: f"Title {k}\nOne {k}\nTwo {k}" + "\nThey said so" * (k < 12) for k in range(10, 20)}
    want |= {k: f"Title {k}\nOne {k}\nTwo {k}\nRead our other stories" for k in range(20, 24)}
    assert got == want | {k: f"Title 1\nOne 1\nTwo 1\nThree\nVersion {k}" for k in range(30, 40)}


def test_articles_of_the_table_come_out_whole(spark):
    want = {}
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
        want[r["page_id"]] = "\n".join(b for b in blocks if b)
    assert {r["page_id"]: r["text"] for r in op6_html_text(spark, SF_SMALL).collect()} == want
