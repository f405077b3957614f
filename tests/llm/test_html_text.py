import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from skymetrics.llm import html_text
from skymetrics.llm.html_text import Page, main_text
from skymetrics.llm.html_tree import Tree

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                       T.StructField("host", T.StringType()), T.StructField("text", T.LongType()), T.StructField("subtrees", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, 2) for i, u, h in rows], SCHEMA)


def texts(df):
    rows = df.collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return sorted(((r.page_id, r.url, r.text) for r in rows), key=str)


def text(page):
    return Page(page).text()


@pytest.mark.parametrize(("page", "want"), [
    ("", ""), ("plain  text\n", "plain text"), ("<p>a<p>b</p>c", "a\nb\nc"), ("<b>x</b>y<i> z</i>", "xy z"),
    ("<article><h1>T &amp; U&ampx</h1><p>a<br>b&nbsp;&nbsp;c&#x4e;</article><p>out", "T & U&x\na b cN"),
    ("<title>t</title><style>p{}</style><body><p>a<script>var x = '</p><p>';</script>b", "ab"),
    ("<p title='a > b'>x</p><p title=it's>y</p><!-- <p>no</p> -->z<!---->!", "x\ny\nz!"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"), ("<table><tr><td>a<td>b<tr><td>c</table>d", "a\nb\nc\nd"),
    ("<dl><dt>a<dd>b<dt>c</dl><h2>x<h3>y</h3>z", "a\nb\nc\nx\ny\nz"), ("a < b <3 c </> d </ x> e <!x> f", "a < b <3 c d e f"),
    ("<p>open tag at the end <a href='x", "open tag at the end"), ("<script>never closed <p>a", ""), ("<textarea>&lt;b></textarea>y", "y"),
    ("<article><header><h1>T</h1><p>by me</p></header><p>a</p><footer>f</footer></article><header>site</header>", "T\na"),
    ("<header>site</header><p>a</p><footer>f</footer>", "a"),
    ("<main><nav>n</nav><p>a</p><aside>s</aside><form>f</form><div class='cookie-notice'>c</div><div id=comments><p>c</p></div></main>x", "a"),
    ("<div class='page has-sidebar'><p>a</p><div class=sidebar>s</div><div class='adBanner'>s</div></div>", "a"),
    ("<div class='layout-sidebar'><article><p>a</p></article></div>", "a"),
    ("<form id=aspnet><article><p>a</p><form>f</form></article></form>", "a"),
    ("<article><p>a</p></article><section class=comments><article><p>c</p></article></section><article class=comment>d</article>", "a"),
    ("<nav><article><p>a</p></article></nav><p>b</p>", "b"), ("<div role=main><p>a</p></div><p>b</p>", "a"),
    ("<article><div role='navigation'>n</div>a<svg><path d='x'/><text>s</text></svg>b<img src=x>c<custom-x/>d</article>", "abcd"),
    ("<ARTICLE><P CLASS=AD>x</P><P>Ü東京&copy;</ARTICLE>", "Ü東京©"), ("<article></article><p>b</p>", "b"),
    ("<head><title>t</title><p>a</p>", "a"), ("<article><pre> x\n  y </pre>\x0c z</article>", "x y\nz"),
])
def test_page_by_hand(page, want):
    assert text(page) == want


def words(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def site(r, host, first, n, marked):
    """Pages with a template that no markup tells, and the blocks of their articles."""
    top = f"<div><div>{words(r, 3)}</div><ul><li>{words(r, 1)}</li><li>{words(r, 1)}</li></ul></div>"
    low = f"<div><p>{words(r, 9)}</p></div>"
    mid = f"<div><div>{words(r, 4)}</div></div>"
    shared = words(r, 8)  # a passage of many articles
    out = []
    for i in range(n):
        blocks = [words(r, r.randint(1, 9)) for _ in range(r.randint(1, 5))] + ([shared] if i % 2 and marked else [])
        body = "".join(f"<p>{b}</p>" for b in blocks[:-1]) + mid + f"<p>{blocks[-1]}"
        body = f"<article>{body}</article>" if marked else f"<div>{body}</div>"
        out.append((first + i, f"https://{host}/{i}", f"<html><body>{top}<nav>{words(r, 3)}</nav>{body}{low}</body></html>", "\n".join(blocks)))
    return out


def test_templates_of_sites_go(spark):
    r = random.Random(1)
    pages = site(r, "a.example", 0, 40, True) + site(r, "B.example", 100, 30, False) + site(r, "c.example", 200, 4, False)
    want = sorted(((i, u, t) for i, u, _, t in pages), key=str)
    assert texts(main_text(frame(spark, [p[:3] for p in pages]))) == want


def test_copies_of_an_article_stay(spark):
    r = random.Random(2)
    pages = site(r, "a.example", 0, 20, False)
    copies = [(1000 + i, f"https://a.example/copy{i}", pages[0][2], pages[0][3]) for i in range(30)] + pages[:5]
    few = site(r, "small.example", 300, 3, False)  # too few to tell: all stays
    got = texts(main_text(frame(spark, [p[:3] for p in pages + copies + few])))
    assert len(got) == len(pages + copies + few)
    assert {(i, u, t) for i, u, _, t in pages + copies} <= set(got)
    assert all(t.count("\n") > want.count("\n") for (i, _, t) in got for (j, _, _, want) in few if i == j)


def brute(rows, least=4, share=0.3):
    seen, pages = defaultdict(set), defaultdict(set)
    host = lambda u: (u or "").split("://", 1)[1].split("/")[0].lower() if "://" in (u or "") else ""
    for _, u, h in rows:
        page = Page(h or "")
        pages[host(u)].add(page.text())
        for d in page.subtrees():
            seen[host(u), d].add(page.text())
    cut = lambda u: frozenset(d for (h, d), at in seen.items() if h and h == host(u) and len(at) >= max(least, share * len(pages[h])))
    return sorted(((i, u, Page(h or "").text(cut(u))) for i, u, h in rows), key=str)


@pytest.mark.parametrize("limit", [html_text.BROADCAST_BYTES, 0])  # templates broadcast, or joined by host
def test_counts_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(html_text, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(html_text, "SLICE_BYTES", 5000)
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    r = random.Random(3)
    rows += [p[:3] for p in site(r, "hot.example", 5000, 150, False) + site(r, "x.example", 6000, 9, True)]
    rows += rows[:20] + [(None, None, "<p>a"), (1, "no host", "<p>a"), (2, "http://x.example/", None), (3, "http://x.example/", ""), (None, "http://x.example/", "<p>b")]
    want = brute(rows)
    assert texts(main_text(frame(spark, rows))) == want
    assert any(w != t for w, t in zip(want, sorted(((i, u, text(h or "")) for i, u, h in rows), key=str)))


def test_text_of_test_pages_is_their_article(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        got = text(r.html)
        assert got and "\n\n" not in got and r.html.count("<p>") + 1 >= got.count("\n") + 1 and "©" not in got


def test_long_and_deep_pages_take_linear_time():
    n = 60_000
    cases = ["<div>" * n + "x", "<p>" * n + "x", "<b>" * n + "<p>x" * n, "<a b='" * n, "<a " * n, "<!--" * n, "< " * n, "</p>" * n, "&amp" * n, "<article>" * n + "x",
             "<form><div class=ad>" + "<article>x" * n, "<table><tr><td>" * n + "x", "<p><table>" + "<span>" * n + "<div></div>" * n, "<script>" * n, "<ul><li>" * n + "x"]
    for case in cases:
        begin = time.time()
        Page(case).text(frozenset([b"none"]))
        assert time.time() - begin < 20, case[:30]
    assert text("<article>" * n + "x") == "x"
    assert len(Tree("<div>" * n).tags) == n


def test_empty_table(spark):
    out = main_text(frame(spark, []))
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == 0
