"""URL filters and HTML extraction."""

import os
import random
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

from payledger.llm import html_extract, url_filters  # noqa: E402

SF = "/root/testdata/sf0.001"
PAGE_SCHEMA = "page_id long, url string, html string, host string, text string, score double, row long"


def odd_pages():
    urls = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "https://net", "https://net/", "https://x.net?q=/en/", "ftp://example.com/de/1",
            "http://example.com/DE/1", "http://myexample.com/de/1", "http://é.org/fr/", "http://org/fr/x", "x://y://z/w", "http://sub.example.net/en", "http://h.com#a/b",
            "http://a.b.com/x", "http://a.b.com/x"]
    return [(i, u, "<p>hello</p>", "h", "t", 1.0, 1) for i, u in enumerate(urls)] + [(None, None, None, None, None, None, None)]


def test_url_rules(spark):
    for df in (spark.createDataFrame(odd_pages(), PAGE_SCHEMA), spark.read.parquet(f"{SF}/pages.parquet")):
        rows = [(r["page_id"], r["url"]) for r in df.collect()]
        expected = brute.urls(rows)
        got = [tuple(r) for r in url_filters.judge_urls(df).select("page_id", "host", "path", "rule", "verdict").collect()]
        order = lambda r: tuple((x is None, x) for x in r[:4])
        for g, e in zip(sorted(got, key=order), sorted(expected, key=order), strict=True):
            assert g[:4] == e[:4]
            assert g[4] == e[4] if e[4] else g[4] in ("allow", "block")


def test_link_graph(spark):
    """Scores equal a plain power iteration; a host that links to blocked hosts is
    blocked, one that trusted hosts link to is not."""
    rng = random.Random(1)
    hosts = ["good.example.net", "bad.net", "spam.com", "fine.com", "both.com", "lone.com"]
    links = {"good.example.net": ["fine.com"], "spam.com": ["bad.net"], "both.com": ["bad.net"], "fine.com": ["good.example.net"], "bad.net": [], "lone.com": []}
    pages, edges = [], {}
    for i, h in enumerate(hosts * 3):
        to = links[h] * rng.randrange(1, 3)
        html = "".join(f'<a href="http://{t}/p?{i}">x</a><a class=b HREF=\'{"https:" * (i % 2)}//{t.upper()}\'>y</a><a href="/local">z</a>' for t in to)
        pages.append((i, f"http://{h}/en/{i}", html, "h", "t", 1.0, 1))
        for t in to:
            edges[h, t] = edges.get((h, t), 0) + 2
    df = spark.createDataFrame(pages, PAGE_SCHEMA)
    got = {(r["src"], r["dst"]): r["weight"] for r in url_filters.host_edges(df).collect()}
    assert got == edges

    def rank(edges, seeds):
        out = {}
        for (s, _), w in edges.items():
            out[s] = out.get(s, 0) + w
        score = dict(seeds)
        for _ in range(200):
            new = {h: 0.15 * m for h, m in seeds.items()}
            for (s, d), w in edges.items():
                new[d] = new.get(d, 0) + 0.85 * score.get(s, 0) * w / out[s]
            score = new
        return score

    trust = rank(edges, {"good.example.net": 1.0})
    distrust = rank({(d, s): w for (s, d), w in edges.items()}, {"bad.net": 1.0})
    scores = {r["host"]: r for r in url_filters.host_scores(df).collect()}
    for h in hosts:
        assert (scores[h]["trust"] if h in scores else 0) == pytest.approx(trust.get(h, 0), abs=1e-4)
        assert (scores[h]["distrust"] if h in scores else 0) == pytest.approx(distrust.get(h, 0), abs=1e-4)
    verdict = {r["host"]: r["verdict"] for r in url_filters.judge_urls(df).collect()}
    assert verdict["spam.com"] == "block" and verdict["fine.com"] == "allow" and verdict["lone.com"] == "allow"
    assert verdict["bad.net"] == "block" and verdict["good.example.net"] == "allow"


def test_verdicts_do_not_change_with_the_size_of_the_table(spark):
    """One blocked host and the host that links to it, alone and among thousands
    of blocked hosts of which one is hot."""
    few = [(1, "http://bad.net/x", "", "h", "t", 1.0, 1), (2, "http://spam.com/x", '<a href="http://bad.net/">x</a>', "h", "t", 1.0, 1),
           (3, "http://good.example.net/en/x", '<a href="http://fine.com/">x</a>', "h", "t", 1.0, 1), (4, "http://fine.com/x", "", "h", "t", 1.0, 1),
           (5, "http://lone.com/x", "", "h", "t", 1.0, 1), (6, "http://far.com/x", '<a href="http://spam.com/">x</a>', "h", "t", 1.0, 1)]
    many = few + [(10 + i, f"http://b{i}.net/x", "", "h", "t", 1.0, 1) for i in range(4000)]
    many += [(5000 + i, "http://hot.net/x", "", "h", "t", 1.0, 1) for i in range(4000)]
    verdicts = []
    for rows in (few, many):
        got = url_filters.judge_urls(spark.createDataFrame(rows, PAGE_SCHEMA), [("allow", "example.net", "/en/"), ("block", "net", "/x")])
        verdicts.append({r["host"]: r["verdict"] for r in got.where("page_id < 10").collect()})
    assert verdicts[0] == verdicts[1] == {"bad.net": "block", "spam.com": "block", "far.com": "block", "good.example.net": "allow",
                                          "fine.com": "allow", "lone.com": "allow"}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li>one</li></ul></nav><div id="cookie-banner">We use cookies</div>
<div class="ad">Buy</div>{main}<aside>More</aside><section class="comments"><p>First!</p></section><form><p>Sign up</p></form><footer>&copy; x</footer></body></html>"""


def test_article():
    main = ("<article><header><h1>Head &amp; line</h1></header><p>One  two<br>three\n four&nbsp;five &#x41;&eacute;<p><b>Open <i>bold</i>"
            "<p>Next &lt;tag&gt;</p><ul><li>a<li>b</ul><div class='comment-list'><p>Reader says</p></div><script>x()</script><p>  </p>"
            "<!-- <p>no</p> --><table><tr><td>c</td><td>d</td></tr></table></article>")
    blocks, marked = html_extract.page_blocks(PAGE.format(main=main))
    assert marked
    assert blocks == ["Head & line", "One two three four five Aé", "Open bold", "Next <tag>", "a", "b", "c", "d"]


def test_without_article():
    blocks, marked = html_extract.page_blocks(PAGE.format(main="<div><p>Body</p>tail</div>"))
    assert (blocks, marked) == (["Body", "tail"], False)


def test_common_lines():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(5) for _ in range(rng.randrange(12))]
        b = [rng.randrange(5) for _ in range(rng.randrange(12))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = html_extract.common_lines(a, b)
        picked, it = [a[i] for i in sorted(got)], iter(b)
        assert len(got) == best[-1][-1] and all(any(x == y for y in it) for x in picked)
        halved, it = html_extract.common_lines(a, b, room=4), iter(b)
        assert len(halved) == best[-1][-1] and all(any(a[i] == y for y in it) for i in sorted(halved))


def test_long_and_malformed_pages():
    """Stray end tags, unclosed elements and long alignments take time in
    proportion, and the text is whole."""
    n = 50_000
    start = time.perf_counter()
    blocks, _ = html_extract.page_blocks("<b>" * n + "<p>x</p>" * 3 + "</i>" * n + "<p>y" * n + "</b></p>" * n)
    assert blocks == ["x"] * 3 + ["y"] * n
    blocks, marked = html_extract.page_blocks("<article>" + "<li>a" * n + "</ul>" * n + "<div>z</div></article>")
    assert marked and blocks == ["a"] * n + ["z"]
    a = [f"a{i}" if i % 3 else "same" for i in range(30_000)]
    b = [f"b{i}" if i % 3 else "same" for i in range(30_000)]
    assert len(html_extract.common_lines(a, b)) == 10_000
    assert time.perf_counter() - start < 60


def test_quoted_lines_stay(spark):
    """A line that articles share between their own lines is text; one that ends
    all of them is not."""
    def page(i):
        return f"<article><p>Title of {i} in its own words</p><p>A proverb that all quote</p><p>More text of {i}</p><p>Share this</p></article>"

    rows = [(i, f"http://h.com/{i}", page(i), "h", "t", 1.0, 1) for i in range(5)]
    rows += [(10 + i, f"http://q.com/{i}", f"<article><p>Text {i} of its own</p><p>{'A passage of three' if 2 < i < 6 else f'End of {i}'}</p></article>", "h", "t", 1.0, 1)
             for i in range(9)]
    df = spark.createDataFrame(rows, PAGE_SCHEMA)
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert all(got[i] == f"Title of {i} in its own words\nA proverb that all quote\nMore text of {i}" for i in (1, 2, 3))
    assert all(got[10 + i] == f"Text {i} of its own\nA passage of three" for i in (3, 4, 5))


def test_differencing(spark):
    """Pages without an article lose the lines they share with their neighbour."""
    def page(i):
        return f"<div>Top line</div><p>Story {i}</p><p>Part two of {i}</p><div>Read more stories</div>"

    rows = [(i, f"http://h.com/a/{i:04d}", page(i), "h", "t", 1.0, 1) for i in range(40)]
    rows += [(100, "http://one.com/x", page(1), "h", "t", 1.0, 1), (101, "http://twin.com/x", page(2), "h", "t", 1.0, 1),
             (102, "http://twin.com/x", page(2), "h", "t", 1.0, 1), (None, None, None, None, None, None, None), (103, "http://e.com", "", "", "", 1.0, 1)]
    df = spark.createDataFrame(rows, PAGE_SCHEMA)
    for group in (html_extract.GROUP, 10):
        got = {r["page_id"]: r["text"] for r in html_extract.extract(df, group).collect()}
        assert all(got[i] == f"Story {i}\nPart two of {i}" for i in range(40))
        assert got[100] == "Top line\nStory 1\nPart two of 1\nRead more stories"
        assert got[101] == got[102] == "Top line\nStory 2\nPart two of 2\nRead more stories"
        assert got[None] == "" and got[103] == ""


def test_neighbours_do_not_change_with_the_size_of_a_host(spark):
    """Near urls meet whatever the range, and copies lose what one page loses."""
    rows = []
    for section in ("blog", "news", "shop"):
        for i in range(30):
            body = f"<div>Menu of {section}</div><p>{section} story {i // 3}</p>"  # three copies of every page
            rows.append((len(rows), f"http://h.com/{section}/{i:03d}", body, "h", "t", 1.0, 1))
    rows += [(1000 + i, f"http://q.com/?p={i}", f"<div>Top</div><p>Query {i}</p>", "h", "t", 1.0, 1) for i in range(25)]
    df = spark.createDataFrame(rows, PAGE_SCHEMA).repartition(3)
    expected = {i: f"{u.split('/')[3]} story {i % 30 // 3}" for i, u, *_ in rows[:90]} | {1000 + i: f"Query {i}" for i in range(25)}
    # the first and last of a section stand beside another section, whose urls are farther
    for group in (html_extract.GROUP, 4):
        assert {r["page_id"]: r["text"] for r in html_extract.extract(df, group).collect()} == expected


def test_differencing_inside_articles(spark):
    """Lines that the pages on both sides share go, also inside an article; those
    of a copy of the article, or of one neighbour, stay."""
    def page(*lines):
        return "<nav>Menu</nav><article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article><footer>End</footer>"

    rows = [(i, f"http://h.com/a/{i:02d}", page(f"Story {i} with its own text", f"Part two of {i}", "Read more stories"), "h", "t", 1.0, 1) for i in range(9)]
    rows += [(20 + i, f"http://copy.com/{i}", page("One article", "in three", "near copies", f"Number {i}"), "h", "t", 1.0, 1) for i in range(3)]
    rows += [(30 + i, f"http://one.com/{i}", page(f"Long text of page {i}", "Said once more" if i < 2 else "Other words"), "h", "t", 1.0, 1) for i in range(3)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, PAGE_SCHEMA)).collect()}
    assert all(got[i] == f"Story {i} with its own text\nPart two of {i}" for i in range(1, 8))
    assert all(got[20 + i] == f"One article\nin three\nnear copies\nNumber {i}" for i in range(3))
    assert got[31] == "Long text of page 1\nSaid once more"


def test_pages_of_the_tables(spark):
    import html as H
    import re

    df = spark.read.parquet(f"{SF}/pages.parquet")
    raw = {r["page_id"]: r for r in df.collect()}
    got = html_extract.extract(df).collect()
    assert len(got) == len(raw)
    for r in got:
        inner = re.search(r"(?s)<article>(.*)</article>", raw[r["page_id"]]["html"])[1]
        blocks = [" ".join(H.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_empty_pages(spark):
    none = spark.createDataFrame([], PAGE_SCHEMA)
    assert html_extract.extract(none).count() == 0 and url_filters.judge_urls(none).count() == 0
