"""URL filter, page extraction and neighbour search against brute force."""

from __future__ import annotations

import html
import re

import numpy as np
import pytest

from gristmill.llm import common, extract, neighbours, urls
from gristmill.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/x?q#f", "http://www.example.com/en/1", "http://x.www.example.com/en", "https://example.com/en/", "https://myexample.com/en/",
    "ftp://a.net/es/1", "http://net/fr/", "http://a.net?x=/es/", "http://a.net#/es/", "http://com", "http://com/", "http://ÄB.org/é", "http://casino-poker.example.org/de/1", "http://library.example.org/de/2",
    "a://b://c/d", "http://" + "long" * 20000 + ".org/x",
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :]
        host = re.match("[^/?#]*", rest, re.S)[0]
        path = re.match("[^?#]*", rest[len(host) :], re.S)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for action, rule in URL_RULES:
        h, t = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + t) and (best is None or len(rule) > len(best[1])):
            best = (action, rule)
    return host, path, best


def test_urls_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate([*URLS, URLS[5]])] + [(None, URLS[6], "x", "y")], "page_id long, url string, host string, rule string")
    rows = urls.judge(pages, URL_RULES).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        url = URLS[6] if r.page_id is None else [*URLS, URLS[5]][r.page_id]
        host, path, best = plain(url)
        assert (r.host, r.path, r.rule) == (host, path, best and best[1]) and 0 <= r.score <= 1
        assert r.verdict == (best[0] if best else "block" if r.score >= 0.6 else "allow")
    by = {r.page_id: r.verdict for r in rows}
    assert by[16] == "block" and by[17] == "allow"
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0


def test_regression_learns_a_given_table(spark):
    labelled = spark.createDataFrame([(f"http://good{i}.org/a", 0) for i in range(40)] + [(f"http://evil{i}.org/a", 1) for i in range(40)] + [(None, 1), ("http://x", None)], "url string, label int")
    pages = spark.createDataFrame([(1, "http://good99.org/b"), (2, "http://evil99.org/b")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, [], labelled).collect()} == {1: "allow", 2: "block"}
    assert urls.judge(pages, [], labelled.limit(0)).where("verdict = 'allow'").count() == 2


def test_extraction_of_the_given_pages(spark):
    pages = common.table(spark, "/root/testdata/sf0.01", "pages")
    want = {}
    for r in pages.collect():
        body = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        want[r.page_id] = re.sub(r"\s+", " ", html.unescape(re.sub("</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", body)))).strip()
    got = {r.page_id: (r.text, r.n_chars) for r in extract.extract(pages).collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def body(inner):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li><a href=x>menu</a></ul></nav>{inner}<footer>foot</footer></body></html>"


PAGES = {
    "main": (body("<main><h1>Head &amp; more</h1><p>A&nbsp;b<p>c <i>d</i>e<br>f<form><p>sign up</p></form><div class='user-comments'><p>nice</p></div></main>"), "Head & more A b c de f"),
    "cut": (body("<article><p>First<p>second").split("<footer>")[0], "First second"),
    "script": (body("<article>one<script>if (a<b) {}</script><style>x{}</style><!-- <p>hidden --> two</article><aside>side</aside>"), "one two"),
    "plain": ("just text", "just text"), "null": (None, ""), "empty": ("", ""), "broken": ("<p>a<b>c</p></div>d < e", "ac d < e"),
    "sidebar": (body("<div class='content'><p>" + "Long text. " * 20 + "</p></div><div class='sidebar'><p>" + "Side. " * 90 + "</p></div><div id='cookie-notice'>ok?</div>"), ("Long text. " * 20).strip()),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_extraction_of_single_pages(spark, name):
    page, want = PAGES[name]
    table = spark.createDataFrame([(1, f"http://{name}.example/1", page, "h")], "page_id long, url string, html string, host string")
    got = extract.extract(table).first()
    assert (got.text, got.n_chars) == (want, len(want))


def test_template_from_many_pages_finds_the_text_slot(spark):
    pages = [(i, f"http://one.example/{i}", body(f"<div class=a><p>share this</p></div><div class=b><p>{'word%d ' % i * 60}</p><p>tail {i}</p></div><div class=c><a href=x>{'link ' * 40}</a></div>")) for i in range(12)]
    pages += [(50, None, "<p>alone</p>"), (None, "http://one.example/x", pages[0][2]), (3, "http://one.example/3", pages[3][2])]
    rows = extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)).collect()
    assert len(rows) == 15
    for r in rows:
        if r.page_id == 50:
            assert r.text == "alone"
        else:
            i = r.page_id or 0
            assert r.text == f"{'word%d ' % i * 60}tail {i}"
    assert extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def exact(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q % every == 0:
            scored = sorted((-float((x * v).sum()), i) for i, v in good if i != q and len(v) == len(x))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


@pytest.mark.parametrize("n, width, scale", [(60, 8, False), (700, 10, True), (12, 3, True)])
def test_neighbours_of_small_tables_are_exact(spark, n, width, scale):
    random = np.random.default_rng(n)
    x = random.normal(size=(n, width)) * (random.uniform(0.2, 3, (n, 1)) if scale else 1)
    if not scale:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows[5] = (5, rows[4][1])  # a tie
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * width), (n + 3, [float("nan")] * width), (n + 4, [float("inf")] + [1.0] * (width - 1)), (n + 5, [None] + [1.0] * (width - 1)), (None, rows[0][1])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = {}
    for r in neighbours.search_every(table, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    want = exact(rows, 5, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)
    assert neighbours.search_every(table.limit(0), 5).count() == 0


def test_recall_of_multiprobe_against_brute_force(spark):
    """Six thousand random directions in groups, with few candidates to meet, so that probing decides."""
    random = np.random.default_rng(8)
    x = random.normal(size=(6000, 64)) + 0.6 * random.normal(size=(40, 64))[random.integers(0, 40, 6000)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(table, table.where("vec_id % 100 = 0"), least=500).groupBy("query_id").agg({"vec_id": "collect_list"}).collect()
    hit = 0
    for q, found in got:
        s = x @ x[q]
        s[q] = -9
        hit += len(set(np.argsort(-s)[:20].tolist()) & set(found))
    assert len(got) == 60 and hit / 1200 >= 0.9


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(1).normal(size=(5, 16))
    for y in neighbours.rotated(x, 3):
        assert np.allclose(np.linalg.norm(y, axis=1), 1)
        assert np.allclose(y @ y.T, (x @ x.T) / np.outer(*(np.linalg.norm(x, axis=1),) * 2))
