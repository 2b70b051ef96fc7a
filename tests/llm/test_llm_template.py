"""Page templates: classes of equal occurrence vectors, their order, and hosts that name nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.llm import extract

SCHEMA = "page_id long, url string, html string"


def words(seed, n):
    """Words that differ from page to page, in ``n`` of them."""
    return " ".join(f"w{chr(97 + (seed * 7 + k * k) % 26)}{chr(97 + (seed + k) % 26)}{chr(97 + (k * 3) % 26)}" for k in range(n))


def plain_page(i):
    """No article, no main, no telling names: menu, text, teasers, comments and a foot, all in div elements."""
    menu = "".join(f"<div class=q><a href=/{k}>Part {k}</a></div>" for k in range(5))
    teasers = "".join(f"<div class=r><b>{words(i + 50 * k, 3)}</b><span>{words(i + 90 * k, 12)}</span></div>" for k in range(2 + i % 3))
    comments = "".join(f"<div class=s><b>{words(i + 11 * k, 1)}</b><p>{words(i + 31 * k, 40)}</p></div>" for k in range(1 + i % 4))
    text = [words(i + 1000 * k, 25) for k in range(2 + i % 5)]
    html = f"<html><body><div class=a id=n{i}>{menu}</div><div class=b><h2>{words(i, 4)}</h2>{''.join(f'<p>{t}</p>' for t in text)}</div><div class=c>{teasers}</div><div class=d>{comments}</div><div class=e><p>All rights kept by us since long ago, ask before you copy.</p></div></body></html>"
    return html, " ".join([words(i, 4), *text])


def test_pages_that_name_nothing(spark):
    """One hot host whose pages carry ids of their own, read by several tasks."""
    made = [plain_page(i) for i in range(40)]
    rows = [(i, f"http://hot.example/{i}", html) for i, (html, _) in enumerate(made)]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got == {i: text for i, (_, text) in enumerate(made)}


def test_rows_of_a_host_do_not_grow_with_its_pages(spark):
    def count(n):
        rows = [("h", i, f"<body><div id=x{chr(97 + i % 26)}{chr(97 + i // 26)}><p>{i}</p></div><div><p>a</p></div></body>") for i in range(n)]
        return extract.tokens(spark.createDataFrame(rows, "host string, page_id long, html string").withColumn("html", F.col("html").cast("binary"))).count()

    assert count(20) == count(300)


def vectors(pages):
    found = {}
    for i, page in enumerate(pages):
        for role, (n, crc) in extract.profile(page).items():
            found.setdefault(role, []).append((i, n, crc))
    return [(r, len(v), max(n for _, n, _ in v), str([(i, n) for i, n, _ in v]), min(c for *_, c in v), max(c for *_, c in v)) for r, v in found.items()]


def test_occurrence_vectors_decide():
    """Two parts on as many pages, but on other ones, are no class: with their vectors taken away they would be."""
    pages = [f"<body><h1>{words(i, 3)}</h1>{'<div class=x>' + words(i, 9) + '</div>' if i % 4 < 2 else ''}{'<div class=y>' + words(i, 8) + '</div>' if i % 4 in (0, 3) else ''}</body>" for i in range(12)]
    tokens = vectors(pages)
    true, blind = extract.deduce(tokens, 12), extract.deduce([(r, n, most, "", *rest) for r, n, most, _, *rest in tokens], 12)
    assert set(true.classes) == {"body", "body/h1"}
    assert set(blind.classes) == {"body", "body/h1", "body/div.x", "body/div.y"}
    slots = [set(extract.measure(pages[0], t)[0]) for t in (true, blind)]
    assert slots[0] != slots[1]


def test_records_are_classes_that_repeat_and_paragraphs_are_none():
    found = extract.deduce(vectors([plain_page(i)[0] for i in range(9)]), 9)
    assert {r.rpartition("/")[2] for r in found.records} == {"div.q", "div.r", "div.s"}
    assert "html/body/div.e/p" in found.fixed and "html/body/div.b/h2" not in found.fixed


def test_a_class_in_changing_order_is_no_template(spark):
    def page(i):
        parts = [f"<div class=u>{words(i, 20)}</div>", f"<div class=v>{words(i + 5, 20)}</div>"]
        return "<body><div class=t>" + "".join(parts[:: 1 if i % 2 else -1]) + "</div></body>"

    def found(make):
        rows = [("h", i, make(i)) for i in range(8)]
        return extract.templates(spark.createDataFrame(rows, "host string, page_id long, html string").withColumn("html", F.col("html").cast("binary"))).first().template

    assert found(page) == []
    assert found(lambda i: page(1).replace("wh", f"w{i}")) == ["body", "body/div.t", "body/div.t/div.u", "body/div.t/div.v"]


def test_a_very_long_page_and_repeated_rows(spark):
    text = words(3, 200_000)
    rows = [(1, "http://l.example/1", f"<body><div class=m><p>{text}</p></div></body>")] * 2 + [(2, None, None), (3, "http://l.example/2", "<body><div class=m><p>short one</p></div></body>")]
    out = extract.extract(spark.createDataFrame(rows, SCHEMA).withColumn("host", F.lit("x")).withColumn("template", F.lit(1)))
    assert sorted((r.page_id, r.text) for r in out.collect()) == [(1, text), (1, text), (2, ""), (3, "short one")]
