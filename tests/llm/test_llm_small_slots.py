"""Headings, captions and tables of pages without article or main stay, however short they are."""

from __future__ import annotations

import pytest

from gristmill.llm import extract
from test_llm_web import body


@pytest.mark.parametrize("pages", [1, 12])
def test_small_parts_of_the_container_stay(spark, pages):
    rows, want = [], {}
    for i in range(pages):
        a, b = f"long{i} " * 90, f"more{i} " * 80
        inner = f"<h1>Over {i}</h1><div class=content><h2>Title {i}</h2><p>{a}</p><figure><img src=x><figcaption>Caption {i}</figcaption></figure><p>{b}</p><table><tr><td>cell {i}</td></tr></table></div>"
        rows.append((i, f"http://small.example/{i}", body(inner + "<div class=sidebar><p>side</p></div>")))
        want[i] = " ".join(f"Over {i} Title {i} {a} Caption {i} {b} cell {i}".split())
    out = extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in out.collect()} == want
