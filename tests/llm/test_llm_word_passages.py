"""The passage stage of the pipeline cuts repeats of more than 50 words, however short the words are."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

import corpus_pipeline
from gristmill.llm import repeats


def cut_by_brute_force(texts):
    texts = [t.encode() for t in texts]
    places = [[m.span() for m in re.finditer(rb"\S+", t)] for t in texts]
    words = [[t[a:b] for a, b in p] for t, p in zip(texts, places)]
    by_byte = Counter(t[p : p + 400] for t in texts for p in range(len(t) - 399))
    by_word = Counter(tuple(w[k : k + 51]) for w in words for k in range(len(w) - 50))
    out = []
    for t, p, w in zip(texts, places, words):
        mark = bytearray(len(t))
        spans = [(k, k + 400) for k in range(len(t) - 399) if by_byte[t[k : k + 400]] > 1]
        spans += [(p[k][0], p[k + 50][1]) for k in range(len(w) - 50) if by_word[tuple(w[k : k + 51])] > 1]
        for a, b in spans:
            mark[a:b] = b"\1" * (b - a)
        out.append(bytes(c for c, m in zip(t, mark) if not m).decode("utf-8", "ignore"))
    return out


def test_passages_of_more_than_fifty_words_are_cut(spark):
    random = np.random.default_rng(51)

    def text(n, longest=6):
        return " ".join("".join(random.choice(list("abcdeé"), int(random.integers(1, longest)))) for _ in range(n))

    p50, p51, p60, wide = text(50), text(51, 3), text(60), "z".join(text(120).split())
    assert len(p51.encode()) < len(p60.encode()) < 400 < len(wide.encode())
    texts = [f"{text(80)} {p} {text(70)}" for p in (p50, p51, p60, wide) for _ in range(3)]
    texts += [text(30) + "\n" + p51.replace(" ", "\n") + "  end", text(40), "a " * 60, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(99, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in corpus_pipeline.without_repeats(spark, table, "").collect()}
    assert got == {**dict(enumerate(cut_by_brute_force(texts))), 99: None}
    assert p50 in got[0] and got[3] != texts[3] and got[6] != texts[6]
    assert {r.text for r in repeats.remove_passages(table.where("doc_id = 3 OR doc_id = 4")).collect()} == {texts[3], texts[4]}
