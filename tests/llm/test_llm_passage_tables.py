"""The refinement of passage ends writes and tells apart only blocks that share something."""

from __future__ import annotations

import random

from gristmill.llm import repeats


def test_blocks_that_share_nothing_are_not_told_apart(spark, monkeypatch):
    was, weights, seen = repeats.stored, {}, []

    def stored(df):
        out = was(df)
        if {"x1", "x2", "y1", "y2"} <= set(out.columns):
            rows = out.collect()
            if not weights:  # all blocks
                for r in rows:
                    weights[r["x1"], r["x2"]] = weights.get((r["x1"], r["x2"]), 0) + r["weight"]
            else:
                seen.extend((r["x1"], r["x2"]) for r in rows)
        return out

    monkeypatch.setattr(repeats, "stored", stored)
    chance = random.Random(5)
    made = lambda n: bytes(chance.randrange(97, 123) for _ in range(n)).decode()
    passage = made(900)
    docs = spark.createDataFrame([(i, made(700 + 37 * i) + passage + made(600)) for i in range(12)], "doc_id long, text string")
    rows = repeats.repeated_passages(docs, batches=1, words=0).collect()
    assert len(rows) == 12 and min(r["n_removed"] for r in rows) >= 900
    assert seen and min(weights.values()) == 1  # there are blocks that share nothing
    assert min(weights[x] for x in seen) > 1
