"""Repeated passages of texts that are worked in several chunks."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from gristmill.llm import repeats
from test_llm_documents import expected_repeats


@pytest.mark.parametrize("repeat", [False, True])
def test_chunk_borders_equal_brute_force(spark, monkeypatch, repeat):
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    random = np.random.default_rng(77)
    rows = [(i, "".join(random.choice(list("abcdefgh "), 20_000))) for i in range(4)]
    if repeat:
        rows.append((4, rows[0][1][3300:9100] + rows[1][1][70:2500] + rows[2][1][:450]))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in repeats.repeated_passages(table).collect())
    assert got == expected_repeats(rows, 400)
