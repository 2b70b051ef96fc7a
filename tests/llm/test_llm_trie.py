"""Prefix trie against a plain one: nulls, ties, repeats, empty texts, absent families, hot turns, clashing columns, empty tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gristmill.llm import trie
from gristmill.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string, c long, depth string, d1 long, chars int, left string"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(rs)] for c, rs in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100 if c >= 0 else c + (-c) % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    out = Counter()
    for p, m in members.items():
        end = ",".join(str(c) for c in m if len(built[c]) == len(p))
        out[(m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(end.encode()).hexdigest())] += 1
    return out


def odd_rows():
    random = np.random.default_rng(11)
    rows = []
    for c in [*range(0, 40), *range(100, 140), 205, 206, 207, 300, -5, -100, -160, 12345678901]:
        for t in range(int(random.integers(1, 14))):
            role = ["user", "assistant", None, ""][int(random.choice(4, p=[0.6, 0.3, 0.05, 0.05]))]
            text = [None, "", "hello", "höw are yoü?"][int(random.choice(4, p=[0.05, 0.1, 0.6, 0.25]))]
            rows.append((c, t if random.random() > 0.05 else None, role, text))
    rows += [(7, 3, "user", "again")] * 3 + [(None, 1, "user", "no id"), (None, None, None, None)]
    rows += [(500 + k, t, "user", f"copy {t}") for k in range(60) for t in range(4)]  # copies, cut where h turns are taken from no family
    rows += [(600, t, "system", "long " * 20000 if t == 3 else "x") for t in range(300)] + [(601, t, "system", "x") for t in range(300)]
    seen = {}
    for r in rows:  # rows of one turn differ in nothing, so that their order is one
        seen.setdefault(r[:2], r)
    return [seen[r[:2]] for r in rows]


@pytest.mark.parametrize("least, most", [(1 << 10, 1 << 18), (1, 40), (1, 1)])
def test_trie_equals_plain_one(spark, least, most):
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], SCHEMA).repartition(5)
    assert Counter(tuple(r) for r in trie.prefix_trie(docs, least, most).collect()) == plain(rows)


def test_trie_of_the_given_conversations(spark):
    docs = table(spark, "/root/testdata/sf0.01", "conversations")
    assert Counter(tuple(r) for r in trie.prefix_trie(docs, 4, 16).collect()) == plain([tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()])


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(empty).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "a", 1, "x", 2, 3, "y")], SCHEMA)).count() == 0


def test_slots_are_minimal_perfect_and_verified():
    random = np.random.default_rng(2)
    keys = np.unique(random.integers(0, 1 << 63, (50_000, 2), dtype=np.uint64), axis=0)
    keys[: len(keys) // 2, 0] = 7  # halves that agree
    slots = trie.Slots.of(np.unique(keys, axis=0))
    found = slots.find(slots.keys)
    assert (found == np.arange(len(slots.keys))).all()
    assert sorted(slots.find(keys)) == list(range(len(keys)))
    assert (slots.find(random.integers(0, 1 << 63, (50_000, 2), dtype=np.uint64)) == -1).all()
    assert len(trie.Slots.of(keys[:0]).find(keys[:3])) == 3
