"""Conversation repair against plain recursion and against all edits: nulls, ties, repeats, odd roles, long conversations, blocks, empty tables."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import repair
from gristmill.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string, c long, o string, audit int, copy string"
WHITE = " \t\n\x0b\x0c\r"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
MADE = {0: 2, 1: 2, 2: 3, 3: 2}


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        bare = text.rstrip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def options(rows, marks, i, s):
    """(letter, cost, next place, next state, role and text)"""
    if i < len(rows):
        (role, text), fault = rows[i], marks[i]
        yield "D", 4, i + 1, s, None
        if fault not in ("blank", "duplicate"):
            more = 3 * (fault == "truncated")
            if (s, role[:1]) in NEXT:
                yield "K", more, i + 1, NEXT[s, role[:1]], (role, text)
            yield "R", 3 + more, i + 1, MADE[s], ({2: "user", 3: "assistant"}[MADE[s]], text)
    yield "I", 3, i, MADE[s], ({2: "user", 3: "assistant"}[MADE[s]], "")


def least(rows):
    marks, after = faults(rows), None
    for i in range(len(rows), -1, -1):
        now = {s: (0, "", ()) for s in (0, 3)} if i == len(rows) else {}
        for _ in range(4):
            for s in range(4):
                for letter, cost, j, t, made in options(rows, marks, i, s):
                    behind = (now if j == i else after).get(t)
                    if behind:
                        found = (cost + behind[0], letter + behind[1], ((made,) if made else ()) + behind[2])
                        now[s] = min(now.get(s, found), found)
        after = now
    return after[0]


def digest(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def report(rows, whole):
    """``rows`` (conv, turn, role, text) in order, after damage."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn, role, text))
    out = set()
    for c in {r[0] for r in whole if r[0] is not None}:
        mine = by[c]
        texts = [r[1:] for r in mine]
        marks, turns = faults(texts), [r[0] for r in mine if r[0] is not None]
        cost, audit, made = least(texts)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(texts, texts[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.add((c, gaps, *(marks.count(n) for n in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest(made)))
    return out


def damage(rows):
    out = []
    for c, turn, role, text in rows:
        if c is None:
            continue
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{c}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(c, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return sorted(out, key=lambda r: (r[0], r[1] is not None, r[1] or 0))


def odd_rows():
    random = np.random.default_rng(13)
    rows = []
    texts = [None, "", " \t\n", "Hello.", "Hello.", "What?  \n", "cut off", "ends. ", "naïve!", "é", "Ja. ", ". "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "sales", "User", "ünder"]
    for c in [*range(1, 160), -7, 99999999999]:
        for t in range(int(random.integers(1, 9))):
            rows.append((c, t * int(random.integers(1, 3)) if random.random() > 0.04 else None, str(roles[int(random.integers(len(roles)))]) if random.random() > 0.05 else None, texts[int(random.integers(len(texts)))]))
    rows += [(300, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(30)] + [(301, None, "user", "all null.")] * 3
    rows += [(302, t, "system", f"x {t}") for t in range(50)] + [(303, 5, "user", "long " * 300_000 + "."), (None, 1, "user", "no id.")]
    rows += [(304, 1 << 40, "user", "far."), (304, 0, "assistant", "near.")] + [(c, 0, "user", "gone.") for c in range(400, 440)]
    seen = {}
    for r in rows:  # rows of one turn are alike, so that their order is one
        seen.setdefault(r[:2], r)
    return [seen[r[:2]] for r in rows]


@pytest.mark.parametrize("block", [4096, 3])
def test_report_equals_plain_recursion(spark, block):
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA).repartition(5)
    got = {tuple(r) for r in repair.structure_report(docs, repair.damaged(docs), block).collect()}
    assert got == report(damage(rows), rows)


def test_report_of_the_given_conversations(spark):
    docs = table(spark, "/root/testdata/sf0.01", "conversations")
    rows = [tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in repair.damaged_report(docs).collect()} == report(damage(rows), rows)


def test_audits_equal_all_edits_tried():
    """The recursion above against every string of edits, and the ranked audits against both, for all short conversations."""
    kinds = [("user", "a."), ("assistant", "b."), ("system", "c."), ("tool", "d."), ("user", ""), ("assistant", "cut")]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            marks, tried = faults(rows), []
            for length in range(n, n + 3):
                for audit in itertools.product("DIKR", repeat=length):
                    i, s, cost = 0, 0, 0
                    for letter in audit:
                        step = next((o for o in options(rows, marks, i, s) if o[0] == letter), None)
                        if step is None:
                            break
                        cost, i, s = cost + step[1], step[2], step[3]
                    else:
                        if i == n and s in (0, 3):
                            tried.append((cost, "".join(audit)))
            want = least(rows)[:2]
            assert min(tried) == want
            if n:
                faulted = np.array(["suat".index(r[0][0] if r[0][0] in "sua" else "t") + 4 * ["", "blank", "duplicate", "truncated"].index(m) for r, m in zip(rows, marks)])
                cost, audit, _ = repair.least_audits([faulted], repair.LAST[None], np.array([True]))
                assert (cost[0, 0], audit[0, 0]) == want


def test_long_conversation_in_blocks(spark):
    random = np.random.default_rng(3)
    rows = [(1, t, ["user", "assistant", "system"][int(random.choice(3, p=[0.5, 0.45, 0.05]))], f"{t}" + ("." if random.random() > 0.2 else "")) for t in range(3000)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {block: repair.audits(repair.marked(repair.damaged(docs)), block).collect() for block in (4096, 100)}
    assert found[4096] == found[100]
    assert (found[100][0].cost, found[100][0].audit) == least([r[2:] for r in damage(rows)])[:2]


def test_repaired_rows_have_the_structure(spark):
    docs = table(spark, "/root/testdata/sf0.001", "conversations").withColumn("role", F.when(F.col("turn") % 3 == 0, "tool").otherwise(F.col("role")))
    rows = repair.damaged(docs)
    out = repair.repaired(rows, repair.audits(repair.marked(rows))).toPandas()
    for _, turns in out.groupby("c"):
        turns = turns.sort_values("place")
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in turns.role)) and list(turns.place) == list(range(len(turns)))


def test_report_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.damaged_report(empty).count() == 0
