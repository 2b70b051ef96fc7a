"""Personal data: base spans against plain patterns; disguised spans, decoys, odd rows, long runs, redaction."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import pii
from gristmill.llm.common import stored, table
from gristmill.llm.quality import grow

SCHEMA = "doc_id long, text string, key long, h string, kind int, start long, gen string, _spans string"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def plain(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


TEXTS = [
    None, "", "none", "a@b.c", "write to x.y@z.example.com, or a@b", "a@b.c_d@e.f", "x@y@z.w q@r.s.", "é𝔸 a@b.de 😀 c@d.e", "@@@ a@@b.c", "1.2.3.4.5.6.7.8", "1.2.3.999.1.2.3.4", "0001.02.255.256 7.8.9.10",
    "4111 1111 1111 1111", "4111-1111-1111-1112 4111111111111111", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "x4111111111111111y", "+1 (243) 555-5526 and +49 30 1234", "+1 2 +3 4567890123456789 +33 (0)1.23.45.67.89.", "++1 23456789",
    "a.b.c.d.e@f-g.h.i.j." * 200, "1.1.1.1 " * 300, "9" * 20000, "a" * 60_000, "a." * 40_000 + "@", "x@" + "y." * 20_000, "+1" + " " * 50_000 + "x", "1 " * 30_000, "+1" * 5000, "tel +1 (243) 555-5526\nmail a.b@c.org\tip 10.0.0.1",
]


def expected(rows):
    out = Counter()
    for i, t in rows:
        found = plain(t)
        n = Counter(k for k, _, _ in found)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        out[(i, *(n[k] for k in PLAIN), hashlib.sha256(listed.encode()).hexdigest())] += 1
    return out


def odd(spark):
    rows = [*enumerate(TEXTS), (None, "a@b.c no id"), (None, None), (3, "a@b.c"), (3, "other c@d.e")]
    return rows, spark.createDataFrame([(i, t, 1, "x", 2, 3, "y", "z") for i, t in rows], SCHEMA).repartition(4)


def test_base_spans_equal_plain_patterns(spark):
    rows, docs = odd(spark)
    out = pii.personal_data(docs).collect()
    assert Counter(tuple(r)[:6] for r in out) == expected(rows)
    for r in out:  # base spans stay
        mine = {",".join(f"{k}:{a}:{b}" for k, a, b in plain(t)) for i, t in rows if i == r.doc_id}
        assert any(set(m.split(",")) - {""} <= set(r.spans.split(",")) for m in mine)
    assert pii.personal_data(docs.limit(0)).count() == 0


@pytest.mark.parametrize("pattern, of", [*zip(pii.BASE, PLAIN.values())])
def test_base_patterns_find_what_the_plain_ones_do(pattern, of, spark):
    random = np.random.default_rng(12)
    alphabet = list("aZ09.-_@+ ()1\n")
    texts = ["".join(random.choice(alphabet, int(random.integers(0, 60)))) for _ in range(3000)]
    rows = spark.createDataFrame(enumerate(texts), "i int, text string").select("text", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("m")).collect()
    assert all(r.m == [m[0] for m in re.finditer(of, r.text)] for r in rows)


def corpus(spark):
    """Whole given documents, and disguised data in surroundings that no lesson has."""
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    hidden = [
        "Please reach jane.doe77 at web3 dot example dot org for the rest.", "His host 10[.]20[.]30[.]44 was down.", "He paid by 4111.1111.1111.1111 yesterday.", "Call 0049-30-5551234 now",
        "We look at the. Then we go to the place 4111.1111.1111.1112 today.", "The numbers 300[.]20[.]30[.]44 are out.",
    ]
    return docs.unionByName(spark.createDataFrame([(10_000_000 + i, t) for i, t in enumerate(hidden)], "doc_id long, text string")), hidden


def test_disguised_spans_are_added_and_decoys_are_not(spark):
    docs, hidden = corpus(spark)
    out = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    found = [[(s.split(":")[0], t[int(s.split(":")[1]) : int(s.split(":")[2])]) for s in out[10_000_000 + i].spans.split(",") if s] for i, t in enumerate(hidden)]
    assert found == [[("email", "jane.doe77 at web3 dot example dot org")], [("ip", "10[.]20[.]30[.]44")], [("card", "4111.1111.1111.1111")], [("phone", "0049-30-5551234")], [], []]
    assert all(r.spans == ",".join(":".join(map(str, s)) for s in plain(d.text)) for d in docs.where("doc_id < 10000000").collect() for r in [out[d.doc_id]])  # the given documents hold no more
    assert Counter(tuple(out[r.doc_id])[:6] for r in docs.collect()) == expected([tuple(r) for r in docs.collect()])


def test_it_runs_as_expressions_only(spark):
    docs, _ = corpus(spark)
    for df in (pii.matches(pii.keyed(docs)), pii.personal_data(docs), pii.redacted(docs)):
        assert not re.search("Python|Pandas|Arrow|ExistingRDD.*docs|CartesianProduct|NestedLoop", df._jdf.queryExecution().executedPlan().toString().replace("Scan ExistingRDD", ""))


def test_margin_equals_plain_descent(spark):
    random = np.random.default_rng(6)
    x = random.normal(size=(500, 6))
    forest = grow(x, (x[:, 1] > 0.2).astype(float), trees=9, depth=3)
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>")
    assert np.allclose([r.m for r in rows.select(pii.margin(forest).alias("m")).collect()], forest.margin(x))


def test_candidates_beside_base_and_best_of_chains(spark):
    base = spark.createDataFrame([(1, 1, 10, 20), (1, 1, 40, 50), (2, 1, 0, 5)], "key long, h long, start long, end long")
    places = [(0, 10), (0, 11), (12, 14), (19, 22), (20, 40), (30, 60), (50, 51), (0, 70)]
    others = spark.createDataFrame([(1, 1, a, b, 3) for a, b in places], "key long, h long, start long, end long, kind int")
    kept = {(r.start, r.end) for r in pii._beside(base, others).collect()}
    assert kept == {(a, b) for a, b in places if not any(a < d and c < b for c, d in [(10, 20), (40, 50)])}
    added = spark.createDataFrame([(1, 1, k, a, b, o) for k, a, b, o in [(0, 0, 5, 0.1), (1, 4, 9, 0.3), (2, 8, 12, 0.2), (3, 12, 13, 0.0), (2, 12, 13, 0.0)]], "key long, h long, kind int, start long, end long, over double")
    assert {(r.kind, r.start) for r in pii._best(added).collect()} == {(1, 4), (2, 12)}


def test_redaction(spark):
    rows, docs = odd(spark)
    out = pii.redacted(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[28] == "tel [phone]\nmail [email]\tip [ip]" and got[7] == "é𝔸 [email] 😀 [email]" and got[0] is None and got[2] == "none"


def test_sampling_takes_the_smallest_hashes(spark):
    rows = stored(spark.range(5000).select(F.col("id").alias("key"), F.lit(0).alias("h"), F.lit(0).alias("start"), F.lit(1).alias("kind")))
    some = {r.key for r in pii._some(rows, 100).collect()}
    place = F.xxhash64("key", "h", "start", "kind")
    assert some == {r.key for r in rows.orderBy(F.shiftrightunsigned(place, 24), place).limit(100).collect()} and len(some) == 100
