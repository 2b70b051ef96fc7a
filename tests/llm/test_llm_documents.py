"""Operators on documents against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gristmill.llm import common, decontaminate, language, packing, quality, repeats, simhash, toxicity

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, fp string, h int, _key string, label int, spans string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def passage(seed, n):
    random = np.random.default_rng(seed)
    return " ".join("".join(random.choice(list("abcdeéß"), 5)) for _ in range(n))


LONG = " ".join(passage(s, 2000) for s in range(20))
COMMON = passage(90, 120)
TEXTS = [
    (1, None), (2, ""), (3, "One"), (4, "one"), (5, "one two"), (6, LONG), (7, LONG + " end"), (8, COMMON), (9, COMMON), (10, COMMON),
    (11, passage(1, 30) + " " + COMMON + " " + passage(2, 30)), (12, passage(3, 40) + COMMON[100:560] + passage(4, 5)), (13, "a" * 1500), (14, "x" * 399), (15, "x" * 400),
    (16, "x" * 401), (None, "no id here at all"), (None, None), (17, passage(5, 200) + passage(5, 200)), (18, "\n\t  "), (19, "!!! ??? 42"), (9, COMMON), (9, COMMON), (20, "é" * 450),
    (21, passage(7, 60) + "\n" + passage(8, 11)), (22, "THE " + passage(8, 11).upper()), (-5, "one"), (23, "ÀÉ ohne"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), 1, "x", 2, "y", 3, "z") for i, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def joined(prints):
    """Component of each row by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def expected_components(rows):
    prints = [fingerprint(t) for _, t in rows]
    groups = joined(prints)
    least = {g: min((rows[i][0] for i in range(len(rows)) if groups[i] == g and rows[i][0] is not None), default=None) for g in groups}
    return Counter((rows[i][0], f"{prints[i]:016x}", least[groups[i]]) for i in range(len(rows)))


def test_simhash_equals_brute_force(docs):
    got = Counter(tuple(r) for r in simhash.near_duplicates(docs).collect())
    assert got == expected_components(TEXTS)


def test_simhash_links_chains_and_all_two_bit_pairs(spark):
    random = np.random.default_rng(4)
    start = [int(v) for v in random.integers(-(1 << 63), 1 << 63, 40)]
    values = set(start)
    for v in start:
        for _ in range(6):  # a chain of steps of one or two bits
            for b in random.choice(64, random.integers(1, 3), replace=False):
                v ^= -(1 << 63) if b == 63 else 1 << int(b)
            values.add(v)
    values = sorted(values)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "key long, fp long")
    got = {r.key: r.component for r in simhash.classes(rows).collect()}
    groups = joined([v & (1 << 64) - 1 for v in values])
    least = {g: min(i for i, h in enumerate(groups) if h == g) for g in groups}
    assert got == {i: least[g] for i, g in enumerate(groups)}


def test_a_large_group_of_near_copies_gives_few_rows(spark):
    values = [(i, (1 << (i % 60)) ^ (1 << (i // 60))) for i in range(3600)]
    rows = spark.createDataFrame(values, "key long, fp long")
    assert simhash.links(rows).count() < 65 * len({v for _, v in values})
    assert simhash.classes(rows).select("component").distinct().count() == 1


def test_simhash_keeps_one_row_of_each_component(docs, empty):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = Counter(r.doc_id for r in kept.collect())
    groups = {}
    for i, _, c in expected_components(TEXTS):
        groups.setdefault(c, i)
    assert set(got) == set(groups) and max(got.values()) == 1
    assert simhash.keep_one(empty).count() == simhash.near_duplicates(empty).count() == 0


def repeated_marks(units, length):
    """For each sequence, a byte per unit: whether a string of ``length`` units that occurs more than once covers it."""
    seen = Counter(u[p : p + length] for u in units for p in range(len(u) - length + 1))
    marks = []
    for u in units:
        mark = bytearray(len(u))
        for p in range(len(u) - length + 1):
            if seen[u[p : p + length]] > 1:
                mark[p : p + length] = b"\1" * length
        marks.append(mark)
    return marks


def repeated_words(texts, words=51):
    """Bytes (first, last + 1) of the maximal runs of words in strings of ``words`` words that occur more than once."""
    places = [[m.span() for m in re.finditer(rb"[^ \t\n\r\x0b\x0c]+", t)] for t in texts]
    marks = repeated_marks([tuple(t[a:b] for a, b in p) for t, p in zip(texts, places)], words)
    return [[(p[m.start()][0], p[m.end() - 1][1]) for m in re.finditer(b"\1+", bytes(mark))] for p, mark in zip(places, marks)]


def expected_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    out = Counter()
    for (i, _), t, mark, spans in zip(rows, texts, repeated_marks(texts, length), repeated_words(texts)):
        kept = bytes(c for c, m in zip(t, mark) if not m)
        out[(i, len(t), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest(), sum(b - a for a, b in spans), len(spans))] += 1
    return out


def without_passages(texts):
    """Texts without repeats of 400 bytes or of 51 words."""
    texts = [t.encode() for t in texts]
    out = []
    for t, mark, spans in zip(texts, repeated_marks(texts, 400), repeated_words(texts)):
        for a, b in spans:
            mark[a:b] = b"\1" * (b - a)
        out.append(bytes(c for c, m in zip(t, mark) if not m).decode("utf-8", "ignore"))
    return out


def test_repeats_equal_brute_force(docs):
    rows = [r for r in TEXTS if r[1] is None or len(r[1]) < 5000]
    few = docs.where("n_chars IS NULL OR n_chars < 5000")
    got = Counter(tuple(r) for r in repeats.repeated_passages(few).collect())
    assert got == expected_repeats(rows, 400)


def test_repeats_with_many_edges_equal_brute_force(spark):
    random = np.random.default_rng(12)
    pool = [passage(200 + k, 60) for k in range(6)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(random.integers(1, 5)):
            p = pool[random.integers(len(pool))]
            a, b = sorted(random.integers(0, len(p), 2))
            parts.append(p[a:b] if random.random() < 0.7 else passage(1000 + i, 8))
        rows.append((i, "".join(parts)))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for batches in (1, 4):
        got = Counter(tuple(r) for r in repeats.repeated_passages(table, length=100, batches=batches).collect())
        assert got == expected_repeats(rows, 100)


def test_passages_are_cut_and_rows_kept(docs, empty):
    out = {r.doc_id: r for r in repeats.remove_passages(docs.where("doc_id >= 8 AND doc_id <= 16")).collect()}
    assert out[8].text == out[10].text == "" and out[8].n_chars == 0 and out[8].spans == "z"
    assert out[11].text.startswith(passage(1, 30)) and COMMON not in out[11].text and out[11].n_chars == len(out[11].text)
    assert out[14].text == "x" * 399 and out[16].text == ""
    assert repeats.remove_passages(docs).count() == len(TEXTS) and repeats.remove_passages(docs).columns == docs.columns
    assert repeats.remove_passages(empty).count() == repeats.repeated_passages(empty).count() == 0


def test_family_merges_equal_levels(spark):
    family = repeats.Family()
    for b in range(6):
        family.add(spark.createDataFrame([(1,), (b + 10,), (b + 10 if b == 5 else 99 + b,)], "gram long"))
    assert [rank for rank, _ in family.levels] == [2, 1]
    assert {r.gram: r.n for r in family.repeated().collect()} == {1: 6, 15: 2}


ITEMS = [(1, passage(8, 11)), (2, "one"), (3, None), (4, "... !!"), (5, passage(5, 200)[:300]), (None, passage(7, 12)), (1, passage(8, 11)), (6, "never anywhere"), (7, LONG[5000:5400])]


def expected_leaks(rows, items, n=10):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall(lower(t))
        for k in range(max(1, len(w) - n + 1)) if w else ():
            windows[tuple(w[k : k + n])].add("" if i is None else str(i))
    out = Counter()
    for i, t in rows:
        w = word.findall(lower(t))
        hit, met = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                found = windows.get(tuple(w[k : k + size]))
                if found:
                    hit.update(range(k, k + size))
                    met |= found
        out[(i, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit))] += 1
    return out


def test_contamination_equals_brute_force(spark, docs, empty):
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, key int")
    want = expected_leaks(TEXTS, ITEMS)
    assert Counter(tuple(r) for r in decontaminate.contamination(docs, items).collect()) == want
    index = common.stored(decontaminate.build_index(docs.select(common.row_id(docs).alias("key"), "text")))
    blocks = decontaminate.search(index, items, block_bytes=200).collect()
    assert sum(bool(r.spans) for r in blocks) == sum(n for k, n in want.items() if k[5])
    assert Counter((len(r["items"]), sum(s.end - s.start for s in r.spans)) for r in blocks) == Counter({k: sum(n for w, n in want.items() if (w[3], w[2]) == k) for k in {(w[3], w[2]) for w in want}})
    assert decontaminate.contamination(empty, items).count() == 0
    assert not decontaminate.contamination(docs, items.limit(0)).where("contaminated").count()
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if not k[5])


def test_proximity(spark):
    rows = spark.createDataFrame([(1, "the quick red fox jumps"), (2, "fox and a quick"), (3, "quick"), (4, "fox one two three four five six quick"), (5, "fox")], "key long, text string")
    found = decontaminate.proximity(decontaminate.build_index(rows), [("q", "quick fox")], slop=2)
    assert sorted(map(tuple, found.collect())) == [(1, "q", 1, 4), (2, "q", 0, 4)]


def test_packing_round_trip(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(docs, block=8).toPandas()
    want = Counter()
    for i, t in TEXTS:
        ids = np.array(reference.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        for k, (start, length) in enumerate(packing.cut(len(ids))):
            want[(i, k, start, length, zlib.crc32(ids[start : start + length].tobytes()))] += 1
    got = Counter((None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows.itertuples())
    assert got == want
    for _, g in rows.sort_values("offset").groupby("sequence_id"):
        assert list(g["offset"]) == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() <= 1024
    assert packing.pack(empty).count() == 0


def test_special_token_text_has_the_same_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    reference, own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.tokenizer("byte_bpe_50k")
    for text in ("a <|endoftext|> b", "<|endoftext|>", "", "  x\n\n\u3000 é", "\U0001f600" * 3, "a" * 5000):
        assert own(text) == reference.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("low, high, capacity", [(1, 100, 100), (20, 45, 100), (51, 100, 100), (1, 10, 17), (1, 1, 5)])
def test_local_search_keeps_pieces_and_never_uses_more_bins(low, high, capacity):
    sizes = np.random.default_rng(low).integers(low, high + 1, 300).tolist()
    first = packing.best_fit(sizes, capacity)
    after = packing.local_search([list(b) for b in first], sizes, capacity)
    assert sorted(i for b in after for i in b) == list(range(300))
    assert all(sum(sizes[i] for i in b) <= capacity for b in after) and -(-sum(sizes) // capacity) <= len(after) <= len(first)


@pytest.mark.parametrize("bins, sizes", [([[0], [1], [2]], [2, 7, 8]), ([[0, 1], [2, 3], [4]], [6, 2, 7, 1, 3]), ([[0], [1, 2], [3, 4]], [4, 3, 5, 6, 2])])
def test_local_search_empties_a_bin(bins, sizes):
    need = -(-sum(sizes) // 10)
    assert len(packing.local_search([list(b) for b in bins], sizes, 10)) == need < len(bins)


def test_toxicity_on_held_out_documents(spark):
    docs, labels = common.table(spark, "/root/testdata/sf0.1", "documents"), common.table(spark, "/root/testdata/sf0.1", "labels")
    out = toxicity.toxic_documents(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    bad, good = out[out.toxic == 1], out[out.toxic == 0]
    assert bad.predicted.mean() > 0.88 and good.predicted.mean() < 0.02 and out.score.between(0, 1).all()


def plain_grams(text, table):
    """Symbols of the n-gram that ends in every letter and word end, from strings; what stands before the word's start is 0."""
    s = [0, 0] + [int(table[ord(c)]) for c in text] + [0, 0]
    out = []
    for i in range(2, len(s)):
        if s[i] or s[i - 1]:
            word = []
            for k in range(i - 1, -1, -1):
                if not s[k]:
                    break
                word.insert(0, s[k])
            out.append(tuple(([0] * toxicity.LONG + word)[-toxicity.LONG :] + [s[i]]))
    return out


def number(gram):
    n = 0
    for symbol in gram:
        n = n * toxicity.SYMBOLS + symbol
    return n


def test_grams_stay_within_words():
    table = toxicity.symbol_of()
    text = "Ein längerer Text, in dem in Wörtern 42 Wörter in sind; réeuxê.  "
    assert toxicity.grams(toxicity.symbols([text.encode()], table)[0]).key.tolist() == [number(g) for g in plain_grams(text, table)]
    assert not len(toxicity.grams(toxicity.symbols([b"", b" .. "], table)[0]).key)


def plain_model(rows, table, part):
    """n-gram: log ratio, of the model of all labelled rows but those of ``part``; Kneser-Ney from dictionaries, order by order."""
    known, counts = set(), ({}, {})
    for text, label, p in rows:
        for g in plain_grams(text or "", table):
            known.add(g)
            if label is not None and p != part:
                counts[label][g] = counts[label].get(g, 0) + 1

    def level(counts, grams, lower):
        once, twice = (sum(v == n for v in counts.values()) for n in (1, 2))
        d = once / (once + 2 * twice) if once and twice else 0.75
        total, kinds = Counter(), Counter()
        for g, n in counts.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        return {g: (max(counts.get(g, 0) - d, 0) + d * kinds[g[:-1]] * lower(g[1:])) / total[g[:-1]] if total[g[:-1]] else lower(g[1:]) for g in grams}

    shorts = {g[1:] for g in known}
    lower, kept = (lambda g: 1 / toxicity.SYMBOLS), {}
    for width in (1, 2, 3):
        behind = Counter(g[-width:] for g in {g[-width - 1 :] for g in shorts})
        kept[width] = level(behind, behind, lower)
        lower = kept[width].__getitem__
    logs = []
    for k in (1, 0):
        short = level(Counter(g[1:] for g in counts[k]), shorts, kept[3].__getitem__)
        logs.append(level(counts[k], known, short.__getitem__))
    return {number(g): np.log(logs[0][g]) - np.log(logs[1][g]) for g in known}


def test_models_equal_plain_kneser_ney(spark, monkeypatch):
    """Each model's log ratios against dictionaries, to 1e-9, also where tasks hold few n-grams at a time."""
    random = np.random.default_rng(9)
    words = ["".join(random.choice(list("abcdeé1"), random.integers(1, 9))) for _ in range(60)]
    rows = [(" ".join(random.choice(words, 12)), [None, 0, 0, 1][i % 4], int(random.integers(0, toxicity.QUARTERS))) for i in range(40)] + [("", 1, 0), (None, 0, 1)]
    table = toxicity.symbol_of()
    for held in (toxicity.MOST_HELD, 50):
        monkeypatch.setattr(toxicity, "MOST_HELD", held)
        got = toxicity.log_ratios(common.stored(toxicity.count_grams(spark.createDataFrame(rows, "text string, label int, part int").repartition(3)))).collect()
        for m in range(toxicity.QUARTERS + 1):
            want = plain_model(rows, table, m)
            assert {r.gram for r in got} == set(want)
            assert max(abs(r[f"r{m}"] - want[r.gram]) for r in got) < 1e-9


def test_probabilities_sum_to_one(spark):
    random = np.random.default_rng(5)
    rows = [(int(g), int(n), int(m)) for g, n, m in zip(range(0, 64 * 64), random.poisson(0.4, 4096), random.poisson(0.1, 4096))]
    counts = spark.createDataFrame(rows, "gram int, a long, b long")
    every = toxicity.smoothed(counts.groupBy(F.col("gram").bitwiseAND(F.lit(63)).alias("gram")).agg(F.count("*").alias("every")), 1)
    for r in toxicity.smoothed(counts, 2, every).groupBy(F.shiftright("gram", 6)).agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect():
        assert r.a == pytest.approx(1) and r.b == pytest.approx(1)


def random_model(random, texts, table, models):
    key = np.unique(np.concatenate([toxicity.grams(toxicity.symbols([t.encode()], table)[0]).key for t in texts]))
    return toxicity.Model(key, (random.normal(size=(models, len(key))) * 3).astype(np.float32))


def test_toxicity_features_do_not_depend_on_the_batch():
    random, table = np.random.default_rng(3), toxicity.symbol_of()
    texts = ["", "idiot", "Ein längerer Text, mit Zeichen.", "x" * 200, " ,. ", "réeuxê 42 a"]
    model = random_model(random, texts, table, 4)
    ratio = dict(zip(model.gram.tolist(), model.ratios[-1]))
    got = toxicity.features([t.encode() for t in texts], model, table)
    for row, text in zip(got, texts):
        words = [[]]
        for g in plain_grams(text, table):
            if not any(g[:-1]):
                words.append([])
            words[-1].append(float(ratio[number(g)]))
        sums = [sum(w) for w in words[1:]]
        hits = sum(v > toxicity.HIT for v in sums)
        want = [max(sums), sum(sums) / sum(map(len, words)), 100 * hits / len(sums), np.log1p(hits)] if sums else [0, 0, 0, 0]
        assert row == pytest.approx(want, abs=1e-4)
    assert toxicity.features([b"", b" "], model, table).tolist() == [[0.0] * 4] * 2
    # Several models at once: each text has the features that its own model gives it alone.
    which, encoded = [2, 0, 1, 2, 0, 1], [t.strip().encode() for t in texts]
    both = toxicity.features(encoded, model, table, which)
    for row, text, m in zip(both, encoded, which):
        assert row[4:] == pytest.approx(toxicity.features([text], toxicity.Model(model.gram, model.ratios[m : m + 1]), table)[0], abs=1e-5)



def test_classifiers_on_odd_rows_and_without_labels(spark, docs, empty):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (None, 1, 1), (5, None, None), (5, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    for of, table in ((toxicity.toxic_documents, labels), (quality.graded_documents, labels)):
        for d in (docs, empty):
            for known in (table, table.limit(0)):
                out = of(d, known).toPandas()
                assert len(out) == d.count() and out.score.between(0, 1).all() and set(out.predicted) <= {0, 1}
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == len(TEXTS)
    out = language.languages(docs).toPandas()
    assert len(out) == len(TEXTS) and set(out.lang_pred) == {"und"}
    assert language.languages(empty).count() == 0
    taught = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").when(F.col("doc_id") > 0, "bb"))
    out = language.languages(taught).toPandas()
    letterless = {i for i, t in TEXTS if i is not None and not any(map(str.isalpha, t or ""))}
    assert set(out[out.lang_pred == "und"].doc_id.dropna()) == letterless and out.score.between(0, 1).all()


def test_quality_on_held_out_documents(spark):
    docs, labels = common.table(spark, "/root/testdata/sf0.1", "documents"), common.table(spark, "/root/testdata/sf0.1", "labels")
    out = quality.graded_documents(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (out.predicted == out.quality).mean() > 0.97 and out.score.between(0, 1).all()


def test_forest_traversal_equals_plain_descent():
    random = np.random.default_rng(5)
    x, y = random.normal(size=(600, 5)), None
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    forest = quality.grow(x, y, trees=20)
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.97

    def descend(row):
        total = forest.base
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return total

    assert np.allclose(forest.margin(x[:50]), [descend(r) for r in x[:50]])


def test_language_on_held_out_documents(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    out = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (out.lang_pred == out.lang).mean() > 0.95
    assert (out[~out.rejected].lang_pred == out[~out.rejected].lang).mean() >= (out.lang_pred == out.lang).mean()


def test_pipeline_equals_its_stages_by_hand(spark):
    """Each stage against brute force on what the stage before it kept."""
    docs = common.table(spark, FOLDER, "documents")
    labels, bench = common.table(spark, FOLDER, "labels"), common.table(spark, FOLDER, "benchmark")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_duplicates", "suffix_dedup", "decontamination", "packing"]
    rows = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.toxic_documents(docs, labels).where("predicted = 1").collect()}
    rows = {i: t for i, t in rows.items() if i not in toxic}
    rows = {i: rows[i] for i in {c for _, _, c in expected_components(list(rows.items()))}}
    cut = dict(zip(rows, without_passages(rows.values())))
    leaks = {k[0] for k in expected_leaks(list(cut.items()), [(r.item_id, r.text) for r in bench.collect()]) if k[5]}
    encode = packing.tokenizer("byte_bpe_50k")
    want = Counter()
    for i, t in cut.items():
        if i not in leaks:
            ids = np.array([*encode(t), 2], "<u4")
            for k, (start, length) in enumerate(packing.cut(len(ids))):
                want[(i, k, start, length, zlib.crc32(ids[start : start + length].tobytes()))] += 1
    out = corpus_pipeline.run(spark, FOLDER)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out.collect()) == want


def test_pipeline_stages_on_odd_rows(spark, docs, empty):
    """Nulls, repeated ids and rows, clashing columns and empty tables go through every stage; all but the last keep the columns."""
    for d in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, FOLDER)
            assert name == "packing" or out.columns == d.columns
            rows = out.count()
            assert rows >= d.count() if name == "packing" else rows <= d.count()
            if name == "suffix_dedup":
                assert rows == d.count() and {r.doc_id for r in out.collect()} == {r.doc_id for r in d.collect()}
    one = corpus_pipeline.without_near_copies(spark, docs, FOLDER)
    assert Counter(r.doc_id for r in one.collect())[9] <= 1


def test_pipeline_leaves_no_tables_of_its_passage_stage(spark, docs):
    fs = spark._jvm.org.apache.hadoop.fs.Path(common.shared_folder(spark))
    count = lambda: len(fs.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(fs))
    before = count()
    repeats.remove_passages(docs, words=51).count()
    assert count() - before == 2  # where passages of either kind start
