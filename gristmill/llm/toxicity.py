"""Toxicity by class-conditional Kneser-Ney models over the letters of words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm import common

#: Symbols: 0 for all that is no letter or digit, 1 to 26 for a to z, 27 for digits, 28 to 63 for other letters, accented ones too.
SYMBOLS = 64
BITS = 6
#: Letters before a letter that predict it, never beyond the start of its word: at the full order; one less at the next lower one.
LONG = 4
#: Distinct n-grams, by kind, that a task holds before it passes them on.
MOST_HELD = 1 << 21
#: Log ratio from which a word counts as a hit.
HIT = 3.0
#: Labelled documents whose features fit the calibration. Those of each quarter come from a model that has not seen it.
MOST_LABELLED = 50_000
QUARTERS = 4
THRESHOLD = 0.3
#: Bytes of text that are worked at a time: some hundred bytes of arrays stand for each.
SLICE = 1 << 19
FEATURES = ("most", "whole", "rate", "hits")


def symbol_of() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x3000):
        c = chr(code).lower()[0]
        if "a" <= c <= "z":
            table[code] = ord(c) - 96
        elif c.isdigit():
            table[code] = 27
        elif c.isalpha():
            table[code] = 28 + ord(c) % 36
    table[0x3000:] = 28 + np.arange(0x3000, 0x110000) % 36
    return table


def symbols(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts with two ends before each and one behind the last, and where each text's part starts (one more at the end)."""
    joined = ["  " + t.decode("utf-8", "replace") for t in texts] + ["  "]
    starts = np.cumsum([0, *map(len, joined)])
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "replace"), np.uint32)
    return table[codes], starts[:-1]


@dataclass
class Grams:
    """Every letter and word end of a text: its place, and the number of its n-gram, six bits a symbol, its own last."""

    place: np.ndarray
    key: np.ndarray


def grams(s: np.ndarray) -> Grams:
    """N-grams of the full order; symbols before the end in front of the word count as ends."""
    place = np.flatnonzero((s[2:] > 0) | (s[1:-1] > 0)) + 2
    key = s[place].astype(np.int32)
    inside = np.ones(len(place), bool)  # the context has not reached the end before the word
    for k in range(1, LONG + 1):
        before = s[np.maximum(place - k, 0)] * inside
        key |= before.astype(np.int32) << (BITS * k)
        inside &= before > 0
    return Grams(place, key)


def _merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, and the sums of their counts."""
    code, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.diff(code, prepend=-1))
    return code[first], np.add.reduceat(n, first) if len(first) else n


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, n): kind is twice the part and the label, or the last one for rows without a label."""
    table = symbol_of()
    codes, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

    def rows(code, n):
        for start in range(0, len(code), 1 << 16):
            c = code[start : start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array((c >> 32).astype(np.int32)), pa.array((c & 0xFFFFFFFF).astype(np.int32)), pa.array(n[start : start + (1 << 16)])], ["kind", "key", "n"])

    for batch in common.slices(batches, "text", SLICE):
        kind = np.array([2 * QUARTERS if v is None else 2 * q + v for v, q in zip(batch.column("label").to_pylist(), batch.column("part").to_pylist())], np.int64)
        texts = common.texts(batch.column("text"))
        for k in np.unique(kind):
            key = np.sort(grams(symbols([texts[i] for i in np.flatnonzero(kind == k)], table)[0]).key)
            first = np.flatnonzero(np.diff(key, prepend=-1))
            codes.append((k << 32) + key[first])
            counts.append(np.diff(np.append(first, len(key))))
            held += len(first)
        if held > MOST_HELD:
            code, n = _merged(codes, counts)
            if len(code) > MOST_HELD // 2:
                yield from rows(code, n)
                code, n = code[:0], n[:0]
            codes, counts, held = [code], [n], len(code)
    yield from rows(*_merged(codes, counts))


def count_grams(labelled: DataFrame) -> DataFrame:
    """(gram, o0, t0, o1, t1 …): how often each n-gram occurs in what a model learns from, ordinary and toxic, over rows of (text, label, part).

    There is a model for each part, of the labelled rows in the other parts, and a last one of all labelled rows. Every n-gram of the corpus
    has a row of its own, whether labelled texts hold it or not; n-grams are numbers without collisions.
    """
    rows = labelled.select(F.col("text").cast("binary").alias("text"), F.col("label").cast("int").alias("label"), F.col("part").cast("int").alias("part"))
    sums = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"k{k}") for k in range(2 * QUARTERS)]
    found = rows.mapInArrow(_counts, "kind int, key int, n long").groupBy(F.col("key").alias("gram")).agg(*sums)
    models = []
    for m in range(QUARTERS + 1):
        for k, c in enumerate("ot"):
            learnt = [F.col(f"k{2 * q + k}") for q in range(QUARTERS) if q != m]
            models.append(sum(learnt[1:], learnt[0]).alias(f"{c}{m}"))
    return found.select("gram", *models)


def _suffix(symbols_left: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << BITS * symbols_left) - 1))


def smoothed(counts: DataFrame, width: int, lower: DataFrame | None = None) -> DataFrame:
    """(gram, a probability of the last symbol after the ones before for each further column) from counts of n-grams of ``width`` symbols.

    Discounted counts; the rest is shared out as ``lower`` says, the same for n-grams without their first symbol, or evenly. ``lower`` has a
    column of the same name or one for all, ``every``. A context has at most ``SYMBOLS`` n-grams, so no window is larger.
    """
    columns = [c for c in counts.columns if c != "gram"]
    seen = counts.agg(*(F.count(F.when(F.col(c) == n, 1)).alias(f"{c}_{n}") for c in columns for n in (1, 2))).first()
    context = Window.partitionBy(F.shiftright("gram", BITS))
    totals = [F.sum(c).over(context).alias(f"{c}_all") for c in columns]
    kinds = [F.count(F.when(F.col(c) > 0, 1)).over(context).alias(f"{c}_kinds") for c in columns]
    rows = counts.select("gram", _suffix(width - 1).alias("suffix"), *columns, *totals, *kinds)
    if lower is not None:
        rest = [c for c in lower.columns if c != "gram"]
        rows = rows.join(lower.select(F.col("gram").alias("suffix"), *(F.col(c).alias(f"{c}_lower") for c in rest)), "suffix")
    out = []
    for c in columns:
        once, twice = seen[f"{c}_1"], seen[f"{c}_2"]
        d = once / (once + 2 * twice) if once and twice else 0.75
        below = F.lit(1 / SYMBOLS) if lower is None else F.col(f"{c}_lower" if c in rest else "every_lower")
        p = (F.greatest(F.col(c) - d, F.lit(0.0)) + d * F.col(f"{c}_kinds") * below) / F.col(f"{c}_all")
        out.append(F.when(F.col(f"{c}_all") > 0, p).otherwise(below).alias(c))
    return rows.select("gram", *out)


def log_ratios(counts: DataFrame) -> DataFrame:
    """(gram, r0, r1 …): log P(letter | context, toxic) - log P(same, ordinary) of each model for each n-gram of :func:`count_grams`.

    Kneser-Ney: raw counts at the full order, numbers of distinct continuations below it. These two orders belong to the class; those of three
    letters and fewer are shared by both classes and come from every document, so what neither class has seen cancels out.
    """
    classes = [c for c in counts.columns if c != "gram"]
    short = common.stored(counts.groupBy(_suffix(LONG).alias("gram")).agg(*(F.count(F.when(F.col(c) > 0, 1)).alias(c) for c in classes)))
    shared, width = [short], LONG
    while width > 1:
        width -= 1
        shared.append(shared[-1].groupBy(_suffix(width).alias("gram")).agg(F.count("*").alias("every")))
    lower = None
    for width, level in enumerate(reversed(shared[1:]), 1):
        lower = smoothed(level, width, lower)
    full = smoothed(counts, LONG + 1, common.stored(smoothed(short, LONG, lower)))
    return full.select("gram", *((F.log(f"t{m}") - F.log(f"o{m}")).alias(f"r{m}") for m in range(len(classes) // 2)))


@dataclass
class Model:
    """N-grams in ascending order and the log ratios of each model, those of the parts and of the whole, in the rows of ``ratios``."""

    gram: np.ndarray
    ratios: np.ndarray

    @classmethod
    def of(cls, ratios: DataFrame) -> Model:
        """The table as two arrays. It has a row for each distinct n-gram within words: what letters of a language allow, not what texts there are."""
        found = ratios.select("gram", *(F.col(c).cast("float").alias(c) for c in ratios.columns[1:])).toArrow()
        order = np.argsort(found["gram"].to_numpy(), kind="stable")
        return cls(found["gram"].to_numpy()[order].astype(np.int32), np.stack([found[c].to_numpy()[order] for c in found.column_names[1:]]))

    def place(self, key: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.gram, key)


def features(texts: list[bytes], model: Model, table: np.ndarray, parts: list[int] | None = None) -> np.ndarray:
    """Per text, over its words' log ratios: the largest, the mean per letter, the hits among a hundred words, and the log of their number.

    The last row of the model's ratios decides. ``parts`` holds the number of a further row for each text; its features follow in further columns.
    """
    s, starts = symbols(texts, table)
    g = grams(s)
    if not len(g.place):
        return np.zeros((len(texts), (1 + (parts is not None)) * len(FEATURES)))
    at = model.place(g.key)
    values = [model.ratios[-1][at]]
    if parts is not None:
        row = np.repeat(np.asarray(parts), np.diff(starts))[g.place - 1]  # a word end may be the first place of the next text
        values.append(model.ratios[row, at])
    first = np.flatnonzero(s[g.place - 1] == 0)  # first letters of words
    text = np.searchsorted(starts, g.place[first], "right") - 1
    letters = np.bincount(text, weights=np.diff(np.append(first, len(g.place))), minlength=len(texts))
    n = np.bincount(text, minlength=len(texts))
    some = np.flatnonzero(n)
    columns = []
    for ratio in values:
        word = np.add.reduceat(ratio.astype(np.float64), first)
        hits = np.bincount(text, weights=word > HIT, minlength=len(texts))
        most = np.zeros(len(texts))
        most[some] = np.maximum.reduceat(word, np.searchsorted(text, some))
        columns += [most, np.bincount(text, weights=word, minlength=len(texts)) / np.maximum(letters, 1), 100 * hits / np.maximum(n, 1), np.log1p(hits)]
    return np.stack(columns, axis=1)


def _featured(model):
    """Features of all rows by the full model, and by the model that has not seen their quarter."""

    def run(batches):
        table = symbol_of()
        names = ["key", *FEATURES, *(f"own_{f}" for f in FEATURES)]
        for batch in common.slices(batches, "text", SLICE):
            x = features(common.texts(batch.column("text")), model.value, table, batch.column("part").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(x[:, k].copy()) for k in range(x.shape[1]))], names)

    return run


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, scale, weights with the intercept last) of a logistic regression by Newton steps; without rows nothing is ever likely."""
    if len(y) == 0:
        return np.zeros(x.shape[1]), np.ones(x.shape[1]), np.append(np.zeros(x.shape[1]), -50.0)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) / len(y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, w


def score(docs: DataFrame, labels: DataFrame, learn) -> DataFrame:
    """Per row of (doc_id, text): key and score from 0 to 1, higher for toxic.

    ``labels`` has (doc_id, toxic); ``learn`` says with a Column over ``key`` which rows may teach. Of several labels of an id the larger
    holds; null labels and ids teach nothing. Without any label every score is about zero. The models are
    counted over all documents; the calibration sees at most ``MOST_LABELLED`` labelled ones, taken by the hash of their ids, with
    features from a model of the three quarters that they are not in.
    """
    keyed = docs.select(common.row_id(docs).alias("key"), F.col("text").cast("binary").alias("text"))
    keyed = keyed.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(QUARTERS)).cast("int"))
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max("toxic").cast("int").alias("label"))
    known = common.stored(known.where(learn(F.col("key"))))
    spark = docs.sparkSession
    counts = common.stored(count_grams(keyed.join(known, "key", "left")))
    model = spark.sparkContext.broadcast(Model.of(log_ratios(counts)))
    doubles = ", ".join(f"{p}{f} double" for p in ("", "own_") for f in FEATURES)
    rows = common.stored(keyed.mapInArrow(_featured(model), f"key long, {doubles}"))
    own = [f"own_{f}" for f in FEATURES]
    sample = rows.join(known, "key").orderBy(F.xxhash64("key", F.lit(1))).limit(MOST_LABELLED).select(*own, "label").toArrow()
    x = np.column_stack([sample[c].to_numpy() for c in own])
    centre, scale, w = logistic(x, sample["label"].to_numpy().astype(float))
    margin = F.lit(float(w[-1]))
    for k, c in enumerate(FEATURES):
        margin = margin + F.lit(float(w[k])) * (F.col(c) - F.lit(float(centre[k]))) / F.lit(float(scale[k]))
    return rows.select("key", *FEATURES, (1 / (1 + F.exp(-margin))).alias("score"))


def teaches(key):
    """Rows that labels may be learnt from: all but those held out for measuring."""
    return ~common.is_fold(key, 4, 2)


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on) for each row; see :func:`score`."""
    scored = score(docs, labels, teaches)
    key = common.real_id(F.col("key"))
    return scored.select(key.alias("doc_id"), common.is_fold(key, 4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without rows scored as toxic; all columns of the others unchanged."""
    return common.without(docs, common.stored(score(docs, labels, teaches).where(F.col("score") >= THRESHOLD).select("key")))
