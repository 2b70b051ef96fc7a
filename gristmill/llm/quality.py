"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm import common

#: Labelled documents that the trees are grown from.
MOST_LABELLED = 30_000
TREES, DEPTH, BINS, RATE, LEAST = 80, 4, 64, 0.15, 20
THRESHOLD = 0.3

_MARKS = re.compile(r"[&%$#*|!@^~<>{}\[\]\\=+_]")
_POINTS = re.compile(r"[.,;:?()\"'-]")
_ENDS = re.compile(r"[.?!]+")
_DIGITS = re.compile(r"\d")
_TIGHT = re.compile(r"\w[&%$#*|!]{2,}")

STATISTICS = (
    "log_chars", "log_words", "mean_word", "longest_word", "upper", "digits", "spaces", "marks", "points", "tight", "lines", "line_length",
    "repeated_lines", "top_line", "distinct_words", "top_word", "doubled_words", "distinct_pairs", "top_pair", "sentence_words", "capital_words",
    "letterless_words", "one_letter_words", "other_script",
)


def statistics(text: str) -> list[float]:
    """The document statistics named in ``STATISTICS``, over the whole text; all but the first zero for a text without words.

    Shares of characters, words and lines count every occurrence; ``upper``, ``capital_words``, ``letterless_words`` and ``one_letter_words`` count different words.
    """
    n = len(text)
    words = text.split()
    m = len(words)
    if not m:
        return [np.log1p(n)] + [0.0] * (len(STATISTICS) - 1)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [line for line in text.split("\n") if line.strip()]
    by_line = Counter(lines)
    lower, upper = text.lower(), text.upper()
    letters = sum(map(len, words))
    ascii_ = len(text.encode("ascii", "ignore"))
    return [
        np.log1p(n), np.log1p(m), letters / m, float(max(map(len, counts))), sum(map(str.isupper, counts)) / len(counts), len(_DIGITS.findall(text)) / n,
        (n - letters) / n, len(_MARKS.findall(text)) / n, len(_POINTS.findall(text)) / n, len(_TIGHT.findall(text)) / m, len(lines) / m, n / max(len(lines), 1),
        1 - len(by_line) / max(len(lines), 1), max(by_line.values(), default=0) / max(len(lines), 1), len(counts) / m, max(counts.values()) / m,
        sum(a == b for (a, b) in pairs) / max(len(pairs), 1), len(pairs) / max(m - 1, 1), max(pairs.values(), default=0) / max(m - 1, 1), m / (len(_ENDS.findall(text)) + 1),
        sum(w[0].isupper() for w in counts) / len(counts), float(counts.get("|", 0)) / m + sum(not w.isalpha() and w.lower() == w.upper() for w in counts) / len(counts),
        sum(len(w) == 1 for w in counts) / len(counts), 1 - ascii_ / n if lower != upper else 0.0,
    ]


@dataclass
class Forest:
    """Complete trees of equal depth in arrays: node i's children are 2i+1 and 2i+2; a row goes right where its value exceeds the cut."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray
    leaf: np.ndarray  # (trees, leaves)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """All rows through one level of all trees at a time."""
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(int(np.log2(self.leaf.shape[1])) if len(self.feature) else 0):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.cut[trees, node])
        return self.base + self.leaf[trees, node - self.feature.shape[1]].sum(axis=1) if len(self.feature) else np.full(len(x), self.base)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, least: int = LEAST) -> Forest:
    """Boosts the logistic loss: features are cut into quantile bins once; each level sums gradients by (node, feature, bin) and takes the best cut."""
    inner, leaves = 2**depth - 1, 2**depth
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    if len(y) < 2 * least or y.min() == y.max():
        return Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    width = max(len(c) for c in cuts) + 1
    values = np.full((x.shape[1], width), np.inf)
    for f, c in enumerate(cuts):
        values[f, : len(c)] = c
    offsets = np.arange(x.shape[1]) * width
    features, limits, weights = [], [], []
    margin = np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (x.shape[1] * width) + offsets + binned).ravel()
            total = count * x.shape[1] * width
            sums = [np.bincount(cell, weights=np.repeat(v, x.shape[1]), minlength=total).reshape(count, x.shape[1], width) for v in (g, h, np.ones(len(y)))]
            left = [s.cumsum(axis=2) for s in sums]
            all_ = [s.sum(axis=2, keepdims=True) for s in sums]
            gain = sum((a**2 / (b + 1.0)) for a, b in ((left[0], left[1]), (all_[0] - left[0], all_[1] - left[1]))) - all_[0] ** 2 / (all_[1] + 1.0)
            gain[(left[2] < least) | (all_[2] - left[2] < least)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            good = gain.reshape(count, -1).max(axis=1) > 1e-9
            at = first + np.arange(count)
            feature[at] = best // width
            limit[at] = np.where(good, values[best // width, best % width], np.inf)
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > limit[node])
        own = node - inner
        leaf = rate * np.bincount(own, weights=g, minlength=leaves) / (np.bincount(own, weights=h, minlength=leaves) + 1.0)
        margin += leaf[own]
        features.append(feature)
        limits.append(limit)
        weights.append(leaf)
    return Forest(base, np.array(features), np.array(limits), np.array(weights))


def _measured(batches):
    for batch in common.slices(batches, "text"):
        x = np.array([statistics(t.decode("utf-8", "replace")) for t in common.texts(batch.column("text"))], float)
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["key", "x"])


def _graded(forest):
    def run(batches):
        model = Forest(*forest.value)
        for batch in batches:
            if len(batch):
                x = np.stack(batch.column("x").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(model.probability(x))], ["key", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, learn) -> DataFrame:
    """Per row of (doc_id, text): key and score from 0 to 1, higher for good.

    ``labels`` has (doc_id, quality); ``learn`` says with a Column over ``key`` which rows may teach. Of several labels of an id the larger
    holds; null labels and ids teach nothing; without labels of both kinds every score is the share of good ones. The trees see at most
    ``MOST_LABELLED`` labelled documents, taken by the hash of their ids; the statistics are those of whole texts.
    """
    keyed = docs.select(common.row_id(docs).alias("key"), F.col("text").cast("binary").alias("text"))
    measured = common.stored(keyed.mapInArrow(_measured, "key long, x array<double>"))
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max("quality").cast("int").alias("label"))
    known = common.stored(known.where(learn(F.col("key"))))
    sample = measured.join(known, "key").orderBy(F.xxhash64("key")).limit(MOST_LABELLED).select("x", "label").toArrow()
    x = np.array(sample["x"].to_pylist(), float).reshape(-1, len(STATISTICS))
    f = grow(x, sample["label"].to_numpy().astype(float))
    forest = docs.sparkSession.sparkContext.broadcast((f.base, f.feature, f.cut, f.leaf))
    return measured.mapInArrow(_graded(forest), "key long, score double")


def graded_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on) for each row; see :func:`score`."""
    scored = score(docs, labels, lambda key: ~common.is_fold(key, 5, 0))
    key = common.real_id(F.col("key"))
    return scored.select(key.alias("doc_id"), common.is_fold(key, 5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
