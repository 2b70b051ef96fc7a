"""Language identification: averaged embeddings of hashed subwords and a linear softmax, with calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm import common

BUCKETS = 1 << 16
DIMENSIONS = 16
ORDERS = (2, 3, 4)
#: Most documents of known language that are learnt from, and the share of them that sets temperature and rejection.
MOST_LABELLED = 3000
CALIBRATION = 0.2
#: Share of right answers that rejection may cost.
REJECTED = 0.01
UNKNOWN = "und"


def letter_codes() -> np.ndarray:
    """Code of each character in lower case; 0 for all that is no letter. Beyond the first 0x3000 every character counts as a letter."""
    table = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x3000):
        c = chr(code)
        table[code] = ord(c.lower()[0]) if c.isalpha() else 0
    return table


def subwords(texts: list[str], codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, place) of all letter n-grams, one order after another. An n-gram may begin before a word or end behind it, but not span two.

    Places count in the texts joined with one end before each and one behind the last.
    """
    s = codes[np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "replace"), np.uint32)].astype(np.uint64)
    letter = s > 0
    h = np.zeros(len(s), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        m = len(s) - n + 1
        if m < 1:
            return
        h = h[:m] * np.uint64(0x100000001B3) + s[n - 1 :] + np.uint64(n)
        if n in ORDERS:
            inner = range(1, n - 1) if n > 2 else range(n)
            inside = letter[inner[0] : inner[0] + m].copy()
            for k in inner[1:]:
                inside = inside & letter[k : k + m] if n > 2 else inside | letter[k : k + m]
            at = np.flatnonzero(inside)
            yield ((h[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 16)).astype(np.int64), at


def _sampled(batches):
    codes = letter_codes()
    for batch in common.slices(batches, "text"):
        found, counts = [], []
        for text in common.texts(batch.column("text")):
            total = np.zeros(BUCKETS, np.int64)
            for bucket, _ in subwords([text.decode("utf-8", "replace")], codes):
                total += np.bincount(bucket, minlength=BUCKETS)
            at = np.flatnonzero(total)
            found.append(at.astype(np.int32))
            counts.append(total[at].astype(np.float32))
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))], ["lang", "bucket", "count"])


def train(buckets: list[np.ndarray], counts: list[np.ndarray], y: np.ndarray, classes: int, steps: int = 500, rate: float = 20.0, batch: int = 64, seed: int = 7) -> np.ndarray:
    """Logits that one occurrence of a bucket adds, (BUCKETS, classes): embeddings times softmax weights, both trained by stochastic gradient descent.

    The number of steps is fixed, so that few documents are passed through more often.
    """
    random = np.random.default_rng(seed)
    embedding = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    weights = np.zeros((DIMENSIONS, classes))
    filled = np.array([i for i in range(len(y)) if len(buckets[i])], np.int64)
    order = np.zeros(0, np.int64)
    for done in range(steps if len(filled) else 0):
        if len(order) < min(batch, len(filled)):
            order = random.permutation(filled)
        rows, order = order[:batch], order[batch:]
        step = rate * (1 - done / steps)
        at = np.concatenate([buckets[i] for i in rows])
        share = np.concatenate([counts[i] / counts[i].sum() for i in rows])
        ends = np.cumsum([0, *(len(buckets[i]) for i in rows)])[:-1]
        mean = np.add.reduceat(embedding[at] * share[:, None], ends)
        p = softmax(mean @ weights)
        p[np.arange(len(rows)), y[rows]] -= 1
        p /= len(rows)
        back = np.repeat(p @ weights.T, np.diff([*ends, len(at)]), axis=0) * share[:, None]
        weights -= step * 0.1 * mean.T @ p
        used, of = np.unique(at, return_inverse=True)
        for k in range(DIMENSIONS):
            embedding[used, k] -= step * np.bincount(of, weights=back[:, k])
    return (embedding @ weights).astype(np.float32)


def calibrate(logits: np.ndarray, y: np.ndarray, rejected: float = REJECTED) -> tuple[float, float]:
    """(temperature, least confidence): the one minimises log loss, the other gives up at most the share ``rejected`` of the right answers."""
    if not len(y):
        return 1.0, 0.0
    losses = []
    grid = np.geomspace(0.05, 20, 60)
    for t in grid:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        losses.append(float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y])))
    t = float(grid[int(np.argmin(losses))])
    p = softmax(logits / t)
    right = p.argmax(axis=1) == y
    return t, float(np.quantile(p.max(axis=1)[right], rejected)) if right.any() else 0.0


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def text_logits(texts: list[str], table: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts, classes) mean logits over all subwords of whole texts, and whether a text has any."""
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    sums, n = np.zeros((starts[-1] + 1, table.shape[1]), np.float32), np.zeros(starts[-1] + 1, np.int32)
    for bucket, at in subwords(texts, codes):
        sums[at] += table[bucket]  # a place occurs once in an order
        n[at] += 1
    total, count = np.add.reduceat(sums, starts[:-1], axis=0, dtype=np.float64), np.add.reduceat(n, starts[:-1])
    return total / np.maximum(count, 1)[:, None], count > 0


def _predicted(model):
    def run(batches):
        table, names, temperature, least = model.value
        codes = letter_codes()
        for batch in common.slices(batches, "text", 1 << 20):
            texts = [t.decode("utf-8", "replace") for t in common.texts(batch.column("text"))]
            logits, known = text_logits(texts, table, codes)
            p = softmax(logits / temperature)
            best = p.argmax(axis=1)
            known &= np.array([any(map(str.isalpha, t)) for t in texts], bool)
            confidence = np.where(known, p[np.arange(len(texts)), best], 0.0)
            label = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(label), pa.array(confidence), pa.array(~known | (confidence < least))], ["key", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, learn) -> DataFrame:
    """Per row of (doc_id, text, lang): key, lang_pred, score (calibrated probability), rejected (score below the calibrated least one).

    ``learn`` says with a Column over ``key`` which rows may teach; of these, rows with a language and an id, at most ``MOST_LABELLED`` by
    the hash of their ids. Null texts and texts without a letter are ``und`` with score 0. With no language to learn all are ``und``.
    """
    keyed = docs.select(common.row_id(docs).alias("key"), F.col("text").cast("binary").alias("text"), "lang")
    sample = keyed.where("lang IS NOT NULL").where(learn(F.col("key"))).select("key", "lang").orderBy(F.xxhash64("key"), "lang").limit(MOST_LABELLED)
    sample = F.broadcast(common.stored(sample.distinct()))  # at most MOST_LABELLED pairs
    rows = keyed.join(sample, ["key", "lang"]).select("lang", "text").mapInArrow(_sampled, "lang string, bucket array<int>, count array<float>").toArrow()
    names = sorted(set(rows["lang"].to_pylist()))
    y = np.array([names.index(v) for v in rows["lang"].to_pylist()], np.int64)
    buckets, counts = rows["bucket"].to_pylist(), rows["count"].to_pylist()
    buckets, counts = [np.array(b, np.int64) for b in buckets], [np.array(c, float) for c in counts]
    rest = np.random.default_rng(11).random(len(y)) < CALIBRATION
    fit = np.flatnonzero(~rest) if (~rest).any() else np.arange(len(y))
    table = train([buckets[i] for i in fit], [counts[i] for i in fit], y[fit], max(len(names), 1))
    held = [i for i in np.flatnonzero(rest) if len(buckets[i])]
    logits = np.array([counts[i] @ table[buckets[i]] / counts[i].sum() for i in held]).reshape(-1, table.shape[1])
    temperature, least = calibrate(logits, y[held])
    model = docs.sparkSession.sparkContext.broadcast((table, names or [UNKNOWN], temperature, least))
    return keyed.select("key", "text").mapInArrow(_predicted(model), "key long, lang_pred string, score double, rejected boolean")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for each row; see :func:`identify`."""
    found = identify(docs, lambda key: ~common.is_fold(common.real_id(key), 4, 2))
    key = common.real_id(F.col("key"))
    return found.select(key.alias("doc_id"), common.is_fold(key, 4, 2).alias("held_out"), "lang_pred", "score", "rejected")
