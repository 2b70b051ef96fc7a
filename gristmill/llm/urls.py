"""URL filter: rules on host and path, and a logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

import string
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
ORDERS = (3, 4, 5)
#: Most labelled URLs that are learnt from; more are taken by the hash of the URL.
MOST_LABELLED = 20_000

ALLOW, BLOCK = "allow", "block"

# A small labelled table: words that name the kind of a site, put together by rule.
_UNWANTED = "casino poker betting bets jackpot lottery pills pharma viagra adult porn xxx escort spam warez crack loans payday ads adserver tracker track clickbait farm win cheap free".split()
_WANTED = "news library school museum science weather recipes garden history travel music forum wiki docs review journal college city health sports".split()
_PLAIN = "blog www m en de fr es page articles post archive index about home read story view".split()


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 for block or 0 for allow): each word alone and joined with another of its kind, on several domains and paths."""
    out = []
    for label, words in ((1, _UNWANTED), (0, _WANTED + _PLAIN)):
        pairs = [(a, words[(i * 7 + 3) % len(words)]) for i, a in enumerate(words)]
        for i, ((a, b), end) in enumerate(product(pairs, ("com", "net", "org"))):
            lead = ("", "www.", "m.", "blog.")[i % 4]
            out.append((f"https://{lead}{a}-{b}.example.{end}/{('en', 'de', 'fr', 'es')[i % 4]}/{i * 37 % 9973}", label))
            out.append((f"http://{lead}{a}.example.{end}/{('en', 'de', 'fr', 'es')[(i + 1) % 4]}/{b}/{i * 53 % 9973}.html", label))
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host up to ``/ ? #`` with A-Z lowered, and the path from there up to ``? #``; both empty without it."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule ``host/path`` whose host is the URL's or a parent of it and whose path starts the URL's; null if none does."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, tail = rule.split("/", 1)
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{tail}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _grams(parts: list[bytes], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of ``parts``, each part within ends, and the number of the part that each is of."""
    joined = b"".join(b"\x02" + p + b"\x03" for p in parts)
    b = np.frombuffer(joined, np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(parts)), [len(p) + 2 for p in parts])
    buckets, owners = [], []
    h = np.full(len(b), salt, np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(b) < n:
            break
        h = (h[: len(b) - n + 1] * np.uint64(0x100000001B3)) ^ (b[n - 1 :] + np.uint64(n << 8))
        if n in ORDERS:
            same = owner[: len(h)] == owner[n - 1 :]
            mixed = (h[same] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
            buckets.append(mixed.astype(np.int64))
            owners.append(owner[: len(h)][same])
    return np.concatenate(buckets), np.concatenate(owners)


def gram_buckets(hosts: list[bytes], paths: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of host and path, which are told apart, and their rows. Empty ones give none."""
    if not hosts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts = [_grams(hosts, 1), _grams(paths, 2)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def scores(hosts: list[bytes], paths: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Probability of block: the mean weight of the n-grams, scaled by the root of their number, through the logistic function."""
    bucket, row = gram_buckets(hosts, paths)
    n = np.bincount(row, minlength=len(hosts))
    margin = np.bincount(row, weights=weights[bucket], minlength=len(hosts)) / np.sqrt(np.maximum(n, 1)) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def train(labelled: list[tuple[bytes, bytes, int]], rounds: int = 200, rate: float = 0.5, penalty: float = 1e-4) -> np.ndarray:
    """Weights of the buckets, the intercept last: full-batch gradient descent with per-weight step sizes. Zeros without labels."""
    w, squares = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-8)
    if not labelled:
        return w
    hosts, paths, y = zip(*labelled)
    y = np.array(y, float)
    bucket, row = gram_buckets(list(hosts), list(paths))
    scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(y)), 1))
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for _ in range(rounds):
        margin = np.bincount(row, weights=w[bucket], minlength=len(y)) * scale + w[-1]
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * share
        gradient = np.append(np.bincount(bucket, weights=(error * scale)[row], minlength=BUCKETS), error.sum()) + penalty * w
        squares += gradient**2
        w -= rate * gradient / np.sqrt(squares)
    return w


def _scored(weights):
    def run(batches):
        w = weights.value
        for batch in batches:
            hosts, paths = ([v.encode() for v in batch.column(c).to_pylist()] for c in ("host", "path"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores(hosts, paths, w))], [*batch.schema.names, "score"])

    return run


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None, threshold: float = 0.6) -> DataFrame:
    """Per row of (page_id, url): page_id, host, path, rule, verdict, score.

    ``rules`` is a short list of (allow or block, host/path). A URL without a rule is blocked from a score of ``threshold`` on. ``labelled``
    (url, label 0 or 1) replaces the built-in table; of it at most ``MOST_LABELLED`` rows are learnt from, null ones not at all. A null URL
    or one without ``://`` has an empty host and path, and the model's verdict on those. Repeated pages each give a row.
    """
    spark = pages.sparkSession
    if labelled is None:
        labelled = spark.createDataFrame(labelled_urls(), "url string, label int")
    host, path = host_and_path(F.col("url"))
    known = labelled.where("url IS NOT NULL AND label IS NOT NULL").orderBy(F.xxhash64("url"), "url", "label").limit(MOST_LABELLED)
    rows = known.select(host.alias("host"), path.alias("path"), F.col("label").cast("int").alias("label")).collect()
    weights = spark.sparkContext.broadcast(train([(r.host.encode(), r.path.encode(), r.label) for r in rows]))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    kind = dict(parts.dtypes)["page_id"]
    scored = parts.mapInArrow(_scored(weights), f"page_id {kind}, host string, path string, score double")
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    blocked = [r for a, r in rules if a == BLOCK]
    by_model = F.when(F.col("score") >= threshold, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    by_rule = F.when(F.col("rule").isin(blocked), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.withColumn("rule", rule).select("page_id", "host", "path", "rule", F.when(F.col("rule").isNull(), by_model).otherwise(by_rule).alias("verdict"), "score")
