"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm import common
from gristmill.llm.graph import components

WORDS = 3
SEED = 42
#: Two segments of 32 bits. Fingerprints that differ in at most two bits agree in one segment, or differ by one bit in each.
SEGMENT = 32
DISTANCE = 2


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Majority of the bits of the shingles' XXH64; zero for a text without words. ``text`` is UTF-8."""
    found = text.lower().split()
    n = len(found) - words + 1
    if not found:
        return 0
    if n < 1:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED)
    digest = xxhash.xxh64_intdigest
    join = b" ".join
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):
        stop = min(n, start + (1 << 16))
        hashes = np.fromiter((digest(join(s), SEED) for s in zip(*(found[start + k : stop + k] for k in range(words)))), np.uint64, stop - start)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.fromiter((fingerprint(t) for t in common.texts(batch.column("text"))), np.uint64, len(batch)).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(values)], ["key", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(key, fp) for each row of (doc_id, text): its id, or a number of its own where it is null, and its fingerprint as a signed long."""
    rows = docs.select(common.row_id(docs).alias("key"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints, "key long, fp long")


def links(values: DataFrame, column: str = "fp") -> DataFrame:
    """Links (a, b) that join each fingerprint to all others within two bits, directly or over a third one of the same key.

    Multi-index hashing. For each of the two segments the ball of one flipped bit is enumerated; the table key is the flipped segment
    together with the other segment, so a match means at most one bit on either side. Within a key, its fingerprints are linked to the
    smallest one instead of pairwise, after the whole distance is verified: a group of n near copies gives at most 65 n rows, never n².
    A key's members are known from the flipped positions alone, which a bit mask collects without any list.
    """
    flip = F.explode(F.sequence(F.lit(0), F.lit(2 * SEGMENT)))  # the last one stands for the fingerprint itself
    # A row becomes 65, so the small table is dealt to as many tasks as shuffles have, not to the few that its size asks for.
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    balls = values.select(column).repartition(parts, column).distinct().select(column, flip.alias("i"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("i"))
    own = F.col("i") == 2 * SEGMENT
    keyed = balls.select(F.when(own, F.col(column)).otherwise(F.col(column).bitwiseXOR(bit)).alias("k"), F.when(own, F.lit(0).cast("long")).otherwise(bit).alias("bit"), own.cast("int").alias("own"))
    met = keyed.groupBy("k").agg(F.bit_or("bit").alias("bits"), F.max("own").alias("own")).where(F.bit_count("bits") + F.col("own") > 1)
    flipped = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(2 * SEGMENT - 1)), lambda i: F.call_function("shiftright", F.col("bits"), i).bitwiseAND(F.lit(1).cast("long")) == 1),
        lambda i: F.col("k").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
    )
    members = met.select(F.concat(flipped, F.when(F.col("own") == 1, F.array("k")).otherwise(F.array().cast("array<bigint>"))).alias("m"))
    pairs = members.select(F.array_min("m").alias("b"), F.explode("m").alias("a"))
    return pairs.where(F.col("a") != F.col("b")).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, fingerprint (16 hex digits), component_id (smallest id reachable over links of at most two bits).

    A null or wordless text has fingerprint zero and is linked like any other. Rows without an id take part; their doc_id is null, and so
    is component_id where no row of the component has an id. Repeated rows each give a row. Other columns are ignored.
    """
    prints = common.stored(fingerprints(docs))
    return classes(prints).select(
        common.real_id(F.col("key")).alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        common.real_id(F.col("component")).alias("component_id"),
    )


def classes(prints: DataFrame) -> DataFrame:
    """(key, fp, component) for (key, fp), the component being the smallest key reachable."""
    first = common.stored(prints.groupBy("fp").agg(F.min("key").alias("first")))
    roots = components(links(first))
    rooted = common.stored(first.join(roots, first.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    smallest = common.stored(rooted.groupBy("root").agg(F.min("first").alias("component")))
    label = common.stored(rooted.join(smallest, "root").select("fp", "component"))
    return prints.join(label, "fp")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without near copies: of each component the row with the smallest id stays, all its columns unchanged.

    Of rows that repeat an id, one stays: the one whose text has the smallest hash.
    """
    key, place = common.free_name(docs, "_key"), common.free_name(docs, "_place")
    kept = classes(common.stored(fingerprints(docs))).where("key = component").select(F.col("key").alias(key)).distinct()
    met = docs.withColumn(key, common.row_id(docs)).join(kept, key)
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64("text")))
    return met.withColumn(place, first).where(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
