"""Removal of long repeated passages with a logarithmic family of sparse suffix indexes."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm import common
from gristmill.llm.common import apart, forget, small_batches, stored

#: Length of a repeated string in bytes, of the bytes that choose an anchor, and of a block of starts in the refinement.
LENGTH = 400
GRAM = 32
BLOCK = 16
#: The same for strings of words, which are four bytes each while they are compared.
WORDS = 51
WORD_GRAM = 8
WORD_BYTES = 4
BATCHES = 4
CHUNK = 1 << 20
#: Bytes worked at a time: of texts, of packed texts with their starts, of contexts cut into blocks (some 20 times as many) and into strings (some 120 times).
SLICE = 1 << 20
PACKED_SLICE = 1 << 18
BLOCK_SLICE = 1 << 18
STRING_SLICE = 1 << 17

_BYTES = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15

ENTRIES = "key long, h long, s int, e int, a int, gram long, u1 long, u2 long"


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM, unit: int = 1) -> tuple[np.ndarray, ...]:
    """(first start, last start, anchor, hash of the anchor's gram) for each anchor of ``text``; the starts follow each other without gap.

    Every string of ``length`` units (single bytes, or words of four) is given to the leftmost of its grams with the smallest hash. The choice
    sees nothing but the string, so equal strings have anchors at equal distances. ``gram`` is a power of two; places count units.
    """
    if unit == 1:
        h = _BYTES[np.frombuffer(text, np.uint8)]
    else:
        h = (np.frombuffer(text, np.uint32).astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    n = len(h) - length + 1
    m = 1
    while m < gram:
        h = h[:-m] * np.uint64(pow(_FACTOR, m, 1 << 64)) + h[m:]
        m *= 2
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, m = length - gram + 1, 1
    while 2 * m <= width:
        low = np.minimum(low[:-m], low[m:])
        m *= 2
    if width > m:
        low = np.minimum(low[: m - width], low[width - m :])
    a = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.flatnonzero(np.diff(a)) + 1
    s = np.concatenate([[0], change])
    e = np.concatenate([change - 1, [n - 1]])
    return s, e, a[s], h.view(np.int64)[a[s]]


def _digests(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), np.int64).reshape(-1, 2)


def _halves(parts: list[bytes]) -> list[pa.Array]:
    return [pa.array(half.copy()) for half in _digests(parts).T]


def _repeated(batch: pa.RecordBatch, names: tuple[str, ...], times: list[int]) -> list[pa.Array]:
    """These columns of numbers, each row so many times."""
    return [pa.array(np.repeat(batch.column(c).to_numpy(), times)) for c in names]


def _entries(length: int, gram: int, unit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", SLICE):
            columns: list[list] = [[] for _ in range(7)]
            for key, h, text in zip(batch.column("key").to_pylist(), batch.column("h").to_pylist(), common.texts(batch.column("text"))):
                for c in range(0, len(text) // unit - length + 1, CHUNK):
                    part = text[unit * c : unit * (c + CHUNK + length - 1)]
                    s, e, a, g = anchors(part, length, gram, unit)
                    u = _digests([part[i:j] for i, j in zip((unit * s).tolist(), (unit * (e + length)).tolist())])
                    n = len(s)
                    for column, v in zip(columns, (np.full(n, key), np.full(n, h), s + c, e + c, a + c, g, u)):
                        column.append(v)
            if columns[0]:
                key, h, s, e, a, g, u = (np.concatenate(c) for c in columns)
                arrays = [pa.array(key), pa.array(h), *(pa.array(x.astype(np.int32)) for x in (s, e, a)), pa.array(g), pa.array(u[:, 0].copy()), pa.array(u[:, 1].copy())]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in ENTRIES.split(", ")])

    return run


class Family:
    """Levels of sorted anchors with their numbers of occurrences; the k-th holds 2^k batches, and two of one size become the next."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, batch: DataFrame) -> None:
        """Takes in the entries of a batch as a new level; equal levels merge, so an entry is rewritten a logarithmic number of times."""
        level, rank, merged = batch.groupBy("gram").agg(F.count("*").alias("n")), 0, []
        while self.levels and self.levels[-1][0] == rank:
            merged.append(self.levels.pop()[1])
            level = level.unionByName(merged[-1]).groupBy("gram").agg(F.sum("n").alias("n"))
            rank += 1
        self.levels.append((rank, stored(level.sortWithinPartitions("gram"))))
        forget(*merged)

    def repeated(self) -> DataFrame:
        """(gram, n) of anchors that occur more than once in all levels together."""
        union = self.levels[0][1]
        for _, level in self.levels[1:]:
            union = union.unionByName(level)
        return union.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")


def _squeeze(batches):
    packer = zstandard.ZstdCompressor(level=3)
    for batch in common.slices(batches, "text", SLICE):
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array([packer.compress(t) for t in common.texts(batch.column("text"))], pa.binary())], [*(c for c in batch.schema.names if c != "text"), "z"])


def _open(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)


def _lists(column: pa.ListArray, fields: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each row's list begins and ends (null: empty), and fields of the elements of all rows."""
    return column.offsets.to_numpy(), [column.values.field(f).to_numpy() for f in fields]


CONTEXTS = "key long, h long, a int, low int, high int, weight int, context binary"


def _contexts(length: int, unit: int):
    """The bytes around each anchor that is still open: from its first start to the end of its last string."""

    def run(batches):
        for batch in common.slices(batches, "z", PACKED_SLICE):
            ends, (first, last, anchor, weight) = _lists(batch.column("items"), ("s", "e", "a", "weight"))
            key, h = (np.repeat(batch.column(c).to_numpy(), np.diff(ends)) for c in ("key", "h"))
            parts, size, done, base = [], 0, int(ends[0]), int(ends[0])

            def made(i: int, j: int) -> pa.RecordBatch:
                near, far = anchor[i:j] - last[i:j], anchor[i:j] - first[i:j]
                columns = (key[i - base : j - base], h[i - base : j - base], anchor[i:j], near, far, weight[i:j])
                return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(parts, pa.binary())], [c.split()[0] for c in CONTEXTS.split(", ")])

            for r, z in enumerate(batch.column("z").to_pylist()):
                text, i, j = _open(z), int(ends[r]), int(ends[r + 1])
                for k, (low, high) in enumerate(zip(first[i:j].tolist(), last[i:j].tolist()), i + 1):
                    parts.append(text[unit * low : unit * (high + length)])
                    size += len(parts[-1])
                    if size >= SLICE:
                        yield made(done, k)
                        parts, size, done = [], 0, k
            if parts:
                yield made(done, int(ends[-1]))

    return run


NODES = "key long, h long, a int, low int, high int, weight int, x1 long, x2 long, y1 long, y2 long"


def _nodes(length: int, block: int, unit: int):
    """Starts are numbered by their distance to the anchor and cut into blocks. x: what all strings of a block share; y: all their bytes."""

    def run(batches):
        for batch in common.slices(batches, "context", BLOCK_SLICE):
            lows, highs, shared, whole, times = [], [], [], [], []
            for low, high, text in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "context"))):
                first, end = low // block, high // block + 1
                times.append(end - first)
                for b in range(first, end):
                    lo, hi = max(b * block, low), min(b * block + block - 1, high)
                    shared.append(text[unit * (high - b * block) : unit * (high - (b * block + block - 1) + length)] + struct.pack("<i", b))
                    whole.append(text[unit * (high - hi) : unit * (high - lo + length)] + struct.pack("<iii", b, lo, hi))
                    lows.append(lo)
                    highs.append(hi)
            if lows:
                key, h, a, weight = _repeated(batch, ("key", "h", "a", "weight"), times)
                columns = [key, h, a, pa.array(lows, pa.int32()), pa.array(highs, pa.int32()), weight, *_halves(shared), *_halves(whole)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in NODES.split(", ")])

    return run


STRINGS = "key long, h long, at int, weight int, y1 long, y2 long"


def _strings(length: int, unit: int):
    def run(batches):
        for batch in common.slices(batches, "context", STRING_SLICE):
            away, parts, times = [], [], []
            for low, high, text, blocks in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "context", "blocks"))):
                before = len(away)
                for block in blocks:
                    if block["low"] < low or block["high"] > high:  # of the same anchor's other range, where a chunk border divides it
                        continue
                    for d in range(block["low"], block["high"] + 1):
                        parts.append(text[unit * (high - d) : unit * (high - d + length)])
                        away.append(d)
                times.append(len(away) - before)
            if away:
                key, h, a, weight = _repeated(batch, ("key", "h", "a", "weight"), times)
                at = pa.array(a.to_numpy() - np.array(away, np.int32))
                yield pa.RecordBatch.from_arrays([key, h, at, weight, *_halves(parts)], [c.split()[0] for c in STRINGS.split(", ")])

    return run


def repeated_starts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, unit: int = 1) -> tuple[DataFrame, list[DataFrame]]:
    """(key, h, low, high): starts of strings of ``length`` units that also start elsewhere, and the written tables that it reads.

    ``docs`` has (key, h, text) with UTF-8 bytes, or words of ``unit`` bytes each.

    1. Each document gives its anchors (about one in 180 bytes); batches of them enter the family, and those met once are dropped: none
       of their strings repeats. 2. Anchors whose whole range of bytes repeats are settled. 3. The others that share an anchor with other
       surroundings are the ends of passages: their range is cut into blocks, blocks are settled the same way, and only starts of blocks
       that are still open are compared one by one. All comparisons count 128-bit digests, so a passage in any number of documents is
       counted by partial aggregation and never gathered. Each table goes as soon as what is made from it is written.
    """
    entries = stored(docs.mapInArrow(_entries(length, gram, unit), ENTRIES))
    family = Family()
    for b in range(batches):
        family.add(entries.where(F.pmod(F.xxhash64("key", "h"), F.lit(batches)) == b))
    found = stored(family.repeated())
    met = stored(entries.join(found.select("gram"), "gram"))
    forget(entries, found, *(level for _, level in family.levels))
    same = ["gram", "u1", "u2"]
    row = [F.first(c).alias(c) for c in ("key", "h", "s", "e", "a")]  # all of one row, whichever it is
    kinds = stored(met.groupBy(*same).agg(F.count("*").alias("copies"), *row))
    several = stored(kinds.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1").select("gram"))
    copied = kinds.where("copies > 1").select(*same)
    settled = stored(met.join(copied, same, "left_semi").select("key", "h", F.col("s").alias("low"), F.col("e").alias("high")))

    open_ = kinds.join(several, "gram", "left_semi").withColumn("weight", F.least("copies", F.lit(2)).cast("int"))
    items = open_.groupBy("key", "h").agg(F.collect_list(F.struct("s", "e", "a", "weight")).alias("items"))
    items = stored(items)
    forget(met, kinds, several)
    packed = docs.mapInArrow(_squeeze, "key long, h long, z binary")
    once = packed.join(items, ["key", "h"])
    contexts = stored(once.mapInArrow(_contexts(length, unit), CONTEXTS))  # a repeated row gives its contexts again, which have weight 2 then
    forget(items)

    nodes = stored(contexts.mapInArrow(_nodes(length, BLOCK, unit), NODES))
    shared = nodes.groupBy("x1", "x2").agg(F.sum("weight").alias("wx")).where("wx > 1")
    near = stored(nodes.join(apart(shared), ["x1", "x2"]))
    forget(nodes)
    alike = near.groupBy("x1", "x2", "y1", "y2").agg(F.sum("weight").alias("wy"), F.first("wx").alias("wx"))
    judged = stored(alike.where("wy > 1 OR wx > wy").select("x1", "x2", "y1", "y2", (F.col("wy") > 1).alias("all"), (F.col("wx") > F.col("wy")).alias("part")))
    known = stored(near.join(judged, ["x1", "x2", "y1", "y2"]).select("key", "h", "a", "low", "high", "weight", "all", "part"))
    forget(near, judged)
    by_block = known.where("all AND weight = 1").select("key", "h", (F.col("a") - F.col("high")).alias("low"), (F.col("a") - F.col("low")).alias("high"))

    parts = known.where("part").select("key", "h", "a", "low", "high").distinct()
    blocks = stored(parts.groupBy("key", "h", "a").agg(F.collect_list(F.struct("low", "high")).alias("blocks")))
    strings = stored(contexts.join(blocks, ["key", "h", "a"]).mapInArrow(_strings(length, unit), STRINGS))
    forget(contexts, blocks)
    twice = stored(strings.groupBy("y1", "y2").agg(F.sum("weight").alias("n")).where("n > 1").select("y1", "y2"))
    single = strings.where("weight = 1").join(twice, ["y1", "y2"], "left_semi").select("key", "h", F.col("at").alias("low"), F.col("at").alias("high"))
    return settled.unionByName(by_block).unionByName(single), [settled, known, strings, twice]


def runs(starts: list[tuple[int, int]] | np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings with these first and last starts."""
    if not len(starts):
        return []
    low, high = np.asarray(starts, np.int64).T
    order = np.argsort(low, kind="stable")
    low, end = low[order], np.maximum.accumulate(high[order]) + length
    new = np.flatnonzero(low[1:] > end[:-1]) + 1
    return list(zip(low[[0, *new]].tolist(), end[[*(new - 1), -1]].tolist()))


def _starts(column: pa.ListArray) -> Iterator[np.ndarray]:
    """For each row the pairs of first and last starts."""
    ends, fields = _lists(column, ("low", "high"))
    pairs = np.stack(fields, 1)
    return (pairs[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()))


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(common.row_id(docs).alias("key"), F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text"))


def _removed(keyed: DataFrame, length: int, batches: int = BATCHES, words: int = 0) -> DataFrame:
    """(key, h, starts, worded): first and last starts of strings of ``length`` bytes and of ``words`` words, gathered per text, whose length bounds their number."""
    starts, read = repeated_starts(keyed, length, batches=batches)
    gathered = F.collect_set(F.struct("low", "high"))  # repeated rows give theirs again
    spans = stored(starts.groupBy("key", "h").agg(gathered.alias("starts")))
    forget(*read)
    if not words:
        return spans.withColumn("worded", F.lit(None).cast("array<struct<low:int,high:int>>"))
    hashed = stored(keyed.mapInArrow(_worded, "key long, h long, text binary"))
    starts, read = repeated_starts(hashed, words, WORD_GRAM, batches, WORD_BYTES)
    worded = stored(starts.groupBy("key", "h").agg(gathered.alias("worded")))
    forget(hashed, *read)
    return spans.join(worded, ["key", "h"], "full")


def _report(length: int, words: int):
    def run(batches):
        for batch in common.slices(batches, "z", PACKED_SLICE):
            rows = []
            for key, z, starts, worded in zip(*(batch.column(c).to_pylist() for c in ("key", "z")), *(_starts(batch.column(c)) for c in ("starts", "worded"))):
                text = _open(z)
                spans = runs(starts, length)
                more = word_spans(text, worded, words)
                kept = hashlib.sha256(cut_out(text, spans)).hexdigest()
                rows.append((key, len(text), sum(b - a for a, b in spans), len(spans), kept, sum(b - a for a, b in more), len(more)))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [c.split()[0] for c in REPORT.split(", ")])

    return run


REPORT = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_bytes long, n_passages long"


def repeated_passages(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, words: int = WORDS) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_bytes, n_passages.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in this document or another, as the input stands.
    Matches never cross documents. Null texts are empty; shorter texts lose nothing; rows without an id keep a null doc_id; repeated
    rows count as occurrences of each other. The last two columns tell how many bytes, in how many runs, lie in strings of ``words`` words that occur
    more than once, however short these are; they are reported only.
    """
    keyed = _keyed(docs)
    with small_batches(docs.sparkSession):
        spans = _removed(keyed, length, batches, words)
        packed = keyed.mapInArrow(_squeeze, "key long, h long, z binary").join(spans, ["key", "h"], "left").select("key", "z", "starts", "worded")
        done = stored(packed.mapInArrow(_report(length, words), REPORT))
    return done.select(common.real_id(F.col("key")).alias("doc_id"), *(c.split()[0] for c in REPORT.split(", ")[1:]))


def _worded(batches):
    """Texts as four bytes for each word, so that strings of words are compared as bytes."""
    for batch in common.slices(batches, "text", SLICE):
        out = [np.fromiter(map(xxhash.xxh32_intdigest, t.split()), np.uint32).tobytes() for t in common.texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("h"), pa.array(out, pa.binary())], ["key", "h", "text"])


_NO_SPACE = np.ones(256, np.int8)
_NO_SPACE[list(b" \t\n\r\x0b\x0c")] = 0


def word_spans(text: bytes, starts: list[tuple[int, int]] | np.ndarray, words: int) -> list[tuple[int, int]]:
    """Bytes of the strings of ``words`` words that start at these first and last words of the text."""
    found = runs(starts, words)
    if not found:
        return []
    inside = _NO_SPACE[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(np.diff(inside, prepend=0, append=0))  # where words begin and end, in turn
    return [(int(edges[2 * a]), int(edges[2 * b - 1])) for a, b in found]


def _cut(length: int, words: int, text: str, starts: str, worded: str, left: str):
    def run(batches):
        for batch in common.slices(batches, text, SLICE):
            out = []
            for value, items, more in zip(batch.column(text).to_pylist(), *(_starts(batch.column(c)) for c in (starts, worded))):
                spans = runs(items, length)
                if len(more):
                    spans = runs(spans + word_spans(value, more, words), 0)
                # A cut inside a character leaves broken bytes, which are dropped.
                out.append(cut_out(value, spans).decode("utf-8", "ignore") if spans else None)
            rest = [c for c in batch.schema.names if c not in (text, starts, worded)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(out, pa.string())], [*rest, left])

    return run


def remove_passages(docs: DataFrame, length: int = LENGTH, words: int = 0) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, every row and column kept; ``n_chars`` follows the text where there is one.

    A passage is a string of ``length`` bytes or, if ``words`` is given, also one of that many words, whatever the white space between them.
    """
    key, h, starts, worded, value, left = (common.free_name(docs, n) for n in ("_key", "_h", "_starts", "_worded", "_value", "_left"))
    with small_batches(docs.sparkSession):
        spans = _removed(_keyed(docs), length, words=words)
    spans = spans.select(F.col("key").alias(key), F.col("h").alias(h), F.col("starts").alias(starts), F.col("worded").alias(worded))
    met = docs.withColumns({key: common.row_id(docs), h: F.xxhash64("text")}).join(spans, [key, h], "left").drop(key, h)
    found = F.col(starts).isNotNull() | F.col(worded).isNotNull()
    met = met.withColumn(value, F.when(found, F.col("text").cast("binary")))
    done = met.mapInArrow(_cut(length, words, value, starts, worded, left), met.drop(value, starts, worded).schema.add(left, "string"))
    changed = F.col(left).isNotNull()
    out = {"text": F.when(changed, F.col(left)).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.length(left).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return done.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in docs.columns])
