"""Benchmark decontamination with a distributed positional inverted index."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm import common

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
#: Unused positions between two documents of a segment; a window or a proximity match never bridges them.
GAP = 1
#: Bytes of text in a segment of the index, and of benchmark text that is searched for in one pass.
SEGMENT_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20

INDEX = "segment long, keys array<long>, starts array<int>, terms binary, ends binary, positions binary"


def words(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    for batch in common.slices(batches, "text", SEGMENT_BYTES):
        ids: defaultdict = defaultdict(count().__next__)
        pieces, starts = [], [0]
        for text in common.texts(batch.column("text")):
            found = words(text)
            pieces.append(np.fromiter(map(ids.__getitem__, found), np.int32, len(found)))
            starts.append(starts[-1] + len(found) + GAP)
        place = np.concatenate([np.arange(s, s + len(p), dtype=np.int32) for s, p in zip(starts, pieces)])
        token = np.concatenate(pieces)
        order = np.argsort(token, kind="stable")
        ends = np.cumsum(np.bincount(token, minlength=len(ids)), dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part << 32 | number], pa.int64()), pa.array([batch.column("key").to_pylist()], pa.list_(pa.int64())),
                pa.array([starts], pa.list_(pa.int32())), pa.array([b"\n".join(ids)], pa.binary()), pa.array([ends.tobytes()], pa.binary()),
                pa.array([place[order].tobytes()], pa.binary()),
            ],
            [c.split()[0] for c in INDEX.split(", ")],
        )
        number += 1


def build_index(docs: DataFrame) -> DataFrame:
    """The index of (key, text): per segment its document keys, where each document's positions start, its terms, and their postings.

    A term's postings are its ascending word positions, from the end of the term before it up to its own end. Null texts have no words.
    """
    rows = docs.select("key", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_segments, INDEX)


class Segment:
    """One row of the index."""

    def __init__(self, row: dict):
        self.number, self.keys = row["segment"], row["keys"]
        self.starts = np.array(row["starts"], np.int64)
        terms = row["terms"].split(b"\n") if row["terms"] else []
        self.term = dict(zip(terms, range(len(terms))))
        self.ends = np.concatenate([[0], np.frombuffer(row["ends"], np.int32)]).astype(np.int64)
        self.positions = np.frombuffer(row["positions"], np.int32).astype(np.int64)
        self.size = int(self.starts[-1]) + 1
        # Postings of all terms in one ascending list, so that many lists are intersected by one binary search.
        self.keyed = np.repeat(np.arange(len(terms)), np.diff(self.ends)) * self.size + self.positions

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        wanted = term * self.size + position
        at = np.searchsorted(self.keyed, wanted)
        ok = at < len(self.keyed)
        ok[ok] = self.keyed[at[ok]] == wanted[ok]
        return ok & (position >= 0)

    def phrases(self, windows: np.ndarray, lengths: np.ndarray, vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of all exact occurrences. ``windows`` holds numbers of ``vocabulary``, each row padded beyond its length."""
        local = np.array([self.term.get(w, -1) for w in vocabulary] + [-1], np.int64)
        rows = local[windows]
        real = np.arange(windows.shape[1]) < lengths[:, None]
        alive = np.flatnonzero(((rows >= 0) | ~real).all(axis=1))
        rows, real = rows[alive], real[alive]
        sizes = np.where(real, np.diff(self.ends)[rows] if len(self.ends) > 1 else 0, np.iinfo(np.int64).max)
        order = np.argsort(sizes, axis=1, kind="stable")  # the rarest term first
        first = rows[np.arange(len(rows)), order[:, 0]] if len(rows) else np.zeros(0, np.int64)
        n = self.ends[first + 1] - self.ends[first] if len(rows) else np.zeros(0, np.int64)
        which = np.repeat(np.arange(len(rows)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = self.positions[self.ends[first][which] + within] - order[which, 0]
        for k in range(1, windows.shape[1]):
            at = order[which, k]
            ok = ~real[which, at] | self.has(rows[which, at], start + at)
            which, start = which[ok], start[ok]
        return alive[which], start

    def near(self, terms: list[bytes], slop: int) -> list[tuple[int, int]]:
        """Spans (first, last position) of at most ``len(terms) + slop`` words in one document that hold all terms, from the rarest one."""
        found = [self.term.get(t, -1) for t in dict.fromkeys(terms)]
        if not found or min(found) < 0:
            return []
        lists = sorted((self.positions[self.ends[t] : self.ends[t + 1]] for t in found), key=len)
        reach, spans = len(found) + slop - 1, set()
        for p in lists[0].tolist():
            options = [x[np.searchsorted(x, p - reach) : np.searchsorted(x, p + reach, "right")] for x in lists[1:]]
            if any(len(x) == 0 for x in options):
                continue
            for low in {p, *(int(v) for x in options for v in x if v <= p)}:
                after = [x[np.searchsorted(x, low) :] for x in options]
                if all(len(x) for x in after):
                    high = max(p, *(int(x[0]) for x in after)) if after else p
                    if high - low <= reach and self.document(low) == self.document(high):
                        spans.add((low, high))
        return sorted(s for s in spans if not any(t != s and s[0] <= t[0] and t[1] <= s[1] for t in spans))

    def document(self, position: int) -> int:
        return int(np.searchsorted(self.starts, position, "right")) - 1


def windows_of(items: list[tuple[str, bytes]], window: int) -> tuple[np.ndarray, np.ndarray, list[bytes], list[list[str]]]:
    """Distinct windows as numbers of a vocabulary, their lengths, the vocabulary, and the items of each window."""
    ids: defaultdict = defaultdict(count().__next__)
    found: dict[tuple, dict] = {}
    for item, text in items:
        tokens = [ids[w] for w in words(text)]
        for i in range(max(1, len(tokens) - window + 1)) if tokens else ():
            found.setdefault(tuple(tokens[i : i + window]), {})[item] = None
    lengths = np.array([len(w) for w in found], np.int64)
    padded = np.full((len(found), int(lengths.max(initial=1))), len(ids), np.int64)
    for row, w in zip(padded, found):
        row[: len(w)] = w
    return padded, lengths, list(ids), [list(v) for v in found.values()]


SPANS = "segment long, row int, key long, n_words int, spans array<struct<start:int,end:int>>, items array<string>"


def _search(items: list[tuple[str, bytes]], window: int):
    def run(batches):
        table, lengths, vocabulary, owners = windows_of(items, window)
        for batch in batches:
            for r in range(len(batch)):
                segment = Segment(batch.slice(r, 1).to_pylist()[0])
                which, start = segment.phrases(table, lengths, vocabulary) if len(table) else (np.zeros(0, np.int64),) * 2
                doc = np.searchsorted(segment.starts, start, "right") - 1
                hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
                met: dict[int, set] = defaultdict(set)
                for w, p, d in zip(which.tolist(), start.tolist(), doc.tolist()):
                    p -= int(segment.starts[d])
                    hits[d].append((p, p + int(lengths[w])))
                    met[d].update(owners[w])
                sizes = np.diff(segment.starts) - GAP
                rows = range(len(segment.keys))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment.number] * len(rows), pa.int64()), pa.array(rows, pa.int32()), pa.array(segment.keys, pa.int64()), pa.array(sizes, pa.int32()),
                        pa.array([[{"start": a, "end": b} for a, b in merged(hits.get(d, []))] for d in rows], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                        pa.array([sorted(met.get(d, ())) for d in rows], pa.list_(pa.string())),
                    ],
                    ["segment", "row", "key", "n_words", "spans", "items"],
                )

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _join_blocks(pdf):
    import pandas as pd

    first = pdf.iloc[0]
    spans = merged([(s["start"], s["end"]) for row in pdf["spans"] for s in row])
    return pd.DataFrame([{
        **{c: first[c] for c in ("segment", "row", "key", "n_words")},
        "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted({i for row in pdf["items"] for i in row}),
    }])


def search(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Exact matches of the windows of (item_id, text) in each indexed document: word spans and item ids, empty where nothing matches.

    The benchmark is searched for in blocks of about ``block_bytes``, each sent to all tasks; a larger benchmark takes more passes over
    the stored index. An item without words has no window. Items with a null id are one item with an empty name.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    parts = []
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).distinct().collect()
        parts.append(index.mapInArrow(_search([(r.item, bytes(r.text or b"")) for r in block], window), SPANS))
    if blocks == 1:
        return parts[0]
    union = parts[0]
    for p in parts[1:]:
        union = union.union(p)
    return union.groupBy("segment", "row").applyInPandas(_join_blocks, SPANS)


def proximity(index: DataFrame, queries: list[tuple[str, str]], slop: int = 3) -> DataFrame:
    """(key, query, start, end): word spans in which all words of a query stand together with at most ``slop`` others, in any order."""
    wanted = [(name, words(text.encode())) for name, text in queries]

    def run(batches):
        for batch in batches:
            for r in range(len(batch)):
                segment = Segment(batch.slice(r, 1).to_pylist()[0])
                rows = []
                for name, terms in wanted:
                    for low, high in segment.near(terms, slop):
                        d = segment.document(low)
                        rows.append((segment.keys[d], name, low - int(segment.starts[d]), high - int(segment.starts[d]) + 1))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int32(), pa.int32()))], ["key", "query", "start", "end"])

    return index.mapInArrow(run, "key long, query string, start int, end int")




def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_hit, n_items, items_sha256, contaminated.

    The positional index of all words is built once and stored in the shared folder; the benchmark's windows are then looked up in it from
    their rarest terms. Rows without an id keep a null doc_id; repeated rows each give a row; null and wordless texts have no words.
    """
    index = common.stored(build_index(docs.select(common.row_id(docs).alias("key"), "text")))
    found = search(index, benchmark, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return found.select(
        common.real_id(F.col("key")).alias("doc_id"), F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without rows that hold a benchmark window; all columns of the others unchanged."""
    index = common.stored(build_index(docs.select(common.row_id(docs).alias("key"), "text")))
    return common.without(docs, common.stored(search(index, benchmark).where(F.size("spans") > 0).select("key")))
