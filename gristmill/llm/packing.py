"""Packing of token sequences: best fit, then a swap-based local search that empties bins."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm import common

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k"
#: Documents whose pieces are packed together. A block wastes less than one sequence beyond what its sizes force.
BLOCK = 8192
#: Steps of the local search without an emptied bin after which a block is taken as done.
PATIENCE = 2000

PIECES = "key long, piece int, start long, length long, ids_crc32 long, block int"
PLACES = "key long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def tokenizer(name: str):
    """Texts to ids. The ids are those of ``tokenizers`` with the JSON file of this name; the same vocabulary as ranks is four times faster."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    special = "<|endoftext|>"
    encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={special: len(ranks)})

    def ids(text: str) -> list[int]:
        return encoding.encode(text, allowed_special="all") if special in text else encoding.encode_ordinary(text)

    return ids


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole where it fits, else pieces of ``capacity`` behind a first one that takes the rest."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(blocks: int, capacity: int, vocabulary: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary)
        number = TaskContext.get().partitionId() * 1_000_003
        for batch in common.slices(batches, "text"):
            out: list[tuple] = []
            for key, text in zip(batch.column("key").to_pylist(), common.texts(batch.column("text"))):
                ids = np.array([*encode(text.decode("utf-8", "replace")), end], "<u4")
                for i, (start, length) in enumerate(cut(len(ids), capacity)):
                    out.append((key, i, start, length, zlib.crc32(ids[start : start + length].tobytes()), number % blocks))
                number += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [c.split()[0] for c in PIECES.split(", ")])

    return run


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions in ``sizes``, the largest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by what is free in them
    mask = 0  # bit r: some bin has r free
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = mask >> sizes[i]
        if fits:
            free = sizes[i] + (fits & -fits).bit_length() - 1
            b = room[free].pop()
            if not room[free]:
                mask &= ~(1 << free)
            bins[b].append(i)
        else:
            b, free = len(bins), capacity
            bins.append([i])
        left = free - sizes[i]
        room[left].append(b)
        mask |= 1 << left
    return bins


def local_search(bins: list[list[int]], sizes: list[int], capacity: int, patience: int = PATIENCE) -> list[list[int]]:
    """Fewer bins, by moves and exchanges that raise the sum of squared fills until bins are empty.

    The emptiest bin gives up content: a piece moves to another underfull bin; else one or two of its pieces are exchanged for a smaller
    one there, which fills the other bin and shrinks this one. Each step fills a bin at least as full as the giver becomes, so the sum
    grows and the search ends. A giver that finds no step is set aside. It stops when the sizes allow no fewer bins.
    """
    need = -(-sum(sizes) // capacity)
    fill = [sum(sizes[i] for i in b) for b in bins]
    alive = {b for b in range(len(bins)) if bins[b]}
    open_ = {b for b in alive if fill[b] < capacity}
    stuck: set[int] = set()
    steps = 0
    while len(alive) > need and steps < patience:
        givers = open_ - stuck
        if not givers:
            break
        giver = min(givers, key=lambda b: (fill[b], b))
        step = _step(giver, bins, fill, sizes, open_, capacity)
        if step is None:
            stuck.add(giver)
            continue
        out, taker, back = step
        for i in out:
            bins[giver].remove(i)
        bins[taker] += out
        if back is not None:
            bins[taker].remove(back)
            bins[giver].append(back)
        moved = sum(sizes[i] for i in out) - (sizes[back] if back is not None else 0)
        fill[giver] -= moved
        fill[taker] += moved
        if fill[taker] == capacity:
            open_.discard(taker)
        steps += 1
        if not bins[giver]:
            alive.discard(giver)
            open_.discard(giver)
            stuck.clear()
            steps = 0
    return [bins[b] for b in sorted(alive)]


def _step(giver, bins, fill, sizes, open_, capacity):
    """(pieces given, taker, piece returned or None) that raises the squared fill most, or None."""
    own = bins[giver]
    singles = {sizes[i]: (i,) for i in own}
    pairs = {sizes[i] + sizes[j]: (i, j) for a, i in enumerate(own) for j in own[a + 1 :]}
    best, gain = None, 0
    for taker in open_:
        if taker == giver:
            continue
        free, base = capacity - fill[taker], fill[taker] - fill[giver]
        for size, (i,) in singles.items():
            if size <= free and 2 * size * (base + size) > gain:
                best, gain = ([i], taker, None), 2 * size * (base + size)
        for j in bins[taker]:
            for options in (singles, pairs):
                for size, given in options.items():
                    d = size - sizes[j]
                    if 0 < d <= free and 2 * d * (base + d) > gain:
                        best, gain = (list(given), taker, j), 2 * d * (base + d)
    return best


def _pack(capacity: int):
    def run(key, pdf):
        pdf = pdf.sort_values(["key", "piece", "ids_crc32"], kind="stable", ignore_index=True)
        sizes = pdf["length"].tolist()
        bins = local_search(best_fit(sizes, capacity), sizes, capacity)
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for b, content in enumerate(bins):
            at = 0
            for i in content:
                sequence[i], offset[i] = (int(key[0]) << 32) | b, at
                at += sizes[i]
        return pdf.drop(columns="block").assign(sequence_id=sequence, offset=offset)

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end: int = END, block: int = BLOCK) -> DataFrame:
    """Per piece of (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end``; a null or empty text is ``end`` alone. Only documents of more than ``capacity`` ids are cut. Pieces
    are dealt to blocks of about ``block`` documents in turn, and each block is packed on its own, so no task grows with the corpus.
    Rows without an id keep a null doc_id; repeated rows are packed each.
    """
    blocks = max(1, -(-docs.count() // block))
    rows = docs.select(common.row_id(docs).alias("key"), F.col("text").cast("binary").alias("text"))
    pieces = rows.mapInArrow(_pieces(blocks, capacity, vocabulary, end), PIECES)
    placed = pieces.groupBy("block").applyInPandas(_pack(capacity), PLACES)
    return placed.select(common.real_id(F.col("key")).alias("doc_id"), *[c.split()[0] for c in PLACES.split(", ")][1:])
