"""Prefix trie of conversations: node tables with minimal perfect hash slots, one for each bounded set of subtrees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import stored

#: A conversation takes up to ``HEAD - 1`` first turns of the first conversation of its family of ids.
HEAD = 6
FAMILY = 100
#: Rows (turns of conversations) beneath a node that a shard may take: at least, and at most.
LEAST, MOST = 1 << 10, 1 << 18
#: Conversation ids that are joined into one string before they are hashed.
BLOCK = 1024


def _twice(*columns) -> list[Column]:
    """Two independent 64-bit hashes of the same columns."""
    return [F.xxhash64(F.lit(k), *columns) for k in (1, 2)]


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (c, depth, d1, d2, p1, p2, chars, left) and conversations (c, total) as rebuilt by :func:`prefix_trie`, both written.

    A prefix's digest is the exclusive or of hashes of (place, role, text), so it needs no text behind the first projection and its
    parent's digest is known from the row alone. Only digests are shuffled.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    t1, t2 = _twice(role, text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), t1.alias("t1"), t2.alias("t2"), F.length(text).cast("long").alias("chars")
    )
    order = Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "t1", "t2")
    own = stored(rows.select("c", F.row_number().over(order).cast("long").alias("pos"), "t1", "t2", "chars"))
    item = F.struct("pos", "t1", "t2", "chars")
    heads = own.where((F.col("c") % FAMILY == 0) & (F.col("pos") < HEAD)).groupBy(F.col("c").alias("base")).agg(F.sort_array(F.collect_list(item)).alias("head"))
    h = F.crc32(F.col("c").cast("string").cast("binary")) % HEAD
    convs = own.groupBy("c").agg(F.count("*").alias("n")).select("c", "n", h.alias("h"), (F.col("c") - F.col("c") % FAMILY).alias("base")).join(heads, "base", "left")
    taken = F.least(F.col("h"), F.coalesce(F.size("head").cast("long"), F.lit(0).cast("long")))
    convs = convs.withColumn("taken", F.greatest(taken, F.lit(0).cast("long")))
    convs = stored(convs.select("c", "h", "taken", F.slice("head", 1, F.col("taken").cast("int")).alias("head"), (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")))
    first = convs.select("c", "total", F.explode("head").alias("x")).select("c", "total", F.col("x.pos").alias("depth"), "x.t1", "x.t2", "x.chars")
    rest = own.join(convs.select("c", "h", "taken", "total"), "c").where("pos > h").select("c", "total", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "t1", "t2", "chars")
    x1, x2 = _twice("depth", "t1", "t2")
    turns = first.unionByName(rest).withColumns({"x1": x1, "x2": x2})
    path = Window.partitionBy("c").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = turns.withColumns({f"d{k}": F.bit_xor(f"x{k}").over(path) for k in (1, 2)})
    parents = [F.col(f"d{k}").bitwiseXOR(F.col(f"x{k}")).alias(f"p{k}") for k in (1, 2)]
    return stored(turns.select("c", "depth", "d1", "d2", *parents, "chars", (F.col("total") - F.col("depth")).alias("left"))), convs.select("c", "total")


@dataclass
class Slots:
    """Minimal perfect hash of distinct 128-bit keys: n keys have the slots 0 to n - 1, and ``keys`` tells what stands in each.

    Level by level, keys that are alone in their cell are settled and the others go on with another hash; a key's slot is the number of
    settled cells before its own. A key that was never put in is recognised by the digest in the slot that it meets.
    """

    levels: list[tuple[int, np.ndarray, np.ndarray]]
    keys: np.ndarray

    @staticmethod
    def _cells(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (keys[:, 0] ^ np.uint64((level * 0x9E3779B97F4A7C15 + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29)) ^ keys[:, 1]) * np.uint64(0x94D049BB133111EB)
        return ((h ^ (h >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> Slots:
        """``keys`` (n, 2) of uint64, all different."""
        levels, placed, left, base = [], np.empty_like(keys), keys, 0
        while len(left):
            cells = cls._cells(left, len(levels), 2 * len(left))
            alone = np.bincount(cells, minlength=2 * len(left)) == 1
            slot = base - 1 + np.cumsum(alone)
            settled = alone[cells]
            placed[slot[cells[settled]]] = left[settled]
            levels.append((2 * len(left), alone, slot))
            base, left = base + int(settled.sum()), left[~settled]
        return cls(levels, placed)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that are not in the table."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, alone, slot) in enumerate(self.levels):
            cells = self._cells(keys[open_], level, size)
            met = alone[cells]
            at = slot[cells[met]]
            right = (self.keys[at] == keys[open_[met]]).all(axis=1)
            out[open_[met][right]] = at[right]
            open_ = open_[~met]
        return out


NODES = "d1 long, d2 long, p1 long, p2 long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def node_table(c: np.ndarray, depth: np.ndarray, key: np.ndarray, parent: np.ndarray, chars: np.ndarray) -> list[np.ndarray]:
    """Columns of ``NODES`` for whole subtrees, given a row for each of their turns; keys are (n, 2) of uint64.

    Every distinct digest gets a slot; counts, smallest members and text lengths are scattered into arrays by slot, and leaves and saved
    tokens are added to the parent's slot from the deepest level up. A node whose parent is not here has the parent -1.
    """
    slots = Slots.of(np.unique(key, axis=0))
    n, at = len(slots.keys), slots.find(key)
    count = np.bincount(at, minlength=n)
    first, level, length, above = np.full(n, np.iinfo(np.int64).max), np.empty(n, np.int64), np.empty(n, np.int64), np.empty((n, 2), np.uint64)
    np.minimum.at(first, at, c)
    level[at], length[at], above[at] = depth, chars, parent
    up = slots.find(above)
    inside = up >= 0
    children = np.bincount(up[inside], minlength=n)
    leaves, saved = (children == 0).astype(np.int64), (count - 1) * length
    order = np.argsort(-level, kind="stable")
    for nodes in np.split(order, np.flatnonzero(np.diff(level[order])) + 1):
        nodes = nodes[inside[nodes]]
        np.add.at(leaves, up[nodes], leaves[nodes])
        np.add.at(saved, up[nodes], saved[nodes])
    signed, over = slots.keys.view(np.int64), above.view(np.int64)
    return [signed[:, 0], signed[:, 1], over[:, 0], over[:, 1], level, first, np.where(inside, first[up], -1), count, children, leaves, saved, inside]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [b for b in batches if len(b)]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    names = [f.split()[0] for f in NODES.split(", ")]
    c, depth, d1, d2, p1, p2, chars = (table[k].to_numpy() for k in ("c", "depth", "d1", "d2", "p1", "p2", "chars"))
    *columns, inside = node_table(c, depth, np.stack([d1, d2], 1).view(np.uint64), np.stack([p1, p2], 1).view(np.uint64), chars)
    arrays = [pa.array(np.ascontiguousarray(v), pa.int64(), mask=~inside if name == "parent_conv_id" else None) for name, v in zip(names, columns)]
    out = pa.RecordBatch.from_arrays(arrays, names)
    for start in range(0, len(out), 1 << 16):
        yield out.slice(start, 1 << 16)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the strings of each key, which come in order; nothing but the running hash is kept."""
    key, running = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([running.hexdigest()])], ["d1", "d2", "ends_sha256"])

    for batch in batches:
        done = []
        for d1, d2, ids in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "ids"))):
            if (d1, d2) == key:
                running.update(b",")
            else:
                if key is not None:
                    done.append(row())
                key, running = (d1, d2), hashlib.sha256()
            running.update(ids.encode())
        yield from pa.Table.from_batches(done).combine_chunks().to_batches() if done else ()
    if key is not None:
        yield row()


def ends(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(d1, d2, ends_sha256) of nodes where conversations end. Ids are joined block by block in parallel; a node's blocks are hashed as a stream."""
    at_root = convs.where("total = 0").select(F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"), "c")
    last = turns.where("left = 0").select("d1", "d2", "c").unionByName(at_root)
    ids = F.concat_ws(",", F.transform(F.sort_array(F.collect_list("c")), lambda c: c.cast("string")))
    blocks = last.groupBy("d1", "d2", F.floor(F.col("c") / BLOCK).alias("block")).agg(ids.alias("ids"))
    return blocks.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "block").mapInArrow(_hashed, "d1 long, d2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """Nodes of the trie of rebuilt conversations, from (conv_id, turn, role, text); further columns are ignored.

    Turns are ordered by ``turn``, nulls first, and rows of one turn by the hash of role and text; null roles and texts are empty; rows
    without conv_id take no part; a repeated row is a further turn. Conversation c is rebuilt from the first crc32(c) mod 6 turns of the
    first conversation of its hundred, and its own turns behind as many. A node is a distinct sequence of first turns, the root that of none. Per node: conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256; nothing for an empty table.

    A node is heavy if more rows lie beneath it than a shard takes, and so are all nodes above it. The first node of a path that is not
    heavy is the top of a subtree that one shard takes whole (:func:`node_table`). A hot first turn is thus divided further down. What
    stands beneath heavy nodes is summed over the paths of the smallest members of subtrees and of heavy nodes, by partial aggregation.
    """
    spark = conversations.sparkSession
    turns, convs = rebuilt_turns(conversations)
    parts, rows = int(spark.conf.get("spark.sql.shuffle.partitions")), turns.count()
    limit = min(most, max(least, rows // (4 * parts)))
    met = turns.groupBy("d1", "d2").agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("depth").alias("depth"), F.min("c").alias("conv_id"), F.count("*").alias("n_convs"),
        F.min("chars").alias("chars"), F.sum(F.col("left") + 1).alias("beneath"),
    )
    heavy = stored(met.where(F.col("beneath") > limit).drop("beneath"))
    marked = stored(turns.drop("left").join(heavy.select("d1", "d2", F.lit(True).alias("heavy")), ["d1", "d2"], "left"))
    top_of = F.min(F.when(F.col("heavy").isNull(), F.struct("depth", F.col("d1").alias("k1"), F.col("d2").alias("k2")))).over(Window.partitionBy("c"))
    light = marked.withColumn("top", top_of).where("heavy IS NULL").select("top.k1", "top.k2", "c", "depth", "d1", "d2", "p1", "p2", "chars")
    nodes = stored(light.repartition(max(parts, -(-rows // limit)), "k1", "k2").mapInArrow(_shards, NODES))

    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    root = convs.agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("d1"), zero.alias("d2"), none.alias("p1"), none.alias("p2"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("chars"))
    upper = heavy.unionByName(root)
    tops = nodes.where("parent_conv_id IS NULL")
    below = tops.select("p1", "p2").unionByName(heavy.select("p1", "p2")).groupBy("p1", "p2").agg(F.count("*").alias("n_children")).select(F.col("p1").alias("d1"), F.col("p2").alias("d2"), "n_children")
    upper = stored(upper.join(below, ["d1", "d2"], "left").withColumn("n_children", F.coalesce("n_children", zero)))
    gives = upper.select(F.col("conv_id").alias("c"), "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    gives = stored(gives.unionByName(tops.select(F.col("conv_id").alias("c"), "depth", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))).where("leaves > 0 OR saved > 0"))
    steps = marked.where("heavy").select("c", "depth", "d1", "d2").unionByName(convs.select("c", zero.alias("depth"), zero.alias("d1"), zero.alias("d2")))
    steps = steps.join(gives.select("c").distinct(), "c", "left_semi").withColumns({"leaves": zero, "saved": zero})
    deeper = Window.partitionBy("c").orderBy(F.desc("depth")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = steps.unionByName(gives.withColumns({"d1": none, "d2": none})).select("d1", "d2", F.sum("leaves").over(deeper).alias("leaves"), F.sum("saved").over(deeper).alias("saved"))
    sums = sums.where("d1 IS NOT NULL").groupBy("d1", "d2").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    above = upper.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    upper = upper.join(sums, ["d1", "d2"], "left").withColumns({c: F.coalesce(c, zero) for c in ("n_leaves", "saved_tokens")})
    open_ = upper.drop("chars").unionByName(tops.drop("parent_conv_id")).join(above, ["p1", "p2"], "left")
    out = nodes.where("parent_conv_id IS NOT NULL").unionByName(open_).join(ends(turns, convs), ["d1", "d2"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
