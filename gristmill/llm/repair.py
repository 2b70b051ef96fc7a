"""Repair of conversation structure: cheapest edits by cost DP, the least of them by prefix-doubling ranks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm import common
from gristmill.llm.common import stored

#: What an edit costs, and what a truncated row costs that is not deleted.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Rows of a conversation that are worked at a time. Longer ones are several blocks, joined by cost matrices.
BLOCK = 4096
#: Nodes of a batch of blocks.
CELLS = 1 << 17
SPACE = " \t\n\x0b\x0c\r"

#: States while role initials are read as (s?(ua)+)?: at the start, behind s, behind u, behind a. It may end at the start and behind a.
#: Next state for the initials s, u, a and others (-1: not allowed), and the one that an inserted or changed role leads to.
STEP = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
MADE = np.array([2, 2, 3, 2])
LAST = np.array([0, 2 * INSERT, INSERT, 0])
ROLES = {2: "user", 3: "assistant"}
FAR = 1 << 40
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
DROP, EMPTY, UNSTOP, REPEAT, USER = range(5)


def damaged(conversations: DataFrame, chance: int = 20) -> DataFrame:
    """Rows (c, turn, o, copy, role, text) of (conv_id, turn, role, text) with faults by crc32(``conv_id:turn``) mod ``chance``; nulls are a space.

    0 drops a row, 1 empties its text, 2 takes away its ``.!?``, 3 repeats it, 4 makes it the user's. ``o`` orders the rows of one turn: a
    hash of role and text before the damage, so that a repeated row stands beside its copy. Rows without conv_id take no part.
    """
    space = F.lit(" ")
    key = F.concat(F.col("conv_id").cast("long").cast("string"), F.lit(":"), F.coalesce(F.col("turn").cast("long").cast("string"), space))
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    fault = F.crc32(key.cast("binary")) % chance
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("o"), fault.alias("fault"), role.alias("role"), text.alias("text")
    )
    rows = rows.where(F.col("fault") != DROP)
    text = F.when(F.col("fault") == EMPTY, "").when(F.col("fault") == UNSTOP, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("c", "turn", "o", F.explode(copies).alias("copy"), F.when(F.col("fault") == USER, "user").otherwise(F.col("role")).alias("role"), text.alias("text"))


def _initial(role: str | Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def marked(rows: DataFrame) -> DataFrame:
    """(c, pos, turn, initial, fault, new_turn, illegal) of each row, without texts: its place, its first fault (0 none, 1 blank, 2 duplicate,
    3 truncated), whether its turn is a new one, and whether its role may not follow the one before.

    An empty role has no initial that could be kept. Only hashes of role and text are shuffled.
    """
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    own = rows.select(
        "c", "turn", "o", "copy", F.xxhash64(F.lit(1), "role", "text").alias("x1"), F.xxhash64(F.lit(2), "role", "text").alias("x2"), _initial("role").alias("initial"),
        (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    order = Window.partitionBy("c").orderBy(F.col("turn").asc_nulls_first(), "o", "copy")
    own = own.select("*", F.row_number().over(order).cast("long").alias("pos"), F.lag("turn").over(order).alias("_turn"), F.lag("initial").over(order).alias("_initial"))
    seen = F.row_number().over(Window.partitionBy("c", "x1", "x2").orderBy("pos")) > 1
    fault = F.when(F.col("blank"), 1).when(seen, 2).when(F.col("cut"), 3).otherwise(0)
    pair = F.col("_initial") * 4 + F.col("initial")
    return own.select(
        "c", "pos", "turn", "initial", fault.alias("fault"), (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_turn"))).alias("new_turn"),
        F.coalesce(~pair.isin(0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1), F.lit(False)).alias("illegal"),
    )


class Blocks:
    """Rows of several blocks, the longest first, numbered from their ends; codes are initial + 4 × fault."""

    def __init__(self, codes: list[np.ndarray]) -> None:
        self.size = np.array([len(c) for c in codes])
        self.longest = int(self.size.max())
        self.codes = np.zeros((len(codes), self.longest + 1), np.int64)
        for row, c in zip(self.codes, codes):
            row[1 : len(c) + 1] = c[::-1]

    def options(self, k: int | slice, state: int, ends: np.ndarray) -> tuple:
        """What deleting, keeping and changing rows cost in ``state``, given the costs ``ends`` of all states behind them (last axis)."""
        code = self.codes[: len(ends), k]
        more, held = np.where(code // 4 == 3, TRUNCATED, 0), np.isin(code // 4, (1, 2))
        to = STEP[state][code % 4]
        kept = np.take_along_axis(ends, np.maximum(to, 0)[..., None], -1)[..., 0]
        return DELETE + ends[..., state], np.where(held | (to < 0), FAR, more + kept), np.where(held, FAR, REROLE + more + ends[..., MADE[state]])

    def layer(self, k: int, ends: np.ndarray) -> np.ndarray:
        """Costs of all states before the k-th row from the end."""
        out = np.stack([np.minimum.reduce(self.options(k, s, ends)) for s in range(4)], axis=-1)
        return closed(out)


def closed(costs: np.ndarray) -> np.ndarray:
    """Costs of states (last axis) once rows may be inserted."""
    out = costs.copy()
    out[..., 2] = np.minimum(costs[..., 2], INSERT + costs[..., 3])
    out[..., 3] = np.minimum(costs[..., 3], INSERT + costs[..., 2])
    for s in (0, 1):
        out[..., s] = np.minimum(costs[..., s], INSERT + out[..., 2])
    return out


def matrices(codes: list[np.ndarray]) -> np.ndarray:
    """(block, state before, state behind): least cost of the edits of each block, the longest block first."""
    blocks = Blocks(codes)
    cost = np.full((4, len(codes), 4), FAR)
    for t in range(4):
        cost[t, :, t] = 0
        for k in range(1, blocks.longest + 1):
            n = int((blocks.size >= k).sum())
            cost[t, :n] = np.minimum(blocks.layer(k, cost[t, :n]), FAR)
    return cost.transpose(1, 2, 0)


def least_audits(codes: list[np.ndarray], behind: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cost, audit, state behind) for each block and each state before it, the longest block first; ``behind`` has the costs of the states behind it.

    Cost DP from the end, then the arcs that keep to the least cost. Arcs are ranked by the first letter of their audits, and from ranks of
    so many letters follow those of twice as many: an arc's rank, then that of the arc which the pointer of this length leads to. The
    arc of least rank leaves each node, and its audit is read by doubling: what the pointers of a length say continues all that is
    read so far. The letters that leave a node differ, so a first letter settles which arc follows.
    """
    blocks = Blocks(codes)
    n, layers = len(codes), blocks.longest + 1
    cost = np.full((n, layers, 4), FAR)
    cost[:, 0] = behind
    for k in range(1, layers):
        m = int((blocks.size >= k).sum())
        cost[:m, k] = blocks.layer(k, cost[:m, k - 1])
    node = np.arange(n * layers * 4).reshape(n, layers, 4)
    there = np.arange(1, layers)[None, :] <= blocks.size[:, None]
    label, source, target = [], [], []

    def arcs(letter, met, from_, to):
        label.append(np.full(int(met.sum()), letter))
        source.append(from_[met])
        target.append(to[met])

    for s in range(4):
        now, after = cost[:, 1:, s], cost[:, :-1]
        delete, keep, change = blocks.options(slice(1, None), s, after)
        to = np.maximum(STEP[s][blocks.codes[:, 1:] % 4], 0)
        arcs(1, there & (delete == now), node[:, 1:, s], node[:, :-1, s])
        arcs(2, there & (INSERT + cost[:, 1:, MADE[s]] == now), node[:, 1:, s], node[:, 1:, MADE[s]])
        arcs(3, there & (keep == now), node[:, 1:, s], np.take_along_axis(node[:, :-1], to[..., None], -1)[..., 0])
        arcs(4, there & (change == now), node[:, 1:, s], node[:, :-1, MADE[s]])
        goes_on = last if s in (1, 2) else np.zeros(n, bool)
        arcs(2, goes_on, node[:, 0, s], node[:, 0, MADE[s]])
        arcs(0, ~goes_on, node[:, 0, s], node[:, 0, s])
    label, source, target = map(np.concatenate, (label, source, target))

    def least(rank):
        out = np.full(node.size, -1)
        order = np.lexsort((rank, source))
        first = np.flatnonzero(np.diff(source[order], prepend=-1))
        out[source[order[first]]] = order[first]
        return out

    rank, pointers = label, [least(label)[target]]
    while True:
        both = rank * (int(rank.max()) + 1) + rank[pointers[-1]]
        rank = np.unique(both, return_inverse=True)[1]
        if (label[pointers[-1]] == 0).all():
            break
        pointers.append(pointers[-1][pointers[-1]])
    start = least(rank)[node[np.arange(n), blocks.size]]  # (block, state)
    path = start.reshape(-1, 1)
    for pointer in pointers:
        path = np.concatenate([path, pointer[path]], axis=1)
    audit = np.array([row.tobytes().rstrip(b"\0").decode() for row in LETTERS[label[path]]], object).reshape(n, 4)
    behind_state = source[path[:, -1]].reshape(n, 4) % 4
    return cost[np.arange(n), blocks.size], audit, behind_state


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Blocks of a batch, the longest first, so many at a time that they hold few cells."""
    size = np.diff(batch.column("codes").offsets.to_numpy())
    batch = batch.take(pa.array(np.argsort(-size, kind="stable")))
    size = -np.sort(-size)
    start = 0
    while start < len(batch):
        n = max(1, CELLS // (int(size[start]) + 1))
        yield batch.slice(start, n)
        start += n


def _codes(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.asarray(c, np.int64) for c in batch.column("codes").to_pylist()]


def _priced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _portions(batch):
            cost = matrices(_codes(part)).reshape(len(part), 16)
            yield pa.RecordBatch.from_arrays([part.column("c"), part.column("block"), pa.array(cost.tolist(), pa.list_(pa.int64()))], ["c", "block", "cost"])


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs of the states behind each block of a conversation, from its last block backwards."""
    for batch in batches:
        rows = []
        for c, blocks in zip(batch.column("c").to_pylist(), batch.column("blocks").to_pylist()):
            costs = LAST
            for x in reversed(blocks):
                rows.append((c, x["block"], costs.tolist(), x is blocks[-1]))
                costs = (np.array(x["cost"]).reshape(4, 4) + costs).min(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*rows)] if rows else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_())], ["c", "block", "behind", "last"])


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _portions(batch):
            cost, audit, state = least_audits(_codes(part), np.array(part.column("behind").to_pylist()), np.array(part.column("last").to_pylist(), bool))
            lists = [pa.array(v.tolist(), pa.list_(t)) for v, t in ((cost, pa.int64()), (audit, pa.string()), (state, pa.int64()))]
            yield pa.RecordBatch.from_arrays([part.column("c"), part.column("block"), *lists], ["c", "block", "cost", "audit", "state"])


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state before each block of a conversation."""
    for batch in batches:
        rows = []
        for c, blocks in zip(batch.column("c").to_pylist(), batch.column("blocks").to_pylist()):
            s = 0
            for x in blocks:
                rows.append((c, x["block"], s))
                s = x["state"][s]
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (zip(*rows) if rows else ((), (), ()))], ["c", "block", "entry"])


def _by_conversation(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("block", column))).alias("blocks"))


def audits(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(c, cost, audit) from :func:`marked` rows.

    A conversation is cut into blocks of ``block`` rows. Each gives a matrix of costs from state to state; their products from the
    last block backwards give what the states behind each block cost, so all blocks find their least audits at once, for every state that they
    may be entered in. A long conversation is never worked in one task; what its blocks say of four states each is.
    """
    code = F.struct("pos", (F.col("initial") + 4 * F.col("fault")).cast("byte").alias("code"))
    grouped = rows.groupBy("c", F.floor((F.col("pos") - 1) / block).alias("block")).agg(F.sort_array(F.collect_list(code)).alias("x"))
    blocks = stored(grouped.select("c", "block", F.col("x.code").alias("codes")))
    priced = stored(blocks.mapInArrow(_priced, "c long, block long, cost array<long>"))
    behind = _by_conversation(priced, "cost").mapInArrow(_behind, "c long, block long, behind array<long>, last boolean")
    found = stored(blocks.join(behind, ["c", "block"]).mapInArrow(_audited, "c long, block long, cost array<long>, audit array<string>, state array<long>"))
    entry = _by_conversation(found, "state").mapInArrow(_entered, "c long, block long, entry long")
    part = found.join(entry, ["c", "block"]).select("c", "block", F.expr("audit[entry]").alias("audit"), F.when(F.col("block") == 0, F.expr("cost[0]")).alias("cost"))
    whole = part.groupBy("c").agg(F.max("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("block", "audit"))).alias("x"))
    return whole.select("c", "cost", F.array_join("x.audit", "").alias("audit"))


TURNS = "c long, place long, edit string, role string, text string"


class Editor:
    """Applies the audit of one conversation after the other to its rows, which come in order."""

    def __init__(self) -> None:
        self.c, self.audit, self.at, self.state, self.place, self.out = None, "", 0, 0, 0, []

    def put(self, edit: str, role: str, text: str, to: int) -> None:
        self.out.append((self.c, self.place, edit, role, text))
        self.state, self.place = to, self.place + 1

    def made(self, edit: str, text: str) -> None:
        to = int(MADE[self.state])
        self.put(edit, ROLES[to], text, to)

    def insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.made("I", "")
            self.at += 1

    def start(self, c: int | None, audit: str) -> None:
        self.insert()
        self.c, self.audit, self.at, self.state, self.place = c, audit, 0, 0, 0

    def row(self, role: str, text: str) -> None:
        self.insert()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.put("K", role, text, int(STEP[self.state]["sua".index(role[0])]))
        elif edit == "R":
            self.made("R", text)

    def done(self) -> Iterator[pa.RecordBatch]:
        if self.out:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*self.out), kinds)], [x.split()[0] for x in TURNS.split(", ")])
        self.out = []


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edited rows of conversations that come in order, each one's audit before its rows."""
    editor = Editor()
    for batch in batches:
        for part in common.slices([batch], "text"):
            for c, audit, role, text in zip(*(part.column(n).to_pylist() for n in ("c", "audit", "role", "text"))):
                if audit is None:
                    editor.row(role, text)
                else:
                    editor.start(c, audit)
            yield from editor.done()
    editor.start(None, "")
    yield from editor.done()


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (c, place, edit, role, text) of the repaired conversations, in order within each task: ``rows`` edited as ``found`` says.

    Each conversation streams through its task in order; nothing but its audit is held.
    """
    none = F.lit(None).cast("string")
    heads = found.select("c", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(0).cast("long").alias("o"), F.lit(0).alias("copy"), "audit", none.alias("role"), none.alias("text"))
    both = heads.unionByName(rows.select("c", F.lit(1).alias("kind"), "turn", "o", "copy", none.alias("audit"), "role", "text"))
    order = both.repartition("c").sortWithinPartitions("c", "kind", F.col("turn").asc_nulls_first(), "o", "copy")
    return order.mapInArrow(_edited, TURNS)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    c, running = None, None

    def row(done):
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.int64()), pa.array([v for _, v in done], pa.string())], ["c", "repaired_sha256"])

    for batch in batches:
        done = []
        for key, role, text in zip(*(batch.column(n).to_pylist() for n in ("c", "role", "text"))):
            if key == c:
                running.update(b"\n")
            else:
                if c is not None:
                    done.append((c, running.hexdigest()))
                c, running = key, hashlib.sha256()
            running.update(f"{role}:{text}".encode())
        if done:
            yield row(done)
    if c is not None:
        yield row([(c, running.hexdigest())])


def structure_report(conversations: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conv_id of ``conversations``, over its ``rows`` (as from :func:`damaged`) in the order of their turns, nulls first: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The audit names the cheapest edits that give the role initials ``(s?(ua)+)?``: Keep, Rerole, Delete, Insert; of several it is the least
    in ASCII. The hash is that of the repaired ``role:text``, joined by line ends. Conversations without rows, and those that lose all, have the
    empty text's hash. A repeated row is a duplicate; further columns are ignored; an empty table gives no rows.
    """
    marks = stored(marked(rows))
    turns = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.sum(F.col("new_turn").cast("long")), F.lit(0).cast("long"))
    faults = [F.sum((F.col("fault") == k).cast("long")).alias(n) for k, n in ((1, "blank"), (2, "duplicate"), (3, "truncated"))]
    stats = marks.groupBy("c").agg(turns.alias("gaps"), *faults, F.sum(F.col("illegal").cast("long")).alias("illegal"))
    found = stored(audits(marks, block))
    digests = repaired(rows, found).mapInArrow(_digested, "c long, repaired_sha256 string")
    every = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("c")).distinct()
    out = every.join(stats, "c", "left").join(found, "c", "left").join(digests, "c", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("c").alias("conv_id"), *(F.coalesce(n, zero).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def damaged_report(conversations: DataFrame) -> DataFrame:
    """:func:`structure_report` of the conversations once they are damaged."""
    return structure_report(conversations, damaged(conversations))
