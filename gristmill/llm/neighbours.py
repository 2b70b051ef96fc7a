"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hash tables, buckets of each that a query visits, and candidates that it must meet in each unless all buckets are visited.
TABLES, PROBES, LEAST = 4, 24, 2000
#: Vectors of a bucket that one task compares at a time.
BLOCK = 512
NEAREST = 20

HITS = "query_id long, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix; their length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        pairs = x.reshape(n, -1, 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, tables: int, seed: int = 20) -> list[np.ndarray]:
    """Unit rows under one pseudo-rotation for each table: three times random signs and the Hadamard transform, after padding."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = []
    for t in range(tables):
        signs = np.random.default_rng((seed, t, width)).choice([-1.0, 1.0], (3, width))
        z = y
        for s in signs:
            z = hadamard(z * s)
        out.append(z)
    return out


def axis_of(y: np.ndarray) -> np.ndarray:
    """The nearest signed axis: twice its number, one more for the negative side."""
    a = np.abs(y).argmax(axis=1)
    return 2 * a + (y[np.arange(len(y)), a] < 0)


def ranked_axes(y: np.ndarray) -> np.ndarray:
    """All signed axes of each row, the nearest first."""
    both = np.stack([y, -y], axis=2).reshape(len(y), -1)
    return np.argsort(-both, axis=1, kind="stable")


def _matrices(batch: pa.RecordBatch):
    """(rows, matrix) for each length of vectors in the batch."""
    lists = batch.column("embedding")
    sizes = np.array(pa.compute.list_value_length(lists).to_pylist(), np.int64) if len(batch) else np.zeros(0, np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.array(lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(at), size)


def _lift(x: np.ndarray, most: float) -> np.ndarray:
    """One more component that gives all vectors the length ``most``; the nearest direction then has the largest inner product."""
    return np.column_stack([x, np.sqrt(np.maximum(most**2 - (x**2).sum(axis=1), 0))])


def _hashed(tables: int, most: float | None):
    def run(batches):
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            for at, x in _matrices(batch):
                ids = batch.column("vec_id").take(pa.array(at))
                data = pa.array([v.tobytes() for v in x], pa.binary())
                for t, y in enumerate(rotated(x if most is None else _lift(x, most), tables)):
                    bucket = (x.shape[1] << 32) + (t << 24) + axis_of(y)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket), ids, data], ["bucket", "vec_id", "data"])

    return run


def _probes(tables: int, probes: int, least: int, lifted: bool, sizes):
    def run(batches):
        import pyarrow.compute  # noqa: F401

        count = sizes.value
        for batch in batches:
            for at, x in _matrices(batch):
                ids = np.array(batch.column("vec_id").take(pa.array(at)).to_pylist())
                for t, y in enumerate(rotated(np.column_stack([x, np.zeros(len(x))]) if lifted else x, tables)):
                    base = (x.shape[1] << 32) + (t << 24)
                    n = np.array([count.get(base + a, 0) for a in range(2 * y.shape[1])])
                    axes = ranked_axes(y)
                    before = np.cumsum(n[axes], axis=1) - n[axes]
                    wanted = ((np.arange(axes.shape[1]) < probes) | (before < least)) & (n[axes] > 0)
                    row, k = np.nonzero(wanted)
                    axis = axes[row, k]
                    parts = -(-n[axis] // BLOCK)
                    row, axis = np.repeat(row, parts), np.repeat(axis, parts)
                    salt = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                    for s in range(0, len(row), 4096):
                        r = row[s : s + 4096]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(base + axis[s : s + 4096]), pa.array(salt[s : s + 4096].astype(np.int32)), pa.array(ids[r]), pa.array([x[i].tobytes() for i in r], pa.binary())],
                            ["bucket", "salt", "query_id", "data"],
                        )

    return run


def _compare(k: int):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        q_ids, v_ids = queries["query_id"].to_numpy(), vectors["vec_id"].to_numpy()
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if len(q_ids) and len(v_ids):
            q, v = (np.stack([np.frombuffer(b, np.float64) for b in t["data"].to_pylist()]) for t in (queries, vectors))
            order = np.argsort(v_ids, kind="stable")
            v_ids, v = v_ids[order], v[order]
            for start in range(0, len(q), 1024):
                part = q[start : start + 1024]
                rough = part @ v.T
                rough[q_ids[start : start + 1024, None] == v_ids] = -np.inf
                for i, row in enumerate(rough):
                    at = np.flatnonzero(row > -np.inf)
                    if len(at) > k:
                        limit = np.partition(row, len(row) - k)[len(row) - k]
                        at = np.flatnonzero(row >= limit - 1e-9 * max(1.0, abs(limit)))
                    # Summed for each pair on its own, so that a score never depends on which vectors are compared together.
                    exact = (part[i] * v[at]).sum(axis=1)
                    best = np.lexsort((v_ids[at], -exact))[:k]
                    out[0].append(np.full(len(best), q_ids[start + i]))
                    out[1].append(v_ids[at][best])
                    out[2].append(exact[best])
        ids, found, scores = (np.concatenate(o) for o in out)
        return pa.table({"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(scores, pa.float64())})

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) without null ids and without vectors that are null, zero, or hold null or non-finite components."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).where(F.col("vec_id").isNotNull() & fine)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, tables: int = TABLES, probes: int = PROBES, least: int = LEAST) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of the ``k`` vectors found with the largest inner product; both inputs have (vec_id, embedding).

    Each table turns unit vectors by a pseudo-rotation and files them under the nearest signed axis. A query visits its ``probes`` nearest
    axes of each table, and more until it has met ``least`` vectors, so few vectors are searched whole. Candidates are compared exactly, in
    double precision. Vectors of unequal lengths of arrow first get one more component that makes them equally long, which keeps the order
    of inner products. Vectors with another number of components than the query are no candidates. A bucket is dealt to tasks in blocks of
    ``BLOCK`` vectors, to each of which its queries go. Ties go to the smaller vec_id; of repeated ids one row takes part.
    """
    spark = vectors.sparkSession
    data = usable(vectors)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v))
    low, high = data.agg(F.min(norm), F.max(norm)).first()
    most = None if low is None or high - low <= 1e-5 * high else float(high) * (1 + 1e-12)
    filed = data.mapInArrow(_hashed(tables, most), "bucket long, vec_id long, data binary")
    sizes = {r.bucket: r.n for r in filed.groupBy("bucket").agg(F.count("*").alias("n")).collect()}  # twice the width for each table
    counts = spark.createDataFrame(list(sizes.items()) or [(-1, 0)], "bucket long, n long")
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    filed = filed.join(F.broadcast(counts), "bucket").withColumn("salt", F.pmod(F.xxhash64("vec_id"), blocks).cast("int")).drop("n")
    sent = spark.sparkContext.broadcast(sizes)
    asked = usable(queries).mapInArrow(_probes(tables, probes, least, most is not None, sent), "bucket long, salt int, query_id long, data binary")
    hits = asked.groupBy("bucket", "salt").cogroup(filed.groupBy("bucket", "salt")).applyInArrow(_compare(k), HITS)
    once = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def search_every(vectors: DataFrame, every: int, k: int = NEAREST) -> DataFrame:
    """:func:`nearest` for the rows whose vec_id is divisible by ``every``, against all rows."""
    return nearest(vectors, vectors.where(F.col("vec_id") % every == 0), k)
