"""What the passage operator holds at a time is bounded by bytes, not by rows."""

from __future__ import annotations

import tracemalloc
import uuid

import pyarrow as pa
import zstandard

from gristmill.llm import repeats


def test_batches_of_whole_texts_are_bounded(spark, tmp_path, monkeypatch):
    was, folder = repeats._squeeze, str(tmp_path)

    def squeeze(batches):
        def seen():
            for batch in batches:
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                    f.write(f"{len(batch)} {batch.get_total_buffer_size()}")
                yield batch

        yield from was(seen())

    monkeypatch.setattr(repeats, "_squeeze", squeeze)
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat(concat(sha2(cast(id AS string), 256), ' '), 800) AS text").coalesce(1)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    out = repeats.repeated_passages(docs, batches=1, words=0)
    assert out.count() == 400 and spark.conf.get(key) == before
    sizes = [tuple(map(int, p.read_text().split())) for p in tmp_path.iterdir()]
    assert sum(n for n, _ in sizes) % 400 == 0 and sizes  # all rows, each time that texts are packed
    assert max(size for _, size in sizes) < 5 << 20  # 20 MB of texts in one batch before


def test_starts_of_a_batch_are_not_held_at_once():
    packed, n = zstandard.ZstdCompressor().compress(bytes(range(256)) * 16), 6000
    starts = [{"low": i, "high": i} for i in range(0, 400, 2)]
    kinds = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    one = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([packed], pa.binary()), pa.array([starts], kinds), pa.array([None], kinds)], ["key", "z", "starts", "worded"])
    batch = pa.Table.from_batches([one] * n).combine_chunks().to_batches()[0]
    assert len(batch) == n
    tracemalloc.start()
    try:
        rows = {tuple(r.items()) for part in repeats._report(400, 51)(iter([batch])) for r in part.to_pylist()}
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(rows) == 1 and dict(rows.pop())["n_removed"] == 798
    assert peak < 100 << 20  # over 200 MB before
