"""What the operators share: reading tables, intermediate tables in the shared folder, row keys and splits."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a missing id inside an operator; real ids are smaller, so a smallest id is a real one where there is one.
NO_ID = 1 << 62

#: Bytes after which Spark ends a batch for Python, where :func:`small_batches` holds.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate data; a folder of our own only on a local session that names none."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here and a lost executor repeats nothing before it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables that :func:`stored` wrote and that nothing reads any more: what was made from them is stored itself."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """Within, batches that go to Python end after ``most`` bytes; else Spark counts 10 000 rows, and so many whole texts are of any size.

    This holds for what runs within, as :func:`stored` does, and not for a plan that is returned.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(name, None)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, was)


def row_id(docs: DataFrame) -> Column:
    """``doc_id``, or a number made of the text where it is null."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID) + F.pmod(F.xxhash64("text"), F.lit(1 << 61)))


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose :func:`row_id` is not in ``keys`` (one column), all columns unchanged."""
    name = free_name(docs, "_key")
    bad = keys.select(keys[keys.columns[0]].alias(name)).distinct()
    return docs.withColumn(name, row_id(docs)).join(bad, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def real_id(key: Column) -> Column:
    return F.when(key < NO_ID, key)


def fold(key: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % n


def is_fold(key: str | Column, n: int, k: int) -> Column:
    """Whether a row is held out; rows without an id are, since nothing may be learnt from them."""
    return F.coalesce(fold(key, n) == k, F.lit(True))


def texts(column: pa.Array) -> list[bytes]:
    """Values of a binary column, missing ones as empty."""
    return [b if b is not None else b"" for b in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` holds about ``most`` bytes in each; a single longer value stays alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        start, total = 0, 0
        for i, size in enumerate(sizes.to_pylist()):
            if i > start and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(batch):
            yield batch.slice(start)


def apart(df: DataFrame) -> DataFrame:
    """Breaks the partitioning of an aggregate, so that a join on it shuffles both sides and can split a hot key."""
    return df.hint("rebalance")
