"""File trees as tables ``(root, path, size[, content])``.

Spark's own file sources skip every name that starts with ``_`` or ``.``, so they would lose ``__init__.py`` or
``.gitignore``. ``scan_tree`` therefore lists directories in tasks, one level per round, and reads bytes only for
the rows that survive the path and size filters. ``scan_visible`` is the built-in source for trees without such
names: one pass, with the size limit pushed into the scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.session import cut_lineage

_LISTING = "root string, base string, path string, is_dir boolean, size bigint"
_ARROW_LISTING = pa.schema([("root", pa.string()), ("base", pa.string()), ("path", pa.string()), ("is_dir", pa.bool_()), ("size", pa.int64())])
_READ_BYTES = 32 << 20
_LIST_CHUNK = 10000


def _list_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Direct children of each folder; one that does not exist or may not be read counts as empty."""
    for batch in batches:
        for row in batch.to_pylist():
            system, top = fs.FileSystem.from_uri(row["base"])
            prefix = f"{row['path']}/" if row["path"] else ""
            folder = f"{top}/{row['path']}" if prefix else top
            try:
                found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            except PermissionError:
                continue
            for start in range(0, len(found), _LIST_CHUNK):
                children = [
                    {**row, "path": prefix + i.base_name, "is_dir": i.type == fs.FileType.Directory, "size": i.size or 0}
                    for i in found[start:start + _LIST_CHUNK]
                ]
                yield pa.RecordBatch.from_pylist(children, schema=_ARROW_LISTING)


def _portions(sizes: list[int], most: int = _READ_BYTES) -> Iterator[tuple[int, int]]:
    """(start, number) of consecutive files of at most ``most`` bytes together."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + (size or 0) > most:
            yield start, i - start
            start, total = i, 0
        total += size or 0
    if start < len(sizes):
        yield start, len(sizes) - start


def _read_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Append the bytes of each file; a batch holds about ``_READ_BYTES`` of them, or one larger file."""
    def read(base: str, path: str) -> bytes:
        system, top = fs.FileSystem.from_uri(base)
        with system.open_input_stream(f"{top}/{path}", compression=None) as stream:
            return stream.read()

    for batch in batches:
        for start, count in _portions(batch.column("size").to_pylist()):
            part = batch.slice(start, count)
            names = zip(part.column("base").to_pylist(), part.column("path").to_pylist())
            yield part.append_column("content", pa.array([read(base, path) for base, path in names], pa.binary()))


def scan_tree(spark: SparkSession, roots: list[str], keep_folders: bool = False) -> DataFrame:
    """List every file below ``roots`` (hidden names included); ``keep_folders`` adds the folders, empty ones too."""
    tops = [(root.rstrip("/"), root.rstrip("/")) for root in roots]
    frontier = spark.createDataFrame(tops, "root string, base string").withColumn("path", F.lit(""))
    levels = []
    while not frontier.isEmpty():
        spread = frontier.select("root", "base", "path").repartition("base", "path")
        level = cut_lineage(spread.mapInArrow(_list_level, _LISTING))
        levels.append(level)
        frontier = level.filter("is_dir")
    everything = levels[0]
    for level in levels[1:]:
        everything = everything.union(level)
    return everything if keep_folders else everything.filter("NOT is_dir").drop("is_dir")


def with_content(files: DataFrame) -> DataFrame:
    """Add the bytes of each listed file; filter the listing before calling it.

    A folder is listed by one task, so the rows are spread first: the files of one huge folder are read by many tasks.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return files.repartition("base", "path").mapInArrow(_read_bytes, f"{fields}, content binary")


def scan_visible(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Built-in binary source: ``content`` is only read when selected, for files that pass the size filter."""
    def one(root: str) -> DataFrame:
        base = root.rstrip("/")
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
        relative = F.regexp_replace(F.col("path"), r"^[a-z0-9]+:/+", "/")
        plain = base if "://" not in base else "/" + base.split("://", 1)[1]
        return found.select(
            F.lit(base).alias("root"), F.substr(relative, F.lit(len(plain) + 2)).alias("path"),
            F.col("length").alias("size"), "content",
        )

    out = one(roots[0])
    for root in roots[1:]:
        out = out.union(one(root))
    return out


def corpus_from_table(df: DataFrame, id: str, source: str, text: str) -> DataFrame:
    """A table of texts in the same shape as decoded files."""
    return df.select(
        F.col(source).alias("root"), F.col(id).alias("path"), F.octet_length(text).cast("bigint").alias("size"),
        F.col(text).alias("content"),
    )
