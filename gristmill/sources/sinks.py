"""Writers."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.functions.dates import Period


def write_period(df: DataFrame, base: str, table: str, period: Period) -> None:
    """Replace one month of a table; other months are untouched, so a rerun is harmless."""
    stamped = df.withColumns({"year": F.lit(period.year), "month": F.lit(period.month)})
    (
        stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month").parquet(f"{base}/{table}")
    )


def write_report(lines: DataFrame, folder: str) -> None:
    """Text parts per root whose name order is the report order; the range exchange keeps every part small.

    :func:`read_report` gives the lines of all parts in that order.
    """
    ordered = lines.repartitionByRange("root", "section", "sort_key").sortWithinPartitions("root", "section", "sort_key")
    ordered.select("root", F.col("text").alias("value")).write.mode("overwrite").partitionBy("root").text(folder)


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """``(root, place, line)`` of a written report; sorted by root and place the lines are the report of a root, whatever its number of parts."""
    lines = spark.read.text(folder)
    place = F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return lines.select(F.col("root").cast("string").alias("root"), place.alias("place"), F.col("value").alias("line"))


def publish_report(lines: DataFrame, folder: str) -> str:
    """One whole report per root in ``folder``: ordered text parts and a manifest of their byte offsets; returns the path of this version.

    Parts are written by many tasks to a hidden folder. The offset of each is the sum of the sizes of the parts of its root before it, so the
    parts of a root, each at its offset, are the report byte for byte. One rename makes parts and manifest visible together; a job that fails leaves
    the version before it. Readers take the last version (:func:`report_manifest`).
    """
    spark = lines.sparkSession
    # Versions are told apart by time and a unique end; the manifest lies in the same folder as the parts that it names.
    version = f"report-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    staging = f"{folder}/_{version}"
    write_report(lines, f"{staging}/parts")
    parts = spark.read.text(f"{staging}/parts").select("root", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    parts = parts.groupBy(F.col("root").cast("string").alias("root"), "file").agg(F.max("bytes").alias("bytes"), F.count("*").alias("n_lines"))
    before = Window.partitionBy("root").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.select("root", "file", "bytes", "n_lines", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"))
    placed.write.parquet(f"{staging}/manifest")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.rename(path(staging), path(f"{folder}/{version}")):
        raise RuntimeError(f"could not publish {folder}/{version}")
    return f"{folder}/{version}"


def published(spark: SparkSession, folder: str) -> str | None:
    """Path of the last version of a report, None if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    return max((f"{folder}/{n}" for n in names if n.startswith("report-")), default=None)


def report_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(root, file, bytes, n_lines, offset, path) of the last version: where each part lies and where it stands in its root's report."""
    version = published(spark, folder)
    if version is None:
        raise ValueError(f"no report in {folder}")
    parts = spark.read.format("binaryFile").load(f"{version}/parts").select(F.col("root").cast("string").alias("root"), "path", F.substring_index("path", "/", -1).alias("file"))
    return spark.read.parquet(f"{version}/manifest").join(parts, ["root", "file"])


def write_quality(summary: DataFrame, detail: DataFrame, folder: str) -> None:
    summary.write.mode("overwrite").option("header", True).csv(f"{folder}/summary")
    detail.write.mode("overwrite").parquet(f"{folder}/detail")
