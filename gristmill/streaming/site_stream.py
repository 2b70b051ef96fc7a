"""Check arriving export files with the batch rules, and follow their issues up from one export to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gristmill.plans.quality import issue_changes, open_issues
from gristmill.plans.site_rules import country_filter, evaluate_sites
from gristmill.sources import delimited
from gristmill.sources.tables import SITE_COLUMNS, clean_country, missing_to_null

ARRIVALS = "path string, modificationTime timestamp, length long, content binary"


def read_arrivals(
    spark: SparkSession, arrived: DataFrame, columns: list[str], sep: str = ";", encoding: str = "UTF-8"
) -> tuple[DataFrame, DataFrame] | None:
    """Good and rejected rows of the files that a batch of :func:`arrivals` names, by the same reader as in batch; None for a batch without files.

    Columns are taken by the names in each file's own header. Rows with too few or too many fields, and all rows of a file
    that lacks a column, are rejected.
    """
    paths = sorted(r.path for r in arrived.select("path").distinct().collect())  # as many as a trigger takes
    if not paths:
        return None
    return delimited.good_and_rejected(delimited.read_delimited(spark, paths, columns, sep, encoding, incomplete="reject"))


def arrivals(spark: SparkSession, in_dir: str, per_trigger: int = 1000) -> DataFrame:
    """A stream of the names of arriving files; their contents are left to the reader."""
    return spark.readStream.format("binaryFile").schema(ARRIVALS).option("maxFilesPerTrigger", per_trigger).load(in_dir).select("path")


def check_sites_stream(
    spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, boxes: DataFrame, regions: DataFrame,
    supported: list[str] | None = None, sep: str = ";", columns: list[str] = SITE_COLUMNS, encoding: str = "UTF-8", rejected_dir: str | None = None,
) -> StreamingQuery:
    """Process what has arrived since the last run, then stop; the file log in ``checkpoint`` avoids repeats.

    Each batch replaces ``out_dir/batch=<number>`` and, with the text of broken rows, ``rejected_dir/batch=<number>`` (by default
    ``out_dir`` with ``_rejected`` behind it), so a batch that is run again after a failure leaves its rows once.
    """

    def write(arrived: DataFrame, batch: int) -> None:
        read = read_arrivals(arrived.sparkSession, arrived, columns, sep, encoding)
        if read is None:
            return
        good, rejected = read
        named = clean_country(missing_to_null(good))
        # The row id only matters for sites without contract or number: it is a digest of the row, stable across retries.
        keyed = named.withColumn("row_id", F.xxhash64(*columns))
        evaluate_sites(country_filter(keyed, supported), boxes, regions).write.mode("overwrite").parquet(f"{out_dir}/batch={batch}")
        rejected.select(F.col(delimited.CORRUPT).alias("row")).write.mode("overwrite").parquet(f"{rejected_dir or out_dir + '_rejected'}/batch={batch}")

    query = arrivals(spark, in_dir).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def _versions(spark: SparkSession, folder: str) -> dict[int, object]:
    """Sub-folders ``batch=<number>`` by number."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.listStatus(path) if files.exists(path) else []
    return {int(s.getPath().getName().removeprefix("batch=")): s.getPath() for s in found if s.getPath().getName().startswith("batch=")}


def follow_up_stream(
    spark: SparkSession, in_dir: str, out_dir: str, state_dir: str, checkpoint: str, boxes: DataFrame, regions: DataFrame,
    supported: list[str] | None = None, sep: str = ";", columns: list[str] = SITE_COLUMNS, encoding: str = "UTF-8",
) -> StreamingQuery:
    """Issues as ``new``, ``open`` or ``resolved`` as exports arrive, each export against the one before it, in the order of their times.

    The state is the table of open issues by (site key, code): ``state_dir/batch=<number>`` holds those of that export, and the next one is joined with it
    by key, which also finds the issues of sites that are gone. A batch reads the newest state before its own number and replaces
    its own state and output, so after a restart, or if a batch runs twice, the result is the same. The last two states are kept.
    """

    def write(arrived: DataFrame, batch: int) -> None:
        session = arrived.sparkSession
        read = read_arrivals(session, arrived, columns, sep, encoding)
        if read is None:
            return
        keyed = clean_country(missing_to_null(read[0])).withColumn("row_id", F.xxhash64(*columns))
        now = open_issues(evaluate_sites(country_filter(keyed, supported), boxes, regions))
        states = _versions(session, state_dir)
        own = f"{state_dir}/batch={batch}"
        now.write.mode("overwrite").parquet(own)
        now = session.read.schema(now.schema).parquet(own)
        last = max((n for n in states if n < batch), default=None)
        before = now.limit(0) if last is None else session.read.schema(now.schema).parquet(f"{state_dir}/batch={last}")
        issue_changes(before, now).write.mode("overwrite").parquet(f"{out_dir}/batch={batch}")
        for n, path in states.items():
            if last is not None and n < last:
                path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)

    query = arrivals(spark, in_dir, per_trigger=1).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()
