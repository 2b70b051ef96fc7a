"""Which snapshot a period reads, and rebuilding a range of periods."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.dates import Period
from gristmill.sources.sinks import write_period

# First archived specialist year, years kept monthly, and the numbering of archive generations.
FIRST_SPECIAL_YEAR = 2015
MONTHLY_YEARS = 5
GENERATION_YEAR, GENERATION_OFFSET = 2012, 8


def source_period(period: Period, today: date) -> tuple[str, int]:
    """``("current", YYYYMM)`` for last month, else ``("archive", generation)``."""
    if period == Period(today.year, today.month).previous():
        return "current", period.value
    return "archive", GENERATION_OFFSET + (period.year - GENERATION_YEAR) * 12 + period.month


def special_period(period: Period, today: date) -> Period:
    """Specialist tables are kept monthly for five years and as December snapshots before that."""
    limit = today.year - MONTHLY_YEARS
    if period.year > limit:
        return period
    if period.year < limit:
        return Period(max(period.year, FIRST_SPECIAL_YEAR), 12)
    return Period(period.year - 1, 12) if period.month < today.month else period


def backfill(periods: list[Period], build: Callable[[Period], DataFrame], base: str, table: str, old: Callable[[Period], DataFrame] | None = None, today: date | None = None, old_years: int = 10) -> list[int]:
    """Rebuild each period and replace its partition. ``old`` is used for periods more than ``old_years`` back.

    Only period numbers pass through the driver; each month is an independent job and can be rerun alone.
    """
    done = []
    for period in periods:
        ancient = old is not None and today is not None and period.year < today.year - old_years
        write_period((old if ancient else build)(period), base, table, period)
        done.append(period.value)
    return done


def routes(spark: SparkSession, periods: list[Period], source: Callable[[Period], object]) -> DataFrame:
    """(period, year, month, snapshot): what each period reads, one row for each of the caller's periods."""
    rows = [(p.value, p.year, p.month, str(source(p))) for p in periods]
    return spark.createDataFrame(rows, "period int, year int, month int, snapshot string")


def routed(snapshots: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Rows of all snapshots that a period of ``table`` (:func:`routes`) reads, once for each such period.

    ``column`` is the partition column of ``snapshots``; partitions that no period reads are left out of the scan. A period whose
    snapshot does not exist has no rows; :func:`unrouted` names those.
    """
    name = F.col(column).cast("string")
    read = sorted({r.snapshot for r in table.select("snapshot").collect()})  # the caller's own list of periods
    return snapshots.where(name.isin(read)).withColumn("snapshot", name).join(F.broadcast(table), "snapshot").drop("snapshot")


def unrouted(snapshots: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Periods whose snapshot does not exist, from the listing of partitions alone."""
    there = snapshots.select(F.col(column).cast("string").alias("snapshot")).distinct()
    return table.join(there, "snapshot", "left_anti")


def rebuild(snapshots: DataFrame, table: DataFrame, column: str, build: Callable[[DataFrame], DataFrame], base: str, name: str, parts: int = 8) -> None:
    """All periods of ``table`` in one job: read by route, built by ``build`` and written, each replacing its own partition.

    ``build`` gets the routed rows with ``period``, ``year`` and ``month`` as columns, which it keeps; what it groups or joins by must hold the
    period. Each period is written by ``parts`` tasks, so a large one is not a single file. Periods without rows keep the partition they had.
    """
    built = build(routed(snapshots, table, column))
    share = F.pmod(F.monotonically_increasing_id(), F.lit(parts))
    spread = built.withColumn("_part", share).repartition("year", "month", "_part").drop("_part", "period")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(f"{base}/{name}")
