"""Ordered de-duplication.

``keep_first`` compiles to a WindowGroupLimit on both sides of the exchange: each map task forwards one row per
key, so a key that holds a third of the table still reaches its reducer as a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.text import is_filled, safe_str


def keep_first(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    if not order:
        raise ValueError("keep_first needs an order: without one the kept row is arbitrary")
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def first_last(df: DataFrame, by: list[str], order: str, salt: int = 16) -> DataFrame:
    """Flags ``is_first`` / ``is_last`` inside each group; ``order`` must be unique within a group.

    The two ends are aggregated (partial aggregation absorbs a hot group) and joined back with the rows of a group
    spread over ``salt`` sub-keys, so that no group is ever sorted or joined in one task.
    """
    ends = df.groupBy(*by).agg(F.min(order).alias("_low"), F.max(order).alias("_high"))
    spread = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salt)).cast("int"))
    ends = ends.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    keys = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, "_salt"]]
    joined = spread.alias("a").join(ends.alias("b"), keys, "left")
    return joined.select(
        *[F.col(f"a.`{c}`") for c in df.columns],
        (F.col(f"a.{order}") == F.col("b._low")).alias("is_first"),
        (F.col(f"a.{order}") == F.col("b._high")).alias("is_last"),
    )


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Position of a row in file order: file, block of the file, row. ``df`` must come straight from a file source.

    A scan sorts blocks by size and packs small files together, so the running number alone is not file order; within a
    block it is.
    """
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return df.withColumn(name, place)


def site_key(contract: str, site: str, row_id: str) -> Column:
    """Stable key of a site row, with fallbacks when contract or site number is blank."""
    contract_col, site_col, row = F.col(contract), F.col(site), F.concat(F.lit("ROW_"), F.col(row_id).cast("string"))
    has_contract, has_site = is_filled(contract_col), is_filled(site_col)
    c, s = safe_str(contract_col), safe_str(site_col)
    return (
        F.when(has_contract & has_site, F.concat_ws("::", c, s))
        .when(has_contract, F.concat_ws("::", c, row))
        .when(has_site, F.concat_ws("::", F.lit("NO_CONTRACT"), s))
        .otherwise(row)
    )
