"""Reconciliation with finance totals, and parity of two result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.numbers import round_half_up
from gristmill.functions.text import is_filled
from gristmill.operators.dedup import first_last
from gristmill.operators.joins import assert_unique, merge_by
from gristmill.operators.setops import union_distinct
from gristmill.plans.movements import book_totals

CELL = ["network", "market", "segment"]


# --- premiums --------------------------------------------------------------------------------------------------

def finance_premiums(control: DataFrame, lines: dict[str, tuple[str, str]], period: int, order: str = "position") -> DataFrame:
    """Control sheet in millions to units; the first line of a block is network 1, later ones 3, the last is a total.

    ``lines`` maps a line name to its (market, segment); blank lines, totals and other lines drop out.
    """
    filled = control.filter(is_filled(F.col("line")) & F.col("premium_all").isNotNull())
    flagged = first_last(filled, ["line"], order)
    network = F.when(F.col("is_last"), F.lit(None)).when(F.col("is_first"), "1").otherwise("3")
    market, segment = (
        reduce(lambda acc, item: acc.when(F.col("line") == item[0], item[1][i]), lines.items(), F).otherwise(F.lit(None)) for i in (0, 1)
    )
    scaled = {c: F.round(F.col(c) * 1000000) for c in ("premium_all", "premium_current")}
    out = flagged.withColumns({"period": F.lit(period), "network": network, "market": market, "segment": segment, **scaled})
    return out.filter("network IS NOT NULL AND market IS NOT NULL").select("period", *CELL, "premium_all", "premium_current")


def reconcile_premiums(cube: DataFrame, finance: DataFrame) -> DataFrame:
    """Rounded cube totals per cell beside finance, and finance minus cube; every cube cell is kept."""
    keys = ["period", *CELL]
    totals = cube.groupBy(*keys).agg(
        F.round(F.sum("premium_all")).alias("premium_all_cube"), F.round(F.sum("premium_current")).alias("premium_current_cube")
    )
    merged = merge_by(totals, finance, keys, keep="left")
    return merged.withColumns({
        f"gap_{m}": F.round(F.col(m) - F.col(f"{m}_cube")) for m in ("premium_all", "premium_current")
    })


# --- movements -------------------------------------------------------------------------------------------------

MOVEMENTS = {"in_force": "policies", "new": "new", "cancelled": "cancelled"}


def reconcile_movements(book: DataFrame, control: list[DataFrame]) -> DataFrame:
    """Counts, premiums and average premiums of the book beside the control sheets, with differences.

    The control columns are ``n_<x>_ref`` and ``premium_<x>_ref`` for x in in_force, new, cancelled. One aggregate
    serves both comparisons; a control cell without book rows is kept.
    """
    sheet = union_distinct(*control)
    measures = [f"{kind}_{x}" for x in MOVEMENTS for kind in ("n", "premium")]
    totals = book_totals(book, CELL, measures)
    merged = merge_by(sheet, totals, CELL, keep="left")
    rounded = {f"premium_{x}{end}": round_half_up(F.col(f"premium_{x}{end}")) for x in MOVEMENTS for end in ("", "_ref")}
    out = merged.withColumns(rounded)
    averages = {
        f"average_{x}{end}": round_half_up(F.try_divide(F.col(f"premium_{x}{end}"), F.col(f"n_{x}{end}")))
        for x in MOVEMENTS for end in ("", "_ref")
    }
    out = out.withColumns(averages)
    gaps = {
        f"gap_{kind}_{x}": round_half_up(F.col(f"{kind}_{x}") - F.col(f"{kind}_{x}_ref"))
        for x in MOVEMENTS for kind in ("n", "premium", "average")
    }
    return out.withColumns(gaps)


# --- parity ----------------------------------------------------------------------------------------------------

def parity_structure(a: DataFrame, b: DataFrame) -> DataFrame:
    """Column by column: type on each side and whether they agree."""
    left, right = dict(a.dtypes), dict(b.dtypes)
    names = sorted({*left, *right})
    rows = [F.struct(F.lit(n).alias("column"), F.lit(left.get(n)).alias("type_a"), F.lit(right.get(n)).alias("type_b")) for n in names]
    listed = a.sparkSession.range(1).select(F.inline(F.array(*rows)))
    return listed.withColumn("same", F.col("type_a").eqNullSafe(F.col("type_b")))


def parity_kpis(a: DataFrame, b: DataFrame, keys: list[str], kpis: list[str], tolerance: float = 0.0001) -> DataFrame:
    """Rows and KPI totals per key on both sides; ``within`` tells whether every relative gap is inside the tolerance."""
    def totals(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias(f"rows_{side}"), *[F.sum(k).alias(f"{k}_{side}") for k in kpis])

    left, right = totals(a, "a"), totals(b, "b")
    rule = reduce(lambda x, y: x & y, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    joined = left.alias("l").join(right.alias("r"), rule, "full")

    def gap(k: str) -> Column:
        va, vb = F.coalesce(F.col(f"{k}_a"), F.lit(0)), F.coalesce(F.col(f"{k}_b"), F.lit(0))
        return F.when(va == vb, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(F.abs(va - vb), F.abs(va)), F.lit(1.0)))

    measured = ["rows", *kpis]
    picked = [F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys]
    values = [F.col(f"{m}_{side}") for m in measured for side in ("a", "b")]
    return joined.select(*picked, *values, (F.greatest(*[gap(m) for m in measured], F.lit(0.0)) <= tolerance).alias("within"))


def parity_fields(a: DataFrame, b: DataFrame, keys: list[str], fraction: float = 1.0, seed: int = 0) -> DataFrame:
    """Field-by-field differences per column over the rows chosen by a seeded hash of the key, the same on both sides."""
    fields = [c for c in a.columns if c in b.columns and c not in keys]

    def chosen(df: DataFrame) -> DataFrame:
        if fraction >= 1:
            return df
        return df.filter(F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1000000)) < int(fraction * 1000000))

    rule = reduce(lambda x, y: x & y, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    joined = chosen(a).withColumn("_in", F.lit(True)).alias("l").join(chosen(b).withColumn("_in", F.lit(True)).alias("r"), rule, "full")
    both = F.col("l._in").isNotNull() & F.col("r._in").isNotNull()
    counted = joined.agg(
        F.count_if(both).alias("_compared"), F.count_if(~both).alias("_alone"),
        *[F.count_if(both & ~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))).alias(f"_d_{c}") for c in fields],
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_d_{c}").alias("differences"), F.col("_compared").alias("compared"), F.col("_alone").alias("one_sided")) for c in fields]
    return counted.select(F.inline(F.array(*rows)))


def _digested(df: DataFrame, keys: list[str], fields: dict[str, str], bits: list[int]) -> DataFrame:
    """Rows with their key ranges (``_r0`` the coarsest) and digest. A null differs from every value, and from a null beside another one."""
    whole = [F.col(f"`{k}`") for k in keys] + [F.col(f"`{c}`").cast(kind) for c, kind in fields.items()]
    gaps = F.concat(*(F.when(c.isNull(), "1").otherwise("0") for c in whole))
    place = F.xxhash64(*(F.col(f"`{k}`").cast("string") for k in keys))
    ranges = {f"_r{i}": F.shiftrightunsigned(place, 64 - b) for i, b in enumerate(bits)}
    return df.select(*(F.col(f"`{k}`") for k in keys), *(F.col(f"`{c}`").cast(kind).alias(c) for c, kind in fields.items()), *(c.alias(n) for n, c in ranges.items()), F.xxhash64(gaps, *whole).alias("_d1"), F.xxhash64(F.lit(1), gaps, *whole).alias("_d2"))


def _sums(rows: DataFrame, column: str, side: str) -> DataFrame:
    """Digest of each range that does not depend on the order of its rows."""
    total = [F.sum(F.col(f"_d{k}").cast("decimal(38,0)")).alias(f"s{k}{side}") for k in (1, 2)]
    return rows.groupBy(column).agg(F.count("*").alias(f"n{side}"), *total)


def parity_rows(a: DataFrame, b: DataFrame, keys: list[str], bits: tuple[int, ...] = (10, 20)) -> DataFrame:
    """Every row that differs between two tables with unique keys: the keys, ``state`` (``changed``, ``only_a`` or ``only_b``) and the ``fields`` that changed.

    Ranges of hashed keys are compared by digests first, coarse ones and then those inside of the ones that differ; sums are formed before
    the exchange, so a table that is equal moves ``2 ** bits[0]`` rows a task. Only rows of the finest ranges that differ are shuffled and joined by key.
    Columns of both tables are compared, with the types of ``a``. A repeated key among the rows that are joined fails the job.
    """
    fields = {c: kind for c, kind in a.dtypes if c in b.columns and c not in keys}
    left, right = (_digested(df, keys, fields, list(bits)) for df in (a, b))
    for i in range(len(bits)):
        column = f"_r{i}"
        both = _sums(left, column, "a").join(_sums(right, column, "b"), column, "full")
        differs = both.where(~(F.col("na").eqNullSafe(F.col("nb")) & F.col("s1a").eqNullSafe(F.col("s1b")) & F.col("s2a").eqNullSafe(F.col("s2b")))).select(column)
        left, right = (df.join(differs, column, "left_semi") for df in (left, right))
    left, right = (assert_unique(df.drop(*(f"_r{i}" for i in range(len(bits)))), keys, null_safe=True) for df in (left, right))
    rule = reduce(lambda x, y: x & y, [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys])
    joined = left.alias("l").join(right.alias("r"), rule, "full").where(~(F.col("l._d1").eqNullSafe(F.col("r._d1")) & F.col("l._d2").eqNullSafe(F.col("r._d2"))))
    changed = F.array_compact(F.array(*(F.when(~F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")), c) for c in fields)) if fields else F.array().cast("array<string>"))
    state = F.when(F.col("l._d1").isNull(), "only_b").when(F.col("r._d1").isNull(), "only_a").otherwise("changed")
    return joined.select(*(F.coalesce(f"l.{k}", f"r.{k}").alias(k) for k in keys), state.alias("state"), F.when(state == "changed", F.concat_ws(",", changed)).alias("fields"))
