"""Column profiles. Each is one aggregation over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.text import is_filled


def _long(one_row: DataFrame, columns: list[str], stats: list[str]) -> DataFrame:
    """Turn ``{column}__{stat}`` of a single row into one row per column."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}__{s}`").alias(s) for s in stats]) for c in columns
    ])
    return one_row.select(F.inline(entries))


def fill_rates(df: DataFrame, columns: list[str] | None = None, blank_is_empty: bool = False) -> DataFrame:
    """Filled rows and percentage per column; blank text counts as filled unless ``blank_is_empty``."""
    columns = columns or df.columns
    types = dict(df.dtypes)

    def filled(c: str) -> Column:
        if blank_is_empty and types[c] == "string":
            return F.count_if(is_filled(F.col(c)))
        return F.count(c)

    counted = df.agg(F.count("*").alias("_rows"), *[filled(c).alias(f"_n_{c}") for c in columns])
    wide = counted.select(
        *[F.col(f"_n_{c}").alias(f"{c}__filled") for c in columns],
        *[F.try_divide(F.col(f"_n_{c}") * 100.0, F.col("_rows")).alias(f"{c}__pct") for c in columns],
    )
    return _long(wide, columns, ["filled", "pct"])


def key_profile(df: DataFrame, key: str, pair: list[str]) -> DataFrame:
    """Rows, exact distinct keys, surplus rows and distinct key pairs."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct(key).alias("n_keys"),
        (F.count(key) - F.countDistinct(key)).alias("n_duplicates"),
        F.countDistinct(*pair).alias("n_pairs"),
    )


def top_values(df: DataFrame, column: str, n: int | None = 10) -> DataFrame:
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))
    ordered = counts.filter(F.col("value").isNotNull()).orderBy(F.col("n_rows").desc(), "value")
    return ordered if n is None else ordered.limit(n)


def _slice_of(edges: str) -> Column:
    return F.size(F.filter(edges, lambda e: e <= F.col("v")))


def _grid(cuts: int) -> Column:
    return F.percentile_approx("v", F.array(*[F.lit(i / cuts) for i in range(1, cuts)]), F.lit(10000))


def _narrow(rows: DataFrame, keys: list[str], name: str, cuts: int) -> DataFrame:
    """Cut the rows of each wanted position once more and keep the slices that hold it, with their new start.

    There is one group per wanted position and slice, so ``edges`` and ``hits`` have a few rows and may be broadcast.
    """
    edges = rows.groupBy(*keys).agg(_grid(cuts).alias("edges"))
    cut = rows.join(F.broadcast(edges), keys).withColumn(name, _slice_of("edges")).drop("edges")
    totals = cut.groupBy(*keys, "at", "start", name).agg(F.sum("n").alias("rows"))
    before = Window.partitionBy(*keys).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.withColumn("start", F.col("start") + F.coalesce(F.sum("rows").over(before), F.lit(0)))
    hits = placed.filter(_holds_position()).select(*keys, name, "start")
    return cut.drop("start").join(F.broadcast(hits), [*keys, name])


def _holds_position() -> Column:
    return (F.col("start") <= F.ceil("at")) & (F.floor("at") < F.col("start") + F.col("rows"))


def quantiles(df: DataFrame, column: str, probabilities: list[float], cuts: int = 64) -> DataFrame:
    """Exact quantiles with linear interpolation, one row ``(p, value)`` each.

    Value counts are cut at approximate percentiles, twice; ranks are counted only inside the slices that hold a wanted
    position. A task therefore sorts one ``cuts * cuts``-th of the distinct values, never the column.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n"))
    edges = values.agg(_grid(cuts).alias("edges")).scalar()
    sliced = values.withColumn("edges", edges).select("v", "n", _slice_of("edges").alias("slice"))
    totals = sliced.groupBy("slice").agg(F.sum("n").alias("rows"))
    # At most ``cuts`` rows here: these windows are over slices, not over data.
    everything = Window.partitionBy(F.lit(1))
    before = everything.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.withColumns({"start": F.coalesce(F.sum("rows").over(before), F.lit(0)), "total": F.sum("rows").over(everything)})
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), ((F.col("total") - 1) * F.lit(float(p))).alias("at")) for p in probabilities])
    near = placed.select("slice", "start", "rows", F.inline(wanted)).filter(_holds_position()).select("p", "at", "slice", "start")
    rows = _narrow(sliced.join(F.broadcast(near), "slice"), ["p", "slice"], "fine", cuts)
    inner = Window.partitionBy("p", "slice", "fine").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("first", F.col("start") + F.coalesce(F.sum("n").over(inner), F.lit(0)))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("first") <= rank) & (rank < F.col("first") + F.col("n")), F.col("v")))

    ends = ranked.groupBy("p", "at").agg(at_rank(F.floor("at")).alias("a"), at_rank(F.ceil("at")).alias("b"))
    return ends.select("p", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))).alias("value"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles as rows ``(statistic, value)``."""
    c = F.col(column)
    basic = df.agg(
        F.count(c).cast("double").alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
    )
    rows = F.array(*[F.struct(F.lit(s).alias("statistic"), F.col(s).alias("value")) for s in basic.columns])
    names = {0.25: "25%", 0.5: "50%", 0.75: "75%"}
    label = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("p"))
    quartiles = quantiles(df, column, list(names)).select(label.alias("statistic"), "value")
    return basic.select(F.inline(rows)).unionByName(quartiles)


def presence_matrix(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.groupBy(a.alias("has_a"), b.alias("has_b")).agg(F.count("*").alias("n_rows"))
