"""Insured capital: from the repeated groups of a policy, and from the legacy capital lines.

The fourteen (label, amount, nature, coefficient) columns are gathered once into ``groups``, an array of structs;
every measure is then a higher-order function over that array, inside the policy's own row.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.dates import anniversary
from gristmill.functions.numbers import greatest_m, sum_m, to_full_share
from gristmill.functions.text import contains_any
from gristmill.operators.joins import lookup
from gristmill.operators.setops import align, union_by_name

GROUPS = 14


def groups_column(label: str, amount: str, nature: str, coef: str, n: int = GROUPS) -> Column:
    """Pack numbered columns (``label1 .. label14`` and so on) into the array."""
    return F.array(*[
        F.struct(
            F.lit(i).alias("pos"), F.col(f"{label}{i}").alias("label"), F.col(f"{amount}{i}").alias("amount"),
            F.col(f"{nature}{i}").alias("nature"), F.col(f"{coef}{i}").alias("coef"),
        )
        for i in range(1, n + 1)
    ])


@dataclass(frozen=True)
class Measure:
    """One capital amount: which labels feed it, which amount of the group, and how several groups combine.

    ``mode`` is ``last`` (the last matching group decides, even with a missing amount) or ``max``. ``seed`` is the
    starting value: None where the program starts from missing, 0.0 where it starts from zero.
    """

    name: str
    labels: list[str]
    mode: str = "max"
    amount: str = "amount"
    seed: float | None = None
    not_exactly: tuple[str, ...] = ()
    also: tuple[str, ...] = ()

    def test(self, label: Column) -> Column:
        hit = contains_any(label, self.labels)
        if self.not_exactly:
            hit = hit & ~label.isin(list(self.not_exactly))
        return F.coalesce(hit | contains_any(label, list(self.also)), F.lit(False))

    def column(self) -> Column:
        matching = F.filter("groups", lambda g: self.test(g["label"]))
        if self.mode == "last":
            kept = F.try_element_at(matching, F.lit(-1))[self.amount]
            return F.when(F.size(matching) > 0, kept).otherwise(F.lit(self.seed).cast("double"))
        largest = F.array_max(F.transform(matching, lambda g: g[self.amount]))
        return largest if self.seed is None else greatest_m(F.lit(self.seed), largest)


def capital(df: DataFrame, measures: list[Measure]) -> DataFrame:
    return df.withColumns({m.name: m.column() for m in measures})


def capital_last(df: DataFrame, measures: list[Measure]) -> DataFrame:
    """Movement job: last matching group wins, zero when nothing matches."""
    return capital(df, [Measure(m.name, m.labels, "last", m.amount, 0.0, m.not_exactly, m.also) for m in measures])


def full_share(df: DataFrame, columns: list[str], share: str = "share_pct") -> DataFrame:
    return df.withColumns({c: to_full_share(F.col(c), F.col(share)) for c in columns})


def complete(df: DataFrame, rules: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """``target = max(target, sum of parts)`` with missing values skipped."""
    return df.withColumns({t: greatest_m(F.col(base), sum_m(*[F.col(p) for p in parts])) for t, (base, parts) in rules.items()})


def capital_max(
    df: DataFrame, measures: list[Measure], completions: dict[str, tuple[str, list[str]]] | None = None,
    limits: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Capital job: measures, share to 100 %, then the completion rules and the largest of several limits."""
    out = full_share(capital(df, measures), [m.name for m in measures])
    out = complete(out, completions or {})
    return out.withColumns({name: greatest_m(*[F.col(p) for p in parts]) for name, parts in (limits or {}).items()})


# --- indexation ------------------------------------------------------------------------------------------------

def index_by_date(index: DataFrame) -> DataFrame:
    """``(index_date, map nature -> value)``; a map holds one entry per nature code of that day."""
    single = index.groupBy("index_date", "nature").agg(F.max("index_value").alias("index_value"))
    entries = F.map_from_entries(F.collect_list(F.struct("nature", "index_value")))
    return single.groupBy("index_date").agg(entries.alias("by_nature"))


def index_amounts(
    df: DataFrame, index: DataFrame, observed: date | None, effect: str = "effect_date", today: date | None = None,
    indexed_prefix: str = "0",
) -> DataFrame:
    """Adds ``indexed`` to each group: amount x (index at the last anniversary / index at the effect date).

    Natures outside the indexed prefix have ratio 1; so has a policy whose effect date follows the anniversary; a
    ratio that cannot be formed leaves the amount as it is. Without ``observed`` the starting index is the stored
    coefficient and the anniversary is counted from ``today``. Two lookups by day bring in maps by nature, so the groups
    are never unfolded and the policies neither regrouped nor dealt out by day.
    """
    by_date = index_by_date(index)
    day = anniversary(F.col("anniversary_mmdd"), observed or today)
    base = df.withColumn("_anniversary", day)
    joined = lookup(base, by_date, {"_anniversary": "index_date"}, {"by_nature": "_now"})
    if observed is not None:
        joined = lookup(joined, by_date, {effect: "index_date"}, {"by_nature": "_then"})
    early = F.col("_anniversary").isNull() & F.col(effect).isNotNull() | (F.col("_anniversary") < F.col(effect))

    def ratio(g: Column) -> Column:
        indexed = F.coalesce(g["nature"].startswith(indexed_prefix), F.lit(False))
        current = F.when(indexed, F.element_at("_now", g["nature"])).otherwise(F.lit(1.0))
        if observed is None:
            start = g["coef"]
        else:
            start = F.when(indexed, F.element_at("_then", g["nature"])).otherwise(F.lit(1.0))
        return F.when(F.coalesce(early, F.lit(False)), F.lit(1.0)).otherwise(F.try_divide(current, start))

    def with_indexed(g: Column) -> Column:
        return g.withField("indexed", g["amount"] * F.coalesce(ratio(g), F.lit(1.0)))

    out = joined.withColumn("groups", F.transform("groups", with_indexed))
    return out.select(*df.columns)


# --- legacy lines ----------------------------------------------------------------------------------------------

def legacy_capital(lines: DataFrame, kinds: dict[str, str], branches: list[str], keys: list[str]) -> DataFrame:
    """Sums per policy and product: for each kind, the full and the company amount over the listed branches."""
    def total(kind: str, amount: str) -> Column:
        taken = (F.col("kind") == kind) & F.col("branch").isin(branches)
        return F.sum(F.when(taken, F.coalesce(F.col(amount), F.lit(0))).otherwise(F.lit(0)))

    sums = []
    for name, kind in kinds.items():
        sums += [total(kind, "amount_full").alias(f"{name}_full"), total(kind, "amount_company").alias(f"{name}_company")]
    return lines.groupBy(*keys).agg(*sums)


def fire_capital(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Loss, direct and insured value; a line with a missing part adds nothing to the insured value."""
    return lines.groupBy(*keys).agg(
        F.sum("loss").alias("loss_full"), F.sum("direct").alias("direct_full"), F.sum(F.col("direct") + F.col("loss")).alias("insured_full")
    )


def consolidate_capital(main: DataFrame, legacy: DataFrame, main_map: dict, legacy_map: dict, legacy_network: str = "3") -> DataFrame:
    """Both channels in one layout; what a channel does not have is null."""
    tagged = align(main, {"channel": F.lit("main"), **main_map})
    older = align(legacy, {"channel": F.lit("legacy"), "network": F.lit(legacy_network), **legacy_map})
    return union_by_name(tagged, older)
