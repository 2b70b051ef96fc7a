"""Classification from rule tables. The rules are data; the plan is one generated CASE."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.missing import in_m
from gristmill.functions.text import contains_any


@dataclass(frozen=True)
class Rule:
    """``kind`` is ``contains``, ``regex`` (unanchored search) or ``codes`` (exact membership)."""

    kind: str
    value: str | tuple[str, ...]
    result: str

    def test(self, text: Column, raw: Column) -> Column:
        if self.kind == "contains":
            return text.contains(self.value)
        if self.kind == "regex":
            return text.rlike(self.value)
        if self.kind == "codes":
            return raw.isin(list(self.value))
        raise ValueError(f"unknown rule kind: {self.kind}")


def classify_ordered(c: Column, rules: Sequence[Rule], default: Column | str | None = None) -> Column:
    """First matching rule wins; text rules look at the upper-cased value, code rules at the value as it is."""
    text = F.upper(c)
    case = reduce(lambda acc, rule: acc.when(rule.test(text, c), rule.result), rules, F)
    return case.otherwise(default if isinstance(default, Column) else F.lit(default))


def classify_last(rules: Sequence[tuple[Column, Column | str]], default: Column | str | None = None) -> Column:
    """Independent tests executed in order, so the last one that holds decides."""
    def value(result) -> Column:
        return result if isinstance(result, Column) else F.lit(result)

    case = reduce(lambda acc, rule: acc.when(rule[0], value(rule[1])), reversed(list(rules)), F)
    return case.otherwise(default if isinstance(default, Column) else F.lit(default))


def classify_any(
    texts: dict[str, Sequence[str]], codes: tuple[str, Sequence[str]], hit: str, miss: str
) -> Column:
    """``hit`` when any keyword occurs in its text column or the code column is listed, else ``miss``."""
    found = reduce(
        lambda a, b: a | b,
        [F.coalesce(contains_any(F.upper(F.col(name)), list(words)), F.lit(False)) for name, words in texts.items()],
        F.lit(False),
    )
    return F.when(found | in_m(F.col(codes[0]), list(codes[1])), hit).otherwise(miss)


@dataclass(frozen=True)
class MatchRule:
    """Conjunction of ``{column: allowed values}``, with optional exclusions, giving one label."""

    label: str
    where: dict[str, Sequence] = field(default_factory=dict)
    unless: dict[str, Sequence] = field(default_factory=dict)

    def test(self) -> Column:
        tests = [in_m(F.col(c), list(v)) for c, v in self.where.items()]
        tests += [~in_m(F.col(c), list(v)) for c, v in self.unless.items()]
        return reduce(lambda a, b: a & b, tests, F.lit(True))


def assign_protocol(df: DataFrame, rules: Sequence[MatchRule], scope: Column, target: str, forced: dict[str, str]) -> DataFrame:
    """Last matching rule names the protocol; a named row also has other columns forced to fixed values."""
    label = F.when(scope, classify_last([(rule.test(), rule.label) for rule in rules]))
    named = F.col(target).isNotNull()
    return df.withColumn(target, label).withColumns(
        {c: F.when(named, F.lit(v)).otherwise(F.col(c)) for c, v in forced.items()}
    )


def code_label(c: Column, labels: dict[str, str], default: str | None = None) -> Column:
    """Label of a code from a driver-side dictionary (bounded by its author, so it lives in the plan)."""
    entries = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*entries), c), F.lit(default))


def override_codes(c: Column, current: Column, overrides: dict[str, str]) -> Column:
    return F.coalesce(code_label(c, overrides), current)


def null_codes(c: Column, codes: Sequence[str]) -> Column:
    return F.when(~in_m(c, list(codes)), c)


def flag_in(c: Column, values: Sequence[str]) -> Column:
    return in_m(c, list(values)).cast("int")
