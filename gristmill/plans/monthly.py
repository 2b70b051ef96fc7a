"""The monthly run: both channels of a period, consolidated and written as that period's partition."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from gristmill.functions.dates import Period
from gristmill.plans import consolidate, legacy, movements, schedule

#: Reads one input: its name, and where the period's snapshot lies (``current`` or ``archive`` with a number).
Load = Callable[[str, tuple[str, int]], DataFrame]


@dataclass(frozen=True)
class MonthlyCodes:
    """Code lists of the user's book. ``networks`` are the inputs of the main channel."""

    networks: list[str]
    scope: movements.MainScope
    main: movements.MovementCodes
    legacy: legacy.LegacyCodes
    migrated_since: int
    reasons: dict[str, str]
    other_reason: str


def build_month(load: Load, period: Period, today: date, codes: MonthlyCodes) -> DataFrame:
    """Main movements, legacy movements and their common layout, from the snapshots that the period is routed to.

    The legacy inputs are opened only for periods that have them.
    """
    source = schedule.source_period(period, today)
    book = movements.main_book({n: load(n, source) for n in codes.networks}, codes.scope, period)
    main = movements.main_movements(book, period, codes.main)
    if period.value < consolidate.LEGACY_SINCE:
        return consolidate.consolidate_book(main, main, period, consolidate.main_layout(), {})
    older = legacy.legacy_movements(load("legacy", source), load("migrated", source), period, codes.legacy, codes.migrated_since)
    return consolidate.consolidate_book(main, older, period, consolidate.main_layout(), consolidate.legacy_layout(codes.reasons, codes.other_reason))


def monthly_run(load: Load, periods: list[Period], today: date, codes: MonthlyCodes, base: str, table: str = "book") -> list[int]:
    """Builds and writes each period; a rerun replaces the partition of its period and nothing else."""
    return schedule.backfill(periods, lambda p: build_month(load, p, today, codes), base, table)
