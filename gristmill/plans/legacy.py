"""Legacy channel: lapse rules, movement flags with two date regimes, suspension and exposure."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.dates import Period
from gristmill.functions.missing import between_m, gt_m, in_m, le_m, lt_m, ne_m, notin_m
from gristmill.functions.numbers import greatest_m, least_m
from gristmill.functions.text import is_filled
from gristmill.operators.joins import flag_exists
from gristmill.plans.movements import blank_unexposed, exposed_days

EPOCH = date(1960, 1, 1)


@dataclass(frozen=True)
class LegacyCodes:
    active_state: str
    cancelled_state: str
    closed_states: list[str]
    temporary_duration: str
    tacit_duration: str
    single_durations: list[str]
    migrated_site: str
    temporary_products: list[str]
    unflagged_products: list[str]
    uncounted_products: list[str]
    month_products: list[str]
    replaced_reasons: list[str]
    screened_reasons: list[str]
    screened_sub_segment: str
    excluded_intermediaries: list[str]
    excluded_policies: list[str]


def scope_legacy(df: DataFrame, codes: LegacyCodes) -> DataFrame:
    temporary = in_m(F.col("duration_code"), [codes.temporary_duration]) & notin_m(F.col("product"), codes.temporary_products)
    site = F.col("site_state")
    kept_site = notin_m(site, [codes.migrated_site]) | in_m(F.col("state"), [codes.cancelled_state])
    return df.filter(
        notin_m(F.col("intermediary"), codes.excluded_intermediaries) & notin_m(F.col("policy"), codes.excluded_policies)
        & ~temporary & ne_m(F.col("end"), F.col("effective")) & kept_site
    )


def flag_migration(df: DataFrame, migrated: DataFrame, period: Period, since: int) -> DataFrame:
    """``not_migrated``: 0 for policies found in the migration table, from the period after ``since`` on."""
    if period.value > since:
        return flag_exists(df, migrated, ["policy"], "not_migrated", present=0)
    return df.withColumn("not_migrated", F.lit(1))


def legacy_dates(df: DataFrame, period: Period, codes: LegacyCodes) -> DataFrame:
    """Expiry repair and anticipated flags first, then the two rules that close a policy."""
    end_of_month = period.last_day
    lapse_before = date(period.year - 1, period.month, 1)
    repaired = df.withColumns({
        "expiry": F.when(gt_m(F.col("end"), F.col("expiry")) & in_m(F.col("state"), codes.closed_states), F.col("end")).otherwise(F.col("expiry")),
        "n_new_anticipated": gt_m(F.col("effective"), end_of_month).cast("int"),
        "n_cancelled_anticipated": gt_m(F.col("end"), end_of_month).cast("int"),
    })
    lapsed = (
        in_m(F.col("duration_code"), [codes.tacit_duration]) & F.col("final_end").isNull()
        & F.col("term").isNotNull() & lt_m(F.col("term"), lapse_before)
    )
    tacit = repaired.withColumn("_lapsed", lapsed).withColumns({
        "state": F.when(F.col("_lapsed"), codes.cancelled_state).otherwise(F.col("state")),
        "end": F.when(F.col("_lapsed"), F.col("term")).otherwise(F.col("end")),
        "cancelled": F.when(F.col("_lapsed"), F.col("term")).otherwise(F.col("cancelled")),
    })
    ended = F.col("final_end").isNotNull() & F.col("end").isNull()
    closed = tacit.withColumn("_ended", ended).withColumns({
        "state": F.when(F.col("_ended"), codes.cancelled_state).otherwise(F.col("state")),
        "end": F.when(F.col("_ended"), F.col("final_end")).otherwise(F.col("end")),
        "cancelled": F.when(F.col("_ended"), F.col("final_end")).otherwise(F.col("cancelled")),
    })
    return closed.drop("_lapsed", "_ended")


def movements_legacy(df: DataFrame, period: Period, codes: LegacyCodes) -> DataFrame:
    start, end = period.year_start, period.last_day
    effective, new, over, cancelled = F.col("effective"), F.col("new_date"), F.col("end"), F.col("cancelled")
    product, kept = F.col("product"), F.col("not_migrated") == 1
    by_month = in_m(product, codes.month_products)
    counted = in_m(F.col("state"), [codes.cancelled_state]) & notin_m(product, codes.uncounted_products) & kept

    def this_year_to_date(c):
        return F.coalesce((F.year(c) == period.year) & (F.month(c) <= period.month), F.lit(False))

    is_new = counted & (
        (by_month & this_year_to_date(new))
        | (~by_month & between_m(start, effective, end) & le_m(new, end))
        | (lt_m(effective, start) & between_m(start, new, end))
    )
    is_gone = counted & (
        (by_month & this_year_to_date(cancelled))
        | (~by_month & between_m(start, over, end) & le_m(cancelled, end))
        | (le_m(over, end) & between_m(start, cancelled, end))
    )
    open_ended = over.isNull() | gt_m(over, end) | gt_m(cancelled, end)
    alive = in_m(F.col("state"), [codes.active_state]) | (
        in_m(F.col("state"), [codes.cancelled_state]) & F.coalesce(over >= F.lit(end), F.lit(False))
    )
    in_force = kept & le_m(effective, end) & le_m(new, end) & open_ended & alive & notin_m(product, codes.unflagged_products)
    return df.withColumns({"n_new": is_new.cast("int"), "n_cancelled": is_gone.cast("int"), "n_in_force": in_force.cast("int")})


def suspension(df: DataFrame, period: Period) -> DataFrame:
    """Days of suspension inside the year."""
    start, end = period.year_start, period.last_day
    over, cancelled = F.col("end"), F.col("cancelled")
    touched = between_m(start, cancelled, end) | between_m(start, over, end)
    from_day = greatest_m(F.date_sub(F.lit(start), 1), F.date_sub(cancelled, 1))
    whole = between_m(EPOCH, cancelled, start) & F.coalesce(over >= F.lit(end), F.lit(False))
    days = (
        F.when(touched, F.date_diff(least_m(over, F.lit(end), F.col("expiry")), from_day))
        .when(whole, F.lit((end - start).days + 1)).otherwise(F.lit(0))
    )
    return df.withColumn("suspended_days", days)


def exposure_legacy(df: DataFrame, period: Period) -> DataFrame:
    start, end = period.year_start, period.last_day
    days = exposed_days(F.col("end"), F.col("effective"), end, start)
    out = df.withColumns({
        "exposure_ytd": days / ((period.year_end - start).days + 1),
        "exposure_rolling": days / (end - period.rolling_start).days,
        "exposure_start": greatest_m(F.col("effective"), F.lit(start)),
        "exposure_end": least_m(F.col("end"), F.lit(end)),
    })
    return blank_unexposed(out)


def adjust_legacy(df: DataFrame, codes: LegacyCodes) -> DataFrame:
    """Products outside the book, replacements and screened reasons no longer count."""
    outside = in_m(F.col("product"), codes.unflagged_products)
    replaced = is_filled(F.col("replaced_by")) & in_m(F.col("cancel_reason"), codes.replaced_reasons)
    screened = in_m(F.col("cancel_reason"), codes.screened_reasons)
    zero = F.lit(0)
    return df.withColumns({
        "n_in_force": F.when(outside, zero).otherwise(F.col("n_in_force")),
        "n_cancelled": F.when(outside | replaced | screened, zero).otherwise(F.col("n_cancelled")),
        "n_new": F.when(in_m(F.col("sub_segment"), [codes.screened_sub_segment]), zero).otherwise(F.col("n_new")),
    })


def legacy_movements(book: DataFrame, migrated: DataFrame, period: Period, codes: LegacyCodes, since: int) -> DataFrame:
    """The steps of the legacy channel in their order, with long-term flag and premiums per movement."""
    scoped = flag_migration(scope_legacy(book, codes), migrated, period, since)
    dated = legacy_dates(scoped, period, codes)
    flagged = adjust_legacy(exposure_legacy(suspension(movements_legacy(dated, period, codes), period), period), codes)
    long_term = notin_m(F.col("duration_code"), codes.single_durations) & is_filled(F.col("duration_code"))
    premiums = {
        f"premium_{name}": F.when(F.col(f"n_{name}") == 1, F.col("premium")).otherwise(F.lit(0.0))
        for name in ("in_force", "new", "cancelled")
    }
    return flagged.withColumns({"is_long_term": long_term.cast("int"), "company_share": F.col("share_pct") / 100, **premiums})
