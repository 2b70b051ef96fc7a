"""Main channel of the monthly book: scope, movement flags, exposure and premium columns.

The steps keep the order of the original updates, because later ones overwrite earlier ones; each is a projection, so
the whole chain is one stage after the scan. Code lists are parameters: they belong to the user's book.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.dates import Period, days_incl
from gristmill.functions.missing import between_m, gt_m, in_m, le_m, lt_m, ne_m, notin_m
from gristmill.functions.numbers import greatest_m, least_m, share_or_full
from gristmill.operators.joins import enrich
from gristmill.operators.rules import code_label
from gristmill.operators.setops import union_by_name

# Coinsurance labels, in test order.
COINS_LABELS = {"lead": "APERITION", "accepted": "COASS. ACCEPTEE", "international": "ACCEPTATION INTERNATIONALE", "other": "AUTRES", "none": "SANS COASSURANCE"}


@dataclass(frozen=True)
class MainScope:
    """Which rows of the book are in scope. The capital job uses its own statuses and natures."""

    markets: list[str]
    segments: list[str]
    natures: list[str]
    excluded_statuses: list[str]
    excluded_risks: list[str] = field(default_factory=list)
    excluded_intermediaries: list[str] = field(default_factory=list)
    excluded_products: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class MovementCodes:
    active: str
    cancelled: str
    book_natures: list[str]
    site_nature: str
    temporary_nature: str
    excluded_nature: str
    excluded_sub_segment: str
    replaced_link: str
    replacing_link: str
    silent_reason: str
    silent_case: str
    long_term_risks: list[str]
    offer_flag: str
    coins_flag: str
    coins_lead: list[str]
    coins_accepted: list[str]
    coins_international: list[str]


def scope_main(df: DataFrame, scope: MainScope) -> DataFrame:
    return df.filter(
        notin_m(F.col("risk_class"), scope.excluded_risks)
        & notin_m(F.col("status"), scope.excluded_statuses)
        & notin_m(F.col("intermediary"), scope.excluded_intermediaries)
        & notin_m(F.col("product"), scope.excluded_products)
        & in_m(F.col("nature"), scope.natures) & in_m(F.col("market"), scope.markets) & in_m(F.col("segment"), scope.segments)
    )


def tagged_book(df: DataFrame, scope: MainScope, period: Period) -> DataFrame:
    """One table that already names the network of each row: filtered and stamped in one pass."""
    stamp = {"period": F.lit(period.value), "year_seen": F.lit(period.year), "month_seen": F.lit(period.month), "channel": F.lit("main")}
    return scope_main(df, scope).withColumns(stamp)


def main_book(networks: dict[str, DataFrame], scope: MainScope, period: Period) -> DataFrame:
    """A table per network: filtered, tagged and stacked."""
    return union_by_name(*[tagged_book(df.withColumn("network", F.lit(name)), scope, period) for name, df in networks.items()])


def coinsurance(df: DataFrame, codes: MovementCodes) -> DataFrame:
    shared = in_m(F.col("coins_flag"), [codes.coins_flag])
    kind = F.col("coins_code")
    label = (
        F.when(~shared, COINS_LABELS["none"])
        .when(in_m(kind, codes.coins_lead), COINS_LABELS["lead"])
        .when(in_m(kind, codes.coins_accepted), COINS_LABELS["accepted"])
        .when(in_m(kind, codes.coins_international), COINS_LABELS["international"])
        .otherwise(COINS_LABELS["other"])
    )
    return df.withColumns({
        "is_coinsured": shared.cast("int"), "coinsurance": label,
        "company_share": F.when(shared, F.col("share_pct") / 100).otherwise(F.lit(1.0)),
    })


def revision(df: DataFrame, labels: dict[str, str], revisable_flag: str) -> DataFrame:
    return df.withColumns({
        "is_revisable": in_m(F.col("revision_flag"), [revisable_flag]).cast("int"),
        "revision_criterion": code_label(F.col("revision_code"), labels),
    })


def turnover(df: DataFrame, specific: DataFrame, product: str) -> DataFrame:
    """Turnover of one product comes from the specialist table (three parts, all needed)."""
    keys = ["network", "product", "policy_no", "intermediary"]
    joined = enrich(df, specific, keys, ["turnover_own", "turnover_sub", "turnover_sales"])
    total = F.col("turnover_own") + F.col("turnover_sub") + F.col("turnover_sales")
    return joined.withColumn("turnover", F.when(F.col("product") == product, total).otherwise(F.col("turnover")))


def turnover_total(df: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    filled = df.withColumns({"turnover": F.coalesce("turnover", zero), "turnover_2": F.coalesce("turnover_2", zero)})
    return filled.withColumn("turnover_all", F.col("turnover") + F.col("turnover_2"))


def net_premium(df: DataFrame) -> DataFrame:
    return df.withColumn("premium_net", F.col("premium") * (1 - F.coalesce("ceded_pct", F.lit(0.0)) / 100))


def contract_flags(df: DataFrame, codes: MovementCodes) -> DataFrame:
    return df.withColumns({
        "is_long_term": (gt_m(F.col("duration"), 1) & in_m(F.col("risk_type"), codes.long_term_risks)).cast("int"),
        "is_temporary": in_m(F.col("nature"), [codes.temporary_nature]).cast("int"),
        "is_offer": in_m(F.col("offer_flag"), [codes.offer_flag]).cast("int"),
    })


def _linked(link: str, year: int | None) -> Column:
    """Any of the three links is of this type (and dated in ``year``)."""
    def one(i: int) -> Column:
        hit = in_m(F.col(f"link_type_{i}"), [link])
        return hit if year is None else hit & F.coalesce(F.year(f"link_date_{i}") == year, F.lit(False))

    return reduce(lambda a, b: a | b, [one(i) for i in (1, 2, 3)])


def _is(column: str, value: str) -> Column:
    return in_m(F.col(column), [value])


def movements_main(df: DataFrame, period: Period, codes: MovementCodes) -> DataFrame:
    """In force, new, cancelled, replaced and replacing counts with the premium of each."""
    start, end = period.year_start, period.last_day
    created, effective, processed = F.col("created"), F.col("effective_new"), F.col("processed_new")
    cancelled, handled = F.col("cancelled"), F.col("processed_cancel")
    in_force = (
        ne_m(F.col("sub_segment"), codes.excluded_sub_segment) & in_m(F.col("nature"), codes.book_natures)
        & ((_is("status", codes.active) & le_m(created, end)) | (_is("status", codes.cancelled) & gt_m(cancelled, end)))
    )
    new = (
        (between_m(start, effective, end) & between_m(start, processed, end)) | between_m(start, created, end)
        | (lt_m(F.year(effective), period.year) & between_m(start, processed, end))
    )
    gone = ne_m(F.col("nature"), codes.site_nature) & _is("status", codes.cancelled) & (
        between_m(start, cancelled, end) | (between_m(start, handled, end) & le_m(cancelled, end))
    )
    flagged = df.withColumns({"_in": in_force, "_new": new, "_gone": gone}).withColumns({
        "_replaced": F.col("_gone") & _linked(codes.replaced_link, period.year),
        "_replacing": F.col("_new") & _linked(codes.replacing_link, period.year),
    })
    final = {
        "in_force": F.col("_in"),
        "new": F.col("_new") & ~F.col("_replacing"),
        "cancelled": F.col("_gone") & ~F.col("_replaced"),
        "replaced": F.col("_replaced"),
        "replacing": F.col("_replacing"),
    }
    counts = {f"n_{name}": flag.cast("int") for name, flag in final.items()}
    amounts = {f"premium_{name}": F.when(flag, F.col("premium_net")).otherwise(F.lit(0.0)) for name, flag in final.items()}
    return flagged.withColumns({**counts, **amounts}).drop("_in", "_new", "_gone", "_replaced", "_replacing")


def anticipated(df: DataFrame, period: Period, codes: MovementCodes) -> DataFrame:
    end = period.last_day
    silent = _linked(codes.replaced_link, None) | _is("cancel_reason", codes.silent_reason) | _is("cancel_case", codes.silent_case)
    new = (gt_m(F.col("effective_new"), end) | gt_m(F.col("created"), end)) & ~_linked(codes.replacing_link, None)
    return df.withColumns({
        "n_new_anticipated": new.cast("int"),
        "n_cancelled_anticipated": (gt_m(F.col("cancelled"), end) & ~silent).cast("int"),
    })


def exposed_days(end: Column, start: Column, last_day, first_day) -> Column:
    """Days of ``[start, end]`` that fall in the window, never negative; a missing end means still running."""
    return greatest_m(F.lit(0), days_incl(least_m(end, F.lit(last_day)), greatest_m(start, F.lit(first_day))))


def exposure(df: DataFrame, period: Period, codes: MovementCodes) -> DataFrame:
    """Share of the year and of the rolling twelve months during which an eligible policy was on risk."""
    created, cancelled, end, back = F.col("created"), F.col("cancelled"), period.last_day, period.rolling_start
    active, gone = _is("status", codes.active), _is("status", codes.cancelled)
    running = in_m(F.col("nature"), codes.book_natures) & ((active & le_m(created, end)) | (gone & gt_m(cancelled, end)))
    ended_inside = F.coalesce((cancelled >= F.lit(back)) & (cancelled < F.lit(end)), F.lit(False))
    overlapping = (
        (le_m(created, end) & (cancelled.isNull() | ended_inside)) | (le_m(created, end) & gt_m(cancelled, end))
        | (gt_m(created, back) & le_m(created, end) & gt_m(cancelled, end))
    )
    eligible = running | ((active | gone) & overlapping & notin_m(F.col("nature"), [codes.excluded_nature]))
    year_days = (period.year_end - period.year_start).days + 1
    rolling_days = (end - back).days
    next_day = F.date_add(F.lit(back), 1)
    out = df.withColumns({
        "exposure_ytd": F.when(eligible, exposed_days(cancelled, created, end, period.year_start) / year_days).otherwise(F.lit(0.0)),
        "exposure_rolling": F.when(
            eligible,
            greatest_m(F.lit(0), days_incl(least_m(cancelled, F.lit(end)), greatest_m(created, next_day))) / rolling_days,
        ).otherwise(F.lit(0.0)),
        "exposure_start": F.when(eligible, greatest_m(created, F.lit(period.year_start))),
        "exposure_end": F.when(eligible, least_m(cancelled, F.lit(end))),
    })
    return blank_unexposed(out)


def blank_unexposed(df: DataFrame) -> DataFrame:
    """No exposure, no exposure dates."""
    exposed = F.col("exposure_ytd") != 0
    return df.withColumns({c: F.when(exposed, F.col(c)) for c in ("exposure_start", "exposure_end")})


def full_premium(df: DataFrame, codes: MovementCodes) -> DataFrame:
    """Premium at 100 %: grossed up for accepted coinsurance, as it is otherwise."""
    accepted = (F.col("is_coinsured") == 1) & in_m(F.col("coins_code"), codes.coins_accepted)
    grossed = F.col("premium") * 100 / share_or_full(F.col("share_pct"))
    return df.withColumn("premium_full", F.when(accepted, grossed).otherwise(F.col("premium")))


def main_movements(book: DataFrame, period: Period, codes: MovementCodes) -> DataFrame:
    """The per-row steps of the main channel in their order."""
    steps = net_premium(contract_flags(coinsurance(book, codes), codes))
    flagged = anticipated(exposure(movements_main(steps, period, codes), period, codes), period, codes)
    return full_premium(flagged, codes)


def book_totals(book: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Totals of the book without temporary contracts."""
    return book.filter("is_temporary = 0").groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
