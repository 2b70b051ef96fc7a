"""Monthly policy datamart on orders (as policies) and lineitem (as capital lines and premiums). All codes are made up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.dates import Period
from gristmill.operators.joins import enrich
from gristmill.operators.rules import MatchRule, Rule
from gristmill.plans import capital, consolidate, control, legacy, movements, premiums, segmentation
from gristmill.queries.base import Data, query

PERIOD = Period.of(199806)
START, END, BACK, YEAR_END = "DATE '1998-01-01'", "DATE '1998-06-30'", "DATE '1997-07-01'", "DATE '1998-12-31'"

SCOPE = movements.MainScope(
    markets=["A"], segments=["s1", "s2"], natures=["N1", "N2", "N3", "N4"], excluded_statuses=["4"], excluded_risks=["X"],
    excluded_intermediaries=["13", "27"], excluded_products=["5-LOW"],
)
CODES = movements.MovementCodes(
    active="1", cancelled="3", book_natures=["N1", "N2"], site_nature="N4", temporary_nature="N3", excluded_nature="N9", excluded_sub_segment="5",
    replaced_link="SB", replacing_link="BS", silent_reason="V", silent_case="9Q", long_term_risks=["QA"], offer_flag="O", coins_flag="1",
    coins_lead=["1", "2"], coins_accepted=["3", "7"], coins_international=["0"],
)
LEGACY = legacy.LegacyCodes(
    active_state="E", cancelled_state="R", closed_states=["X", "R"], temporary_duration="00", tacit_duration="01", single_durations=["00", "01"],
    migrated_site="MIG", temporary_products=["L00", "L01"], unflagged_products=["L00", "L01", "L02"], uncounted_products=["L02"],
    month_products=["1-URGENT", "2-HIGH"], replaced_reasons=["K1"], screened_reasons=["K2"], screened_sub_segment="5",
    excluded_intermediaries=["3"], excluded_policies=["17"],
)
MIGRATED_SINCE = 199712

_SCOPED = """(SELECT * FROM @policies p WHERE coalesce(risk_class <> 'X', true) AND status <> '4' AND intermediary NOT IN ('13', '27') AND product <> '5-LOW'
  AND nature IN ('N1', 'N2', 'N3', 'N4') AND market = 'A')"""


def cents(c: Column) -> Column:
    """Hundredths of a cent for comparison; the cut is moved off the values that computed amounts fall on."""
    return F.floor(c * 10000 + F.lit(0.37).cast("double")).cast("bigint")


def _le(c: str, d: str) -> str:
    return f"({c} IS NULL OR {c} <= {d})"


def _gt(c: str, d: str) -> str:
    return f"coalesce({c} > {d}, false)"


def _in(c: str, low: str = START, high: str = END) -> str:
    return f"coalesce({c} BETWEEN {low} AND {high}, false)"


def _link(code: str, dated: bool) -> str:
    tests = [
        f"coalesce(link_type_{i} = '{code}'" + (f" AND year(link_date_{i}) = 1998" if dated else "") + ", false)" for i in (1, 2, 3)
    ]
    return "(" + " OR ".join(tests) + ")"


_FLAGS = f"""f0 AS (SELECT *, premium * (1 - coalesce(ceded_pct, 0) / 100) AS premium_net,
    (sub_segment IS NULL OR sub_segment <> '5') AND coalesce(nature IN ('N1', 'N2'), false) AND ((status = '1' AND {_le('created', END)}) OR (status = '3' AND {_gt('cancelled', END)})) AS i,
    ({_in('effective_new')} AND {_in('processed_new')}) OR {_in('created')} OR ((effective_new IS NULL OR year(effective_new) < 1998) AND {_in('processed_new')}) AS n,
    (nature IS NULL OR nature <> 'N4') AND status = '3' AND ({_in('cancelled')} OR ({_in('processed_cancel')} AND {_le('cancelled', END)})) AS g FROM base),
  f1 AS (SELECT *, g AND {_link('SB', True)} AS rd, n AND {_link('BS', True)} AS rg FROM f0)"""
_COUNTS = "CAST(i AS INT) AS n_in_force, CAST(n AND NOT rg AS INT) AS n_new, CAST(g AND NOT rd AS INT) AS n_cancelled, CAST(rd AS INT) AS n_replaced, CAST(rg AS INT) AS n_replacing"


def book(d: Data) -> DataFrame:
    return movements.tagged_book(d.policies.filter(F.col("network").isin("1", "3")), SCOPE, PERIOD)


def main_flags(d: Data) -> DataFrame:
    return movements.main_movements(book(d), PERIOD, CODES)


# --- main channel ----------------------------------------------------------------------------------------------

@query("policy_main_book", f"SELECT policy_no, network, product, 199806 AS period, 'main' AS channel FROM {_SCOPED} b")
def policy_main_book(d: Data) -> DataFrame:
    parts = {n: d.policies.filter(F.col("network") == n).drop("network") for n in ("1", "3")}
    return movements.main_book(parts, SCOPE, PERIOD).select("policy_no", "network", "product", "period", "channel")


@query("policy_scope", f"SELECT policy_no, status, nature FROM {_SCOPED} b")
def policy_scope(d: Data) -> DataFrame:
    return movements.scope_main(d.policies, SCOPE).select("policy_no", "status", "nature")


@query("policy_coinsurance", """SELECT policy_no, CASE WHEN coins_flag = '1' THEN 1 ELSE 0 END AS is_coinsured, CASE WHEN coins_flag IS NULL OR coins_flag <> '1' THEN 'SANS COASSURANCE' WHEN coins_code IN ('1', '2') THEN 'APERITION'
  WHEN coins_code IN ('3', '7') THEN 'COASS. ACCEPTEE' WHEN coins_code = '0' THEN 'ACCEPTATION INTERNATIONALE' ELSE 'AUTRES' END AS coinsurance,
  CASE WHEN coins_flag = '1' THEN share_pct / 100 ELSE 1 END AS company_share FROM @policies p""")
def policy_coinsurance(d: Data) -> DataFrame:
    return movements.coinsurance(d.policies, CODES).select("policy_no", "is_coinsured", "coinsurance", "company_share")


@query("policy_revision", "SELECT policy_no, CASE WHEN revision_flag = '1' THEN 1 ELSE 0 END AS is_revisable, CASE revision_code WHEN '20' THEN 'manual' WHEN '41' THEN 'variable' WHEN '24' THEN 'at end' END AS revision_criterion FROM @policies p")
def policy_revision(d: Data) -> DataFrame:
    out = movements.revision(d.policies, {"20": "manual", "41": "variable", "24": "at end"}, "1")
    return out.select("policy_no", "is_revisable", "revision_criterion")


@query("policy_movements", f"""WITH base AS (SELECT * FROM {_SCOPED} b), {_FLAGS} SELECT policy_no, {_COUNTS}, CASE WHEN i THEN premium_net ELSE 0 END AS premium_in_force,
  CASE WHEN n AND NOT rg THEN premium_net ELSE 0 END AS premium_new, CASE WHEN g AND NOT rd THEN premium_net ELSE 0 END AS premium_cancelled FROM f1""")
def policy_movements(d: Data) -> DataFrame:
    names = [f"n_{x}" for x in ("in_force", "new", "cancelled", "replaced", "replacing")]
    return main_flags(d).select("policy_no", *names, "premium_in_force", "premium_new", "premium_cancelled")


@query("policy_anticipated", f"""SELECT policy_no, CAST(({_gt('effective_new', END)} OR {_gt('created', END)}) AND NOT {_link('BS', False)} AS INT) AS n_new_anticipated,
  CAST({_gt('cancelled', END)} AND NOT ({_link('SB', False)} OR cancel_reason = 'V' OR coalesce(cancel_case = '9Q', false)) AS INT) AS n_cancelled_anticipated FROM @policies p""")
def policy_anticipated(d: Data) -> DataFrame:
    return movements.anticipated(d.policies, PERIOD, CODES).select("policy_no", "n_new_anticipated", "n_cancelled_anticipated")


_ELIGIBLE = f"""((nature IN ('N1', 'N2') AND ((status = '1' AND {_le('created', END)}) OR (status = '3' AND {_gt('cancelled', END)})))
  OR (status IN ('1', '3') AND (({_le('created', END)} AND (cancelled IS NULL OR (cancelled >= {BACK} AND cancelled < {END}))) OR ({_le('created', END)} AND {_gt('cancelled', END)})
    OR ({_gt('created', BACK)} AND {_le('created', END)} AND {_gt('cancelled', END)})) AND nature <> 'N9'))"""


@query("policy_exposure", f"""SELECT policy_no, ytd AS exposure_ytd, CASE WHEN e THEN greatest(0, date_diff('day', greatest(created, {BACK} + 1), least(cancelled, {END})) + 1) / 364.0 ELSE 0 END AS exposure_rolling,
  CASE WHEN ytd <> 0 THEN CAST(greatest(created, {START}) AS STRING) END AS exposure_start, CASE WHEN ytd <> 0 THEN CAST(least(cancelled, {END}) AS STRING) END AS exposure_end
FROM (SELECT *, CASE WHEN e THEN greatest(0, date_diff('day', greatest(created, {START}), least(cancelled, {END})) + 1) / 365.0 ELSE 0 END AS ytd FROM (SELECT *, {_ELIGIBLE} AS e FROM @policies p) t) u""")
def policy_exposure(d: Data) -> DataFrame:
    out = movements.exposure(d.policies, PERIOD, CODES)
    return out.select(
        "policy_no", "exposure_ytd", "exposure_rolling", F.col("exposure_start").cast("string").alias("exposure_start"), F.col("exposure_end").cast("string").alias("exposure_end")
    )


@query("policy_premium_columns", """SELECT policy_no, premium * (1 - coalesce(ceded_pct, 0) / 100) AS premium_net,
  CASE WHEN coins_flag = '1' AND coins_code IN ('3', '7') THEN premium * 100 / CASE WHEN share_pct IS NULL OR share_pct = 0 THEN 100 ELSE share_pct END ELSE premium END AS premium_full FROM @policies p""")
def policy_premium_columns(d: Data) -> DataFrame:
    out = movements.full_premium(movements.net_premium(movements.coinsurance(d.policies, CODES)), CODES)
    return out.select("policy_no", "premium_net", "premium_full")


@query("policy_contract_flags", """SELECT policy_no, CASE WHEN duration > 1 AND risk_type = 'QA' THEN 1 ELSE 0 END AS is_long_term, CASE WHEN nature = 'N3' THEN 1 ELSE 0 END AS is_temporary,
  CASE WHEN offer_flag = 'O' THEN 1 ELSE 0 END AS is_offer FROM @policies p""")
def policy_contract_flags(d: Data) -> DataFrame:
    return movements.contract_flags(d.policies, CODES).select("policy_no", "is_long_term", "is_temporary", "is_offer")


_TURNOVER = """SELECT CASE l_orderkey % 2 WHEN 0 THEN '1' ELSE '3' END AS network, o_orderpriority AS product, CAST(l_orderkey AS STRING) AS policy_no, CAST(o_custkey % 50 AS STRING) AS intermediary,
  CAST(sum(l_quantity) AS DOUBLE) AS turnover_own, CAST(count(*) AS DOUBLE) AS turnover_sub, CASE WHEN l_orderkey % 4 <> 3 THEN CAST(max(l_linenumber) AS DOUBLE) END AS turnover_sales
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey WHERE o_orderpriority = '2-HIGH' GROUP BY l_orderkey, o_orderpriority, o_custkey"""


@query("policy_turnover", f"""SELECT policy_no, turnover, turnover_2, turnover + turnover_2 AS turnover_all FROM (SELECT p.policy_no, coalesce(CASE WHEN p.product = '2-HIGH' THEN turnover_own + turnover_sub + turnover_sales ELSE turnover END, 0) AS turnover,
  coalesce(turnover_2, 0) AS turnover_2 FROM @policies p LEFT JOIN ({_TURNOVER.format(lineitem='lineitem', orders='orders')}) t ON t.policy_no = p.policy_no AND t.network = p.network AND t.product = p.product AND t.intermediary = p.intermediary) u""")
def policy_turnover(d: Data) -> DataFrame:
    out = movements.turnover_total(movements.turnover(d.policies, d.sql(_TURNOVER), "2-HIGH"))
    return out.select("policy_no", "turnover", "turnover_2", "turnover_all")


@query("policy_book_totals", f"""WITH base AS (SELECT * FROM {_SCOPED} b), {_FLAGS} SELECT network, market, segment, CAST(sum(CAST(i AS INT)) AS BIGINT) AS n_in_force, CAST(sum(CAST(n AND NOT rg AS INT)) AS BIGINT) AS n_new,
  CAST(sum(CAST(g AND NOT rd AS INT)) AS BIGINT) AS n_cancelled, round(sum(CASE WHEN i THEN premium_net ELSE 0 END)) AS premium_in_force FROM f1 WHERE nature <> 'N3' GROUP BY 1, 2, 3""")
def policy_book_totals(d: Data) -> DataFrame:
    out = movements.book_totals(main_flags(d), ["network", "market", "segment"], ["n_in_force", "n_new", "n_cancelled", "premium_in_force"])
    return out.withColumn("premium_in_force", F.round("premium_in_force"))


# --- legacy channel --------------------------------------------------------------------------------------------

_L0 = f"""l0 AS (SELECT l.*, CASE WHEN c_custkey IS NOT NULL THEN 0 ELSE 1 END AS kept FROM @legacy l LEFT JOIN customer ON CAST(c_custkey AS STRING) = policy AND c_mktsegment = 'HOUSEHOLD'
  WHERE intermediary <> '3' AND policy <> '17' AND NOT (duration_code = '00' AND product NOT IN ('L00', 'L01')) AND "end" IS DISTINCT FROM effective AND (coalesce(site_state <> 'MIG', true) OR state = 'R'))"""
_L1 = f"""{_L0}, l1 AS (SELECT * REPLACE (CASE WHEN coalesce("end" > expiry, "end" IS NOT NULL) AND state IN ('X', 'R') THEN "end" ELSE expiry END AS expiry),
    CAST({_gt('effective', END)} AS INT) AS na, CAST({_gt('"end"', END)} AS INT) AS ca, duration_code = '01' AND final_end IS NULL AND term IS NOT NULL AND term < DATE '1997-06-01' AS lapsed FROM l0),
  l2 AS (SELECT * REPLACE (CASE WHEN lapsed THEN 'R' ELSE state END AS state, CASE WHEN lapsed THEN term ELSE "end" END AS "end", CASE WHEN lapsed THEN term ELSE cancelled END AS cancelled) FROM l1),
  l3 AS (SELECT * REPLACE (CASE WHEN final_end IS NOT NULL AND "end" IS NULL THEN 'R' ELSE state END AS state, coalesce("end", final_end) AS "end",
    CASE WHEN final_end IS NOT NULL AND "end" IS NULL THEN final_end ELSE cancelled END AS cancelled) FROM l2)"""
_MONTHLY = "product IN ('1-URGENT', '2-HIGH')"
_YTD = "coalesce(year({0}) = 1998 AND month({0}) <= 6, false)"
_L4 = f"""{_L1}, l4 AS (SELECT *, state = 'R' AND product <> 'L02' AND kept = 1 AND (({_MONTHLY} AND {_YTD.format('new_date')}) OR (NOT {_MONTHLY} AND {_in('effective')} AND {_le('new_date', END)})
      OR ((effective IS NULL OR effective < {START}) AND {_in('new_date')})) AS is_new,
    state = 'R' AND product <> 'L02' AND kept = 1 AND (({_MONTHLY} AND {_YTD.format('cancelled')}) OR (NOT {_MONTHLY} AND {_in('"end"')} AND {_le('cancelled', END)}) OR ({_le('"end"', END)} AND {_in('cancelled')})) AS gone,
    kept = 1 AND {_le('effective', END)} AND {_le('new_date', END)} AND ("end" IS NULL OR "end" > {END} OR {_gt('cancelled', END)}) AND (state = 'E' OR (state = 'R' AND coalesce("end" >= {END}, false)))
      AND product NOT IN ('L00', 'L01', 'L02') AS alive FROM l3)"""


def _migrated(d: Data) -> DataFrame:
    return d.customer.filter("c_mktsegment = 'HOUSEHOLD'").select(F.col("c_custkey").cast("string").alias("policy"))


def legacy_dated(d: Data) -> DataFrame:
    scoped = legacy.flag_migration(legacy.scope_legacy(d.legacy, LEGACY), _migrated(d), PERIOD, MIGRATED_SINCE)
    return legacy.legacy_dates(scoped, PERIOD, LEGACY)


def legacy_flags(d: Data) -> DataFrame:
    return legacy.legacy_movements(d.legacy, _migrated(d), PERIOD, LEGACY, MIGRATED_SINCE)


@query("legacy_scope_and_dates", f"""WITH {_L1} SELECT policy, state, CAST("end" AS STRING) AS ended, CAST(cancelled AS STRING) AS cancelled, CAST(expiry AS STRING) AS expiry, na AS n_new_anticipated, ca AS n_cancelled_anticipated, kept AS not_migrated FROM l3""")
def legacy_scope_and_dates(d: Data) -> DataFrame:
    return legacy_dated(d).select(
        "policy", "state", F.col("end").cast("string").alias("ended"), F.col("cancelled").cast("string").alias("cancelled"), F.col("expiry").cast("string").alias("expiry"),
        "n_new_anticipated", "n_cancelled_anticipated", "not_migrated",
    )


@query("legacy_movement_flags", f"WITH {_L4} SELECT policy, CAST(is_new AS INT) AS n_new, CAST(gone AS INT) AS n_cancelled, CAST(alive AS INT) AS n_in_force FROM l4")
def legacy_movement_flags(d: Data) -> DataFrame:
    return legacy.movements_legacy(legacy_dated(d), PERIOD, LEGACY).select("policy", "n_new", "n_cancelled", "n_in_force")


@query("legacy_suspension", f"""WITH {_L1} SELECT policy, CASE WHEN {_in('cancelled')} OR {_in('"end"')} THEN date_diff('day', greatest({START} - 1, cancelled - 1), least("end", {END}, expiry))
  WHEN coalesce(cancelled <= {START} AND "end" >= {END}, false) THEN 181 ELSE 0 END AS suspended_days FROM l3""")
def legacy_suspension(d: Data) -> DataFrame:
    return legacy.suspension(legacy_dated(d), PERIOD).select("policy", F.col("suspended_days").cast("bigint").alias("suspended_days"))


@query("legacy_exposure", f"""WITH {_L1} SELECT policy, days / 365.0 AS exposure_ytd, days / 364.0 AS exposure_rolling, CASE WHEN days > 0 THEN CAST(greatest(effective, {START}) AS STRING) END AS exposure_start
FROM (SELECT *, greatest(0, date_diff('day', greatest(effective, {START}), least("end", {END})) + 1) AS days FROM l3) t""")
def legacy_exposure(d: Data) -> DataFrame:
    out = legacy.exposure_legacy(legacy_dated(d), PERIOD)
    return out.select("policy", "exposure_ytd", "exposure_rolling", F.col("exposure_start").cast("string").alias("exposure_start"))


_L5 = f"""{_L4}, l5 AS (SELECT *, CASE WHEN product IN ('L00', 'L01', 'L02') THEN 0 ELSE CAST(alive AS INT) END AS n_in_force, CASE WHEN sub_segment = '5' THEN 0 ELSE CAST(is_new AS INT) END AS n_new,
  CASE WHEN product IN ('L00', 'L01', 'L02') OR (coalesce(replaced_by, '') <> '' AND cancel_reason = 'K1') OR cancel_reason = 'K2' THEN 0 ELSE CAST(gone AS INT) END AS n_cancelled FROM l4)"""


@query("legacy_adjusted", f"""WITH {_L5} SELECT policy, n_in_force, n_new, n_cancelled, CASE WHEN coalesce(trim(duration_code), '') NOT IN ('', '00', '01') THEN 1 ELSE 0 END AS is_long_term,
  CASE WHEN n_in_force = 1 THEN premium ELSE 0 END AS premium_in_force FROM l5""")
def legacy_adjusted(d: Data) -> DataFrame:
    return legacy_flags(d).select("policy", "n_in_force", "n_new", "n_cancelled", "is_long_term", "premium_in_force")


# --- consolidation ---------------------------------------------------------------------------------------------

_REASONS = {"Y1": "A", "Y2": "L", "Y3": ""}


def both_channels(d: Data) -> DataFrame:
    period = Period.of(201806)
    main = movements.main_movements(book(d), PERIOD, CODES)
    return consolidate.consolidate_book(main, legacy_flags(d), period, consolidate.main_layout(), consolidate.legacy_layout(_REASONS, "X"))


@query("book_consolidated", f"""WITH base AS (SELECT * FROM {_SCOPED} b), {_FLAGS}, {_L5} SELECT 'main' AS channel, policy_no, network, cancel_reason, CAST(substr(anniversary_mmdd, 1, 2) AS INT) AS due_month, CAST(substr(anniversary_mmdd, 3, 2) AS INT) AS due_day,
  CAST(i AS INT) AS n_in_force, CAST(n AND NOT rg AS INT) AS n_new, CAST(rd AS INT) AS n_replaced FROM f1
UNION ALL SELECT 'legacy', policy, '3', CASE cancel_origin WHEN 'Y1' THEN 'A' WHEN 'Y2' THEN 'L' WHEN 'Y3' THEN '' ELSE 'X' END, CAST(month(anniversary) AS INT), CAST(day(anniversary) AS INT), n_in_force, n_new, 0 FROM l5""")
def book_consolidated(d: Data) -> DataFrame:
    return both_channels(d).select("channel", "policy_no", "network", "cancel_reason", "due_month", "due_day", "n_in_force", "n_new", "n_replaced")


@query("book_before_legacy", f"SELECT count(*) AS n_rows FROM {_SCOPED} b")
def book_before_legacy(d: Data) -> DataFrame:
    """A period older than the legacy feed holds the main channel alone."""
    main = movements.main_movements(book(d), PERIOD, CODES)
    out = consolidate.consolidate_book(main, legacy_flags(d), PERIOD, consolidate.main_layout(), consolidate.legacy_layout(_REASONS, "X"))
    return out.agg(F.count("*").alias("n_rows"))


_RISK = """SELECT CAST(l_orderkey AS STRING) AS policy_no, upper(strftime(min(l_shipdate), '%d%b%Y')) || ':00:00:00' AS opened, CASE WHEN l_orderkey % 2 = 0 THEN upper(strftime(max(l_shipdate), '%d%b%Y')) || ':00:00:00' END AS finished,
  CASE WHEN l_orderkey % 5 = 0 THEN ' ' ELSE 'works ' || min(l_returnflag) END AS nature_text FROM lineitem WHERE l_linenumber {} GROUP BY l_orderkey"""


def _risk(d: Data, lines) -> DataFrame:
    def stamp(c):
        return F.concat(F.upper(F.date_format(c, "ddMMMyyyy")), F.lit(":00:00:00"))

    key = F.col("l_orderkey")
    per_policy = d.lineitem.filter(lines).groupBy("l_orderkey").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"), F.min("l_returnflag").alias("r"))
    raw = per_policy.select(
        key.cast("string").alias("policy_no"), stamp("a").alias("opened"), F.when(key % 2 == 0, stamp("b")).alias("finished"),
        F.when(key % 5 == 0, " ").otherwise(F.concat(F.lit("works "), "r")).alias("nature_text"),
    )
    return consolidate.risk_source(raw, ["opened", "finished"])


@query("book_risk_fill", f"""SELECT p.policy_no, CAST(strptime(coalesce(a.opened, b.opened), '%d%b%Y:%H:%M:%S')::DATE AS STRING) AS opened, coalesce(nullif(trim(work_text), ''), nullif(trim(a.nature_text), ''), nullif(trim(b.nature_text), '')) AS work_text,
  CAST(strptime(coalesce(a.finished, b.finished), '%d%b%Y:%H:%M:%S')::DATE AS STRING) AS received FROM @policies p LEFT JOIN ({_RISK.format('<= 2')}) a ON a.policy_no = p.policy_no LEFT JOIN ({_RISK.format('> 2')}) b ON b.policy_no = p.policy_no""")
def book_risk_fill(d: Data) -> DataFrame:
    gaps = d.policies.select("policy_no", "work_text", *[F.lit(None).cast("date").alias(c) for c in ("opened", "received", "finished")])
    sources = [_risk(d, "l_linenumber <= 2"), _risk(d, "l_linenumber > 2")]
    columns = {"opened": "opened", "finished": "finished", "work_text": "nature_text"}
    out = consolidate.risk_fill(gaps, [], sources, PERIOD, columns, completed=("received", "finished"))
    return out.select("policy_no", "work_text", *[F.col(c).cast("string").alias(c) for c in ("opened", "received")])


@query("book_client_details", """SELECT p.policy_no, coalesce(a.v, b.v) AS company_no FROM @policies p LEFT JOIN (SELECT CAST(c_custkey AS STRING) AS k, c_mktsegment AS v FROM customer WHERE c_mktsegment <> 'MACHINERY') a ON a.k = client_no
LEFT JOIN (SELECT CAST(s_suppkey AS STRING) AS k, s_name AS v FROM supplier) b ON b.k = client_no""")
def book_client_details(d: Data) -> DataFrame:
    first = d.customer.filter("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").cast("string").alias("client_no"), F.col("c_mktsegment").alias("company_no"))
    third = d.supplier.select(F.col("s_suppkey").cast("string").alias("client_no"), F.col("s_name").alias("company_no"))
    return consolidate.client_details(d.policies, first, third, ["company_no"]).select("policy_no", "company_no")


@query("book_destination", """SELECT policy_no, CASE WHEN product = '2-HIGH' AND coalesce(known, '') = '' THEN CASE WHEN contains(upper(destination_text), 'HOUSE') OR contains(upper(work_text), 'COTTAGE') OR destination_text IN ('41') THEN 'Home' ELSE 'Other' END ELSE known END AS destination
FROM @policies p LEFT JOIN (SELECT CAST(c_custkey AS STRING) AS k, c_mktsegment AS known FROM customer WHERE c_mktsegment = 'FURNITURE') c ON k = policy_no""")
def book_destination(d: Data) -> DataFrame:
    known = d.customer.filter("c_mktsegment = 'FURNITURE'").select(F.col("c_custkey").cast("string").alias("policy_no"), F.col("c_mktsegment").alias("destination"))
    rows = d.policies.withColumn("segment_2", F.col("product"))
    out = consolidate.destination(
        rows, known, "2-HIGH", {"destination_text": ["HOUSE"], "work_text": ["COTTAGE"]}, ("destination_text", ["41"]), "Home", "Other"
    )
    return out.select("policy_no", "destination")


DESTINATIONS = [Rule("contains", "HOUSE", "HOUSE"), Rule("contains", "DESK", "OFFICE"), Rule("regex", "DEP+OT", "STORE"), Rule("codes", ("41",), "HOUSE")]
_GRADED = """(SELECT DISTINCT c_nationkey AS nk, year(o_orderdate) * 100 + 1 AS period FROM {orders} JOIN {customer} ON c_custkey = o_custkey
  WHERE o_orderstatus <> 'P')"""
_GRADED_SQL = _GRADED.format(orders="orders", customer="customer")


def _grades(d: Data) -> DataFrame:
    """Dated grade snapshots: one per year for the nations with orders in that year, with gaps."""
    pairs = d.sql(f"SELECT * FROM {_GRADED} g")
    grades = [((F.col("nk") + i + F.col("period")) % 7).alias(h) for i, h in enumerate(consolidate.HAZARDS)]
    return pairs.select(F.col("nk").cast("string").alias("sector_code"), "period", *grades)


@query("book_activity_codes", f"""WITH g AS {_GRADED_SQL}, c0 AS (SELECT p.*, CASE WHEN market = 'A' THEN coalesce(a.v, b.v) END AS s0, CASE WHEN market = 'A' THEN CASE WHEN a.v IS NOT NULL THEN 'NATIVE' WHEN b.v IS NOT NULL THEN 'CLIENT' END END AS o0
    FROM @policies p LEFT JOIN (SELECT CAST(n_nationkey AS STRING) AS k, CAST(n_regionkey AS STRING) AS v FROM nation) a ON a.k = p.activity LEFT JOIN (SELECT CAST(c_custkey AS STRING) AS k, CAST(c_nationkey AS STRING) AS v FROM customer WHERE c_mktsegment = 'FURNITURE') b ON b.k = p.client_no),
  c1 AS (SELECT *, CASE WHEN market = 'A' AND nature = 'N4' THEN CASE WHEN product = '3-MEDIUM' AND s0 IS NOT NULL THEN NULL WHEN product = '1-URGENT' THEN 'SALE' WHEN contains(upper(destination_text), 'HOUSE') THEN 'HOUSE'
      WHEN contains(upper(destination_text), 'DESK') THEN 'OFFICE' WHEN regexp_matches(upper(destination_text), 'DEP+OT') THEN 'STORE' WHEN destination_text = '41' THEN 'HOUSE' WHEN s0 IS NULL THEN 'OTHER' END END AS dc FROM c0),
  c2 AS (SELECT *, CASE WHEN market = 'A' AND nature = 'N1' AND CAST(activity AS INT) < 25 THEN CAST((CAST(activity AS INT) * 3) % 25 AS STRING) END AS rc,
      CASE WHEN market = 'A' AND nature = 'N4' THEN CASE dc WHEN 'HOUSE' THEN '11' WHEN 'OFFICE' THEN '12' WHEN 'STORE' THEN '13' WHEN 'SALE' THEN '14' END END AS sc FROM c1)
SELECT policy_no, coalesce(rc, sc, s0) AS sector_code, CASE WHEN rc IS NOT NULL THEN 'ACTIVITY' WHEN sc IS NOT NULL THEN 'DESTINATION' ELSE o0 END AS sector_origin, dc AS destination_class,
  CASE WHEN rc IS NOT NULL THEN 'i' || activity WHEN sc IS NOT NULL THEN 'd' || dc ELSE product END AS industry_code, CAST((nk + period) % 7 AS INT) AS hazard_fire, CAST((nk + 6 + period) % 7 AS INT) AS hazard_damage
FROM c2 LEFT JOIN (SELECT * FROM g WHERE period = (SELECT max(period) FROM g WHERE period <= 199806)) g ON CAST(nk AS STRING) = coalesce(rc, sc, s0)""")
def book_activity_codes(d: Data) -> DataFrame:
    key = F.col("n_nationkey")
    native = d.nation.select(key.cast("string").alias("k"), F.col("n_regionkey").cast("string").alias("v"))
    client = d.customer.filter("c_mktsegment = 'FURNITURE'").select(F.col("c_custkey").cast("string").alias("k"), F.col("c_nationkey").cast("string").alias("v"))
    running = d.nation.select(
        key.cast("string").alias("activity"), (key * 3 % 25).cast("string").alias("sector_code"), F.concat(F.lit("i"), key.cast("string")).alias("industry_code")
    )
    kinds = F.array(*[F.struct(F.lit(c).alias("destination_class"), F.lit(s).alias("sector_code")) for c, s in (("HOUSE", "11"), ("OFFICE", "12"), ("STORE", "13"), ("SALE", "14"))])
    site = d.region.filter("r_regionkey = 0").select(F.inline(kinds)).withColumn("industry_code", F.concat(F.lit("d"), "destination_class"))
    out = consolidate.activity_codes(
        d.policies.withColumn("industry_code", F.col("product")), running, site, [(native, {"activity": "k"}, "v", "NATIVE"), (client, {"client_no": "k"}, "v", "CLIENT")],
        _grades(d), PERIOD, ["A"], "N1", "N4", DESTINATIONS, "OTHER", {"1-URGENT": "SALE"}, ["3-MEDIUM"],
    )
    return out.select("policy_no", "sector_code", "sector_origin", "destination_class", "industry_code", "hazard_fire", "hazard_damage")


# --- capital ---------------------------------------------------------------------------------------------------

SLOTS = 7
_LIMIT, _KEPT = ["GLOBAL LIMIT"], ["MAX LOSS KEPT"]
MEASURES = [
    capital.Measure("limit_all", _LIMIT, amount="indexed"), capital.Measure("loss_kept", _KEPT, amount="indexed"),
    capital.Measure("direct_risk", ["DIRECT RISK"], amount="indexed", not_exactly=("MAX LOSS DIRECT RISK",)),
    capital.Measure("income_loss", ["LOSS OF INCOME"], seed=0.0), capital.Measure("loss_direct", ["MAX LOSS DIRECT RISK"], mode="last", seed=0.0),
    capital.Measure("loss_income", ["NO SUCH LABEL"], mode="last", seed=0.0), capital.Measure("loss_all", _KEPT, seed=0.0),
]


_SLOT_LABELS = {
    1: "MAX LOSS KEPT", 2: "DIRECT RISK", 3: "MAX LOSS DIRECT RISK", 4: "LOSS OF INCOME", 5: "GLOBAL LIMIT B", 6: None, 7: "GLOBAL LIMIT A",
}


def slots(d: Data) -> DataFrame:
    """Policies with their repeated groups, packed from numbered columns as in a real book.

    The columns come from one aggregate over the lines. It has a fixed number of numeric slots, so it hashes without
    sorting and merges on the map side however many lines a policy has.
    """
    line, part = F.col("l_linenumber"), F.col("l_partkey")
    sums = []
    for i in range(1, SLOTS + 1):
        sums += [
            F.max(F.when((line == i) & (part % 10 != 0), F.col("l_extendedprice"))).alias(f"amount{i}"),
            F.max(F.when(line == i, part)).alias(f"part{i}"), F.max(F.when(line == i, F.col("l_discount"))).alias(f"discount{i}"),
        ]
    wide = d.lineitem.groupBy("l_orderkey").agg(*sums)
    named = {}
    for i, label in _SLOT_LABELS.items():
        kind = F.col(f"part{i}") % 4
        named[f"label{i}"] = F.when(F.col(f"part{i}").isNotNull(), F.lit(label))
        named[f"nature{i}"] = F.when(kind == 1, "01").when(kind == 2, "02").when(kind == 3, "11")
        named[f"coef{i}"] = F.col(f"discount{i}") + 1
    book = wide.withColumns({**named, "policy_no": F.col("l_orderkey").cast("string")})
    return book.select("policy_no", capital.groups_column("label", "amount", "nature", "coef", SLOTS).alias("groups"))


def with_groups(d: Data) -> DataFrame:
    base = d.policies.select("policy_no", "share_pct", "anniversary_mmdd", F.col("created").alias("effect_date"))
    return base.join(slots(d), "policy_no")


@query("capital_last_group", """SELECT policy_no, coalesce(CASE WHEN n1 > 0 THEN v1 ELSE 0 END, -1) AS limit_all, coalesce(CASE WHEN n2 > 0 THEN v2 ELSE 0 END, -1) AS loss_kept, coalesce(CASE WHEN n3 > 0 THEN v3 ELSE 0 END, -1) AS direct_risk
FROM (SELECT policy_no, count(*) FILTER (contains(label, 'GLOBAL LIMIT')) AS n1, last(amount ORDER BY pos) FILTER (contains(label, 'GLOBAL LIMIT')) AS v1, count(*) FILTER (label = 'MAX LOSS KEPT') AS n2,
  last(amount ORDER BY pos) FILTER (label = 'MAX LOSS KEPT') AS v2, count(*) FILTER (label = 'DIRECT RISK') AS n3, last(amount ORDER BY pos) FILTER (label = 'DIRECT RISK') AS v3
  FROM @group_rows g GROUP BY 1) t""")
def capital_last_group(d: Data) -> DataFrame:
    measures = [capital.Measure(m.name, m.labels, not_exactly=m.not_exactly) for m in MEASURES[:3]]
    out = capital.capital_last(slots(d), measures)
    return out.select("policy_no", *[F.coalesce(m.name, F.lit(-1.0)).alias(m.name) for m in measures])


_INDEXED = """ix AS (SELECT g.policy_no, g.pos, g.label, g.amount, g.share_pct, g.amount * coalesce(CASE WHEN early THEN 1 ELSE
    CASE WHEN starts_with(coalesce(g.nature, ''), '0') THEN n.index_value ELSE 1 END / nullif(CASE WHEN starts_with(coalesce(g.nature, ''), '0') THEN t.index_value ELSE 1 END, 0) END, 1) AS indexed
  FROM (SELECT g.*, p.share_pct, p.created, p.ann, coalesce(p.ann < p.created, false) OR (p.ann IS NULL AND p.created IS NOT NULL) AS early FROM @group_rows g JOIN (SELECT *, CASE WHEN d > DATE '1998-06-30' THEN try_cast('1997-' || md AS DATE) ELSE d END AS ann
      FROM (SELECT *, substr(anniversary_mmdd, 1, 2) || '-' || substr(anniversary_mmdd, 3, 2) AS md, try_cast('1998-' || substr(anniversary_mmdd, 1, 2) || '-' || substr(anniversary_mmdd, 3, 2) AS DATE) AS d FROM @policies p) q) p ON p.policy_no = g.policy_no) g
  LEFT JOIN @index_values n ON n.index_date = ann AND n.nature = g.nature LEFT JOIN @index_values t ON t.index_date = created AND t.nature = g.nature)"""


@query("capital_indexed_groups", f"WITH {_INDEXED} SELECT policy_no, pos, CAST(floor(indexed * 10000 + 0.37) AS BIGINT) AS indexed FROM ix WHERE indexed IS NOT NULL")
def capital_indexed_groups(d: Data) -> DataFrame:
    out = capital.index_amounts(with_groups(d), d.index_values, PERIOD.last_day)
    rows = out.select("policy_no", F.inline("groups")).filter("indexed IS NOT NULL")
    return rows.select("policy_no", "pos", cents(F.col("indexed")).alias("indexed"))


@query("capital_largest_group", f"""WITH {_INDEXED}, m AS (SELECT policy_no, any_value(CASE WHEN share_pct IS NULL OR share_pct = 0 THEN 100 ELSE share_pct END) AS sh,
    max(indexed) FILTER (contains(label, 'GLOBAL LIMIT')) AS a, max(indexed) FILTER (label = 'MAX LOSS KEPT') AS b, max(indexed) FILTER (label = 'DIRECT RISK') AS c,
    greatest(0, max(amount) FILTER (label = 'LOSS OF INCOME')) AS e, greatest(0, max(amount) FILTER (label = 'MAX LOSS KEPT')) AS f FROM ix GROUP BY 1)
SELECT policy_no, CAST(floor(a * 100 / sh * 10000 + 0.37) AS BIGINT) AS limit_all, CAST(floor(b * 100 / sh * 10000 + 0.37) AS BIGINT) AS loss_kept, CAST(floor(c * 100 / sh * 10000 + 0.37) AS BIGINT) AS direct_risk, CAST(floor(e * 100 / sh * 10000 + 0.37) AS BIGINT) AS income_loss, CAST(floor(greatest(a * 100 / sh, b * 100 / sh) * 10000 + 0.37) AS BIGINT) AS top_limit FROM m""")
def capital_largest_group(d: Data) -> DataFrame:
    indexed = capital.index_amounts(with_groups(d), d.index_values, PERIOD.last_day)
    out = capital.capital_max(indexed, MEASURES, {"loss_all": ("loss_all", ["loss_direct", "loss_income"])}, {"top_limit": ["limit_all", "loss_kept"]})
    return out.select("policy_no", *[cents(F.col(c)).alias(c) for c in ("limit_all", "loss_kept", "direct_risk", "income_loss", "top_limit")])


_LEGACY_SUMS = """SELECT policy, product, CAST(sum(CASE WHEN kind = 'A' AND branch IN ('O', 'F') THEN coalesce(amount_full, 0) ELSE 0 END) AS DOUBLE) AS limit_full, CAST(sum(CASE WHEN kind = 'A' AND branch IN ('O', 'F') THEN amount_company ELSE 0 END) AS DOUBLE) AS limit_company,
  CAST(sum(CASE WHEN kind = 'R' AND branch IN ('O', 'F') THEN coalesce(amount_full, 0) ELSE 0 END) AS DOUBLE) AS loss_full FROM @capital_lines l GROUP BY 1, 2"""


def _legacy_capital(d: Data) -> DataFrame:
    return capital.legacy_capital(d.capital_lines, {"limit": "A", "loss": "R"}, ["O", "F"], ["policy", "product"])


@query("capital_legacy_lines", _LEGACY_SUMS)
def capital_legacy_lines(d: Data) -> DataFrame:
    return _legacy_capital(d).select("policy", "product", *[F.col(c).cast("double").alias(c) for c in ("limit_full", "limit_company", "loss_full")])


@query("capital_fire_lines", """SELECT policy, product, CAST(sum(loss) AS DOUBLE) AS loss_full, CAST(sum(direct) AS DOUBLE) AS direct_full, CAST(sum(direct + loss) AS DOUBLE) AS insured_full FROM @capital_lines l GROUP BY 1, 2""")
def capital_fire_lines(d: Data) -> DataFrame:
    out = capital.fire_capital(d.capital_lines, ["policy", "product"])
    return out.select("policy", "product", *[F.col(c).cast("double").alias(c) for c in ("loss_full", "direct_full", "insured_full")])


@query("capital_consolidated", f"""WITH {_INDEXED} SELECT 'main' AS channel, policy_no, '1' AS network, CAST(floor(max(indexed) FILTER (contains(label, 'GLOBAL LIMIT')) * 10000 + 0.37) AS BIGINT) AS limit_amount FROM ix GROUP BY 1, 2, 3
UNION ALL SELECT 'legacy', policy, '3', CAST(floor(limit_full * 10000 + 0.37) AS BIGINT) FROM ({_LEGACY_SUMS}) l""")
def capital_consolidated(d: Data) -> DataFrame:
    main = capital.capital(capital.index_amounts(with_groups(d), d.index_values, PERIOD.last_day), MEASURES[:1])
    out = capital.consolidate_capital(
        main, _legacy_capital(d), {"policy_no": "policy_no", "network": F.lit("1"), "limit_amount": cents(F.col("limit_all"))},
        {"policy_no": "policy", "limit_amount": cents(F.col("limit_full").cast("double"))},
    )
    return out.select("channel", "policy_no", "network", "limit_amount")


# --- premiums --------------------------------------------------------------------------------------------------

PREMIUM_SCOPE = premiums.PremiumScope(
    markets=["A"], networks={"1": ["DA", "DP"], "3": ["BK"]}, excluded_intermediaries=["13"], excluded_products=["5-LOW"], excluded_guarantees=["GO103"],
    excluded_categories=["707"], excluded_pairs=[{"intermediary": ["7"], "product": ["1-URGENT"]}],
)
_PREMIUMS = """pm AS (SELECT *, CASE WHEN level IN ('DA', 'DP') THEN '1' WHEN level = 'BK' THEN '3' END AS network FROM @premium_detail d WHERE market = 'A' AND accounting_period <= '199806' AND intermediary <> '13' AND product <> '5-LOW'
    AND guarantee <> 'GO103' AND category <> '707' AND NOT (intermediary = '7' AND product = '1-URGENT'))"""


@query("premium_scope", f"WITH {_PREMIUMS} SELECT network, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS amount FROM pm GROUP BY 1")
def premium_scope(d: Data) -> DataFrame:
    scoped = premiums.scope_premium(d.premium_detail, PERIOD, PREMIUM_SCOPE).withColumn("network", premiums.network_of(F.col("level"), PREMIUM_SCOPE.networks))
    return scoped.groupBy("network").agg(F.count("*").alias("n_rows"), F.sum("amount").cast("double").alias("amount"))


@query("premium_all_and_current", f"""WITH {_PREMIUMS} SELECT network, policy_no, product, CAST(sum(amount) AS DOUBLE) AS premium_all, CAST(sum(amount) FILTER (trim(attached_year) >= '1998') AS DOUBLE) AS premium_current FROM pm GROUP BY 1, 2, 3""")
def premium_all_and_current(d: Data) -> DataFrame:
    scoped = premiums.scope_premium(d.premium_detail, PERIOD, PREMIUM_SCOPE).withColumn("network", premiums.network_of(F.col("level"), PREMIUM_SCOPE.networks))
    out = premiums.premiums(scoped, 1998, ["network", "policy_no", "product"])
    return out.select("network", "policy_no", "product", *[F.col(c).cast("double").alias(c) for c in ("premium_all", "premium_current")])


_BY_GUARANTEE = f"""{_PREMIUMS}, bg AS (SELECT pm.network, policy_no, pm.product, intermediary, substr(guarantee, 3, 5) AS guarantee_short, s.segment, category, sum(amount) AS premium_all,
    sum(amount) FILTER (trim(attached_year) >= '1998') AS premium_current, sum(commission) AS commission_all FROM pm JOIN @segments s ON s.product = pm.product AND s.network = pm.network WHERE s.market = 'A' GROUP BY ALL)"""


def _premium_job(d: Data) -> dict[str, DataFrame]:
    return premiums.premium_job(d.premium_detail, d.segments, PERIOD, PREMIUM_SCOPE)


@query("premium_by_guarantee", f"WITH {_BY_GUARANTEE} SELECT network, policy_no, product, guarantee_short, segment, category, CAST(premium_all AS DOUBLE) AS premium_all, CAST(premium_current AS DOUBLE) AS premium_current FROM bg")
def premium_by_guarantee(d: Data) -> DataFrame:
    out = _premium_job(d)["by_guarantee"]
    return out.select("network", "policy_no", "product", "guarantee_short", "segment", "category", *[F.col(c).cast("double").alias(c) for c in ("premium_all", "premium_current")])


@query("premium_by_policy", f"WITH {_BY_GUARANTEE} SELECT network, policy_no, segment, CAST(sum(premium_all) AS DOUBLE) AS premium_all, CAST(sum(premium_current) AS DOUBLE) AS premium_current, CAST(sum(commission_all) AS DOUBLE) AS commission_all FROM bg GROUP BY network, policy_no, segment, intermediary, product")
def premium_by_policy(d: Data) -> DataFrame:
    out = _premium_job(d)["by_policy"]
    return out.select("network", "policy_no", "segment", *[F.col(c).cast("double").alias(c) for c in premiums.MEASURES])


# --- controls --------------------------------------------------------------------------------------------------

_SHEET = """SELECT o_orderpriority AS line, position, CAST(total / 1000000 AS DOUBLE) AS premium_all, CAST(total / 2000000 AS DOUBLE) AS premium_current FROM (
  SELECT o_orderpriority, extract(year FROM o_orderdate) AS position, CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18, 2)))) AS DOUBLE) AS total FROM {orders} GROUP BY 1, 2) t"""
_FIN = f"""sh AS ({_SHEET.format(orders='orders')}), fin AS (SELECT line, 199806 AS period, CASE WHEN position = max(position) OVER w THEN NULL WHEN position = min(position) OVER w THEN '1' ELSE '3' END AS network,
    CASE line WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'A' END AS market, CASE line WHEN '1-URGENT' THEN 'g1' WHEN '2-HIGH' THEN 'g2' END AS segment,
    round(premium_all * 1000000) AS premium_all, round(premium_current * 1000000) AS premium_current FROM sh WINDOW w AS (PARTITION BY line))"""


def _finance(d: Data) -> DataFrame:
    return control.finance_premiums(d.sql(_SHEET), {"1-URGENT": ("A", "g1"), "2-HIGH": ("A", "g2")}, 199806)


@query("control_finance_lines", f"WITH {_FIN} SELECT period, network, market, segment, premium_all, premium_current FROM fin WHERE network IS NOT NULL AND market IS NOT NULL")
def control_finance_lines(d: Data) -> DataFrame:
    return _finance(d)


@query("control_premium_gaps", f"""WITH {_BY_GUARANTEE}, {_FIN}, f AS (SELECT network, market, segment, min(premium_all) AS premium_all FROM fin WHERE network IS NOT NULL AND market IS NOT NULL GROUP BY 1, 2, 3),
  c AS (SELECT network, segment, round(CAST(sum(premium_all) AS DOUBLE)) AS premium_all_cube FROM bg GROUP BY 1, 2)
SELECT c.network, c.segment, premium_all_cube, premium_all - premium_all_cube AS gap_premium_all FROM c LEFT JOIN f ON f.network = c.network AND f.segment = c.segment""")
def control_premium_gaps(d: Data) -> DataFrame:
    finance = _finance(d).groupBy("period", *control.CELL).agg(F.min("premium_all").alias("premium_all"), F.min("premium_current").alias("premium_current"))
    cube = _premium_job(d)["by_guarantee"]
    amounts = cube.withColumns({c: F.col(c).cast("decimal(38,2)") for c in ("premium_all", "premium_current")})
    out = control.reconcile_premiums(amounts, finance)
    return out.select("network", "segment", *[F.col(c).cast("double").alias(c) for c in ("premium_all_cube", "gap_premium_all")])


_CONTROL = """SELECT CASE o_orderkey % 2 WHEN 0 THEN '1' ELSE '3' END AS network, CASE o_custkey % 5 WHEN 0 THEN 'B' ELSE 'A' END AS market, CASE o_custkey % 4 WHEN 0 THEN 's2' ELSE 's1' END AS segment,
  count(*) AS n_in_force_ref, CAST(0 AS BIGINT) AS n_new_ref, CAST(5 AS BIGINT) AS n_cancelled_ref, CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18, 2)))) AS DOUBLE) AS premium_in_force_ref,
  CAST(1000 AS DOUBLE) AS premium_new_ref, CAST(2000 AS DOUBLE) AS premium_cancelled_ref FROM {orders} GROUP BY 1, 2, 3"""


@query("control_movement_gaps", f"""WITH base AS (SELECT * FROM {_SCOPED} b), {_FLAGS}, ct AS (SELECT network, market, segment, CAST(sum(CAST(i AS INT)) AS BIGINT) AS a, CAST(sum(CAST(n AND NOT rg AS INT)) AS BIGINT) AS b, round(sum(CASE WHEN i THEN premium_net ELSE 0 END)) AS c FROM f1 WHERE nature <> 'N3' GROUP BY 1, 2, 3),
  rf AS ({_CONTROL.format(orders='orders')})
SELECT rf.network, rf.market, rf.segment, a - n_in_force_ref AS gap_n_in_force, b - n_new_ref AS gap_n_new, c - premium_in_force_ref AS gap_premium_in_force, round(c / nullif(a, 0)) - round(premium_in_force_ref / nullif(n_in_force_ref, 0)) AS gap_average_in_force,
  round(premium_new_ref / nullif(n_new_ref, 0)) AS average_new_ref FROM rf LEFT JOIN ct ON ct.network = rf.network AND ct.market = rf.market AND ct.segment = rf.segment""")
def control_movement_gaps(d: Data) -> DataFrame:
    sheet = d.sql(_CONTROL)
    parts = [sheet.filter("network = '1'"), sheet.filter("network = '3'")]
    out = control.reconcile_movements(main_flags(d), parts)
    return out.select(*control.CELL, "gap_n_in_force", "gap_n_new", "gap_premium_in_force", "gap_average_in_force", "average_new_ref")


def _perturbed(d: Data) -> tuple[DataFrame, DataFrame]:
    a = d.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    changed = (F.col("o_orderstatus") == "P") & (F.col("amount") > 400000)
    b = a.filter("amount > 5000").withColumn("amount", F.when(changed, F.col("amount") + 1).otherwise(F.col("amount")))
    return a, b


_PAIR = """a AS (SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18, 2)) AS amount FROM orders),
  b AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' AND amount > 400000 THEN amount + 1 ELSE amount END AS amount FROM a WHERE amount > 5000)"""


@query("parity_totals", f"""WITH {_PAIR}, x AS (SELECT o_orderstatus, count(*) AS r, sum(amount) AS s FROM a GROUP BY 1), y AS (SELECT o_orderstatus, count(*) AS r, sum(amount) AS s FROM b GROUP BY 1)
SELECT x.o_orderstatus, x.r AS rows_a, y.r AS rows_b, CAST(x.s AS DOUBLE) AS amount_a, CAST(y.s AS DOUBLE) AS amount_b, greatest(abs(x.r - y.r) / CAST(x.r AS DOUBLE), CAST(abs(x.s - y.s) AS DOUBLE) / CAST(x.s AS DOUBLE)) <= 0.0001 AS within FROM x FULL JOIN y ON x.o_orderstatus = y.o_orderstatus""")
def parity_totals(d: Data) -> DataFrame:
    out = control.parity_kpis(*_perturbed(d), ["o_orderstatus"], ["amount"])
    return out.withColumns({c: F.col(c).cast("double") for c in ("amount_a", "amount_b")})


@query("parity_by_field", f"""WITH {_PAIR}, j AS (SELECT a.o_orderkey AS ka, b.o_orderkey AS kb, a.amount IS DISTINCT FROM b.amount AS da, a.o_orderstatus IS DISTINCT FROM b.o_orderstatus AS ds FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT 'amount' AS "column", count(*) FILTER (ka IS NOT NULL AND kb IS NOT NULL AND da) AS differences, count(*) FILTER (ka IS NOT NULL AND kb IS NOT NULL) AS compared, count(*) FILTER (ka IS NULL OR kb IS NULL) AS one_sided FROM j
UNION ALL SELECT 'o_orderstatus', count(*) FILTER (ka IS NOT NULL AND kb IS NOT NULL AND ds), count(*) FILTER (ka IS NOT NULL AND kb IS NOT NULL), count(*) FILTER (ka IS NULL OR kb IS NULL) FROM j""")
def parity_by_field(d: Data) -> DataFrame:
    return control.parity_fields(*_perturbed(d), ["o_orderkey"])


@query("parity_changed_rows", f"""WITH {_PAIR} SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'only_b' WHEN b.o_orderkey IS NULL THEN 'only_a' ELSE 'changed' END AS state,
  CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN concat_ws(',', CASE WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' END, CASE WHEN a.amount IS DISTINCT FROM b.amount THEN 'amount' END) END AS fields
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.amount IS DISTINCT FROM b.amount OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus""")
def parity_changed_rows(d: Data) -> DataFrame:
    a, b = _perturbed(d)
    return control.parity_rows(a.select("o_orderkey", "o_orderstatus", "amount"), b, ["o_orderkey"])


# --- segmentation ----------------------------------------------------------------------------------------------

_PRODUCTS = """SELECT CAST(p_partkey AS STRING) AS product, p_name AS product_label, CASE p_size % 3 WHEN 0 THEN 'B' ELSE 'A' END AS market, p_type AS market_label, CAST(p_size % 4 AS STRING) AS segment_code,
  p_brand AS segment_label, CAST(p_size % 5 AS STRING) AS sub_segment, p_type AS sub_segment_label FROM {part}"""


@query("segmentation_reference", f"""WITH pr AS ({_PRODUCTS.format(part='part')}), st AS (SELECT *, '1' AS network FROM pr WHERE sub_segment <> '0' UNION ALL SELECT *, '3' FROM pr WHERE segment_code <> '1')
SELECT st.network, st.product, coalesce(s_name, product_label) AS product_label, market || '_' || market_label AS market_text, segment_code || '_' || segment_label AS segment_text, n_name AS product_type
FROM st LEFT JOIN nation ON CAST(n_nationkey AS STRING) = product LEFT JOIN supplier ON CAST(s_suppkey AS STRING) = product AND s_acctbal > 4000 WHERE market = 'A'""")
def segmentation_reference(d: Data) -> DataFrame:
    products = d.sql(_PRODUCTS)
    types = d.nation.select(F.col("n_nationkey").cast("string").alias("product"), F.col("n_name").alias("product_type"), F.lit("s").alias("segment"), F.lit("t").alias("segment_3"))
    labels = d.supplier.filter("s_acctbal > 4000").select(F.col("s_suppkey").cast("string").alias("product"), F.col("s_name").alias("product_label"))
    networks = {"1": (products.filter("sub_segment <> '0'"), ["product_label"]), "3": (products.filter("segment_code <> '1'"), ["product_label"])}
    out = segmentation.segmentation(networks, types, labels, ["A"])
    return out.select("network", "product", "product_label", "market_text", "segment_text", "product_type")


@query("segmentation_on_book", """SELECT policy_no, s.segment AS segment_2, s.product_type AS product_type_2, r_name AS upper_mid FROM @policies p LEFT JOIN @segments s ON s.product = p.product AND s.network = p.network
LEFT JOIN region ON mgmt_point = 'P' || CAST(r_regionkey AS STRING)""")
def segmentation_on_book(d: Data) -> DataFrame:
    points = d.region.select(F.concat(F.lit("P"), F.col("r_regionkey").cast("string")).alias("mgmt_point"), F.col("r_name").alias("upper_mid"))
    out = segmentation.with_segment(d.policies, d.segments, points, ["status"])
    return out.select("policy_no", "segment_2", "product_type_2", "upper_mid")


_GUARANTEES = [("1", "a1 a2"), ("2", "a4"), ("3", "a8 a9")]


@query("segmentation_market_codes", """SELECT policy, CASE WHEN a + b + c = 1 THEN CASE WHEN a = 1 THEN 'a1 a2' WHEN b = 1 THEN 'a4' ELSE 'a8 a9' END END AS market_from_guarantee FROM (SELECT CAST(l_orderkey AS STRING) AS policy,
  max(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS a, max(CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END) AS b, max(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS c FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linenumber <= 3 GROUP BY 1) t""")
def segmentation_market_codes(d: Data) -> DataFrame:
    lines = d.lineitem.select(F.col("l_orderkey").cast("string").alias("policy"), F.col("l_linenumber").cast("string").alias("guarantee"), F.col("l_returnflag").alias("branch"))
    return segmentation.market_codes(lines, ["A", "R"], _GUARANTEES)


ACTIVITY = segmentation.ActivityCodes(
    rules=[
        MatchRule("CRAFT", {"product": ["1-URGENT", "2-HIGH"], "_market": ["a1"]}), MatchRule("FIRM", {"product": ["1-URGENT", "2-HIGH"], "_market": ["a2", "a3", "a4"]}),
        MatchRule("FIRM", {"product": ["1-URGENT", "2-HIGH"], "_market": ["<blank>"], "formula": ["f1", "f2"]}), MatchRule("DEALER", {"product": ["2-HIGH"], "_market": ["a7"]}),
    ],
    nature_product="3-MEDIUM", nature_labels={"c1": "GROUP", "c2": "SINGLE"}, switched_product="1-URGENT", switched_markets=["a7"], switched_to="2-HIGH", switched_label="DEALER",
)
TYPES = segmentation.TypeCodes(
    unusable_activities=["GROUP"], defaults={"works": "T1", "damage": "D1"}, fallback="Other", forced_products={"5-LOW": "Firms"}, ten_year_label="ten years",
    ten_year_type="Craft", ten_year_sub_segment="7",
)
_LINES = """SELECT CAST(o_orderkey AS STRING) AS policy, o_orderkey AS line_no, o_orderstatus AS order_status, o_orderpriority AS product, CASE o_orderkey % 5 WHEN 0 THEN ' ' WHEN 1 THEN 'a1' WHEN 2 THEN 'a4' WHEN 3 THEN 'a7' END AS market_code,
  CASE o_orderkey % 3 WHEN 0 THEN 'f1' WHEN 1 THEN 'f4' END AS formula, CASE o_orderkey % 4 WHEN 0 THEN 'c1' WHEN 1 THEN 'c2' END AS nature_code FROM {orders}"""
_ACTIVE = f"""(SELECT policy, CASE WHEN product = '3-MEDIUM' AND nature_code = 'c1' THEN 'GROUP' WHEN product = '3-MEDIUM' AND nature_code = 'c2' THEN 'SINGLE' WHEN product = '1-URGENT' AND m = 'a7' THEN 'DEALER' WHEN product = '2-HIGH' AND m = 'a7' THEN 'DEALER'
  WHEN product IN ('1-URGENT', '2-HIGH') AND m = '' AND formula IN ('f1', 'f2') THEN 'FIRM' WHEN product IN ('1-URGENT', '2-HIGH') AND m IN ('a2', 'a3', 'a4') THEN 'FIRM' WHEN product IN ('1-URGENT', '2-HIGH') AND m = 'a1' THEN 'CRAFT' END AS activity,
  CASE WHEN product = '1-URGENT' AND m = 'a7' THEN '2-HIGH' ELSE product END AS product FROM (SELECT *, coalesce(trim(market_code), '') AS m FROM ({_LINES.format(orders='orders')}) l) t)"""


@query("segmentation_activity", f"SELECT policy, activity, product FROM {_ACTIVE} a")
def segmentation_activity(d: Data) -> DataFrame:
    return segmentation.activity(d.sql(_LINES), ACTIVITY).select("policy", "activity", "product")


def _types(d: Data) -> DataFrame:
    kinds = F.array(*[F.struct(F.lit(a).alias("activity"), F.lit(t).alias("product_type")) for a, t in (("CRAFT", "Craft"), ("FIRM", "Firms"), ("GROUP", "Groups"), ("SINGLE", "Singles"))])
    return d.region.filter("r_regionkey = 0").select(F.inline(kinds))


_LABEL = "CASE CAST(substr(policy, length(policy), 1) AS INT) % 4 WHEN 0 THEN 'works' WHEN 1 THEN 'damage' WHEN 2 THEN 'ten years' ELSE 'none' END"
_TYPED = f"""(SELECT *, CASE WHEN product = '5-LOW' THEN 'Firms' WHEN activity = 'CRAFT' THEN 'Craft' WHEN activity = 'FIRM' THEN 'Firms' WHEN activity = 'SINGLE' THEN 'Singles' WHEN label = 'works' THEN 'T1' WHEN label = 'damage' THEN 'D1' ELSE 'Other' END AS product_type
  FROM (SELECT *, {_LABEL} AS label FROM {_ACTIVE} a) t)"""


@query("segmentation_product_type", f"""SELECT policy, product_type, CASE WHEN label = 'ten years' AND product_type = 'Craft' THEN '7' ELSE '1' END AS sub_segment,
  CASE WHEN product_type = 'Craft' THEN 'Craft' WHEN product_type IN ('T1', 'D1') THEN 'Sites' ELSE 'Renewable' END AS family FROM {_TYPED} t""")
def segmentation_product_type(d: Data) -> DataFrame:
    active = segmentation.activity(d.sql(_LINES), ACTIVITY)
    digit = F.substring("policy", -1, 1).cast("int") % 4
    label = F.when(digit == 0, "works").when(digit == 1, "damage").when(digit == 2, "ten years").otherwise("none")
    rows = active.withColumns({"sub_segment_label": label, "sub_segment": F.lit("1"), "market_text": F.lit("A_x")})
    typed = segmentation.product_type(rows, _types(d), TYPES)
    out = segmentation.product_family(typed, "A_x", {"Craft": ["Craft"], "Sites": ["T1", "D1"]}, "Renewable")
    return out.select("policy", "product_type", "sub_segment", "family")


@query("segmentation_legacy", f"""WITH lk AS (SELECT DISTINCT o_orderpriority AS product, 'g' || substr(o_orderpriority, 1, 1) AS segment, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'ten years' WHEN '4' THEN 'works' ELSE 'none' END AS label, substr(o_orderpriority, 3, 1) AS sub FROM orders WHERE o_orderpriority <> '3-MEDIUM'),
  mk AS (SELECT policy, CASE WHEN a + b + c = 1 THEN CASE WHEN a = 1 THEN 'a1 a2' WHEN b = 1 THEN 'a4' ELSE 'a8 a9' END END AS mg FROM (SELECT CAST(l_orderkey AS STRING) AS policy,
    max(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS a, max(CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END) AS b, max(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS c FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linenumber <= 3 GROUP BY 1) t),
  ln AS (SELECT l.policy, l.product, formula, coalesce(nullif(trim(market_code), ''), mg, '') AS m FROM ({_LINES.format(orders='orders')}) l JOIN lk ON lk.product = l.product LEFT JOIN mk ON mk.policy = l.policy WHERE order_status <> 'P'),
  ac AS (SELECT policy, CASE WHEN product = '1-URGENT' AND m = 'a7' THEN 'DEALER' WHEN product = '2-HIGH' AND m = 'a7' THEN 'DEALER' WHEN product IN ('1-URGENT', '2-HIGH') AND m = '' AND formula IN ('f1', 'f2') THEN 'FIRM'
    WHEN product IN ('1-URGENT', '2-HIGH') AND m IN ('a2', 'a3', 'a4') THEN 'FIRM' WHEN product IN ('1-URGENT', '2-HIGH') AND m = 'a1' THEN 'CRAFT' END AS activity FROM ln),
  ty AS (SELECT CAST(o_orderkey AS STRING) AS policy, o_orderpriority AS product, lk.segment, label, sub, CASE WHEN o_orderpriority = '5-LOW' THEN 'Firms' WHEN activity = 'CRAFT' THEN 'Craft' WHEN activity = 'FIRM' THEN 'Firms' WHEN label = 'works' THEN 'T1' ELSE 'Other' END AS product_type
    FROM orders JOIN lk ON lk.product = o_orderpriority LEFT JOIN ac ON ac.policy = CAST(o_orderkey AS STRING))
SELECT policy, product, segment, CASE WHEN label = 'ten years' AND product_type = 'Craft' THEN '7' ELSE sub END AS sub_segment, product_type FROM ty""")
def segmentation_legacy(d: Data) -> DataFrame:
    priority = F.col("o_orderpriority")
    first = F.substring(priority, 1, 1)
    products = d.orders.select(
        priority.alias("product"), F.when(priority == "3-MEDIUM", "B").otherwise("A").alias("market"), F.concat(F.lit("g"), first).alias("segment"),
        F.when(first == "1", "ten years").when(first == "4", "works").otherwise("none").alias("sub_segment_label"), F.substring(priority, 3, 1).alias("sub_segment"),
    ).distinct()
    lines = d.sql(_LINES)
    construction = lines.filter("order_status = 'O'")
    technical = lines.filter("order_status = 'F'")
    guarantees = d.lineitem.select(F.col("l_orderkey").cast("string").alias("policy"), F.col("l_linenumber").cast("string").alias("guarantee"), F.col("l_returnflag").alias("branch"))
    policies = d.orders.select(F.col("o_orderkey").cast("string").alias("policy"), priority.alias("product"), F.col("o_orderkey").alias("line_no"))
    return segmentation.legacy_segmentation(
        policies, construction, technical, guarantees, products, _types(d), ["A"], ["A", "R"], _GUARANTEES, ACTIVITY, TYPES, ["line_no"]
    )


@query("book_with_score", """SELECT policy_no, score FROM @policies p LEFT JOIN (SELECT CAST(o_custkey AS STRING) AS k, score FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS a, lead(CAST(o_orderdate AS DATE), 1, DATE '2999-01-01') OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS b,
  o_orderpriority AS score FROM orders) h WHERE a <= DATE '1998-06-30' AND b > DATE '1998-06-30') h ON k = client_no""")
def book_with_score(d: Data) -> DataFrame:
    history = d.sql("""SELECT CAST(o_custkey AS STRING) AS company_no, CAST(o_orderdate AS DATE) AS valid_from,
      lead(CAST(o_orderdate AS DATE), 1, DATE '2999-01-01') OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to, o_orderpriority AS score FROM {orders}""")
    return consolidate.risk_score(d.policies.withColumn("company_no", F.col("client_no")), history, PERIOD).select("policy_no", "score")
