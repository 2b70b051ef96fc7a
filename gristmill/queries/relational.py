"""Joins, de-duplication, unions, rule tables and profiles on the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import dates, missing, numbers, text
from gristmill.operators import dedup, joins, profile, rules, setops, sketches
from gristmill.plans import consolidate, control
from gristmill.queries.base import Data, query
from gristmill.session import scratch_path
from gristmill.sources import delimited, tables

PERIOD = dates.Period.of(199806)


# --- joins -----------------------------------------------------------------------------------------------------

@query("join_left_one_key", "SELECT c_custkey, n_name, n_regionkey FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def join_left_one_key(d: Data) -> DataFrame:
    out = joins.enrich(d.customer, d.nation, {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])
    return out.select("c_custkey", "n_name", "n_regionkey")


@query("join_left_many_keys", """SELECT policy_no, segment_ref, product_type FROM @policies p
LEFT JOIN (SELECT product AS pr, network AS nw, segment AS segment_ref, product_type FROM @segments s) s ON pr = product AND nw = network""")
def join_left_many_keys(d: Data) -> DataFrame:
    out = joins.enrich(d.policies, d.segments, ["product", "network"], {"segment": "segment_ref", "product_type": "product_type"}, order=["segment"])
    return out.select("policy_no", "segment_ref", "product_type")


@query("join_left_conditional", "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND o_orderstatus = 'O'")
def join_left_conditional(d: Data) -> DataFrame:
    out = joins.enrich(d.orders, d.customer, {"o_custkey": "c_custkey"}, ["c_name"], condition=F.col("l.o_orderstatus") == "O")
    return out.select("o_orderkey", "c_name")


@query("join_left_salted", "SELECT l_orderkey, l_linenumber, l_partkey, s_name FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey")
def join_left_salted(d: Data) -> DataFrame:
    out = joins.enrich(d.lineitem, d.supplier, {"l_suppkey": "s_suppkey"}, ["s_name"], salt=4)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "s_name")


@query("join_lookup_keep", "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey AND c_nationkey < 9")
def join_lookup_keep(d: Data) -> DataFrame:
    out = joins.lookup_keep(d.orders, d.customer.filter("c_nationkey < 9"), {"o_custkey": "c_custkey"}, ["c_mktsegment"])
    return out.select("o_orderkey", "c_mktsegment")


@query("join_priority_fill", """SELECT p_partkey, coalesce(nullif(a, ''), b, c) AS label, CASE WHEN nullif(a, '') IS NOT NULL THEN 'SUPPLIER' WHEN b IS NOT NULL THEN 'NATION' WHEN c IS NOT NULL THEN 'REGION' END AS origin
FROM (SELECT p_partkey, (SELECT max(CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_name END) FROM supplier WHERE s_suppkey = p_partkey) AS a,
  (SELECT max(n_name) FROM nation WHERE n_nationkey = p_size) AS b, (SELECT max(r_name) FROM region WHERE r_regionkey = p_partkey % 9) AS c FROM part) t""")
def join_priority_fill(d: Data) -> DataFrame:
    suppliers = d.supplier.withColumn("s_name", F.when(F.col("s_suppkey") % 4 == 0, "").otherwise(F.col("s_name")))
    parts = d.part.withColumn("ninth", F.col("p_partkey") % 9)
    refs = [
        (suppliers, {"p_partkey": "s_suppkey"}, "s_name", "SUPPLIER"), (d.nation, {"p_size": "n_nationkey"}, "n_name", "NATION"),
        (d.region, {"ninth": "r_regionkey"}, "r_name", "REGION"),
    ]
    return joins.priority_fill(parts, refs, "label", "origin").select("p_partkey", "label", "origin")


@query("join_fill_missing", """SELECT c_custkey, coalesce(nullif(a, ''), s_name, n_name) AS label, coalesce(v, s_acctbal) AS amount
FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN c_name END AS a, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS v FROM customer) t
LEFT JOIN supplier ON s_suppkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""")
def join_fill_missing(d: Data) -> DataFrame:
    gaps = d.customer.select(
        "c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, F.col("c_name")).alias("label"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).alias("amount"),
    )
    once = joins.fill_missing(gaps, d.supplier, {"c_custkey": "s_suppkey"}, {"label": "s_name", "amount": "s_acctbal"})
    return joins.fill_missing(once, d.nation, {"c_nationkey": "n_nationkey"}, {"label": "n_name"}).select("c_custkey", "label", "amount")


_HISTORY = """SELECT o_custkey AS cust, CAST(o_orderdate AS DATE) AS valid_from,
  lead(CAST(o_orderdate AS DATE), 1, DATE '2999-01-01') OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to, o_orderpriority AS score FROM {orders}"""


@query("join_valid_at", f"""SELECT c_custkey, score FROM customer LEFT JOIN (SELECT * FROM ({_HISTORY.format(orders='orders')}) h
WHERE valid_from <= DATE '1998-06-30' AND valid_to > DATE '1998-06-30') h ON cust = c_custkey""")
def join_valid_at(d: Data) -> DataFrame:
    history = d.sql(_HISTORY)
    return joins.join_valid_at(d.customer, history, {"c_custkey": "cust"}, PERIOD.last_day, ["score"]).select("c_custkey", "score")


@query("join_as_of", """SELECT l_suppkey, n_lines FROM (SELECT l_suppkey, year(l_shipdate) * 100 + month(l_shipdate) AS period, count(*) AS n_lines FROM lineitem GROUP BY ALL) t
WHERE period = (SELECT max(year(l_shipdate) * 100 + month(l_shipdate)) FROM lineitem WHERE year(l_shipdate) * 100 + month(l_shipdate) <= 199806)""")
def join_as_of(d: Data) -> DataFrame:
    stamped = d.lineitem.withColumn("period", F.year("l_shipdate") * 100 + F.month("l_shipdate"))
    monthly = stamped.groupBy("l_suppkey", "period").agg(F.count("*").alias("n_lines"))
    return joins.as_of(monthly, PERIOD.value).select("l_suppkey", "n_lines")


@query("join_valid_per_row", f"""SELECT l_orderkey, l_linenumber, l_partkey, score FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN ({_HISTORY.format(orders='orders')}) h ON cust = o_custkey AND CAST(l_shipdate AS DATE) >= valid_from AND CAST(l_shipdate AS DATE) < valid_to""")
def join_valid_per_row(d: Data) -> DataFrame:
    lines = joins.enrich(d.lineitem, d.orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"], unique=True)
    return joins.join_valid_on(lines, d.sql(_HISTORY), {"o_custkey": "cust"}, "l_shipdate", ["score"]).select("l_orderkey", "l_linenumber", "l_partkey", "score")


@query("join_as_of_per_row", """WITH v AS (SELECT user_id, ts, max(event_id) AS seen FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT event_id, seen FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF LEFT JOIN v ON v.user_id = e.user_id AND v.ts <= e.ts""")
def join_as_of_per_row(d: Data) -> DataFrame:
    views = d.events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("seen"))
    bought = d.events.where("event_type = 'purchase'")
    return joins.join_as_of(bought, views, ["user_id"], "ts", "ts", ["seen"], order=["seen"]).select("event_id", "seen")


@query("join_as_of_strictly_before", """WITH v AS (SELECT user_id, ts, max(event_id) AS seen FROM events GROUP BY ALL)
SELECT event_id, seen FROM events e ASOF LEFT JOIN v ON v.user_id = e.user_id AND v.ts < e.ts""")
def join_as_of_strictly_before(d: Data) -> DataFrame:
    ref = d.events.select("user_id", "ts", F.col("event_id").alias("seen"))
    return joins.join_as_of(d.events, ref, ["user_id"], "ts", "ts", ["seen"], order=["seen"], width=86_400, strict=True).select("event_id", "seen")


@query("join_flag_exists", "SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 0 ELSE 1 END AS kept FROM orders")
def join_flag_exists(d: Data) -> DataFrame:
    returned = d.lineitem.filter("l_returnflag = 'R'")
    return joins.flag_exists(d.orders, returned, {"o_orderkey": "l_orderkey"}, "kept", present=0).select("o_orderkey", "kept")


@query("join_anti", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def join_anti(d: Data) -> DataFrame:
    return joins.drop_existing(d.orders, d.lineitem, {"o_orderkey": "l_orderkey"}).select("o_orderkey")


@query("join_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def join_semi(d: Data) -> DataFrame:
    return joins.keep_existing(d.customer, d.orders.filter("o_totalprice > 400000"), {"c_custkey": "o_custkey"}).select("c_custkey")


def _merge_sides(d: Data) -> tuple[DataFrame, DataFrame]:
    left = d.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    totals = d.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    right = totals.filter("n > 8").select("k", F.lit("from orders").alias("name"), "n")
    return left, right


_RIGHT = "(SELECT o_custkey AS k, 'from orders' AS name, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 8)"


@query("merge_keep_left", f"SELECT c_custkey AS k, CASE WHEN r.k IS NULL THEN c_name ELSE r.name END AS name, c_mktsegment AS segment, n FROM customer LEFT JOIN {_RIGHT} r ON r.k = c_custkey")
def merge_keep_left(d: Data) -> DataFrame:
    return joins.merge_by(*_merge_sides(d), ["k"], keep="left")


@query("merge_keep_both", f"SELECT c_custkey AS k, r.name, c_mktsegment AS segment, n FROM customer JOIN {_RIGHT} r ON r.k = c_custkey")
def merge_keep_both(d: Data) -> DataFrame:
    return joins.merge_by(*_merge_sides(d), ["k"], keep="both")


@query("merge_left_only", f"SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_custkey NOT IN (SELECT k FROM {_RIGHT} r)")
def merge_left_only(d: Data) -> DataFrame:
    return joins.merge_by(*_merge_sides(d), ["k"], keep="left_only")


@query("merge_keep_right", f"SELECT r.k, r.name, c_mktsegment AS segment, n FROM {_RIGHT} r LEFT JOIN customer ON r.k = c_custkey")
def merge_keep_right(d: Data) -> DataFrame:
    return joins.merge_by(*_merge_sides(d), ["k"], keep="right")


@query("join_client_coalesce", """SELECT o_orderkey, coalesce(a.v, b.v) AS client FROM orders LEFT JOIN (SELECT c_custkey AS k, c_name AS v FROM customer WHERE c_mktsegment = 'BUILDING') a ON a.k = o_custkey
LEFT JOIN (SELECT s_suppkey AS k, s_name AS v FROM supplier) b ON b.k = o_custkey""")
def join_client_coalesce(d: Data) -> DataFrame:
    first = d.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("client"))
    third = d.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("client"))
    return joins.coalesce_sources(d.orders, [first, third], {"o_custkey": "k"}, ["client"]).select("o_orderkey", "client")


# --- de-duplication, unions, order -----------------------------------------------------------------------------

@query("keep_first_per_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1")
def keep_first_per_key(d: Data) -> DataFrame:
    return dedup.keep_first(d.orders, ["o_custkey"], [F.col("o_orderdate").desc(), "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("first_last_flags", """SELECT o_orderkey, CASE WHEN o_orderkey = max(o_orderkey) OVER w THEN '' WHEN o_orderkey = min(o_orderkey) OVER w THEN '1' ELSE '3' END AS network
FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def first_last_flags(d: Data) -> DataFrame:
    flagged = dedup.first_last(d.orders, ["o_custkey"], "o_orderkey")
    return flagged.select("o_orderkey", F.when(F.col("is_last"), "").when(F.col("is_first"), "1").otherwise("3").alias("network"))


@query("union_by_name", """SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance, NULL AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""")
def union_by_name(d: Data) -> DataFrame:
    left = d.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    right = d.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return setops.union_by_name(left, right)


@query("union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(d: Data) -> DataFrame:
    return setops.union_distinct(d.customer.select(F.col("c_nationkey").alias("nation")), d.supplier.select(F.col("s_nationkey").alias("nation")))


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(d: Data) -> DataFrame:
    return d.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("top_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_orders(d: Data) -> DataFrame:
    return setops.top_n(d.orders, [F.col("o_totalprice").desc(), "o_orderkey"], 20).select("o_orderkey", "o_totalprice")


@query("align_layout", "SELECT o_orderkey AS id, 'main' AS channel, o_totalprice AS amount, CAST(NULL AS STRING) AS note, CAST(year(o_orderdate) AS INT) AS year_seen FROM orders")
def align_layout(d: Data) -> DataFrame:
    out = setops.align(d.orders, {"id": "o_orderkey", "channel": F.lit("main"), "amount": "o_totalprice", "note": None, "year_seen": F.year("o_orderdate")})
    return out.withColumn("note", F.col("note").cast("string"))


@query("array_first_appearance", """SELECT o_custkey, array_to_string(list_distinct_ordered, ',') AS statuses FROM (SELECT o_custkey,
  list(o_orderstatus ORDER BY first_key) AS list_distinct_ordered FROM (SELECT o_custkey, o_orderstatus, min(o_orderkey) AS first_key FROM orders GROUP BY 1, 2) t GROUP BY 1) u""")
def array_first_appearance(d: Data) -> DataFrame:
    """Distinct statuses in order of first appearance; at most three survive the first aggregate."""
    firsts = d.orders.groupBy("o_custkey", "o_orderstatus").agg(F.min("o_orderkey").alias("first_key"))
    ordered = firsts.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("first_key", "o_orderstatus"))).alias("s"))
    return ordered.select("o_custkey", F.array_join(F.array_distinct(F.col("s.o_orderstatus")), ",").alias("statuses"))


# --- rules -----------------------------------------------------------------------------------------------------

PART_RULES = [
    rules.Rule("contains", "SMALL", "COMPACT"), rules.Rule("contains", "RED", "WARM"), rules.Rule("regex", "G+E", "GEAR"),
    rules.Rule("contains", "RING", "ROUND"), rules.Rule("codes", ("blue widget",), "LISTED"),
]


@query("classify_first_match", """SELECT p_partkey, CASE WHEN contains(upper(p_name), 'SMALL') THEN 'COMPACT' WHEN contains(upper(p_name), 'RED') THEN 'WARM' WHEN regexp_matches(upper(p_name), 'G+E') THEN 'GEAR'
  WHEN contains(upper(p_name), 'RING') THEN 'ROUND' WHEN p_name IN ('blue widget') THEN 'LISTED' ELSE 'OTHER' END AS class FROM part""")
def classify_first_match(d: Data) -> DataFrame:
    return d.part.select("p_partkey", rules.classify_ordered(F.col("p_name"), PART_RULES, "OTHER").alias("class"))


@query("classify_last_match", """SELECT p_partkey, CASE WHEN p_size > 40 THEN 'big' WHEN p_brand IN ('Brand#2', 'Brand#17') THEN 'brand' WHEN p_type = 'ECONOMY' THEN 'cheap' END AS class FROM part""")
def classify_last_match(d: Data) -> DataFrame:
    tests = [(F.col("p_type") == "ECONOMY", "cheap"), (F.col("p_brand").isin("Brand#2", "Brand#17"), "brand"), (F.col("p_size") > 40, "big")]
    return d.part.select("p_partkey", rules.classify_last(tests).alias("class"))


@query("classify_any_keyword", """SELECT p_partkey, CASE WHEN contains(upper(p_name), 'RING') OR contains(upper(p_name), 'BOLT') OR contains(upper(p_type), 'PROMO') OR p_brand IN ('Brand#3') THEN 'hit' ELSE 'miss' END AS class FROM part""")
def classify_any_keyword(d: Data) -> DataFrame:
    found = rules.classify_any({"p_name": ["RING", "BOLT"], "p_type": ["PROMO"]}, ("p_brand", ["Brand#3"]), "hit", "miss")
    return d.part.select("p_partkey", found.alias("class"))


PROTOCOLS = [
    rules.MatchRule("LEASE", {"o_orderpriority": ["1-URGENT"]}), rules.MatchRule("FLEET", {"o_orderstatus": ["F"]}, {"o_orderpriority": ["5-LOW"]}),
    rules.MatchRule("PARTNER", {"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderstatus": ["P"]}),
]


@query("assign_protocols", """SELECT o_orderkey, protocol, CASE WHEN protocol IS NOT NULL THEN 'H1' ELSE o_orderpriority END AS point FROM (SELECT *, CASE WHEN o_custkey % 2 = 0 THEN CASE
  WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'P' THEN 'PARTNER' WHEN o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' THEN 'FLEET'
  WHEN o_orderpriority = '1-URGENT' THEN 'LEASE' END END AS protocol FROM orders) t""")
def assign_protocols(d: Data) -> DataFrame:
    rows = d.orders.withColumns({"protocol": F.lit(None).cast("string"), "point": F.col("o_orderpriority")})
    return rules.assign_protocol(rows, PROTOCOLS, F.col("o_custkey") % 2 == 0, "protocol", {"point": "H1"}).select("o_orderkey", "protocol", "point")


@query("code_labels_and_flags", """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END AS label, CASE o_orderstatus WHEN 'P' THEN 'Q' ELSE o_orderstatus END AS overridden,
  CASE WHEN o_orderpriority NOT IN ('5-LOW') THEN o_orderpriority END AS cleaned, CASE WHEN o_orderpriority IN ('1-URGENT') THEN 1 ELSE 0 END AS urgent,
  CASE WHEN o_orderpriority LIKE '1%' THEN substr('*' || o_orderpriority, 2, 3) ELSE o_orderpriority END AS unstarred FROM orders""")
def code_labels_and_flags(d: Data) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    starred = F.when(priority.startswith("1"), F.concat(F.lit("*"), priority)).otherwise(priority)
    return d.orders.select(
        "o_orderkey", rules.code_label(status, {"O": "open", "F": "filled"}).alias("label"), rules.override_codes(status, status, {"P": "Q"}).alias("overridden"),
        rules.null_codes(priority, ["5-LOW"]).alias("cleaned"), rules.flag_in(priority, ["1-URGENT"]).alias("urgent"), text.strip_star(starred).alias("unstarred"),
    )


@query("global_sector_codes", """SELECT policy_no, sector_code, CASE sector_code WHEN '3' THEN 'G-override' ELSE g END AS sector_code_global, CASE WHEN intermediary IN ('7', '8') THEN 1 ELSE 0 END AS is_partner,
  CASE WHEN intermediary IN ('8') THEN 1 ELSE 0 END AS is_special, CASE WHEN product <> '5-LOW' THEN product END AS industry_code
FROM (SELECT *, activity AS sector_code FROM @policies p) p LEFT JOIN (SELECT CAST(n_nationkey AS STRING) AS local_code, n_name AS g FROM nation) n ON local_code = sector_code""")
def global_sector_codes(d: Data) -> DataFrame:
    book = d.policies.withColumns({"sector_code": F.col("activity"), "industry_code": F.col("product")})
    ref = d.nation.select(F.col("n_nationkey").cast("string").alias("local_code"), F.col("n_name").alias("global_code"))
    out = consolidate.global_code(book, ref, {"3": "G-override"}, ["7", "8"], ["8"], ["5-LOW"])
    return out.select("policy_no", "sector_code", "sector_code_global", "is_partner", "is_special", "industry_code")


@query("fix_accents", "SELECT doc_id, replace(replace(lang, 'f', 'ph'), 'e', 'é') AS lang, replace(replace(source, 'f', 'ph'), 'e', 'é') AS source FROM documents")
def fix_accents(d: Data) -> DataFrame:
    return text.fix_accents(d.documents.select("doc_id", "lang", "source"), {"f": "ph", "e": "é"})


@query("strip_control_characters", "SELECT doc_id, regexp_replace(source || chr(7) || lang, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g') AS label FROM documents")
def strip_control_characters(d: Data) -> DataFrame:
    noisy = d.documents.select("doc_id", F.concat("source", F.char(F.lit(7)), "lang").alias("label"))
    return text.strip_illegal(noisy, ["label"])


# --- dates, numbers, missing values ----------------------------------------------------------------------------

@query("date_parts", """SELECT policy_no, CAST(substr(anniversary_mmdd, 1, 2) AS INT) AS due_month, CAST(substr(anniversary_mmdd, 3, 2) AS INT) AS due_day, CAST(year(created) AS INT) AS year_created, CAST(month(created) AS INT) AS month_created,
  date_diff('day', created, cancelled) + 1 AS days, CAST(CAST(created - INTERVAL 1 MONTH AS DATE) AS STRING) AS month_before FROM @policies p""")
def date_parts(d: Data) -> DataFrame:
    mmdd = F.col("anniversary_mmdd")
    return d.policies.select(
        "policy_no", dates.anniversary_month(mmdd).alias("due_month"), dates.anniversary_day(mmdd).alias("due_day"), F.year("created").alias("year_created"),
        F.month("created").alias("month_created"), dates.days_incl(F.col("cancelled"), F.col("created")).cast("bigint").alias("days"),
        dates.previous_month(F.col("created")).cast("string").alias("month_before"),
    )


@query("last_anniversary", """SELECT policy_no, CAST(CASE WHEN d > DATE '1998-06-30' THEN try_cast('1997-' || md AS DATE) ELSE d END AS STRING) AS anniversary
FROM (SELECT policy_no, substr(anniversary_mmdd, 1, 2) || '-' || substr(anniversary_mmdd, 3, 2) AS md, try_cast('1998-' || substr(anniversary_mmdd, 1, 2) || '-' || substr(anniversary_mmdd, 3, 2) AS DATE) AS d FROM @policies p) t""")
def last_anniversary(d: Data) -> DataFrame:
    return d.policies.select("policy_no", dates.anniversary(F.col("anniversary_mmdd"), PERIOD.last_day).cast("string").alias("anniversary"))


@query("datetime_text_dates", "SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS day FROM events")
def datetime_text_dates(d: Data) -> DataFrame:
    stamp = F.upper(F.date_format("ts", "ddMMMyyyy':'HH:mm:ss"))
    return d.events.select("event_id", dates.sas_date(stamp).cast("string").alias("day"))


@query("numbers_with_gaps", """SELECT policy_no, CAST(least(created, cancelled) AS STRING) AS low, CAST(greatest(created, cancelled) AS STRING) AS high,
  CASE WHEN turnover_2 IS NULL AND ceded_pct IS NULL THEN NULL ELSE coalesce(turnover_2, 0) + coalesce(ceded_pct, 0) END AS total, turnover_2 + ceded_pct AS propagated,
  premium * 100 / CASE WHEN share_pct IS NULL OR share_pct = 0 THEN 100 ELSE share_pct END AS full_amount, round(premium) AS rounded FROM @policies p""")
def numbers_with_gaps(d: Data) -> DataFrame:
    c = F.col
    return d.policies.select(
        "policy_no", numbers.least_m(c("created"), c("cancelled")).cast("string").alias("low"), numbers.greatest_m(c("created"), c("cancelled")).cast("string").alias("high"),
        numbers.sum_m(c("turnover_2"), c("ceded_pct")).alias("total"), (c("turnover_2") + c("ceded_pct")).alias("propagated"),
        numbers.to_full_share(c("premium"), c("share_pct")).alias("full_amount"), numbers.round_half_up(c("premium")).alias("rounded"),
    )


@query("missing_order", """SELECT policy_no, created IS NULL OR created <= DATE '1998-06-30' AS le, coalesce(created > DATE '1998-06-30', false) AS gt, sub_segment IS NULL OR sub_segment <> '5' AS ne,
  sub_segment IS NULL OR sub_segment NOT IN ('1', '2') AS notin, created IS NOT NULL AND (cancelled IS NULL OR created > cancelled) AS gt_columns,
  created IS NULL AND cancelled IS NULL OR coalesce(created = cancelled, false) AS eq_columns FROM @policies p""")
def missing_order(d: Data) -> DataFrame:
    created, cancelled, sub, end = F.col("created"), F.col("cancelled"), F.col("sub_segment"), date(1998, 6, 30)
    return d.policies.select(
        "policy_no", missing.le_m(created, end).alias("le"), missing.gt_m(created, end).alias("gt"), missing.ne_m(sub, "5").alias("ne"),
        missing.notin_m(sub, ["1", "2"]).alias("notin"), missing.gt_m(created, cancelled).alias("gt_columns"), missing.eq_m(created, cancelled).alias("eq_columns"),
    )


# --- profiles --------------------------------------------------------------------------------------------------

_PROFILED = ["ID_SITE", "PAYS_SITE", "CP_SITE", "ADRESSE_SITE", "COORD_X_SITE", "SURFACE"]


@query("profile_fill_rates", "SELECT t.column, filled, filled * 100.0 / n AS pct FROM (SELECT count(*) AS n FROM @sites s), (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS filled FROM @sites s" for c in _PROFILED) + ") t")
def profile_fill_rates(d: Data) -> DataFrame:
    return profile.fill_rates(d.sites, _PROFILED)


@query("profile_fill_rates_not_blank", "SELECT t.column, filled FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (coalesce(trim({c}, ' ' || chr(9)), '') <> '') AS filled FROM @sites s" for c in _PROFILED) + ") t")
def profile_fill_rates_not_blank(d: Data) -> DataFrame:
    return profile.fill_rates(d.sites, _PROFILED, blank_is_empty=True).select("column", "filled")


@query("profile_keys", """SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_keys, count(o_custkey) - count(DISTINCT o_custkey) AS n_duplicates,
  (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders) t) AS n_pairs FROM orders""")
def profile_keys(d: Data) -> DataFrame:
    return profile.key_profile(d.orders, "o_custkey", ["o_custkey", "o_orderstatus"])


@query("profile_sketches", """WITH r AS (SELECT * FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1998) SELECT 'o_custkey' AS name, CAST(NULL AS DOUBLE) AS p, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS exact, true AS within FROM r
UNION ALL SELECT 'o_orderpriority', NULL, count(DISTINCT o_orderpriority), true FROM r UNION ALL SELECT 'o_totalprice', p, NULL, true FROM (SELECT unnest([0.1, 0.5, 0.9]) AS p) t WHERE (SELECT count(*) FROM r) > 0""")
def profile_sketches(d: Data) -> DataFrame:
    year = F.year("o_orderdate")
    kept = sketches.period_sketches(d.orders, year, ["o_custkey", "o_orderpriority"], ["o_totalprice"])
    return sketches.beside_exact(d.orders.where(year.between(1995, 1998)), sketches.merged(kept, 1995, 1998), ["o_custkey", "o_orderpriority"], ["o_totalprice"], [0.1, 0.5, 0.9])


@query("profile_top_values", "SELECT user_id AS value, count(*) AS n_rows FROM events GROUP BY 1 ORDER BY n_rows DESC, value LIMIT 10")
def profile_top_values(d: Data) -> DataFrame:
    return profile.top_values(d.events, "user_id")


@query("profile_describe", """SELECT 'count' AS statistic, CAST(count(o_totalprice) AS DOUBLE) AS value FROM orders UNION ALL SELECT 'min', min(o_totalprice) FROM orders UNION ALL SELECT 'max', max(o_totalprice) FROM orders
UNION ALL SELECT 'mean', round(avg(o_totalprice), 4) FROM orders UNION ALL SELECT 'std', round(stddev_samp(o_totalprice), 4) FROM orders UNION ALL SELECT '25%', round(quantile_cont(o_totalprice, 0.25), 4) FROM orders
UNION ALL SELECT '50%', round(quantile_cont(o_totalprice, 0.5), 4) FROM orders UNION ALL SELECT '75%', round(quantile_cont(o_totalprice, 0.75), 4) FROM orders""")
def profile_describe(d: Data) -> DataFrame:
    return profile.describe(d.orders, "o_totalprice").withColumn("value", F.round("value", 4))


@query("profile_presence", """SELECT cancelled IS NOT NULL AS has_a, turnover_2 IS NOT NULL AS has_b, count(*) AS n_rows FROM @policies p GROUP BY 1, 2""")
def profile_presence(d: Data) -> DataFrame:
    return profile.presence_matrix(d.policies, F.col("cancelled").isNotNull(), F.col("turnover_2").isNotNull())


# --- inputs that may be absent, sheets by position, whole folders ----------------------------------------------

def _loader(d: Data, name: str):
    return lambda: tables.load_table(d.spark, d.folder, name)


@query("union_of_existing_tables", "SELECT r_name AS name, r_regionkey AS code FROM region UNION ALL SELECT n_name, n_regionkey FROM nation")
def union_of_existing_tables(d: Data) -> DataFrame:
    """The table in between does not exist and counts as empty."""
    region = lambda: _loader(d, "region")().select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("code"))
    nation = lambda: _loader(d, "nation")().select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("code"))
    return tables.union_existing(d.spark, [region, _loader(d, "no_such_table"), nation], "name string, code int")


@query("special_activity", "SELECT CAST(o_orderkey AS STRING) AS policy_no, o_orderpriority AS code FROM orders WHERE o_orderkey % 3 <> 0")
def special_activity(d: Data) -> DataFrame:
    key = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey").cast("string"))
    there = lambda: d.orders.select(key.alias("policy_no"), F.col("o_orderpriority").alias("code"))
    return consolidate.special_activity(d.spark, [_loader(d, "no_such_table"), there], "policy_no string, code string")


@query("control_sheet_by_position", "SELECT c_mktsegment AS segment, c_acctbal AS premium, c_custkey AS line FROM customer")
def control_sheet_by_position(d: Data) -> DataFrame:
    at = {name: i for i, name in enumerate(d.customer.columns)}
    return tables.read_control(d.customer, {"segment": at["c_mktsegment"], "premium": at["c_acctbal"], "line": at["c_custkey"]})


_LOADED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query("loaded_tables", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in _LOADED))
def loaded_tables(d: Data) -> DataFrame:
    counted = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in tables.load_tables(d.spark, d.folder, _LOADED).items()]
    return setops.concat(*counted)


@query("parity_structure", """SELECT CASE WHEN n > 0 THEN 'amount' END AS "column", 'double' AS type_a, 'bigint' AS type_b, false AS same FROM (SELECT count(*) AS n FROM orders) t
UNION ALL SELECT 'only_a', 'string', NULL, false UNION ALL SELECT 'only_b', NULL, 'string', false UNION ALL SELECT 'policy', 'bigint', 'bigint', true""")
def parity_structure(d: Data) -> DataFrame:
    a = d.orders.select(F.col("o_orderkey").alias("policy"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("only_a"))
    b = d.orders.select(F.col("o_orderkey").alias("policy"), F.col("o_totalprice").cast("bigint").alias("amount"), F.col("o_orderstatus").alias("only_b"))
    return control.parity_structure(a, b)


_NOTES = """SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 4 = 0 THEN 'said "' || o_orderstatus || '"' || chr(10) || ';' || chr(10) || o_orderpriority WHEN o_orderkey % 4 = 1 THEN o_orderstatus || ';' END AS note,
  o_orderkey % 3 AS kind FROM orders"""


def _exports(d: Data) -> list[str]:
    """Orders as three exports: with notes that hold line ends, with the columns in another order, and without one of the columns."""
    note = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit('said "'), "o_orderstatus", F.lit('"\n;\n'), "o_orderpriority")).when(F.col("o_orderkey") % 4 == 1, F.concat("o_orderstatus", F.lit(";")))
    rows = d.orders.select(F.col("o_orderkey").cast("string").alias("id"), note.alias("note"), (F.col("o_orderkey") % 3).alias("kind"))
    paths = []
    for kind, columns in enumerate((["id", "note"], ["note", "kind", "id"], ["id"])):
        paths.append(scratch_path(d.spark, "export"))
        rows.where(F.col("kind") == kind).select(*columns).write.option("header", True).option("sep", ";").option("escape", '"').csv(paths[-1])
    return paths


@query("export_with_quoted_line_ends", f"SELECT id, note FROM ({_NOTES}) t WHERE kind < 2")
def export_with_quoted_line_ends(d: Data) -> DataFrame:
    return tables.read_strings(d.spark, _exports(d)[:2], ["id", "note"], sep=";", encoding="UTF-8")


@query("export_rejected_rows", f"SELECT CASE WHEN kind < 2 THEN id END AS id, CASE WHEN kind < 2 THEN note END AS note, CASE WHEN kind = 2 THEN id END AS rejected FROM ({_NOTES}) t")
def export_rejected_rows(d: Data) -> DataFrame:
    rows = delimited.read_delimited(d.spark, _exports(d), ["id", "note"], ";", incomplete="reject")
    good, rejected = delimited.good_and_rejected(rows)
    return good.withColumn("rejected", F.lit(None).cast("string")).unionByName(rejected.withColumnRenamed(delimited.CORRUPT, "rejected"))
