"""Views over the driver tables in the shape the jobs expect.

The text is common to Spark SQL and DuckDB, so both sides of a comparison start from the same rows. Codes and boxes are
made up. ``{name}`` stands for a table.
"""

from __future__ import annotations

import re

SITES = """
SELECT c_custkey AS row_id,
  CASE WHEN c_custkey % 50 <> 49 THEN CAST(c_custkey AS STRING) END AS ID_SITE,
  CAST(c_custkey AS STRING) AS NU_CNT, c_name AS NOM_SITE, c_mktsegment AS NOM_CLI,
  CASE WHEN c_custkey % 10 = 9 THEN '0' ELSE ' 1' END AS STOCK,
  CASE WHEN c_custkey % 11 = 0 THEN '2020-01-01' END AS DT_EFF_RESIL_CNT,
  CASE c_nationkey % 5 WHEN 0 THEN 'FRANCE' WHEN 1 THEN ' belgique ' WHEN 2 THEN NULL WHEN 3 THEN 'france' ELSE 'ATLANTIS' END AS PAYS_SITE,
  CASE c_custkey % 8 WHEN 3 THEN NULL WHEN 5 THEN '  '
    ELSE lpad(CAST((c_custkey * 7) % 100 AS STRING), 2, '0') || lpad(CAST((c_custkey * 31) % 1000 AS STRING), 3, '0') END AS CP_SITE,
  CASE c_custkey % 7 WHEN 0 THEN NULL ELSE c_mktsegment END AS VILLE_SITE,
  CASE c_custkey % 6 WHEN 0 THEN CAST(c_custkey % 50 AS STRING) END AS NUM_VOIE_SITE,
  CASE c_custkey % 7 WHEN 1 THEN 'Grand Place' END AS RUE_SITE,
  CAST(NULL AS STRING) AS NUM_RUE_SITE,
  CASE c_custkey % 9 WHEN 4 THEN 'Le Bourg' END AS LIEU_DIT_SITE,
  CASE c_custkey % 5
    WHEN 1 THEN CAST(1 + c_custkey % 120 AS STRING) || ' rue des Arts, ' || lpad(CAST((c_custkey * 7) % 100 AS STRING), 2, '0') || '123 Lille'
    WHEN 2 THEN 'rue sans plaque' WHEN 3 THEN '   ' WHEN 4 THEN chr(9) || '12 quai Est' END AS ADRESSE_SITE,
  CASE c_custkey % 16 WHEN 0 THEN NULL WHEN 2 THEN ' ' WHEN 3 THEN 'abc' WHEN 4 THEN '200'
    WHEN 5 THEN CAST(43 + c_custkey % 8 AS STRING) || '.25' WHEN 6 THEN '-30.5'
    WHEN 7 THEN CAST(c_custkey % 7 AS STRING) || ',75' WHEN 9 THEN '-' || CAST(3 + c_custkey % 5 AS STRING) || '.5'
    ELSE CAST((c_custkey * 37) % 9 AS STRING) || '.' || CAST(1 + c_custkey % 9 AS STRING) END AS COORD_X_SITE,
  CASE c_custkey % 16 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 5 THEN CAST((c_custkey * 37) % 9 AS STRING) || '.5'
    ELSE CAST(43 + (c_custkey * 53) % 8 AS STRING) || '.' || CAST(1 + (c_custkey * 3) % 9 AS STRING) END AS COORD_Y_SITE,
  CAST(NULL AS STRING) AS QUALITE_GEOCODAGE,
  CASE WHEN c_custkey % 13 > 2 THEN CAST((c_custkey * 17) % 1000 AS STRING) END AS CAPITAUX_MURS_BATIMENTS,
  CASE WHEN c_custkey % 13 = 1 THEN '0' END AS CAPITAUX_CONTENU,
  CAST(NULL AS STRING) AS CAPITAUX_MATERIEL, CAST(NULL AS STRING) AS CAPITAUX_MARCHANDISES,
  CASE WHEN c_custkey % 17 = 0 THEN 'n/c' END AS CAPITAUX_TT, CAST(NULL AS STRING) AS CAPITAUX_ASS_MH_HLL_CARAV,
  CAST(NULL AS STRING) AS CAPITAUX_DEPENDANCE, CAST(NULL AS STRING) AS CAPITAUX_COMPL, CAST(NULL AS STRING) AS CAPITAUX_DD,
  CASE WHEN c_custkey % 19 = 0 THEN '12.5' END AS SURFACE, CAST(NULL AS STRING) AS SURFACE_DPDCE
FROM {customer}
"""

CONTRACTS = """
SELECT CAST(o_custkey AS STRING) AS NOPOL, o_orderpriority AS PTGST,
  CASE o_orderstatus WHEN 'O' THEN ' 1 ' ELSE '3' END AS CDSITP, o_orderkey AS ordinal
FROM {orders}
"""

COUNTRY_BOXES = """
SELECT n_country AS country, CAST(a AS DOUBLE) AS lon_min, CAST(b AS DOUBLE) AS lat_min, CAST(c AS DOUBLE) AS lon_max, CAST(d AS DOUBLE) AS lat_max
FROM (SELECT DISTINCT CASE n_regionkey % 2 WHEN 0 THEN 'FRANCE' ELSE 'BELGIQUE' END AS n_country,
        CASE n_regionkey % 2 WHEN 0 THEN -5 ELSE 2 END AS a, CASE n_regionkey % 2 WHEN 0 THEN 42 ELSE 49 END AS b,
        CASE n_regionkey % 2 WHEN 0 THEN 9 ELSE 6 END AS c, CASE n_regionkey % 2 WHEN 0 THEN 51 ELSE 52 END AS d FROM {nation}) t
"""

REGION_BOXES = """
SELECT CASE WHEN n % 10 = 9 THEN 'ELBONIA' ELSE 'FRANCE' END AS country, lpad(CAST(n AS STRING), 2, '0') AS region_code, CAST(n % 7 - 3 AS DOUBLE) AS lon_min, CAST(42 AS DOUBLE) AS lat_min,
  CAST(n % 7 + 4 AS DOUBLE) AS lon_max, CAST(44 + n % 9 AS DOUBLE) AS lat_max
FROM (SELECT DISTINCT c_custkey % 100 AS n FROM {customer}) t
"""

POLICIES = """
SELECT CAST(o_orderkey AS STRING) AS policy_no, o_orderkey AS order_key, o_orderpriority AS product,
  CAST(o_custkey % 50 AS STRING) AS intermediary, CAST(o_custkey AS STRING) AS client_no,
  CASE o_orderkey % 2 WHEN 0 THEN '1' ELSE '3' END AS network,
  CASE o_custkey % 5 WHEN 0 THEN 'B' ELSE 'A' END AS market, CASE o_custkey % 4 WHEN 0 THEN 's2' ELSE 's1' END AS segment,
  CASE o_orderkey % 8 WHEN 7 THEN NULL ELSE CAST(o_orderkey % 8 AS STRING) END AS sub_segment,
  CASE o_orderkey % 6 WHEN 0 THEN 'N1' WHEN 1 THEN 'N2' WHEN 2 THEN 'N3' WHEN 3 THEN 'N4' WHEN 4 THEN 'N1' ELSE 'N9' END AS nature,
  CASE o_orderstatus WHEN 'O' THEN '1' WHEN 'F' THEN '3' ELSE '4' END AS status,
  CASE o_orderkey % 31 WHEN 0 THEN 'X' WHEN 1 THEN NULL ELSE 'N' END AS risk_class,
  CASE WHEN o_orderkey % 37 <> 0 THEN CAST(o_orderdate AS DATE) END AS created,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) END AS effective_new,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INT) END AS processed_new,
  CASE WHEN o_orderstatus = 'F' THEN CAST(shipped AS DATE) END AS cancelled,
  CASE WHEN o_orderstatus = 'F' THEN CAST(shipped AS DATE) + CAST(o_orderkey % 60 AS INT) END AS processed_cancel,
  CASE o_orderkey % 11 WHEN 0 THEN 'SB' WHEN 1 THEN 'BS' ELSE 'ZZ' END AS link_type_1,
  CASE o_orderkey % 13 WHEN 0 THEN 'SB' WHEN 1 THEN 'BS' END AS link_type_2, CAST(NULL AS STRING) AS link_type_3,
  CAST(o_orderdate AS DATE) AS link_date_1, CAST(shipped AS DATE) AS link_date_2, CAST(NULL AS DATE) AS link_date_3,
  CASE o_orderkey % 17 WHEN 0 THEN 'V' ELSE 'A' END AS cancel_reason, CASE o_orderkey % 19 WHEN 0 THEN '9Q' END AS cancel_case,
  lpad(CAST(1 + o_orderkey % 12 AS STRING), 2, '0') || lpad(CAST(1 + o_orderkey % 31 AS STRING), 2, '0') AS anniversary_mmdd,
  o_totalprice AS premium, CASE o_orderkey % 4 WHEN 0 THEN NULL ELSE CAST((o_orderkey % 4) * 10 AS DOUBLE) END AS ceded_pct,
  CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DOUBLE) ELSE CAST(40 AS DOUBLE) END AS share_pct,
  CASE o_orderkey % 5 WHEN 0 THEN '1' WHEN 1 THEN NULL ELSE '0' END AS coins_flag, CAST(o_orderkey % 9 AS STRING) AS coins_code,
  CASE o_orderkey % 4 WHEN 1 THEN '1' END AS revision_flag, CAST(20 + o_orderkey % 5 AS STRING) AS revision_code,
  CAST(o_custkey % 1000 AS DOUBLE) AS turnover, CASE o_orderkey % 3 WHEN 1 THEN CAST(o_orderkey % 500 AS DOUBLE) END AS turnover_2,
  CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 4 END AS duration, CASE o_orderkey % 3 WHEN 0 THEN 'QA' ELSE 'QZ' END AS risk_type,
  CASE o_orderkey % 10 WHEN 0 THEN 'O' END AS offer_flag, o_clerk_point AS mgmt_point,
  CASE o_orderkey % 6 WHEN 0 THEN 'town house' WHEN 1 THEN 'Central desk' WHEN 2 THEN '41' WHEN 3 THEN 'north depot' WHEN 4 THEN NULL ELSE 'bridge' END AS destination_text,
  CASE o_orderkey % 9 WHEN 0 THEN 'cottage' WHEN 1 THEN 'main works' END AS work_text, CAST(o_orderkey % 30 AS STRING) AS activity
FROM (SELECT o.*, 'P' || substr(o_orderpriority, 1, 1) AS o_clerk_point FROM {orders} o) o
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM {lineitem} GROUP BY l_orderkey) l ON l_orderkey = o_orderkey
"""

LEGACY = """
SELECT CAST(o_orderkey AS STRING) AS policy, CASE o_orderkey % 6 WHEN 0 THEN 'L00' WHEN 1 THEN 'L01' WHEN 2 THEN 'L02' ELSE o_orderpriority END AS product,
  CASE o_orderstatus WHEN 'O' THEN 'E' WHEN 'F' THEN 'R' ELSE 'X' END AS state,
  CAST(o_orderdate AS DATE) AS effective, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 70 AS INT) END AS new_date,
  CASE WHEN o_orderstatus <> 'O' THEN CASE WHEN o_orderkey % 41 = 0 THEN CAST(o_orderdate AS DATE) ELSE CAST(shipped AS DATE) END END AS end,
  CASE WHEN o_orderstatus = 'F' THEN CAST(shipped AS DATE) + CAST(o_orderkey % 30 AS INT) END AS cancelled,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) + 365 END AS term, CAST(o_orderdate AS DATE) + 90 AS expiry,
  CASE WHEN o_orderkey % 8 = 3 THEN CAST(o_orderdate AS DATE) + 200 END AS final_end,
  CASE o_orderkey % 5 WHEN 0 THEN '00' WHEN 1 THEN '01' WHEN 2 THEN ' ' ELSE '05' END AS duration_code,
  CAST(o_custkey % 40 AS STRING) AS intermediary, substr(o_orderpriority, 1, 1) AS mgmt_point, o_totalprice AS premium,
  CAST(50 + o_orderkey % 50 AS DOUBLE) AS share_pct, CASE o_orderkey % 7 WHEN 0 THEN 'K1' WHEN 1 THEN 'K2' ELSE 'ZZ' END AS cancel_reason,
  CASE o_orderkey % 4 WHEN 0 THEN 'Y1' WHEN 1 THEN 'Y3' ELSE 'QQ' END AS cancel_origin,
  CASE o_orderkey % 3 WHEN 1 THEN 'N1' ELSE '' END AS replaced_by, CASE o_orderkey % 23 WHEN 0 THEN 'MIG' END AS site_state,
  CAST(o_orderdate AS DATE) AS anniversary, CASE o_custkey % 5 WHEN 0 THEN 'B' ELSE 'A' END AS market, 's1' AS segment, CAST(o_orderkey % 8 AS STRING) AS sub_segment
FROM {orders}
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM {lineitem} GROUP BY l_orderkey) l ON l_orderkey = o_orderkey
"""

CAPITAL_LINES = """
SELECT CAST(l_orderkey AS STRING) AS policy, CASE l_orderkey % 3 WHEN 0 THEN 'L00' ELSE 'L01' END AS product, l_returnflag AS kind,
  l_linestatus AS branch, CASE WHEN l_linenumber <> 5 THEN CAST(l_extendedprice AS DECIMAL(18, 2)) END AS amount_full,
  CAST(l_quantity AS DECIMAL(18, 2)) AS amount_company,
  CASE WHEN l_linenumber <> 3 THEN CAST(l_extendedprice AS DECIMAL(18, 2)) END AS loss, CAST(l_quantity AS DECIMAL(18, 2)) AS direct
FROM {lineitem}
"""

PREMIUM_DETAIL = """
SELECT CASE l_suppkey % 4 WHEN 0 THEN 'DA' WHEN 1 THEN 'DP' WHEN 2 THEN 'BK' ELSE 'ZZ' END AS level, CAST(o_custkey % 50 AS STRING) AS intermediary,
  CAST(l_orderkey AS STRING) AS policy_no, o_orderpriority AS product,
  CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING) AS accounting_period,
  CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount, CAST(l_tax AS DECIMAL(18, 2)) AS commission,
  CAST(700 + l_linenumber AS STRING) AS category, l_returnflag AS main_guarantee, 'G' || l_linestatus || CAST(100 + l_partkey % 7 AS STRING) AS guarantee,
  ' ' || CAST(year(o_orderdate) AS STRING) AS attached_year, CASE o_custkey % 6 WHEN 0 THEN 'B' ELSE 'A' END AS market
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
"""

SEGMENTS = """
SELECT DISTINCT o_orderpriority AS product, CASE o_orderkey % 2 WHEN 0 THEN '1' ELSE '3' END AS network,
  CASE substr(o_orderpriority, 1, 1) WHEN '5' THEN 'B' ELSE 'A' END AS market, 'g' || substr(o_orderpriority, 1, 1) AS segment,
  'u' || substr(o_orderpriority, 3, 1) AS sub_segment, 'T' || substr(o_orderpriority, 1, 1) AS product_type
FROM {orders}
"""

# One row per occupied slot of a policy: lines that share a number are reduced to the largest values.
GROUP_ROWS = """
SELECT policy_no, pos, CASE pos WHEN 7 THEN 'GLOBAL LIMIT A' WHEN 1 THEN 'MAX LOSS KEPT' WHEN 2 THEN 'DIRECT RISK' WHEN 3 THEN 'MAX LOSS DIRECT RISK'
    WHEN 4 THEN 'LOSS OF INCOME' WHEN 5 THEN 'GLOBAL LIMIT B' END AS label, amount,
  CASE part_no % 4 WHEN 0 THEN NULL WHEN 1 THEN '01' WHEN 2 THEN '02' ELSE '11' END AS nature, coef
FROM (SELECT CAST(l_orderkey AS STRING) AS policy_no, l_linenumber AS pos, max(CASE WHEN l_partkey % 10 <> 0 THEN l_extendedprice END) AS amount,
        max(l_partkey) AS part_no, max(l_discount) + 1 AS coef FROM {lineitem} GROUP BY l_orderkey, l_linenumber) t
"""

CORPUS = """
SELECT 'docs' AS root, source || '/' || lang || '/' || CAST(doc_id AS STRING) || CASE doc_id % 4 WHEN 0 THEN '.txt' WHEN 1 THEN '.tar.gz' WHEN 2 THEN '' ELSE '.md' END AS path,
  CAST({bytes}(text) AS BIGINT) AS size, text AS content
FROM {documents}
"""

INDEX_VALUES = """
SELECT nature, index_date, CAST(100 + ((y - 1990) * 12 + m) % 37 + f AS DOUBLE) AS index_value
FROM (SELECT DISTINCT '0' || CAST(1 + o_orderkey % 2 AS STRING) AS nature, CAST(o_orderdate AS DATE) AS index_date, year(o_orderdate) AS y,
        month(o_orderdate) AS m, o_orderkey % 2 AS f FROM {orders}) t
"""

VIEWS = {
    "sites": SITES, "contracts": CONTRACTS, "country_boxes": COUNTRY_BOXES, "region_boxes": REGION_BOXES, "policies": POLICIES,
    "legacy": LEGACY, "capital_lines": CAPITAL_LINES, "premium_detail": PREMIUM_DETAIL, "segments": SEGMENTS,
    "group_rows": GROUP_ROWS, "corpus": CORPUS, "index_values": INDEX_VALUES,
}


def placeholders(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)) - {"bytes"})


def duckdb_text(name: str) -> str:
    """The view as a parenthesised DuckDB sub-query."""
    text = VIEWS[name]
    return "(" + text.format(**{t: t for t in placeholders(text)}, bytes="strlen").strip() + ")"
