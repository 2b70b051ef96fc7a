"""Site quality on customers (as sites) and orders (as contracts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import geo, text
from gristmill.operators.dedup import site_key
from gristmill.plans import quality, site_exhaustive, site_rules, site_severity
from gristmill.plans.city_check import city_check
from gristmill.queries.base import Data, query
from gristmill.sources import references

# Whitespace that both engines strip in these tables.
_TRIM = "trim({}, ' ' || chr(9))"


def _t(c: str) -> str:
    return _TRIM.format(c)


_NUM = "try_cast(replace({0}, ',', '.') AS DOUBLE)"
_X, _Y = _NUM.format(_t("COORD_X_SITE")), _NUM.format(_t("COORD_Y_SITE"))
_HAS_X, _HAS_Y = f"coalesce({_t('COORD_X_SITE')}, '') <> ''", f"coalesce({_t('COORD_Y_SITE')}, '') <> ''"
_ADDRESS_POSTAL = r"regexp_extract(coalesce(ADRESSE_SITE, ''), '\b(\d{5})\b', 1)"


def _department(code: str) -> str:
    five = f"CASE WHEN length({code}) < 5 THEN lpad({code}, 5, '0') ELSE {code} END"
    return (
        f"CASE WHEN substr({five}, 1, 3) IN ('971','972','973','974','976') THEN substr({five}, 1, 3) "
        f"WHEN substr({five}, 1, 2) = '20' THEN CASE WHEN substr({five}, 3, 1) IN ('0','1','2') THEN '2A' ELSE '2B' END "
        f"ELSE substr({five}, 1, 2) END"
    )


def _context(source: str, use_address: bool = True) -> str:
    postal = f"coalesce(nullif({_t('CP_SITE')}, ''), {_ADDRESS_POSTAL})" if use_address else f"coalesce({_t('CP_SITE')}, '')"
    return f"""
    ctx0 AS (SELECT s.*, upper(coalesce({_t('PAYS_SITE')}, '')) AS cn, {postal} AS po, {_HAS_X} AS hx, {_HAS_Y} AS hy,
        CASE WHEN {_X} BETWEEN -180 AND 180 THEN {_X} END AS x, CASE WHEN {_Y} BETWEEN -90 AND 90 THEN {_Y} END AS y FROM {source} s),
    ctx1 AS (SELECT *, CASE WHEN po = '' OR cn <> 'FRANCE' THEN '' ELSE {_department('po')} END AS rg FROM ctx0),
    ctx AS (SELECT c.*, b.country IS NOT NULL AS boxed, b.lon_min AS b1, b.lat_min AS b2, b.lon_max AS b3, b.lat_max AS b4,
        r.country IS NOT NULL AS split, r.lon_min AS r1, r.lat_min AS r2, r.lon_max AS r3, r.lat_max AS r4
      FROM ctx1 c LEFT JOIN @country_boxes b ON b.country = cn LEFT JOIN @region_boxes r ON r.country = cn AND r.region_code = rg)"""


_FILLED = " OR ".join(f"coalesce({_t(c)}, '') <> ''" for c in site_rules.ADDRESS_FIELDS)
_NUMBERED = f"(coalesce({_t('NUM_VOIE_SITE')}, '') <> '' OR regexp_extract(coalesce({_t('ADRESSE_SITE')}, ''), '^(\\d{{1,4}})\\s', 1) <> '')"
_GPS = """CASE WHEN NOT (hx AND hy) THEN CASE WHEN hx OR hy THEN 'G-02' END WHEN x IS NULL OR y IS NULL THEN 'G-03'
  WHEN NOT (x BETWEEN b1 AND b3 AND y BETWEEN b2 AND b4) THEN CASE WHEN y BETWEEN b1 AND b3 AND x BETWEEN b2 AND b4 THEN 'G-06' ELSE 'G-04' END
  WHEN po = '' THEN 'P-02' WHEN split AND NOT (x BETWEEN r1 AND r3 AND y BETWEEN r2 AND r4) THEN 'G-05' END"""
_KEY = """CASE WHEN coalesce(NU_CNT,'') <> '' AND coalesce(ID_SITE,'') <> '' THEN NU_CNT || '::' || ID_SITE
  WHEN coalesce(NU_CNT,'') <> '' THEN NU_CNT || '::ROW_' || row_id WHEN coalesce(ID_SITE,'') <> '' THEN 'NO_CONTRACT::' || ID_SITE ELSE 'ROW_' || row_id END"""
_ACTIVE = """act AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY NOPOL ORDER BY ordinal) AS rn FROM @contracts c WHERE trim(CDSITP) = '1') t WHERE rn = 1),
    src AS (SELECT s.*, a.PTGST FROM @sites s JOIN act a ON a.NOPOL = s.NU_CNT)"""
_SUPPORTED = f"""sup AS (SELECT * REPLACE (CASE WHEN coalesce({_t('PAYS_SITE')}, '') = '' THEN 'FRANCE' ELSE PAYS_SITE END AS PAYS_SITE) FROM src),
    kept AS (SELECT * FROM sup WHERE upper({_t('PAYS_SITE')}) IN ('FRANCE', 'BELGIQUE'))"""
_EVAL = f"""gate AS (SELECT *, CASE WHEN cn = '' THEN 'P-01' WHEN NOT boxed THEN 'R-01' END AS c0 FROM ctx),
    gps AS (SELECT *, CASE WHEN c0 IS NULL THEN {_GPS} END AS c1 FROM gate),
    adr AS (SELECT *, c0 IS NULL AND hx AND hy AND c1 IS NULL AS ok FROM gps),
    ev AS (SELECT *, {_KEY} AS site_key, CASE WHEN c0 IS NULL AND NOT ok THEN CASE WHEN NOT ({_FILLED}) THEN 'A-01' WHEN NOT {_NUMBERED} THEN 'A-02' END END AS c2 FROM adr),
    evaluated AS (SELECT *, concat_ws(', ', c0, c1, c2) AS codes,
      CASE WHEN ok THEN 'GPS_OK' WHEN c0 IS NULL AND c2 IS NULL THEN 'ADRESSE_OK' ELSE 'INCOMPLET' END AS mode FROM ev)"""
SUPPORTED = ["FRANCE", "BELGIQUE"]


def _all(use: str = "@sites") -> str:
    return f"WITH {_context(use)}, {_EVAL}"


_RUN = f"WITH {_ACTIVE}, {_SUPPORTED}, {_context('kept')}, {_EVAL}"


def _labels_sql(code: str) -> str:
    whens = " ".join(f"WHEN '{c}' THEN '{label}'" for c, label in site_rules.LABELS.items())
    return f"CASE {code} {whens} END"


def evaluated(d: Data) -> DataFrame:
    return site_rules.evaluate_sites(d.sites, d.country_boxes, d.region_boxes)


def active(d: Data) -> DataFrame:
    return site_rules.join_active(d.sites, d.contracts, ["ordinal"])


def checked(d: Data) -> DataFrame:
    return site_rules.evaluate_sites(site_rules.country_filter(active(d), SUPPORTED), d.country_boxes, d.region_boxes)


# --- scalar functions ------------------------------------------------------------------------------------------

@query("site_text_cleanup", f"""
SELECT row_id, coalesce({_t('CP_SITE')}, '') = '' AS postal_empty, coalesce({_t('ADRESSE_SITE')}, '') AS address,
  lower(coalesce({_t('PAYS_SITE')}, '')) AS country_lower, upper(coalesce({_t('PAYS_SITE')}, '')) AS country_upper,
  coalesce(nullif({_t('CP_SITE')}, ''), NOM_CLI) AS postal_or_client, {_ADDRESS_POSTAL} AS address_postal,
  regexp_extract(coalesce({_t('ADRESSE_SITE')}, ''), '^(\\d{{1,4}})\\s', 1) AS street_no FROM @sites s""")
def site_text_cleanup(d: Data) -> DataFrame:
    return d.sites.select(
        "row_id", text.is_empty(F.col("CP_SITE")).alias("postal_empty"), text.safe_str(F.col("ADRESSE_SITE")).alias("address"),
        text.normalize_string(F.col("PAYS_SITE")).alias("country_lower"), text.normalize_country(F.col("PAYS_SITE")).alias("country_upper"),
        text.coalesce_blank(F.col("CP_SITE"), F.col("NOM_CLI")).alias("postal_or_client"),
        text.extract_postal(F.col("ADRESSE_SITE")).alias("address_postal"), text.extract_street_no(F.col("ADRESSE_SITE")).alias("street_no"),
    )


@query("site_codes_normalised", f"""
SELECT row_id, CASE WHEN regexp_full_match(p, '\\d+') AND length(p) < 7 THEN lpad(p, 7, '0') ELSE p END AS postal7,
  regexp_replace(NU_CNT || CASE WHEN row_id % 3 = 0 THEN '.0' ELSE '' END, '^(\\d+)\\.0$', '\\1') AS contract
FROM (SELECT *, upper(replace(replace(coalesce({_t('CP_SITE')}, ''), ' ', ''), '-', '')) AS p FROM @sites s) t""")
def site_codes_normalised(d: Data) -> DataFrame:
    noisy = F.concat("NU_CNT", F.when(F.col("row_id") % 3 == 0, ".0").otherwise(""))
    return d.sites.select("row_id", text.normalize_postal(F.col("CP_SITE"), 7).alias("postal7"), text.norm_key(noisy).alias("contract"))


@query("site_coordinates", f"""
SELECT row_id, CASE WHEN {_X} BETWEEN -180 AND 180 THEN {_X} END AS lon, CASE WHEN {_Y} BETWEEN -90 AND 90 THEN {_Y} END AS lat FROM @sites s""")
def site_coordinates(d: Data) -> DataFrame:
    return d.sites.select(
        "row_id", text.parse_coordinate(F.col("COORD_X_SITE"), -180, 180).alias("lon"), text.parse_coordinate(F.col("COORD_Y_SITE"), -90, 90).alias("lat")
    )


@query("site_departments", f"""
SELECT row_id, {_department(f"coalesce({_t('CP_SITE')}, '')")} AS department,
  CASE WHEN upper(coalesce({_t('PAYS_SITE')}, '')) = 'FRANCE' THEN {_department(f"coalesce({_t('CP_SITE')}, '')")} ELSE '' END AS region FROM @sites s""")
def site_departments(d: Data) -> DataFrame:
    return d.sites.select(
        "row_id", geo.department(F.col("CP_SITE")).alias("department"), geo.region_code(F.col("PAYS_SITE"), F.col("CP_SITE")).alias("region")
    )


@query("site_in_box", f"""WITH {_context('@sites')}
SELECT row_id, x BETWEEN b1 AND b3 AND y BETWEEN b2 AND b4 AS in_country FROM ctx WHERE boxed AND x IS NOT NULL AND y IS NOT NULL""")
def site_in_box(d: Data) -> DataFrame:
    rows = site_rules.with_context(d.sites, d.country_boxes, d.region_boxes)
    usable = rows.filter("country_box IS NOT NULL AND _lon IS NOT NULL AND _lat IS NOT NULL")
    return usable.select("row_id", geo.in_bbox(F.col("_lon"), F.col("_lat"), F.col("country_box")).alias("in_country"))


@query("labels_grouped_thousands", """
SELECT o_orderkey, replace(format('{:,}', CAST(floor(o_totalprice) AS BIGINT)), ',', ' ') AS amount_text,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'x' END AS letter FROM orders""")
def labels_grouped_thousands(d: Data) -> DataFrame:
    return d.orders.select(
        "o_orderkey", text.group_thousands(F.floor("o_totalprice")).alias("amount_text"), F.when(F.col("o_orderkey") % 5 != 0, "x").alias("letter")
    )


# --- selection -------------------------------------------------------------------------------------------------

@query("sites_active_contracts", f"WITH {_ACTIVE} SELECT row_id, NU_CNT, PTGST FROM src")
def sites_active_contracts(d: Data) -> DataFrame:
    return active(d).select("row_id", "NU_CNT", "PTGST")


@query("sites_active_stock", f"SELECT row_id, NU_CNT FROM @sites s WHERE trim(STOCK) = '1' AND coalesce({_t('DT_EFF_RESIL_CNT')}, '') = ''")
def sites_active_stock(d: Data) -> DataFrame:
    return site_rules.active_sites(d.sites).select("row_id", "NU_CNT")


@query("sites_supported_country", f"WITH src AS (SELECT * FROM @sites s), {_SUPPORTED} SELECT row_id, PAYS_SITE FROM kept")
def sites_supported_country(d: Data) -> DataFrame:
    return site_rules.country_filter(d.sites, SUPPORTED).select("row_id", "PAYS_SITE")


@query("sites_one_country", f"SELECT row_id, PAYS_SITE FROM @sites s WHERE upper({_t('PAYS_SITE')}) = 'BELGIQUE'")
def sites_one_country(d: Data) -> DataFrame:
    return site_rules.filter_country(d.sites, [" Belgique", ""]).select("row_id", "PAYS_SITE")


@query("sites_keys", f"SELECT row_id, {_KEY} AS site_key FROM @sites s")
def sites_keys(d: Data) -> DataFrame:
    return d.sites.select("row_id", site_key("NU_CNT", "ID_SITE", "row_id").alias("site_key"))


@query("sites_retention", f"""WITH {_ACTIVE} SELECT b AS n_before, a AS n_after, round(a * 100.0 / nullif(b, 0), 2) AS pct_kept
FROM (SELECT (SELECT count(*) FROM @sites s) AS b, (SELECT count(*) FROM src) AS a) t""")
def sites_retention(d: Data) -> DataFrame:
    return quality.retention(d.sites, active(d))


# --- evaluation ------------------------------------------------------------------------------------------------

@query("site_country_gate", f"{_all()} SELECT row_id, c0 AS code FROM evaluated")
def site_country_gate(d: Data) -> DataFrame:
    rows = site_rules.with_context(d.sites, d.country_boxes, d.region_boxes)
    return rows.select("row_id", site_rules.country_gate().alias("code"))


@query("site_gps_gate", f"{_all()} SELECT row_id, c1 AS code FROM evaluated WHERE c0 IS NULL")
def site_gps_gate(d: Data) -> DataFrame:
    rows = site_rules.with_context(d.sites, d.country_boxes, d.region_boxes).filter(site_rules.country_gate().isNull())
    return rows.select("row_id", site_rules.gps_gate().alias("code"))


@query("site_address_gate", f"SELECT row_id, CASE WHEN NOT ({_FILLED}) THEN 'A-01' WHEN NOT {_NUMBERED} THEN 'A-02' END AS code FROM @sites s")
def site_address_gate(d: Data) -> DataFrame:
    return d.sites.select("row_id", site_rules.address_gate().alias("code"))


@query("site_evaluation", f"""{_all()} SELECT row_id, site_key, mode, codes,
  len(list_filter([c0, c1, c2], lambda x: x IS NOT NULL)) AS n_issues,
  concat_ws(' | ', {_labels_sql('c0')}, {_labels_sql('c1')}, {_labels_sql('c2')}) AS labels FROM evaluated""")
def site_evaluation(d: Data) -> DataFrame:
    return evaluated(d).select(
        "row_id", F.col("_SITE_KEY").alias("site_key"), F.col("_CONTROL_MODE").alias("mode"), F.col("_ISSUE_CODES").alias("codes"),
        F.col("_ISSUE_COUNT").cast("bigint").alias("n_issues"), F.col("_ISSUE_SUMMARY").alias("labels"),
    )


def _case(on: str, texts: dict[str, tuple], i: int) -> str:
    return f"CASE {on} " + " ".join(f"WHEN '{code}' THEN {values[i]}" for code, values in texts.items()) + " END"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LON, _LAT = "CAST(x AS VARCHAR)", "CAST(y AS VARCHAR)"
_XY_FIELDS = "COORD_X_SITE, COORD_Y_SITE"
_POINT = f"'X=' || {_LON} || ', Y=' || {_LAT}"
_RAW_POINT = "'X=' || coalesce(COORD_X_SITE, 'nan') || ', Y=' || coalesce(COORD_Y_SITE, 'nan')"
# Category, description, fields, value and suggestion of each code, as SQL.
_TEXTS = {
    code: (_quoted(category), description, _quoted(fields), value, _quoted(suggestion)) for code, category, description, fields, value, suggestion in [
        ("P-01", "pays", _quoted("Le pays n'est pas renseigné."), "PAYS_SITE", "''", "Renseigner le pays."),
        ("R-01", "pays", "'Le pays ''' || cn || ''' n''est pas présent dans le référentiel.'", "PAYS_SITE", "'Pays=' || cn", ""),
        ("G-02", "gps", _quoted("Une seule coordonnée GPS renseignée (X ou Y manquant)."), _XY_FIELDS, _RAW_POINT, "Compléter la coordonnée manquante."),
        ("G-03", "gps", _quoted("Les coordonnées GPS ne sont pas valides (non numériques ou hors limites)."), _XY_FIELDS, _RAW_POINT, "Vérifier et corriger les coordonnées GPS."),
        ("G-06", "gps", f"'GPS (' || {_LON} || ', ' || {_LAT} || ') hors ' || cn || ', mais (' || {_LAT} || ', ' || {_LON} || ') y est — coordonnées probablement inversées.'", _XY_FIELDS, _POINT, "Inverser X et Y."),
        ("G-04", "gps", f"'GPS (' || {_LON} || ', ' || {_LAT} || ') situé hors de ' || cn || '.'", f"{_XY_FIELDS}, PAYS_SITE", f"{_POINT} || ', Pays=' || cn", "Vérifier les coordonnées GPS."),
        ("P-02", "adresse", _quoted("Le GPS est dans le pays mais le code postal est absent."), "CP_SITE", "''", "Renseigner le code postal."),
        ("G-05", "gps", f"'GPS (' || {_LON} || ', ' || {_LAT} || ') incohérent avec le code postal ' || po || ' (département ' || rg || ').'", f"{_XY_FIELDS}, CP_SITE", f"{_POINT} || ', CP=' || po",
            "Vérifier la cohérence entre GPS et code postal."),
        ("A-01", "adresse", _quoted("Aucune information d'adresse renseignée."), ", ".join(site_rules.ADDRESS_FIELDS), "''", "Renseigner l'adresse du site."),
        ("A-02", "adresse", _quoted("L'adresse est renseignée mais le numéro de rue est absent."), "NUM_VOIE_SITE, ADRESSE_SITE", "''", "Ajouter le numéro de rue."),
    ]
}
_DETAIL_COLUMNS = {"category": "CATEGORIE", "description": "DESCRIPTION", "fields": "CHAMPS_CONCERNES", "found": "VALEUR_ACTUELLE", "suggestion": "SUGGESTION"}


@query("site_evaluation_details", f"""{_all()} SELECT row_id, code, {_labels_sql('code')} AS label, {', '.join(f"{_case('code', _TEXTS, i)} AS {n}" for i, n in enumerate(_DETAIL_COLUMNS))}
FROM (SELECT *, unnest([c0, c1, c2]) AS code FROM evaluated) t WHERE code IS NOT NULL""")
def site_evaluation_details(d: Data) -> DataFrame:
    found = evaluated(d).select("row_id", F.inline("_ISSUE_DETAILS"))
    return found.select("row_id", F.col("CODE_ANOMALIE").alias("code"), F.col("LIBELLE").alias("label"), *[F.col(c).alias(n) for n, c in _DETAIL_COLUMNS.items()])


@query("site_evaluation_single", f"{_all()} SELECT row_id, coalesce(c0, c1, c2, '') AS codes FROM evaluated")
def site_evaluation_single(d: Data) -> DataFrame:
    rows = site_rules.evaluate_sites(d.sites, d.country_boxes, d.region_boxes, single_issue=True)
    return rows.select("row_id", F.col("_ISSUE_CODES").alias("codes"))


_STATS = """SELECT code, count(*) AS occurrences, round(count(*) * 100.0 / (SELECT count(*) FROM evaluated), 1) AS pct
FROM (SELECT unnest([c0, c1, c2]) AS code FROM evaluated) t WHERE code IS NOT NULL GROUP BY code"""


@query("site_issue_counts", f"{_RUN} {_STATS}")
def site_issue_counts(d: Data) -> DataFrame:
    return quality.issue_stats(checked(d)).select("code", "occurrences", "pct")


@query("site_issue_counts_all", f"{_all()} {_STATS}")
def site_issue_counts_all(d: Data) -> DataFrame:
    return quality.issue_stats(evaluated(d)).select("code", "occurrences", "pct")


@query("site_summary", f"""{_RUN} SELECT (SELECT count(*) FROM @sites s) AS n_total, (SELECT count(*) FROM @sites s) - (SELECT count(*) FROM src) AS n_inactive,
  count(*) AS n_analysed, count(*) FILTER (codes = '') AS n_ok, count(*) FILTER (mode = 'GPS_OK') AS n_gps_ok,
  count(*) FILTER (mode = 'ADRESSE_OK') AS n_address_ok, count(*) FILTER (codes <> '') AS n_with_issues FROM evaluated""")
def site_summary(d: Data) -> DataFrame:
    kept = active(d)
    rows = site_rules.evaluate_sites(site_rules.country_filter(kept, SUPPORTED), d.country_boxes, d.region_boxes)
    return quality.quality_summary(rows, d.sites, kept)


@query("site_stats_by_country", f"""{_all()} SELECT PAYS_SITE AS country, count(*) AS n_sites, count(*) FILTER (codes <> '') AS n_with_issues,
  count(*) FILTER (mode = 'GPS_OK') AS n_gps_ok, count(*) FILTER (mode = 'ADRESSE_OK') AS n_address_ok,
  count(*) FILTER (mode = 'INCOMPLET') AS n_incomplete FROM evaluated GROUP BY 1""")
def site_stats_by_country(d: Data) -> DataFrame:
    return quality.stats_by_country(evaluated(d))


@query("site_anomaly_detail", f"""{_all()} SELECT ID_SITE, NU_CNT, concat_ws(' | ', {_labels_sql('c0')}, {_labels_sql('c1')}, {_labels_sql('c2')}) AS labels,
  {_case('coalesce(c0, c1, c2)', _TEXTS, 1)} AS description FROM evaluated WHERE codes <> ''""")
def site_anomaly_detail(d: Data) -> DataFrame:
    return quality.anomaly_detail(evaluated(d)).select("ID_SITE", "NU_CNT", F.col("LIBELLE").alias("labels"), F.col("DESCRIPTION").alias("description"))


@query("site_run", f"{_RUN} SELECT row_id, site_key, mode, codes, PTGST FROM evaluated")
def site_run(d: Data) -> DataFrame:
    result = quality.run_quality(d.sites, d.contracts, d.country_boxes, d.region_boxes, SUPPORTED)["sites"]
    return result.select(
        "row_id", F.col("_SITE_KEY").alias("site_key"), F.col("_CONTROL_MODE").alias("mode"), F.col("_ISSUE_CODES").alias("codes"), "PTGST"
    )


# --- severity variant ------------------------------------------------------------------------------------------

_V1_ADDRESS = " OR ".join(f"coalesce({_t(c)}, '') <> ''" for c in [*site_severity.STREET_FIELDS, "LIEU_DIT_SITE"])
_V1_STREET = " OR ".join(f"coalesce({_t(c)}, '') <> ''" for c in site_severity.STREET_FIELDS)
_RANKS = " ".join(f"WHEN '{c}' THEN {site_severity.PRIORITIES.index(p)}" for c, (_, p) in site_severity.CATALOGUE.items())
_V1 = f"""WITH {_context('@sites', use_address=False)},
  v0 AS (SELECT *, hx AND hy AS bo, CASE WHEN cn <> '' AND hx AND hy AND x IS NOT NULL AND y IS NOT NULL AND boxed THEN x BETWEEN b1 AND b3 AND y BETWEEN b2 AND b4 END AS inside,
    ({_V1_ADDRESS}) AS adr, coalesce({_t('NUM_VOIE_SITE')}, '') <> '' AS num, ({_V1_STREET}) AS street,
    CASE WHEN cn = 'FRANCE' AND po <> '' THEN split END AS home FROM ctx),
  v1 AS (SELECT *, CASE WHEN inside AND po <> '' AND split THEN x BETWEEN r1 AND r3 AND y BETWEEN r2 AND r4 END AS fits FROM v0),
  v2 AS (SELECT *, CASE WHEN cn = '' THEN 'P-01' WHEN NOT bo THEN CASE WHEN hx OR hy THEN 'G-02' END WHEN x IS NULL OR y IS NULL THEN 'G-03'
    WHEN NOT boxed THEN 'R-01' WHEN NOT inside THEN 'G-04' WHEN po = '' THEN 'P-02' WHEN NOT fits THEN 'G-05' END AS c1 FROM v1),
  v3 AS (SELECT *, cn <> '' AND bo AND c1 IS NULL AS ok FROM v2),
  v4 AS (SELECT *, CASE WHEN cn <> '' AND NOT ok AND NOT adr THEN 'A-01' END AS c2, CASE WHEN cn <> '' AND NOT ok AND adr AND NOT num THEN 'A-02' END AS c3,
    CASE WHEN cn <> '' AND NOT ok AND adr AND NOT num AND street THEN 'A-03' END AS c4, CASE WHEN NOT home THEN 'D-01' END AS c5 FROM v3),
  v5 AS (SELECT *, concat_ws(', ', c1, c2, c3, c4, c5) AS codes, coalesce(list_max(list_transform([c1, c2, c3, c4, c5], lambda c: CASE c {_RANKS} END)), 0) AS rk FROM v4),
  sev AS (SELECT *, ['OK', 'FAIBLE', 'MOYENNE', 'HAUTE'][rk + 1] AS priority, ['OK', 'A_VERIFIER', 'A_COMPLETER', 'A_CORRIGER'][rk + 1] AS status,
    CASE WHEN ok THEN 'GPS_OK' WHEN cn <> '' AND adr AND num THEN 'ADRESSE_OK' ELSE 'INCOMPLET' END AS mode FROM v5)"""


def severity(d: Data) -> DataFrame:
    return site_severity.evaluate_sites_v1(d.sites, d.country_boxes, d.region_boxes)


@query("site_severity_evaluation", f"{_V1} SELECT row_id, mode, status, priority, codes FROM sev")
def site_severity_evaluation(d: Data) -> DataFrame:
    return severity(d).select(
        "row_id", F.col("_CONTROL_MODE").alias("mode"), F.col("_CONTROL_STATUS").alias("status"), F.col("_PRIORITY").alias("priority"),
        F.col("_ISSUE_CODES").alias("codes"),
    )


def _flag_text(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'none')"


@query("site_diagnostics", f"""{_V1} SELECT row_id, {_flag_text('hx OR hy')} AS has_gps, {_flag_text('inside')} AS in_country, {_flag_text('fits')} AS fits_postal,
  {_flag_text('adr')} AS has_address, {_flag_text('num')} AS has_number, rg AS department, {_flag_text('home')} AS department_ok FROM sev""")
def site_diagnostics(d: Data) -> DataFrame:
    names = {
        "_HAS_GPS": "has_gps", "_GPS_IN_COUNTRY": "in_country", "_GPS_MATCH_POSTAL_CODE": "fits_postal", "_ADDRESS_PRESENT": "has_address",
        "_STREET_NUMBER_PRESENT": "has_number", "_DEPARTMENT_COUNTRY_OK": "department_ok",
    }
    return severity(d).select(
        "row_id", *[F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(n) for c, n in names.items()], F.col("_DEPARTMENT_CODE").alias("department")
    )


@query("site_status_counts", f"""{_V1} SELECT count(*) FILTER (status = 'OK') AS status_ok, count(*) FILTER (status = 'A_CORRIGER') AS status_a_corriger,
  count(*) FILTER (status = 'A_COMPLETER') AS status_a_completer, count(*) FILTER (status = 'A_VERIFIER') AS status_a_verifier,
  count(*) FILTER (priority = 'FAIBLE') AS priority_faible, count(*) FILTER (priority = 'MOYENNE') AS priority_moyenne,
  count(*) FILTER (priority = 'HAUTE') AS priority_haute FROM sev""")
def site_status_counts(d: Data) -> DataFrame:
    return quality.status_counts(severity(d))


@query("site_worst_first", f"""{_V1} SELECT row_id, priority, codes, NU_CNT AS contract, ID_SITE AS site, len(list_filter([c1, c2, c3, c4, c5], lambda c: c IS NOT NULL)) AS issues FROM sev""")
def site_worst_first(d: Data) -> DataFrame:
    """All rows in order, with what they are ordered by."""
    return site_severity.sort_issues(severity(d)).select(
        "row_id", F.col("_PRIORITY").alias("priority"), F.col("_ISSUE_CODES").alias("codes"), F.col("NU_CNT").alias("contract"), F.col("ID_SITE").alias("site"),
        F.col("_ISSUE_COUNT").cast("bigint").alias("issues"),
    )


_V1_RAW = "'Lon=' || coalesce(COORD_X_SITE, 'nan') || ', Lat=' || coalesce(COORD_Y_SITE, 'nan')"
_V1_POINT = f"'Lon=' || {_LON} || ', Lat=' || {_LAT}"
_V1_RUE = "coalesce(RUE_SITE, 'nan')"
_V1_TEXTS = {
    code: (_quoted(category), description, _quoted(fields), value, _quoted(suggestion)) for code, category, description, fields, value, suggestion in [
        ("P-01", "pays", _quoted("Le pays n'est pas renseigné. Validation bloquée."), "PAYS_SITE", "''", "Renseigner le pays."),
        ("G-02", "adresse", _quoted("Une seule coordonnée GPS renseignée (X ou Y manquant)."), _XY_FIELDS, _V1_RAW, "Compléter la coordonnée manquante."),
        ("G-03", "gps", _quoted("Coordonnée GPS non numérique ou hors limites."), _XY_FIELDS, _V1_RAW, "Vérifier les coordonnées GPS."),
        ("R-01", "pays", "'Pays ''' || cn || ''' non couvert par le référentiel.'", "PAYS_SITE", "'Pays=' || cn", ""),
        ("G-04", "gps", f"'GPS (' || {_LON} || ', ' || {_LAT} || ') situé hors de ' || cn || '.'", f"{_XY_FIELDS}, PAYS_SITE", f"{_V1_POINT} || ', Pays=' || cn", "Vérifier les coordonnées GPS."),
        ("P-02", "adresse", _quoted("Le code postal n'est pas renseigné."), "CP_SITE", "''", "Renseigner le code postal."),
        ("G-05", "gps", f"'GPS (' || {_LON} || ', ' || {_LAT} || ') ne correspond pas au code postal ' || po || '.'", f"{_XY_FIELDS}, CP_SITE", f"{_V1_POINT} || ', CP=' || po || ', Dept=' || rg",
            "Vérifier la cohérence GPS / code postal."),
        ("A-01", "adresse", _quoted("Aucune information d'adresse renseignée."), ", ".join([*site_severity.STREET_FIELDS, "LIEU_DIT_SITE"]), "''", "Rencher l'adresse."),
        ("A-02", "adresse", _quoted("L'adresse est renseignée mais le numéro de voie est absent."), "NUM_VOIE_SITE", f"'Numéro=, Rue=' || {_V1_RUE}", "Compléter le numéro de rue si l'information existe."),
        ("A-03", "adresse", _quoted("Le numéro de rue manque : la cohérence du nom de rue avec le département doit être vérifiée manuellement."), "RUE_SITE, NUM_RUE_SITE, CP_SITE",
            f"'Rue=' || {_V1_RUE} || ', CP=' || po", "Contrôler le nom de rue avec la source métier du département."),
        ("D-01", "pays", "'Le département ''' || rg || ''' n''existe pas dans le référentiel.'", "CP_SITE", "'CP=' || po || ', Dept=' || rg", "Vérifier le code département."),
    ]
}


def _v1_joined(i: int) -> str:
    each = ", ".join(_case(f"c{k}", _V1_TEXTS, i) for k in range(1, 6))
    return f"array_to_string(list_sort(list_distinct(list_filter([{each}], lambda t: t IS NOT NULL AND t <> ''))), '; ')"


_V1_LABELS = ", ".join(f"CASE c{k} " + " ".join(f"WHEN '{c}' THEN {_quoted(label)}" for c, (label, _) in site_severity.CATALOGUE.items()) + " END" for k in range(1, 6))


@query("site_consolidated", f"""{_V1} SELECT ID_SITE, NU_CNT, codes, priority, concat_ws(' | ', {_V1_LABELS}) AS labels, {_case('coalesce(c1, c2, c3, c4, c5)', _V1_TEXTS, 0)} AS category,
  {_v1_joined(1)} AS description, {_v1_joined(2)} AS fields, {_v1_joined(3)} AS found, {_v1_joined(4)} AS suggestion, '' AS similarity FROM sev WHERE codes <> ''""")
def site_consolidated(d: Data) -> DataFrame:
    names = {"codes": "CODE_ANOMALIE", "labels": "LIBELLE", "priority": "GRAVITE", **_DETAIL_COLUMNS, "similarity": "SCORE_SIMILARITE"}
    return site_severity.consolidate(severity(d)).select("ID_SITE", "NU_CNT", *[F.col(c).alias(n) for n, c in names.items()])


_EXPORTED = [c for c in site_severity.EXPORT_ORDER if not c.startswith("_")]


@query("site_enriched_export", f"""{_V1} SELECT {', '.join(_EXPORTED)}, mode AS control_mode, status AS control_status, priority, CAST(len(list_filter([c1, c2, c3, c4, c5], lambda c: c IS NOT NULL)) AS INT) AS issue_count,
  codes AS issue_codes, concat_ws(' | ', {_V1_LABELS}) AS issue_summary, {_KEY} AS site_key, hx OR hy AS has_gps, inside AS gps_in_country, fits AS gps_match_postal_code, adr AS address_present,
  num AS street_number_present, rg AS department_code, home AS department_country_ok FROM sev""")
def site_enriched_export(d: Data) -> DataFrame:
    """All columns of the export."""
    return site_severity.enriched_export(severity(d)).select(*[F.col(c).alias(c.lower().removeprefix("_") if c.startswith("_") else c) for c in site_severity.EXPORT_ORDER])


# --- exhaustive variant ----------------------------------------------------------------------------------------

def _cities(d: Data) -> DataFrame:
    """Two market segment names per postal code stand for its cities."""
    rows = d.sites.filter("CP_SITE IS NOT NULL AND trim(CP_SITE) <> '' AND trim(STOCK) = '1'")
    named = rows.select(F.col("CP_SITE").alias("postal_code"), F.lower("NOM_CLI").alias("city"), F.col("row_id").alias("ordinal"))
    return named.groupBy("postal_code", "city").agg(F.min("ordinal").alias("ordinal"))


def exhaustive(d: Data) -> DataFrame:
    return site_exhaustive.evaluate_sites_full(d.sites, d.country_boxes, d.region_boxes, _cities(d))


_XF, _YF = f"try_cast({_t('COORD_X_SITE')} AS DOUBLE)", f"try_cast({_t('COORD_Y_SITE')} AS DOUBLE)"
_NO_STREET = " AND ".join(f"coalesce({_t(c)}, '') = ''" for c in ("RUE_SITE", "NUM_RUE_SITE", "ADRESSE_SITE"))
_TECHNICAL = " OR ".join(f"coalesce({_t(c)}, '') <> ''" for c in site_exhaustive.TECHNICAL_COLUMNS)
_FULL = f"""WITH cty AS (SELECT DISTINCT CP_SITE AS cp5, lower(NOM_CLI) AS cy FROM @sites s WHERE coalesce(trim(CP_SITE), '') <> '' AND trim(STOCK) = '1'),
  e0 AS (SELECT s.*, {_HAS_X} AS hx, {_HAS_Y} AS hy, {_XF} AS x, {_YF} AS y, upper(coalesce({_t('PAYS_SITE')}, '')) AS cn, coalesce({_t('CP_SITE')}, '') AS cp,
    coalesce({_t('VILLE_SITE')}, '') AS vl, ({_NO_STREET}) AS nostreet, NOT ({_TECHNICAL}) AS notech FROM @sites s),
  e1 AS (SELECT e0.*, CASE WHEN cp <> '' THEN {_department('cp')} END AS dp, hx AND hy AND coalesce(x BETWEEN -180 AND 180, false) AND coalesce(y BETWEEN -90 AND 90, false) AS rdy FROM e0),
  e2 AS (SELECT e1.*, b.country IS NOT NULL AS boxed, b.lon_min AS b1, b.lat_min AS b2, b.lon_max AS b3, b.lat_max AS b4, r.region_code IS NOT NULL AS split,
    r.lon_min AS r1, r.lat_min AS r2, r.lon_max AS r3, r.lat_max AS r4, cp IN (SELECT cp5 FROM cty) AS knowncp, (cp, lower(vl)) IN (SELECT (cp5, cy) FROM cty) AS fits
    FROM e1 LEFT JOIN @country_boxes b ON b.country = cn LEFT JOIN @region_boxes r ON r.region_code = dp AND r.country = 'FRANCE'),
  e3 AS (SELECT *, rdy AND boxed AND NOT (x BETWEEN b1 AND b3 AND y BETWEEN b2 AND b4) AS outside, y BETWEEN b1 AND b3 AND x BETWEEN b2 AND b4 AS swapped,
    (-x BETWEEN b1 AND b3 AND y BETWEEN b2 AND b4) OR (x BETWEEN b1 AND b3 AND -y BETWEEN b2 AND b4) AS flipped FROM e2),
  e4 AS (SELECT *, concat_ws(', ', CASE WHEN (hx OR hy) AND NOT (hx AND hy) THEN 'G-01' END,
    CASE WHEN hx AND hy AND NOT coalesce(x BETWEEN -180 AND 180, false) THEN 'G-02' END, CASE WHEN hx AND hy AND NOT coalesce(y BETWEEN -90 AND 90, false) THEN 'G-03' END,
    CASE WHEN outside AND swapped THEN 'G-06' END, CASE WHEN outside AND NOT swapped AND flipped THEN 'G-07' END, CASE WHEN outside AND NOT swapped AND NOT flipped THEN 'G-05' END,
    CASE WHEN rdy AND split AND NOT (x BETWEEN r1 AND r3 AND y BETWEEN r2 AND r4) THEN 'G-04' END) AS g,
    concat_ws(', ', CASE WHEN cp = '' THEN 'A-01' END, CASE WHEN vl = '' THEN 'A-02' END, CASE WHEN nostreet THEN 'A-03' END,
    CASE WHEN cp <> '' AND NOT knowncp THEN 'A-04' END, CASE WHEN cp <> '' AND knowncp AND vl <> '' AND NOT fits THEN 'A-05' END) AS a FROM e3),
  e5 AS (SELECT *, CASE WHEN NOT (hx OR hy) OR g <> '' THEN a ELSE '' END AS aa FROM e4)"""
_SEVERITY = "CASE WHEN code IN ('G-01', 'A-03') THEN 'LÉGÈRE' WHEN code IN ('G-06', 'G-07') THEN 'INFO' ELSE 'GRAVE' END"


@query("site_exhaustive_evaluation", f"""{_FULL} SELECT row_id, CASE WHEN (hx OR hy) AND g = '' THEN 'gps_ok' WHEN hx OR hy THEN 'gps_issue' WHEN aa <> '' THEN 'not_locatable' ELSE 'address_ok' END AS outcome,
  concat_ws(', ', CASE WHEN cn = '' THEN 'P-01' END, CASE WHEN notech THEN 'P-07' END, nullif(g, ''), nullif(aa, ''), CASE WHEN NOT (hx OR hy) AND aa <> '' THEN 'L-01' END) AS codes FROM e5""")
def site_exhaustive_evaluation(d: Data) -> DataFrame:
    return exhaustive(d).select("row_id", "outcome", F.array_join(F.col("issues.code"), ", ").alias("codes"))


_FULL_TEXTS = {
    "P-01": ("'Pays manquant'",), "P-07": ("'Données techniques manquantes'",), "G-01": ("'GPS incomplet (une seule coordonnée)'",),
    "G-02": (f"CASE WHEN x IS NULL THEN 'Longitude ''' || COORD_X_SITE || ''' non numérique' ELSE 'Longitude ' || {_LON} || ' hors limites' END",),
    "G-03": (f"CASE WHEN y IS NULL THEN 'Latitude ''' || COORD_Y_SITE || ''' non numérique' ELSE 'Latitude ' || {_LAT} || ' hors limites' END",),
    "G-06": ("'X/Y probablement inversés'",), "G-07": ("'Signe probablement erroné'",), "G-05": (f"'GPS (' || {_LON} || ',' || {_LAT} || ') hors de ' || cn",),
    "G-04": ("'GPS hors département ' || dp",), "A-01": ("'Code postal manquant'",), "A-02": ("'Ville manquante'",), "A-03": ("'Rue manquante'",),
    "A-04": ("'CP ''' || CP_SITE || ''' non trouvé dans la référence'",), "A-05": ("'''' || VILLE_SITE || ''' ≠ CP ' || CP_SITE || ' (attendu: [' || expected || '])'",),
    "L-01": ("'Site non localisable'",),
}


@query("site_exhaustive_issues", f"""{_FULL}, known AS (SELECT cp5, array_to_string(list('''' || name || '''' ORDER BY o), ', ') AS expected
    FROM (SELECT CP_SITE AS cp5, min(NOM_CLI) AS name, lower(NOM_CLI) AS cy, min(row_id) AS o FROM @sites s WHERE coalesce(trim(CP_SITE), '') <> '' AND trim(STOCK) = '1' GROUP BY 1, 3) t GROUP BY 1),
  issues AS (SELECT e5.*, expected, unnest(string_split(concat_ws(', ', CASE WHEN cn = '' THEN 'P-01' END, CASE WHEN notech THEN 'P-07' END, nullif(g, ''), nullif(aa, ''),
    CASE WHEN NOT (hx OR hy) AND aa <> '' THEN 'L-01' END), ', ')) AS code FROM e5 LEFT JOIN known ON cp5 = cp)
  SELECT row_id, code, {_SEVERITY} AS severity, {_case('code', _FULL_TEXTS, 0)} AS description FROM issues WHERE code <> ''""")
def site_exhaustive_issues(d: Data) -> DataFrame:
    """Every issue with its text and severity; wrong cities list all known ones in their original spelling."""
    rows = d.sites.filter("CP_SITE IS NOT NULL AND trim(CP_SITE) <> '' AND trim(STOCK) = '1'")
    named = rows.groupBy(F.col("CP_SITE").alias("postal_code"), F.lower("NOM_CLI").alias("city")).agg(F.min("row_id").alias("ordinal"), F.min("NOM_CLI").alias("name"))
    found = site_exhaustive.evaluate_sites_full(d.sites, d.country_boxes, d.region_boxes, named)
    return found.select("row_id", F.inline("issues")).select("row_id", "code", F.col("gravite").alias("severity"), "description")


@query("site_exhaustive_gps", f"{_FULL} SELECT row_id, g AS codes FROM e5")
def site_exhaustive_gps(d: Data) -> DataFrame:
    codes = F.filter(F.col("issues.code"), lambda c: c.startswith("G-"))
    return exhaustive(d).select("row_id", F.array_join(codes, ", ").alias("codes"))


# No two segment names are alike enough for a typo or a doubt, so a wrong city is always severe here.
@query("site_issues_by_severity", f"""{_FULL}, codes AS (SELECT unnest(string_split(concat_ws(', ', CASE WHEN cn = '' THEN 'P-01' END, CASE WHEN notech THEN 'P-07' END, nullif(g, ''), nullif(aa, ''),
    CASE WHEN NOT (hx OR hy) AND aa <> '' THEN 'L-01' END), ', ')) AS code FROM e5)
  SELECT code, {_SEVERITY} AS gravite, count(*) AS n_issues FROM codes WHERE code <> '' GROUP BY 1, 2""")
def site_issues_by_severity(d: Data) -> DataFrame:
    return site_exhaustive.issues_by_severity(site_exhaustive.issue_rows(exhaustive(d)))


@query("site_technical_gap", f"""SELECT row_id, NOT ({' OR '.join(f"coalesce({_t(c)}, '') <> ''" for c in site_exhaustive.TECHNICAL_COLUMNS)}) AS nothing_filled,
  NOT ({' OR '.join(f"coalesce(try_cast({_t(c)} AS DOUBLE) > 0, false)" for c in site_exhaustive.TECHNICAL_COLUMNS)}) AS nothing_positive FROM @sites s""")
def site_technical_gap(d: Data) -> DataFrame:
    columns = site_exhaustive.TECHNICAL_COLUMNS
    return d.sites.select(
        "row_id", site_rules.technical_gap(d.sites, columns).alias("nothing_filled"), site_rules.technical_gap(d.sites, columns, numeric=True).alias("nothing_positive")
    )


# --- follow-up, support, cities --------------------------------------------------------------------------------

def _earlier(d: Data) -> DataFrame:
    """Last month: sites of one client had no coordinates yet, and those of another did not exist."""
    missing = F.col("NOM_CLI") == "HOUSEHOLD"
    older = d.sites.filter(F.col("NOM_CLI") != "MACHINERY")
    return older.withColumns({c: F.when(~missing, F.col(c)) for c in ("COORD_X_SITE", "COORD_Y_SITE")})


_EARLIER = "(SELECT * REPLACE (CASE WHEN NOM_CLI <> 'HOUSEHOLD' THEN COORD_X_SITE END AS COORD_X_SITE, CASE WHEN NOM_CLI <> 'HOUSEHOLD' THEN COORD_Y_SITE END AS COORD_Y_SITE) FROM @sites s WHERE NOM_CLI <> 'MACHINERY')"


@query("site_follow_up", f"""WITH cur AS ({_all()} SELECT DISTINCT site_key, code FROM (SELECT site_key, unnest([c0, c1, c2]) AS code FROM evaluated) t WHERE code IS NOT NULL),
  prev AS ({_all(_EARLIER)} SELECT DISTINCT site_key, code FROM (SELECT site_key, unnest([c0, c1, c2]) AS code FROM evaluated) t WHERE code IS NOT NULL)
SELECT coalesce(p.site_key, c.site_key) AS site_key, coalesce(p.code, c.code) AS code,
  CASE WHEN p.code IS NULL THEN 'new' WHEN c.code IS NULL THEN 'resolved' ELSE 'open' END AS state
FROM prev p FULL JOIN cur c ON p.site_key = c.site_key AND p.code = c.code""")
def site_follow_up(d: Data) -> DataFrame:
    before = site_rules.evaluate_sites(_earlier(d), d.country_boxes, d.region_boxes)
    return quality.follow_up(before, evaluated(d))


@query("country_support_level", f"""SELECT cn AS country, CASE WHEN cn NOT IN (SELECT country FROM @country_boxes b) THEN 'NON_SUPPORTÉ'
  WHEN cn NOT IN (SELECT country FROM @region_boxes r) THEN 'PARTIEL' ELSE 'COMPLET' END AS support_level
FROM (SELECT DISTINCT upper({_t('PAYS_SITE')}) AS cn FROM @sites s WHERE coalesce({_t('PAYS_SITE')}, '') <> '') t""")
def country_support_level(d: Data) -> DataFrame:
    countries = d.sites.select(text.normalize_country(F.col("PAYS_SITE")).alias("country")).filter("country <> ''").distinct()
    return references.support_level(countries, d.country_boxes, d.region_boxes)


_BRANDS = "(SELECT p_brand, lower(p_name) AS city, min(p_partkey) AS ordinal FROM part GROUP BY 1, 2)"
_ASKED = f"""(SELECT p_brand, city AS base, CASE ordinal % 3 WHEN 0 THEN city WHEN 1 THEN city || '§' ELSE '§§§§' || CAST(ordinal % 2 AS VARCHAR) END AS city, ordinal % 3 AS kind FROM {_BRANDS} b
  UNION ALL SELECT 'none of these', city, city, 3 FROM {_BRANDS} b)"""


def _asked_names(d: Data) -> tuple[DataFrame, DataFrame]:
    """All part names by brand, and questions about them: as they are, with one letter added, like none of them, and for an unknown brand."""
    known = d.part.groupBy(F.col("p_brand").alias("postal_code"), F.lower("p_name").alias("city")).agg(F.min("p_partkey").alias("ordinal"), F.min("p_name").alias("name"))
    kind = F.col("ordinal") % 3
    changed = F.when(kind == 0, F.col("city")).when(kind == 1, F.concat("city", F.lit("§"))).otherwise(F.concat(F.lit("§§§§"), (F.col("ordinal") % 2).cast("string")))
    asked = known.select("postal_code", changed.alias("city")).union(known.select(F.lit("none of these"), "city"))
    return asked, known


# A name of n letters with one more that no name has: the name itself covers n letters, any other fewer in proportion.
@query("city_name_check", f"""SELECT DISTINCT p_brand AS postal_code, city, CASE WHEN kind = 3 THEN 'unknown_postal' WHEN kind = 0 THEN 'match' WHEN kind = 2 OR 200.0 * length(base) / (2 * length(base) + 1) < 70 THEN 'mismatch'
    WHEN 200.0 * length(base) / (2 * length(base) + 1) < 90 THEN 'doubtful' ELSE 'typo' END AS verdict,
  CASE WHEN kind = 1 AND length(base) > 1 THEN (SELECT min(p_name) FROM part p WHERE lower(p.p_name) = base) END AS best_city,
  CASE WHEN kind = 1 AND length(base) > 1 THEN round(200.0 * length(base) / (2 * length(base) + 1), 4) END AS score FROM {_ASKED} a""")
def city_name_check(d: Data) -> DataFrame:
    checks = city_check(*_asked_names(d))
    return checks.select("postal_code", "city", "verdict", "best_city", F.round("score", 4).alias("score"))


@query("city_name_expected", f"""SELECT DISTINCT a.p_brand AS postal_code, a.city, e.expected FROM {_ASKED} a
JOIN (SELECT p_brand, array_to_string(list(city ORDER BY ordinal), '|') AS expected FROM {_BRANDS} b GROUP BY 1) e ON e.p_brand = a.p_brand WHERE kind = 2""")
def city_name_expected(d: Data) -> DataFrame:
    """All known names are listed for a name like none of them."""
    asked, known = _asked_names(d)
    wrong = city_check(asked, known.drop("name")).filter("verdict = 'mismatch'")
    return wrong.select("postal_code", "city", F.array_join("expected", "|").alias("expected"))


@query("city_name_exact", f"""SELECT DISTINCT p_brand AS postal_code, city, CASE WHEN kind = 3 THEN 'unknown_postal' WHEN kind = 0 THEN 'match' ELSE 'differs' END AS verdict FROM {_ASKED} a""")
def city_name_exact(d: Data) -> DataFrame:
    """Known code and exact name only."""
    verdict = F.when(F.col("verdict").isin("unknown_postal", "match"), F.col("verdict")).otherwise("differs")
    return city_name_check(d).select("postal_code", "city", verdict.alias("verdict"))


@query("geojson_boxes", """SELECT region_code, round(min(x), 4) AS lon_min, round(min(y), 4) AS lat_min, round(max(x + 1), 4) AS lon_max, round(max(y + 2.5), 4) AS lat_max
FROM (SELECT c_mktsegment AS region_code, CAST(c_custkey % 50 AS DOUBLE) AS x, CAST(c_nationkey AS DOUBLE) AS y, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey DESC) AS rn FROM customer) t WHERE rn = 1 GROUP BY 1""")
def geojson_boxes(d: Data) -> DataFrame:
    """Rectangles written as GeoJSON, one feature per customer; the last feature of a code is the one that counts."""
    x, y = F.col("c_custkey") % 50, F.col("c_nationkey")
    ring = F.format_string("[[[%d, %d], [%d, %d], [%d, %d.5], [%d, %d]]]", x, y, x + 1, y, x + 1, y + 2, x, y)
    multi = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("["), ring, F.lit("]"))).otherwise(ring)
    kind = F.when(F.col("c_custkey") % 2 == 0, "MultiPolygon").otherwise("Polygon")
    features = d.customer.select(
        "c_custkey", F.to_json(F.struct(F.col("c_mktsegment").alias("code"))).alias("properties"),
        F.concat(F.lit('{"type": "'), kind, F.lit('", "coordinates": '), multi, F.lit("}")).alias("geometry"),
    )
    return references.region_bboxes(features, "c_custkey").drop("name")


@query("json_boxes", """SELECT n_regionkey AS area, n_name AS country, CAST(n_nationkey AS DOUBLE) AS lon_min, CAST(0 AS DOUBLE) AS lat_min, CAST(n_nationkey + 10 AS DOUBLE) AS lon_max, CAST(5 AS DOUBLE) AS lat_max FROM nation""")
def json_boxes(d: Data) -> DataFrame:
    """Boxes written as JSON, bare or inside an object."""
    bare = F.format_string("[%d, 0, %d, 5]", F.col("n_nationkey"), F.col("n_nationkey") + 10)
    value = F.when(F.col("n_nationkey") % 2 == 0, bare).otherwise(F.concat(F.lit('{"name": "x", "bbox": '), bare, F.lit("}")))
    texts = d.nation.select(F.col("n_regionkey").alias("area"), F.concat(F.lit('{"'), "n_name", F.lit('": '), value, F.lit("}")).alias("text"))
    return references.boxes_from_json(texts, "text", ["area"], "country")


@query("sites_active_normalised", f"""WITH c AS (SELECT NOPOL AS k, PTGST, row_number() OVER (PARTITION BY NOPOL ORDER BY ordinal) AS rn FROM @contracts c WHERE trim(CDSITP) = '1')
SELECT row_id, PTGST FROM @sites s JOIN c ON k = NU_CNT WHERE rn = 1""")
def sites_active_normalised(d: Data) -> DataFrame:
    noisy = d.contracts.withColumn("NOPOL", F.concat(F.lit(" "), "NOPOL", F.when(F.col("ordinal") % 2 == 0, ".0").otherwise("")))
    return site_rules.join_active(d.sites, noisy, ["ordinal"], normalise=True).select("row_id", "PTGST")


@query("postal_cities", f"""SELECT VILLE_SITE AS country, postal_code, lower(NOM_SITE) AS city, min(row_id) AS ordinal FROM (SELECT *, CASE WHEN length(p) < w AND regexp_full_match(p, '\\d+') THEN lpad(p, CAST(w AS INT), '0') ELSE p END AS postal_code
  FROM (SELECT *, upper(replace(replace(coalesce({_t('CP_SITE')}, ''), ' ', ''), '-', '')) AS p, max(CASE WHEN regexp_full_match({_t('CP_SITE')}, '\\d+') THEN length({_t('CP_SITE')}) END) OVER (PARTITION BY VILLE_SITE) AS w FROM @sites s WHERE VILLE_SITE IS NOT NULL) t) u
WHERE postal_code <> '' GROUP BY 1, 2, 3""")
def postal_cities(d: Data) -> DataFrame:
    return references.postal_cities(d.sites.filter("VILLE_SITE IS NOT NULL"), "VILLE_SITE", "CP_SITE", "NOM_SITE", "row_id")


@query("postal_city_map", "SELECT CP_SITE AS postal_code, arg_max(NOM_CLI, row_id) AS city FROM @sites s WHERE CP_SITE IS NOT NULL GROUP BY 1")
def postal_city_map(d: Data) -> DataFrame:
    return references.postal_map(d.sites.filter("CP_SITE IS NOT NULL"), "CP_SITE", "NOM_CLI", "row_id")


@query("site_known_cities", f"""WITH pc AS (SELECT *, upper(replace(replace(coalesce({_t('CP_SITE')}, ''), ' ', ''), '-', '')) AS p, upper(coalesce({_t('PAYS_SITE')}, '')) AS cn FROM @sites s),
  places AS (SELECT cn, p, lower(NOM_CLI) AS city, min(row_id) AS ordinal FROM pc WHERE p <> '' AND cn <> '' AND row_id % 4 <> 1 GROUP BY 1, 2, 3),
  lists AS (SELECT cn, p, array_to_string(list(city ORDER BY ordinal, city), '|') AS cities FROM places GROUP BY 1, 2)
SELECT row_id, coalesce(cities, '') AS cities FROM pc LEFT JOIN lists USING (cn, p)""")
def site_known_cities(d: Data) -> DataFrame:
    """Segment names of three quarters of the sites stand for the cities of a code; the other sites have to find theirs."""
    places = d.sites.filter("row_id % 4 <> 1").withColumn("country", text.normalize_country(F.col("PAYS_SITE"))).filter("country <> ''")
    cities = references.postal_cities(places, "country", "CP_SITE", "NOM_CLI", "row_id")
    found = references.with_cities(d.sites, cities, "PAYS_SITE", "CP_SITE")
    return found.select("row_id", F.array_join("known_cities", "|").alias("cities"))
