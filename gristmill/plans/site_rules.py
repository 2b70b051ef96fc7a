"""Site-location checks: country, then coordinates, then address.

Column names are those of the site export. Boxes are looked up once by country and once by region, from measured and
broadcast tables; everything after that is one projection, so a site does not leave its partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import geo
from gristmill.functions.text import (
    blank_to_null, extract_postal, extract_street_no, in_range, is_empty, is_filled, norm_key, normalize_country,
    number_text, parse_number, safe_str, to_number,
)
from gristmill.operators.dedup import keep_first, site_key
from gristmill.operators.joins import enrich, lookup

# Issue codes, labels and texts of the reports, in catalogue order.
LABELS = {
    "P-01": "Pays manquant",
    "P-02": "Code postal manquant",
    "R-01": "Pays non trouvé dans le référentiel",
    "G-02": "Une seule coordonnée GPS (X ou Y) renseignée",
    "G-03": "Coordonnées GPS (X,Y) non valides",
    "G-04": "Coordonnées GPS (X,Y) hors pays",
    "G-05": "GPS (X,Y) incohérent avec le code postal",
    "G-06": "Coordonnées GPS (X,Y) potentiellement inversées",
    "A-01": "Adresse manquante",
    "A-02": "Numéro de rue manquant",
}
MODES = {"gps": "GPS_OK", "address": "ADRESSE_OK", "none": "INCOMPLET"}
ADDRESS_FIELDS = ["NUM_VOIE_SITE", "RUE_SITE", "NUM_RUE_SITE", "ADRESSE_SITE", "LIEU_DIT_SITE"]
HOME = geo.HOME_COUNTRY


# --- selection of the sites to check ---------------------------------------------------------------------------

def active_contracts(contracts: DataFrame, status: str = "CDSITP") -> DataFrame:
    return contracts.filter(F.trim(F.col(status)) == "1")


def join_active(
    sites: DataFrame, contracts: DataFrame, order: list[str], key: str = "NU_CNT", salt: int | None = None, normalise: bool = False
) -> DataFrame:
    """Sites with an active contract, plus its management point; the first active row of a contract is used.

    An empty contract table means that no filter applies; the management point is null then. ``normalise`` compares keys
    without outer spaces and without a ``.0`` left by a float round trip. ``salt`` spreads a contract with very many
    sites over several tasks when the contracts are too many to broadcast.
    """
    listed = contracts.limit(1).agg(F.count("*").alias("n")).scalar()
    usable = active_contracts(contracts).filter(F.col("NOPOL").isNotNull())
    left, on = sites, key
    if normalise:
        usable = usable.withColumn("NOPOL", norm_key(F.col("NOPOL")))
        left, on = sites.withColumn("_key", norm_key(F.col(key))), "_key"
    first = keep_first(usable, ["NOPOL"], order).withColumn("_active", F.lit(True))
    joined = enrich(left, first, {on: "NOPOL"}, ["PTGST", "_active"], salt=salt, unique=True)
    return joined.filter(F.coalesce("_active", F.lit(False)) | (listed == 0)).drop("_active", "_key")


def active_sites(sites: DataFrame) -> DataFrame:
    """Older rule: in stock and without a cancellation date."""
    return sites.filter((F.trim("STOCK") == "1") & is_empty(F.col("DT_EFF_RESIL_CNT")))


def country_filter(sites: DataFrame, supported: list[str] | None = None) -> DataFrame:
    """Blank country becomes the home country when that one is supported; unsupported countries are dropped.

    Without a list only the home country is supported; an empty list supports none.
    """
    names = [c.upper() for c in ([HOME] if supported is None else supported)]
    country = normalize_country(F.col("PAYS_SITE"))
    defaulted = F.when(country == "", F.lit(HOME if HOME in names else None)).otherwise(F.col("PAYS_SITE"))
    kept = sites.withColumn("PAYS_SITE", defaulted)
    return kept.filter(normalize_country(F.col("PAYS_SITE")).isin(names))


def filter_country(sites: DataFrame, countries: list[str] | None) -> DataFrame:
    """Optional filter; None keeps everything."""
    if countries is None:
        return sites
    wanted = {" ".join(c.split()).upper() for c in countries} - {""}
    return sites.filter(normalize_country(F.col("PAYS_SITE")).isin(sorted(wanted)))


# --- context ---------------------------------------------------------------------------------------------------

def with_country_box(sites: DataFrame, boxes: DataFrame) -> DataFrame:
    packed = boxes.select("country", geo.box_struct(*_sides()).alias("country_box"))
    return lookup(sites, packed, {"_country": "country"}, ["country_box"])


def with_region_box(sites: DataFrame, regions: DataFrame) -> DataFrame:
    packed = regions.select("country", "region_code", geo.box_struct(*_sides()).alias("region_box"))
    return lookup(sites, packed, {"_country": "country", "_region": "region_code"}, ["region_box"])


def _sides() -> list[Column]:
    return [F.col(c) for c in ("lon_min", "lat_min", "lon_max", "lat_max")]


def with_postal(c_postal: Column, c_address: Column, use_address: bool = True) -> Column:
    """Postal code of the column, else the first five-digit number of the address, else an empty string."""
    if not use_address:
        return safe_str(c_postal)
    return F.coalesce(blank_to_null(c_postal), extract_postal(c_address))


def with_context(sites: DataFrame, boxes: DataFrame, regions: DataFrame, use_address: bool = True) -> DataFrame:
    """Derived fields shared by the rule sets, under names with a leading underscore."""
    x, y, address = F.col("COORD_X_SITE"), F.col("COORD_Y_SITE"), F.col("ADRESSE_SITE")
    base = sites.withColumns({
        "_country": normalize_country(F.col("PAYS_SITE")),
        "_postal": with_postal(F.col("CP_SITE"), address, use_address),
        "_has_lon": is_filled(x),
        "_has_lat": is_filled(y),
        "_x": parse_number(x),
        "_y": parse_number(y),
    })
    # A second projection, so that the parsed numbers are computed once and not once per use.
    base = base.withColumns({"_lon": in_range(F.col("_x"), -180.0, 180.0), "_lat": in_range(F.col("_y"), -90.0, 90.0)})
    region = F.when(F.col("_postal") == "", "").otherwise(geo.region_code(F.col("_country"), F.col("_postal")))
    located = with_country_box(base.withColumn("_region", region), boxes)
    return with_region_box(located, regions)


CONTEXT = ["_country", "_postal", "_has_lon", "_has_lat", "_lon", "_lat", "_region", "country_box", "region_box"]


# --- gates -----------------------------------------------------------------------------------------------------

def country_gate() -> Column:
    """P-01 blank country, R-01 country without a box; both end the check."""
    return F.when(F.col("_country") == "", "P-01").when(F.col("country_box").isNull(), "R-01")


def gps_gate() -> Column:
    """One code, or null when there is nothing to report; evaluated after the country gate."""
    lon, lat, box = F.col("_lon"), F.col("_lat"), F.col("country_box")
    both = F.col("_has_lon") & F.col("_has_lat")
    return (
        F.when(~both, F.when(F.col("_has_lon") | F.col("_has_lat"), "G-02"))
        .when(lon.isNull() | lat.isNull(), "G-03")
        .when(~geo.in_bbox(lon, lat, box), F.when(geo.in_bbox(lat, lon, box), "G-06").otherwise("G-04"))
        .when(F.col("_postal") == "", "P-02")
        .when(F.col("region_box").isNotNull() & ~geo.in_bbox(lon, lat, F.col("region_box")), "G-05")
    )


def address_gate() -> Column:
    """A-01 nothing filled, A-02 no street number in its column or at the head of the address."""
    present = reduce(lambda a, b: a | b, [is_filled(F.col(c)) for c in ADDRESS_FIELDS])
    numbered = is_filled(F.col("NUM_VOIE_SITE")) | (extract_street_no(F.col("ADRESSE_SITE")) != "")
    return F.when(~present, "A-01").when(~numbered, "A-02")


# --- result ----------------------------------------------------------------------------------------------------

def _detail(code: str, category: str, description: Column, fields: list[str], value: Column, suggestion: str, **extra: str) -> Column:
    label = extra.pop("label", None) or LABELS[code]
    columns = [F.lit(code).alias("CODE_ANOMALIE"), F.lit(label).alias("LIBELLE")]
    columns += [F.lit(v).alias(k) for k, v in extra.items()]
    columns += [
        F.lit(category).alias("CATEGORIE"), description.alias("DESCRIPTION"), F.lit(", ".join(fields)).alias("CHAMPS_CONCERNES"),
        value.alias("VALEUR_ACTUELLE"), F.lit(suggestion).alias("SUGGESTION"),
    ]
    return F.struct(*columns)


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def build_details() -> dict[str, Column]:
    """Detail record of every code. The wording of the reports."""
    x, y, xy = "COORD_X_SITE", "COORD_Y_SITE", ["COORD_X_SITE", "COORD_Y_SITE"]
    lon, lat = number_text(F.col("_lon")), number_text(F.col("_lat"))
    country, postal, region = F.col("_country"), F.col("_postal"), F.col("_region")
    raw = _text("X=", F.coalesce(x, F.lit("nan")), ", Y=", F.coalesce(y, F.lit("nan")))
    point = _text("X=", lon, ", Y=", lat)
    none = F.lit("")
    return {
        "P-01": _detail("P-01", "pays", F.lit("Le pays n'est pas renseigné."), ["PAYS_SITE"], none, "Renseigner le pays."),
        "R-01": _detail(
            "R-01", "pays", _text("Le pays '", country, "' n'est pas présent dans le référentiel."), ["PAYS_SITE"],
            _text("Pays=", country), "",
        ),
        "G-02": _detail(
            "G-02", "gps", F.lit("Une seule coordonnée GPS renseignée (X ou Y manquant)."), xy, raw,
            "Compléter la coordonnée manquante.",
        ),
        "G-03": _detail(
            "G-03", "gps", F.lit("Les coordonnées GPS ne sont pas valides (non numériques ou hors limites)."), xy, raw,
            "Vérifier et corriger les coordonnées GPS.",
        ),
        "G-06": _detail(
            "G-06", "gps",
            _text("GPS (", lon, ", ", lat, ") hors ", country, ", mais (", lat, ", ", lon, ") y est — coordonnées probablement inversées."),
            xy, point, "Inverser X et Y.",
        ),
        "G-04": _detail(
            "G-04", "gps", _text("GPS (", lon, ", ", lat, ") situé hors de ", country, "."), [*xy, "PAYS_SITE"],
            _text(point, ", Pays=", country), "Vérifier les coordonnées GPS.",
        ),
        "P-02": _detail(
            "P-02", "adresse", F.lit("Le GPS est dans le pays mais le code postal est absent."), ["CP_SITE"], none,
            "Renseigner le code postal.",
        ),
        "G-05": _detail(
            "G-05", "gps",
            _text("GPS (", lon, ", ", lat, ") incohérent avec le code postal ", postal, " (département ", region, ")."),
            [*xy, "CP_SITE"], _text(point, ", CP=", postal), "Vérifier la cohérence entre GPS et code postal.",
        ),
        "A-01": _detail(
            "A-01", "adresse", F.lit("Aucune information d'adresse renseignée."), ADDRESS_FIELDS, none,
            "Renseigner l'adresse du site.",
        ),
        "A-02": _detail(
            "A-02", "adresse", F.lit("L'adresse est renseignée mais le numéro de rue est absent."),
            ["NUM_VOIE_SITE", "ADRESSE_SITE"], none, "Ajouter le numéro de rue.",
        ),
    }


def labels_of(codes: Column, catalogue: dict[str, str], unknown: str = "Code inconnu") -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in catalogue.items() for x in pair])
    return F.transform(codes, lambda code: F.coalesce(F.element_at(lookup, code), F.lit(unknown)))


def issue_columns(codes: Column, catalogue: dict[str, str]) -> dict[str, Column]:
    """Count, code list and label list of an array of codes (first appearance kept)."""
    distinct = F.array_distinct(codes)
    return {
        "_ISSUE_COUNT": F.size(distinct),
        "_ISSUE_CODES": F.array_join(distinct, ", "),
        "_ISSUE_SUMMARY": F.array_join(labels_of(distinct, catalogue), " | "),
    }


def details_for(codes: Column, details: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.array_contains(codes, code), record) for code, record in details.items()]))


def evaluate_sites(
    sites: DataFrame, boxes: DataFrame, regions: DataFrame, row_id: str = "row_id", single_issue: bool = False
) -> DataFrame:
    """All checks. A site whose coordinates fail still goes through the address check, so it can carry two codes;
    ``single_issue`` stops at the first one instead."""
    located = with_context(sites, boxes, regions)
    stop = located.withColumn("_stop", country_gate()).withColumn("_gps", F.when(F.col("_stop").isNull(), gps_gate()))
    complete = F.col("_has_lon") & F.col("_has_lat")
    valid = F.col("_stop").isNull() & complete & F.col("_gps").isNull()
    by_address = F.col("_stop").isNull() & ~valid
    if single_issue:
        by_address = by_address & F.col("_gps").isNull()
    checked = stop.withColumn("_valid", valid).withColumn("_address", F.when(by_address, address_gate()))
    codes = F.array_compact(F.array("_stop", "_gps", "_address"))
    address_ok = by_address & F.col("_address").isNull()
    mode = F.when(F.col("_valid"), MODES["gps"]).when(address_ok, MODES["address"]).otherwise(MODES["none"])
    results = {
        "_SITE_KEY": site_key("NU_CNT", "ID_SITE", row_id),
        "_CONTROL_MODE": mode,
        **issue_columns(codes, LABELS),
        "_ISSUE_DETAILS": details_for(codes, build_details()),
    }
    return checked.select(*sites.columns, *[c.alias(name) for name, c in results.items()])


def technical_gap(sites: DataFrame, columns: list[str], numeric: bool = False) -> Column:
    """True when none of the capital and surface columns is filled (or, numerically, above zero)."""
    def has(c: str) -> Column:
        return F.coalesce(to_number(F.col(c)) > 0, F.lit(False)) if numeric else is_filled(F.col(c))

    present = [has(c) for c in columns if c in sites.columns]
    return ~reduce(lambda a, b: a | b, present, F.lit(False))
