"""The earlier rule set: the same gates with severities, a status, diagnostic flags and a region check of its own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import geo
from gristmill.functions.text import is_filled, number_text
from gristmill.operators.dedup import site_key
from gristmill.plans.site_rules import HOME, MODES, _text, details_for, issue_columns, with_context

# Catalogue of the earlier version, code -> (label, priority).
CATALOGUE = {
    "P-01": ("Pays manquant", "HAUTE"),
    "P-02": ("Code postal manquant", "MOYENNE"),
    "R-01": ("Pays non couvert", "FAIBLE"),
    "G-01": ("GPS manquant", "MOYENNE"),
    "G-02": ("GPS incomplet", "MOYENNE"),
    "G-03": ("GPS invalide", "HAUTE"),
    "G-04": ("GPS hors pays", "HAUTE"),
    "G-05": ("GPS incohérent avec le code postal", "HAUTE"),
    "A-01": ("Adresse manquante", "HAUTE"),
    "A-02": ("Numéro de voie manquant", "MOYENNE"),
    "A-03": ("Rue à vérifier manuellement", "FAIBLE"),
    "D-01": ("Département / pays à vérifier", "FAIBLE"),
}
PRIORITIES = ["OK", "FAIBLE", "MOYENNE", "HAUTE"]
STATUSES = {"OK": "OK", "HAUTE": "A_CORRIGER", "MOYENNE": "A_COMPLETER", "FAIBLE": "A_VERIFIER"}
STREET_FIELDS = ["NUM_RUE_SITE", "RUE_SITE", "ADRESSE_SITE"]
EXPORT_ORDER = [
    "NU_CNT", "ID_SITE", "NOM_CLI", "NOM_SITE", "PAYS_SITE", "CP_SITE", "VILLE_SITE", "NUM_VOIE_SITE", "RUE_SITE",
    "NUM_RUE_SITE", "ADRESSE_SITE", "COORD_X_SITE", "COORD_Y_SITE", "_CONTROL_MODE", "_CONTROL_STATUS", "_PRIORITY",
    "_ISSUE_COUNT", "_ISSUE_CODES", "_ISSUE_SUMMARY", "_SITE_KEY", "_HAS_GPS", "_GPS_IN_COUNTRY",
    "_GPS_MATCH_POSTAL_CODE", "_ADDRESS_PRESENT", "_STREET_NUMBER_PRESENT", "_DEPARTMENT_CODE", "_DEPARTMENT_COUNTRY_OK",
]


def _lookup(values: dict[str, int | str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def worst_priority(codes: Column) -> Column:
    ranks = {code: PRIORITIES.index(priority) for code, (_, priority) in CATALOGUE.items()}
    worst = F.array_max(F.transform(codes, lambda code: F.coalesce(F.element_at(_lookup(ranks), code), F.lit(1))))
    return F.element_at(F.array(*[F.lit(p) for p in PRIORITIES]), F.coalesce(worst, F.lit(0)) + 1)


def control_status(priority: Column) -> Column:
    return F.element_at(_lookup(STATUSES), priority)


def _any_filled(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [is_filled(F.col(c)) for c in columns])


def _record(code: str, severity: str, category: str, description, fields: list[str], value, suggestion: str, label: str | None = None) -> Column:
    texts = [
        ("CODE_ANOMALIE", code), ("LIBELLE", label or CATALOGUE[code][0]), ("GRAVITE", severity), ("CATEGORIE", category),
        ("DESCRIPTION", description), ("CHAMPS_CONCERNES", ", ".join(fields)), ("VALEUR_ACTUELLE", value), ("SUGGESTION", suggestion),
    ]
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(name) for name, v in texts])


def build_details() -> dict[str, Column]:
    """The wording of the earlier reports."""
    xy = ["COORD_X_SITE", "COORD_Y_SITE"]
    lon, lat = number_text(F.col("_lon")), number_text(F.col("_lat"))
    country, postal, region = F.col("_country"), F.col("_postal"), F.col("_region")
    raw = _text("Lon=", F.coalesce("COORD_X_SITE", F.lit("nan")), ", Lat=", F.coalesce("COORD_Y_SITE", F.lit("nan")))
    street = F.coalesce("RUE_SITE", F.lit("nan"))
    return {
        "P-01": _record(
            "P-01", "GRAVE", "pays", "Le pays n'est pas renseigné. Validation bloquée.", ["PAYS_SITE"], "", "Renseigner le pays.",
        ),
        "G-02": _record(
            "G-02", "LEGERE", "adresse", "Une seule coordonnée GPS renseignée (X ou Y manquant).", xy, raw,
            "Compléter la coordonnée manquante.",
        ),
        "G-03": _record(
            "G-03", "GRAVE", "gps", "Coordonnée GPS non numérique ou hors limites.", xy, raw, "Vérifier les coordonnées GPS.",
        ),
        "R-01": _record(
            "R-01", "FAIBLE", "pays", _text("Pays '", country, "' non couvert par le référentiel."), ["PAYS_SITE"],
            _text("Pays=", country), "",
        ),
        "G-04": _record(
            "G-04", "GRAVE", "gps", _text("GPS (", lon, ", ", lat, ") situé hors de ", country, "."), [*xy, "PAYS_SITE"],
            _text("Lon=", lon, ", Lat=", lat, ", Pays=", country), "Vérifier les coordonnées GPS.",
        ),
        "P-02": _record(
            "P-02", "MOYENNE", "adresse", "Le code postal n'est pas renseigné.", ["CP_SITE"], "", "Renseigner le code postal.",
        ),
        "G-05": _record(
            "G-05", "HAUTE", "gps", _text("GPS (", lon, ", ", lat, ") ne correspond pas au code postal ", postal, "."),
            [*xy, "CP_SITE"], _text("Lon=", lon, ", Lat=", lat, ", CP=", postal, ", Dept=", region),
            "Vérifier la cohérence GPS / code postal.",
        ),
        "A-01": _record(
            "A-01", "GRAVE", "adresse", "Aucune information d'adresse renseignée.", [*STREET_FIELDS, "LIEU_DIT_SITE"], "",
            "Rencher l'adresse.",
        ),
        "A-02": _record(
            "A-02", "MOYENNE", "adresse", "L'adresse est renseignée mais le numéro de voie est absent.", ["NUM_VOIE_SITE"],
            _text("Numéro=, Rue=", street), "Compléter le numéro de rue si l'information existe.",
        ),
        "A-03": _record(
            "A-03", "FAIBLE", "adresse",
            "Le numéro de rue manque : la cohérence du nom de rue avec le département doit être vérifiée manuellement.",
            ["RUE_SITE", "NUM_RUE_SITE", "CP_SITE"], _text("Rue=", street, ", CP=", postal),
            "Contrôler le nom de rue avec la source métier du département.",
        ),
        "D-01": _record(
            "D-01", "FAIBLE", "pays", _text("Le département '", region, "' n'existe pas dans le référentiel."), ["CP_SITE"],
            _text("CP=", postal, ", Dept=", region), "Vérifier le code département.", label="Code département à vérifier",
        ),
    }


def evaluate_sites_v1(sites: DataFrame, boxes: DataFrame, regions: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Codes with priority and status, and the nullable diagnostic flags."""
    located = with_context(sites, boxes, regions, use_address=False)
    lon, lat = F.col("_lon"), F.col("_lat")
    both, started = F.col("_has_lon") & F.col("_has_lat"), F.col("_country") != ""
    numeric = started & both & lon.isNotNull() & lat.isNotNull()
    inside = F.when(numeric & F.col("country_box").isNotNull(), geo.in_bbox(lon, lat, F.col("country_box")))
    comparable = inside & (F.col("_postal") != "") & F.col("region_box").isNotNull()
    matches = F.when(comparable, geo.in_bbox(lon, lat, F.col("region_box")))
    flags = located.withColumns({
        "_HAS_GPS": F.col("_has_lon") | F.col("_has_lat"),
        "_GPS_IN_COUNTRY": inside,
        "_GPS_MATCH_POSTAL_CODE": matches,
        "_ADDRESS_PRESENT": _any_filled([*STREET_FIELDS, "LIEU_DIT_SITE"]),
        "_STREET_NUMBER_PRESENT": is_filled(F.col("NUM_VOIE_SITE")),
        "_street_text": _any_filled(STREET_FIELDS),
        "_home": F.when((F.col("_country") == HOME) & (F.col("_postal") != ""), F.col("region_box").isNotNull()),
    })
    gps = (
        F.when(~started, "P-01")
        .when(~both, F.when(F.col("_HAS_GPS"), "G-02"))
        .when(lon.isNull() | lat.isNull(), "G-03")
        .when(F.col("country_box").isNull(), "R-01")
        .when(~F.col("_GPS_IN_COUNTRY"), "G-04")
        .when(F.col("_postal") == "", "P-02")
        .when(~F.col("_GPS_MATCH_POSTAL_CODE"), "G-05")
    )
    coded = flags.withColumn("_gps", gps)
    valid = started & both & F.col("_gps").isNull()
    by_address = started & ~valid
    unnumbered = by_address & F.col("_ADDRESS_PRESENT") & ~F.col("_STREET_NUMBER_PRESENT")
    codes = F.array_compact(F.array(
        F.col("_gps"),
        F.when(by_address & ~F.col("_ADDRESS_PRESENT"), "A-01"),
        F.when(unnumbered, "A-02"),
        F.when(unnumbered & F.col("_street_text"), "A-03"),
        F.when(~F.col("_home"), "D-01"),
    ))
    address_ok = by_address & F.col("_ADDRESS_PRESENT") & F.col("_STREET_NUMBER_PRESENT")
    graded = coded.withColumn("_codes", codes).withColumn("_PRIORITY", worst_priority(F.col("_codes")))
    labels = {code: label for code, (label, _) in CATALOGUE.items()}
    results = {
        "_SITE_KEY": site_key("NU_CNT", "ID_SITE", row_id),
        "_CONTROL_MODE": F.when(valid, MODES["gps"]).when(address_ok, MODES["address"]).otherwise(MODES["none"]),
        "_CONTROL_STATUS": control_status(F.col("_PRIORITY")),
        "_PRIORITY": F.col("_PRIORITY"),
        **issue_columns(F.col("_codes"), labels),
        "_ISSUE_DETAILS": details_for(F.col("_codes"), build_details()),
        **{c: F.col(c) for c in ("_HAS_GPS", "_GPS_IN_COUNTRY", "_GPS_MATCH_POSTAL_CODE", "_ADDRESS_PRESENT", "_STREET_NUMBER_PRESENT")},
        "_DEPARTMENT_CODE": F.col("_region"),
        "_DEPARTMENT_COUNTRY_OK": F.col("_home"),
    }
    return graded.select(*sites.columns, *[c.alias(name) for name, c in results.items()])


def diagnostics(evaluated: DataFrame) -> DataFrame:
    return evaluated.select("_SITE_KEY", *[c for c in EXPORT_ORDER if c in evaluated.columns and c.startswith(("_HAS", "_GPS", "_ADDR", "_STREET", "_DEP"))])


def priority_rank(c: Column) -> Column:
    return F.coalesce(F.element_at(_lookup({p: i for i, p in enumerate(PRIORITIES)}), c), F.lit(0))


def sort_issues(evaluated: DataFrame) -> DataFrame:
    """Priority and number of issues falling, then contract and site."""
    return evaluated.orderBy(priority_rank(F.col("_PRIORITY")).desc(), F.col("_ISSUE_COUNT").desc(), "NU_CNT", "ID_SITE")


def consolidate(evaluated: DataFrame) -> DataFrame:
    """One row per site with issues; distinct texts of its details joined by ``; `` (sorted, so it is repeatable)."""
    details = F.col("_ISSUE_DETAILS")

    def joined(name: str) -> Column:
        texts = F.filter(F.transform(details, lambda d: d[name]), lambda t: F.length(t) > 0)
        return F.array_join(F.array_sort(F.array_distinct(texts)), "; ").alias(name)

    first = F.coalesce(F.get(details, F.lit(0))["CATEGORIE"], F.lit(""))
    return evaluated.filter("_ISSUE_COUNT > 0").select(
        "ID_SITE", "NU_CNT", F.col("_ISSUE_CODES").alias("CODE_ANOMALIE"), F.col("_ISSUE_SUMMARY").alias("LIBELLE"),
        F.col("_PRIORITY").alias("GRAVITE"), first.alias("CATEGORIE"), joined("DESCRIPTION"), joined("CHAMPS_CONCERNES"),
        joined("VALEUR_ACTUELLE"), joined("SUGGESTION"), F.lit("").alias("SCORE_SIMILARITE"),
    )


def enriched_export(evaluated: DataFrame) -> DataFrame:
    return sort_issues(evaluated).select(*[c for c in EXPORT_ORDER if c in evaluated.columns])
