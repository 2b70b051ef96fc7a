"""Exhaustive variant: every check that fails is reported, with its own severity, instead of the first of a gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import geo
from gristmill.functions.text import is_empty, is_filled, normalize_string, number_text, safe_str, to_number, zero_fill
from gristmill.operators.joins import enrich, lookup
from gristmill.plans.city_check import city_check
from gristmill.plans.site_rules import _text, technical_gap, with_country_box

TECHNICAL_COLUMNS = [
    "CAPITAUX_MURS_BATIMENTS", "CAPITAUX_CONTENU", "CAPITAUX_MATERIEL", "CAPITAUX_MARCHANDISES", "CAPITAUX_TT", "SURFACE",
    "SURFACE_DPDCE",
]
SEVERE, LIGHT, INFO = "GRAVE", "LÉGÈRE", "INFO"


def _issue(when: Column, code: str, description, severity: str | Column) -> Column:
    text = description if isinstance(description, Column) else F.lit(description)
    level = severity if isinstance(severity, Column) else F.lit(severity)
    return F.when(when, F.struct(F.lit(code).alias("code"), text.alias("description"), level.alias("gravite")))


def _context(sites: DataFrame, boxes: DataFrame, regions: DataFrame) -> DataFrame:
    x, y = F.col("COORD_X_SITE"), F.col("COORD_Y_SITE")
    cp = safe_str(F.col("CP_SITE"))
    base = sites.withColumns({
        "_country": F.upper(safe_str(F.col("PAYS_SITE"))),
        "_cp": cp,
        "_postal": zero_fill(cp, 5),
        "_city": normalize_string(F.col("VILLE_SITE")),
        "_has_lon": is_filled(x),
        "_has_lat": is_filled(y),
        "_x": to_number(x),
        "_y": to_number(y),
        "_department": F.when(cp != "", geo.department(cp)),
    })
    located = with_country_box(base, boxes)
    # The department check does not look at the country, so only its own box table is joined.
    packed = regions.filter(F.col("country") == geo.HOME_COUNTRY).select(
        F.col("region_code").alias("_code"), geo.box_struct(*[F.col(c) for c in ("lon_min", "lat_min", "lon_max", "lat_max")]).alias("region_box")
    )
    return lookup(located, packed, {"_department": "_code"}, ["region_box"])


def evaluate_sites_full(
    sites: DataFrame, boxes: DataFrame, regions: DataFrame, cities: DataFrame, salt: int | None = None
) -> DataFrame:
    """Adds ``issues ARRAY<STRUCT<code, description, gravite>>`` and ``outcome``.

    ``cities`` holds ``(postal_code, city, ordinal)`` and, for the texts, the original spelling as ``name``; ``salt`` spreads
    sites of one very frequent city. ``outcome`` is ``gps_ok``, ``gps_issue``, ``address_ok`` or ``not_locatable``.
    """
    located = _context(sites, boxes, regions)
    asked = located.filter("_cp <> ''").select(F.col("_postal").alias("postal_code"), F.col("_city").alias("city"))
    verdicts = city_check(asked, cities)
    rows = enrich(
        located, verdicts, {"_postal": "postal_code", "_city": "city"},
        {"verdict": "_verdict", "best_city": "_best", "score": "_score", "expected": "_expected"}, salt=salt, unique=True,
    )
    raw_x, raw_y, both = F.col("COORD_X_SITE"), F.col("COORD_Y_SITE"), F.col("_has_lon") & F.col("_has_lat")
    x, y = F.col("_x"), F.col("_y")
    lon_ok, lat_ok = F.coalesce(x.between(-180, 180), F.lit(False)), F.coalesce(y.between(-90, 90), F.lit(False))
    ready = both & lon_ok & lat_ok
    box, region = F.col("country_box"), F.col("region_box")
    outside = ready & box.isNotNull() & ~geo.in_bbox(x, y, box)
    swapped = geo.in_bbox(y, x, box)
    flipped = geo.in_bbox(-x, y, box) | geo.in_bbox(x, -y, box)
    has_gps = F.col("_has_lon") | F.col("_has_lat")
    gps = F.array_compact(F.array(
        _issue(has_gps & ~both, "G-01", "GPS incomplet (une seule coordonnée)", LIGHT),
        _issue(both & x.isNull(), "G-02", _text("Longitude '", raw_x, "' non numérique"), SEVERE),
        _issue(both & x.isNotNull() & ~lon_ok, "G-02", _text("Longitude ", number_text(x), " hors limites"), SEVERE),
        _issue(both & y.isNull(), "G-03", _text("Latitude '", raw_y, "' non numérique"), SEVERE),
        _issue(both & y.isNotNull() & ~lat_ok, "G-03", _text("Latitude ", number_text(y), " hors limites"), SEVERE),
        _issue(outside & swapped, "G-06", "X/Y probablement inversés", INFO),
        _issue(outside & ~swapped & flipped, "G-07", "Signe probablement erroné", INFO),
        _issue(
            outside & ~swapped & ~flipped, "G-05",
            _text("GPS (", number_text(x), ",", number_text(y), ") hors de ", F.col("_country")), SEVERE,
        ),
        _issue(
            ready & region.isNotNull() & ~geo.in_bbox(x, y, region), "G-04",
            _text("GPS hors département ", F.col("_department")), SEVERE,
        ),
    ))
    staged = rows.withColumn("_gps_issues", gps)
    gps_failed = F.size("_gps_issues") > 0
    check_address = ~has_gps | gps_failed
    no_street = is_empty(F.col("RUE_SITE")) & is_empty(F.col("NUM_RUE_SITE")) & is_empty(F.col("ADRESSE_SITE"))
    filled_cp, city, verdict = F.col("_cp") != "", F.col("VILLE_SITE"), F.col("_verdict")
    percent = F.format_string(" (%.0f%%)", F.col("_score"))
    listed = _text("[", F.array_join(F.transform("_expected", lambda c: _text("'", c, "'")), ", "), "]")
    city_text = (
        F.when(verdict == "typo", _text("Probable typo : '", city, "' → '", F.col("_best"), "'", percent))
        .when(verdict == "doubtful", _text("Ville douteuse : '", city, "' vs '", F.col("_best"), "'", percent))
        .otherwise(_text("'", city, "' ≠ CP ", F.col("CP_SITE"), " (attendu: ", listed, ")"))
    )
    wrong_city = filled_cp & is_filled(city) & verdict.isin("typo", "doubtful", "mismatch")
    address = F.array_compact(F.array(
        _issue(~filled_cp, "A-01", "Code postal manquant", SEVERE),
        _issue(is_empty(city), "A-02", "Ville manquante", SEVERE),
        _issue(no_street, "A-03", "Rue manquante", LIGHT),
        _issue(
            filled_cp & (verdict == "unknown_postal"), "A-04",
            _text("CP '", F.col("CP_SITE"), "' non trouvé dans la référence"), SEVERE,
        ),
        _issue(wrong_city, "A-05", city_text, F.when(verdict == "mismatch", SEVERE).otherwise(LIGHT)),
    ))
    checked = staged.withColumn("_address_issues", F.filter(address, lambda _: check_address))
    address_failed = F.size("_address_issues") > 0
    first = F.array_compact(F.array(
        _issue(is_empty(F.col("PAYS_SITE")), "P-01", "Pays manquant", SEVERE),
        _issue(technical_gap(sites, TECHNICAL_COLUMNS), "P-07", "Données techniques manquantes", SEVERE),
    ))
    last = F.array_compact(F.array(_issue(~has_gps & address_failed, "L-01", "Site non localisable", SEVERE)))
    outcome = (
        F.when(has_gps & ~gps_failed, "gps_ok").when(has_gps, "gps_issue")
        .when(address_failed, "not_locatable").otherwise("address_ok")
    )
    return checked.select(
        *sites.columns, F.concat(first, "_gps_issues", "_address_issues", last).alias("issues"), outcome.alias("outcome")
    )


def issue_rows(evaluated: DataFrame) -> DataFrame:
    """One row per issue."""
    return evaluated.select("ID_SITE", "NU_CNT", F.inline("issues"))


def issues_by_severity(issues: DataFrame) -> DataFrame:
    counts = issues.groupBy("code", "gravite").agg(F.count("*").alias("n_issues"))
    return counts.orderBy(F.col("n_issues").desc(), "code", "gravite")
