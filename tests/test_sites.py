"""One site per branch of the rule cascade, with the expected codes and texts."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from gristmill.plans import city_check, quality, site_exhaustive, site_rules, site_severity
from gristmill.sources.tables import SITE_COLUMNS, string_schema

BASE = {"PAYS_SITE": "FRANCE", "CP_SITE": "12345", "NU_CNT": "C1", "ID_SITE": "S1"}
INSIDE = {"COORD_X_SITE": "2.5", "COORD_Y_SITE": "44.5"}
GOOD_ADDRESS = {"ADRESSE_SITE": "12 rue X", "NUM_VOIE_SITE": None}

# name -> (columns, codes, mode)
CASES = {
    "blank country": ({"PAYS_SITE": "  "}, "P-01", "INCOMPLET"),
    "unknown country": ({"PAYS_SITE": "atlantis"}, "R-01", "INCOMPLET"),
    "no gps, full address": (GOOD_ADDRESS, "", "ADRESSE_OK"),
    "no gps, address without number": ({"ADRESSE_SITE": "rue X"}, "A-02", "INCOMPLET"),
    "no gps, nothing": ({"ADRESSE_SITE": " \t"}, "A-01", "INCOMPLET"),
    "number column only": ({"NUM_VOIE_SITE": "7"}, "", "ADRESSE_OK"),
    "only x": ({"COORD_X_SITE": "2.5", **GOOD_ADDRESS}, "G-02", "ADRESSE_OK"),
    "only y": ({"COORD_Y_SITE": "44", "COORD_X_SITE": " "}, "G-02, A-01", "INCOMPLET"),
    "comma decimals": ({"COORD_X_SITE": "2,5", "COORD_Y_SITE": " 44,5 "}, "", "GPS_OK"),
    "not numeric": ({"COORD_X_SITE": "2.5d", "COORD_Y_SITE": "44", **GOOD_ADDRESS}, "G-03", "ADRESSE_OK"),
    "out of range": ({"COORD_X_SITE": "2.5", "COORD_Y_SITE": "91"}, "G-03, A-01", "INCOMPLET"),
    "outside": ({"COORD_X_SITE": "-20", "COORD_Y_SITE": "44", "LIEU_DIT_SITE": "Le Bourg"}, "G-04, A-02", "INCOMPLET"),
    "swapped": ({"COORD_X_SITE": "44.5", "COORD_Y_SITE": "2.5"}, "G-06, A-01", "INCOMPLET"),
    "no postal code": ({**INSIDE, "CP_SITE": None}, "P-02, A-01", "INCOMPLET"),
    "postal code in the address": ({**INSIDE, "CP_SITE": "", "ADRESSE_SITE": "rue X 12345 Y"}, "", "GPS_OK"),
    "region mismatch": ({**INSIDE, "CP_SITE": "59000", **GOOD_ADDRESS}, "G-05", "ADRESSE_OK"),
    "region unknown": ({**INSIDE, "CP_SITE": "99000"}, "", "GPS_OK"),
    "four digits": ({**INSIDE, "CP_SITE": "1234"}, "", "GPS_OK"),
    "island": ({**INSIDE, "CP_SITE": "20090", **GOOD_ADDRESS}, "G-05", "ADRESSE_OK"),
    "valid": (INSIDE, "", "GPS_OK"),
    "other country has no region rule": ({**INSIDE, "PAYS_SITE": " elbonia "}, "", "GPS_OK"),
}


@pytest.fixture(scope="module")
def boxes(spark):
    return spark.createDataFrame([("FRANCE", -5.0, 42.0, 9.5, 51.0), ("ELBONIA", 0.0, 40.0, 10.0, 50.0)], "country string, lon_min double, lat_min double, lon_max double, lat_max double")


@pytest.fixture(scope="module")
def regions(spark):
    rows = [("FRANCE", "12", 2.0, 44.0, 3.0, 45.0), ("FRANCE", "59", 2.0, 50.0, 4.0, 51.0), ("FRANCE", "2A", 8.5, 41.3, 9.4, 42.4), ("FRANCE", "01", 2.0, 44.0, 3.0, 45.0)]
    return spark.createDataFrame(rows, "country string, region_code string, lon_min double, lat_min double, lon_max double, lat_max double")


def make(spark, rows):
    values = [tuple(row.get(c) for c in SITE_COLUMNS) for row in rows]
    return spark.createDataFrame(values, string_schema(SITE_COLUMNS)).withColumn("row_id", F.monotonically_increasing_id())


@pytest.fixture(scope="module")
def sites(spark):
    return make(spark, [{**BASE, "NOM_SITE": name, **changes} for name, (changes, _, _) in CASES.items()])


def test_every_branch(sites, boxes, regions):
    rows = {r.NOM_SITE: r for r in site_rules.evaluate_sites(sites, boxes, regions).collect()}
    wrong = {n: (rows[n]._ISSUE_CODES, rows[n]._CONTROL_MODE) for n, (_, codes, mode) in CASES.items() if (rows[n]._ISSUE_CODES, rows[n]._CONTROL_MODE) != (codes, mode)}
    assert not wrong
    assert all(r._ISSUE_COUNT == len(r._ISSUE_DETAILS) == len([c for c in r._ISSUE_CODES.split(", ") if c]) for r in rows.values())
    outside = rows["outside"]._ISSUE_DETAILS[0]
    assert (outside.DESCRIPTION, outside.VALEUR_ACTUELLE) == ("GPS (-20.0, 44.0) situé hors de FRANCE.", "X=-20.0, Y=44.0, Pays=FRANCE")
    assert rows["only x"]._ISSUE_DETAILS[0].VALEUR_ACTUELLE == "X=2.5, Y=nan"
    assert rows["outside"]._ISSUE_SUMMARY == "Coordonnées GPS (X,Y) hors pays | Numéro de rue manquant"


def test_single_issue(sites, boxes, regions):
    rows = site_rules.evaluate_sites(sites, boxes, regions, single_issue=True).collect()
    assert {r.NOM_SITE: r._ISSUE_CODES for r in rows} == {n: codes.split(", ")[0] for n, (_, codes, _) in CASES.items()}


def test_counters_add_up(sites, boxes, regions):
    evaluated = site_rules.evaluate_sites(sites, boxes, regions)
    s = quality.quality_summary(evaluated).first()
    assert s.n_analysed == len(CASES) == s.n_ok + s.n_with_issues
    stats = {r.code: r.occurrences for r in quality.issue_stats(evaluated).collect()}
    expected = {}
    for _, codes, _ in CASES.values():
        for code in filter(None, codes.split(", ")):
            expected[code] = expected.get(code, 0) + 1
    assert stats == expected
    order = [(-r.occurrences, r.code) for r in quality.issue_stats(evaluated).collect()]
    assert order == sorted(order)


def test_site_keys(spark, boxes, regions):
    rows = make(spark, [{"NU_CNT": " A ", "ID_SITE": "1"}, {"NU_CNT": "A"}, {"ID_SITE": "1", "NU_CNT": " "}, {}]).coalesce(1).withColumn("row_id", F.monotonically_increasing_id())
    assert [r._SITE_KEY for r in site_rules.evaluate_sites(rows, boxes, regions).orderBy("row_id").collect()] == ["A::1", "A::ROW_1", "NO_CONTRACT::1", "ROW_3"]


def test_join_active(spark, sites):
    contracts = spark.createDataFrame(
        [("C1", "old", "3", 0), ("C1", "p1", " 1 ", 1), ("C1", "p2", "1", 2), (None, "p3", "1", 3)], "NOPOL string, PTGST string, CDSITP string, ordinal int"
    )
    joined = site_rules.join_active(sites, contracts, ["ordinal"])
    assert joined.count() == len(CASES) and {r.PTGST for r in joined.collect()} == {"p1"}
    assert site_rules.join_active(sites, contracts, ["ordinal"], salt=3).count() == len(CASES)
    assert site_rules.join_active(sites, contracts.filter("false"), ["ordinal"]).count() == len(CASES)


def test_country_filter(spark):
    rows = make(spark, [{"PAYS_SITE": None}, {"PAYS_SITE": "france"}, {"PAYS_SITE": "Elbonia"}])
    assert [r.PAYS_SITE for r in site_rules.country_filter(rows).collect()] == ["FRANCE", "france"]
    assert [r.PAYS_SITE for r in site_rules.country_filter(rows, ["Elbonia"]).collect()] == ["Elbonia"]


def test_severity_rules(sites, boxes, regions):
    rows = {r.NOM_SITE: r for r in site_severity.evaluate_sites_v1(sites, boxes, regions).collect()}
    got = {n: (r._ISSUE_CODES, r._PRIORITY, r._CONTROL_STATUS) for n, r in rows.items()}
    assert got["blank country"] == ("P-01", "HAUTE", "A_CORRIGER")
    assert got["unknown country"] == ("A-01", "HAUTE", "A_CORRIGER")
    assert got["no gps, full address"] == ("A-02, A-03", "MOYENNE", "A_COMPLETER")
    assert got["swapped"] == ("G-04, A-01", "HAUTE", "A_CORRIGER")
    assert got["valid"] == ("", "OK", "OK")
    assert got["region unknown"] == ("D-01", "FAIBLE", "A_VERIFIER")
    assert got["postal code in the address"][0] == "P-02, A-02, A-03"
    assert (rows["valid"]._GPS_IN_COUNTRY, rows["valid"]._GPS_MATCH_POSTAL_CODE, rows["valid"]._DEPARTMENT_COUNTRY_OK) == (True, True, True)
    assert (rows["only x"]._GPS_IN_COUNTRY, rows["only x"]._HAS_GPS) == (None, True)
    flags = site_severity.diagnostics(site_severity.evaluate_sites_v1(sites, boxes, regions))
    assert flags.columns == ["_SITE_KEY", "_HAS_GPS", "_GPS_IN_COUNTRY", "_GPS_MATCH_POSTAL_CODE", "_ADDRESS_PRESENT", "_STREET_NUMBER_PRESENT", "_DEPARTMENT_CODE", "_DEPARTMENT_COUNTRY_OK"]
    merged = {r.ID_SITE: r for r in site_severity.consolidate(site_severity.evaluate_sites_v1(sites.filter("NOM_SITE = 'swapped'"), boxes, regions)).collect()}["S1"]
    assert merged.CHAMPS_CONCERNES == "COORD_X_SITE, COORD_Y_SITE, PAYS_SITE; NUM_RUE_SITE, RUE_SITE, ADRESSE_SITE, LIEU_DIT_SITE"


def test_exhaustive_rules(spark, boxes, regions):
    full = {"VILLE_SITE": "Rodez", "RUE_SITE": "rue", "SURFACE": "1", "CP_SITE": "12000", "PAYS_SITE": "France"}
    cases = {
        "ok": ({**full, **INSIDE}, "", "gps_ok"),
        "comma is not numeric here": ({**full, "COORD_X_SITE": "2,5", "COORD_Y_SITE": "44"}, "G-02", "gps_issue"),
        "both wrong": ({**full, "COORD_X_SITE": "x", "COORD_Y_SITE": "95"}, "G-02, G-03", "gps_issue"),
        "sign": ({**full, "COORD_X_SITE": "2.5", "COORD_Y_SITE": "-44.5"}, "G-07, G-04", "gps_issue"),
        "country ignored by department": ({**full, "PAYS_SITE": "Atlantis", "COORD_X_SITE": "0", "COORD_Y_SITE": "0"}, "G-04", "gps_issue"),
        "typo": ({**full, "VILLE_SITE": "Rodezz"}, "A-05, L-01", "not_locatable"),
        "far": ({**full, "VILLE_SITE": "Paris"}, "A-05, L-01", "not_locatable"),
        "unknown code": ({**full, "CP_SITE": "99999"}, "A-04, L-01", "not_locatable"),
        "address ok": (full, "", "address_ok"),
        "empty": ({"PAYS_SITE": None}, "P-01, P-07, A-01, A-02, A-03, L-01", "not_locatable"),
    }
    rows = make(spark, [{"NOM_SITE": n, **c} for n, (c, _, _) in cases.items()])
    cities = spark.createDataFrame([("12000", "rodez", 0), ("12000", "onet", 1)], "postal_code string, city string, ordinal int")
    got = {r.NOM_SITE: r for r in site_exhaustive.evaluate_sites_full(rows, boxes, regions, cities).collect()}
    assert {n: (", ".join(i.code for i in r.issues), r.outcome) for n, r in got.items()} == {n: v[1:] for n, v in cases.items()}
    texts = {n: [(i.description, i.gravite) for i in r.issues if i.code == "A-05"] for n, r in got.items()}
    assert texts["typo"] == [("Probable typo : 'Rodezz' → 'rodez' (91%)", "LÉGÈRE")]
    assert texts["far"] == [("'Paris' ≠ CP 12000 (attendu: ['rodez', 'onet'])", "GRAVE")]


def test_city_check_equals_brute_force(spark):
    rng = random.Random(11)
    base = ["saint denis", "saint ouen", "paris", "lille", "lyon", "le mans", "marseille", "montreuil", "ay", "y"]

    def noisy(word):
        letters = list(word)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(letters) + 1)
            letters[i:i + rng.randint(0, 1)] = rng.choices("aeilst ", k=rng.randint(0, 1))
        return "".join(letters).strip()

    known = sorted({(rng.choice("12"), rng.choice(base)) for _ in range(14)})
    asked = sorted({(rng.choice("123"), noisy(rng.choice(base))) for _ in range(250)})
    cities = spark.createDataFrame([(p, c, i) for i, (p, c) in enumerate(known)], "postal_code string, city string, ordinal int")
    pairs = spark.createDataFrame(asked, "postal_code string, city string")
    got = {(r.postal_code, r.city): (r.verdict, r.best_city, r.expected) for r in city_check.city_check(pairs, cities).collect()}
    for postal, city in asked:
        options = [c for p, c in known if p == postal]
        if not options:
            want = ("unknown_postal", None, None)
        elif city in options or city == "":
            want = ("match", None, None)
        else:
            scores = [SequenceMatcher(None, city, c).ratio() * 100 for c in options]
            best = max(scores)
            name = options[scores.index(best)]
            want = ("typo", name, None) if best >= 90 else ("doubtful", name, None) if best >= 70 else ("mismatch", None, options)
        assert got[(postal, city)] == want, (postal, city)


def test_follow_up(spark, sites, boxes, regions):
    evaluated = site_rules.evaluate_sites(sites.withColumn("ID_SITE", F.col("NOM_SITE")), boxes, regions)
    earlier = evaluated.filter("NOM_SITE <> 'swapped'").withColumn("_ISSUE_CODES", F.when(F.col("NOM_SITE") == "valid", "G-04").otherwise(F.col("_ISSUE_CODES")))
    states = {(r.site_key, r.code): r.state for r in quality.follow_up(earlier, evaluated).collect()}
    assert states[("C1::swapped", "G-06")] == "new" and states[("C1::valid", "G-04")] == "resolved" and states[("C1::outside", "G-04")] == "open"
