"""Branches of the monthly jobs on small hand-made policies."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from gristmill.functions.dates import Period
from gristmill.operators import dedup, joins, rules, setops
from gristmill.plans import capital, consolidate, control, legacy, movements, premiums
from gristmill.queries.policy import CODES, LEGACY

PERIOD = Period.of(202306)
POLICY = (
    "id string, status string, nature string, sub_segment string, created date, effective_new date, processed_new date, cancelled date, processed_cancel date, "
    "link_type_1 string, link_date_1 date, link_type_2 string, link_date_2 date, link_type_3 string, link_date_3 date, cancel_reason string, cancel_case string, premium_net double"
)
NAMES = [part.split()[0] for part in POLICY.split(", ")]
DAY = date(2023, 3, 15)
OLD = date(2020, 5, 1)
NEXT = date(2024, 2, 1)


def policies(spark, rows):
    base = {"status": "1", "nature": "N1", "created": OLD, "effective_new": OLD, "processed_new": OLD, "premium_net": 100.0}
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in NAMES) for r in rows], POLICY)


def flags(df):
    out = movements.movements_main(df, PERIOD, CODES)
    return {r.id: "".join(n for n, v in zip("FNCRG", (r.n_in_force, r.n_new, r.n_cancelled, r.n_replaced, r.n_replacing)) if v) for r in out.collect()}


def test_main_movements(spark):
    cases = {
        "in force": ({}, "F"),
        "missing creation counts as early": ({"created": None}, "F"),
        "excluded sub-segment": ({"sub_segment": "5"}, ""),
        "missing sub-segment is not excluded": ({"sub_segment": None}, "F"),
        "other nature": ({"nature": "N3"}, ""),
        "cancelled later": ({"status": "3", "cancelled": NEXT}, "F"),
        "created this year": ({"created": DAY}, "FN"),
        "created after the period": ({"created": NEXT}, ""),
        "effective and processed this year": ({"effective_new": DAY, "processed_new": DAY}, "FN"),
        "effective before, processed now": ({"processed_new": DAY}, "FN"),
        "missing effective year is early": ({"effective_new": None, "processed_new": DAY}, "FN"),
        "cancelled this year": ({"status": "3", "cancelled": DAY}, "C"),
        "site contracts are not counted": ({"status": "3", "cancelled": DAY, "nature": "N4"}, ""),
        "handled this year, missing date": ({"status": "3", "processed_cancel": DAY}, "C"),
        "replaced": ({"status": "3", "cancelled": DAY, "link_type_2": "SB", "link_date_2": DAY}, "R"),
        "replaced another year": ({"status": "3", "cancelled": DAY, "link_type_2": "SB", "link_date_2": OLD}, "C"),
        "replacing": ({"created": DAY, "link_type_3": "BS", "link_date_3": DAY}, "FG"),
        "replaced link without cancellation": ({"link_type_1": "SB", "link_date_1": DAY}, "F"),
    }
    assert flags(policies(spark, [{"id": n, **c} for n, (c, _) in cases.items()])) == {n: f for n, (_, f) in cases.items()}


def test_anticipated(spark):
    rows = policies(spark, [
        {"id": "new", "effective_new": NEXT}, {"id": "replacing", "created": NEXT, "link_type_1": "BS"}, {"id": "gone", "cancelled": NEXT},
        {"id": "replaced", "cancelled": NEXT, "link_type_1": "SB"}, {"id": "silent", "cancelled": NEXT, "cancel_reason": "V"}, {"id": "none"},
    ])
    got = {r.id: (r.n_new_anticipated, r.n_cancelled_anticipated) for r in movements.anticipated(rows, PERIOD, CODES).collect()}
    assert got == {"new": (1, 0), "replacing": (0, 0), "gone": (0, 1), "replaced": (0, 0), "silent": (0, 0), "none": (0, 0)}


def test_exposure(spark):
    rows = policies(spark, [
        {"id": "whole"}, {"id": "late", "created": date(2023, 6, 21)}, {"id": "ended", "status": "3", "cancelled": date(2023, 1, 10), "nature": "N2"},
        {"id": "long ago", "status": "3", "cancelled": OLD}, {"id": "other", "status": "4"}, {"id": "future", "created": NEXT},
    ])
    got = {r.id: r for r in movements.exposure(rows, PERIOD, CODES).collect()}
    assert got["whole"].exposure_ytd == 181 / 365 and got["whole"].exposure_rolling == 364 / 364
    assert got["late"].exposure_ytd == 10 / 365 and got["late"].exposure_start == date(2023, 6, 21)
    assert got["ended"].exposure_ytd == 10 / 365 and got["ended"].exposure_end == date(2023, 1, 10)
    for name in ("long ago", "other", "future"):
        assert (got[name].exposure_ytd, got[name].exposure_start, got[name].exposure_end) == (0.0, None, None)


def test_legacy_dates_order(spark):
    names = "id string, state string, end date, cancelled date, term date, expiry date, final_end date, duration_code string, effective date"
    rows = spark.createDataFrame([
        ("lapse", "E", None, None, date(2022, 5, 31), None, None, "01", OLD), ("recent term", "E", None, None, date(2022, 6, 1), None, None, "01", OLD),
        ("temporary", "E", None, None, None, None, DAY, "05", OLD), ("expiry", "X", DAY, None, None, OLD, None, "05", OLD),
        ("missing expiry", "R", DAY, None, None, None, None, "05", OLD), ("future end", "E", NEXT, None, None, None, None, "05", NEXT),
    ], names)
    got = {r.id: r for r in legacy.legacy_dates(rows, PERIOD, LEGACY).collect()}
    assert (got["lapse"].state, got["lapse"].end, got["lapse"].cancelled) == ("R", date(2022, 5, 31), date(2022, 5, 31))
    assert (got["recent term"].state, got["recent term"].end) == ("E", None)
    assert (got["temporary"].state, got["temporary"].end) == ("R", DAY)
    assert got["expiry"].expiry == DAY and got["missing expiry"].expiry == DAY
    assert (got["future end"].n_new_anticipated, got["future end"].n_cancelled_anticipated) == (1, 1)


def test_legacy_regimes(spark):
    names = "id string, state string, product string, effective date, new_date date, end date, cancelled date, not_migrated int"
    rows = spark.createDataFrame([
        ("by month", "R", "1-URGENT", OLD, DAY, NEXT, None, 1), ("by month, later", "R", "1-URGENT", NEXT, date(2023, 7, 1), NEXT, None, 1),
        ("by effect", "R", "3-MEDIUM", DAY, None, NEXT, None, 1), ("old effect, new entry", "R", "3-MEDIUM", OLD, DAY, NEXT, None, 1),
        ("not closed", "E", "3-MEDIUM", DAY, DAY, None, None, 1), ("migrated", "R", "3-MEDIUM", DAY, DAY, DAY, DAY, 0),
        ("gone", "R", "3-MEDIUM", OLD, OLD, DAY, None, 1), ("gone late entry", "R", "3-MEDIUM", OLD, OLD, OLD, DAY, 1), ("uncounted", "R", "L02", DAY, DAY, DAY, DAY, 1),
    ], names)
    got = {r.id: (r.n_new, r.n_cancelled, r.n_in_force) for r in legacy.movements_legacy(rows, PERIOD, LEGACY).collect()}
    assert got == {
        "by month": (1, 0, 1), "by month, later": (0, 0, 0), "by effect": (1, 0, 1), "old effect, new entry": (1, 0, 1), "not closed": (0, 0, 1),
        "migrated": (0, 0, 0), "gone": (0, 1, 0), "gone late entry": (0, 1, 0), "uncounted": (0, 0, 0),
    }


def test_capital_modes(spark):
    rows = spark.createDataFrame([(1, [(1, "LIMIT A", 5.0), (2, "LIMIT B", None), (3, "OTHER", 9.0)]), (2, [(1, "OTHER", 1.0)]), (3, [(1, "LIMIT A", 7.0), (2, "NOT LIMIT", 8.0)])],
                                 "id int, groups array<struct<pos:int,label:string,amount:double>>")
    limit = dict(name="x", labels=["LIMIT"], not_exactly=("NOT LIMIT",))
    assert [r.x for r in capital.capital_last(rows, [capital.Measure(**limit)]).orderBy("id").collect()] == [None, 0.0, 7.0]
    assert [r.x for r in capital.capital(rows, [capital.Measure(**limit)]).orderBy("id").collect()] == [5.0, None, 7.0]
    assert [r.x for r in capital.capital(rows, [capital.Measure(**limit, seed=6.0)]).orderBy("id").collect()] == [6.0, 6.0, 7.0]


def test_pack_groups(spark):
    wide = spark.createDataFrame([("a", 1.0, "01", 1.5, "b", None, "11", 1.0)], "l1 string, a1 double, n1 string, c1 double, l2 string, a2 double, n2 string, c2 double")
    got = wide.select(capital.groups_column("l", "a", "n", "c", 2).alias("g")).first().g
    assert [tuple(x) for x in got] == [(1, "a", 1.0, "01", 1.5), (2, "b", None, "11", 1.0)]


def test_indexation(spark):
    index = spark.createDataFrame([("01", date(2023, 3, 1), 120.0), ("01", date(2020, 5, 1), 100.0)], "nature string, index_date date, index_value double")
    names = "id string, anniversary_mmdd string, effect_date date, groups array<struct<pos:int,amount:double,nature:string,coef:double>>"
    rows = spark.createDataFrame([
        ("indexed", "0301", OLD, [(1, 50.0, "01", 80.0), (2, 50.0, "11", 80.0), (3, 50.0, "02", 80.0), (4, None, "01", 80.0), (5, 50.0, None, 50.0)]),
        ("effect after anniversary", "0301", date(2023, 4, 1), [(1, 50.0, "01", 80.0)]), ("no such day", "0230", OLD, [(1, 50.0, "01", 80.0)]),
    ], names)
    got = {r.id: [g.indexed for g in r.groups] for r in capital.index_amounts(rows, index, PERIOD.last_day).collect()}
    assert got == {"indexed": [60.0, 50.0, 50.0, None, 50.0], "effect after anniversary": [50.0], "no such day": [50.0]}
    stored = {r.id: [g.indexed for g in r.groups] for r in capital.index_amounts(rows, index, None, today=PERIOD.last_day).collect()}
    assert stored["indexed"][:2] == [75.0, 50.0 * (1.0 / 80.0)]


def test_legacy_capital_groups_without_match(spark):
    lines = spark.createDataFrame([("p", "L", "I", 10.0, None), ("p", "L", "Z", 5.0, 5.0), ("q", "S", "Z", 1.0, 1.0)], "policy string, kind string, branch string, amount_full double, amount_company double")
    got = {r.policy: (r.limit_full, r.limit_company) for r in capital.legacy_capital(lines, {"limit": "L"}, ["I"], ["policy"]).collect()}
    assert got == {"p": (10.0, 0.0), "q": (0.0, 0.0)}


def test_premium_current_is_null_without_rows(spark):
    rows = spark.createDataFrame([("p", "2023 ", 5.0, 1.0), ("q", "2022", 7.0, 1.0), (None, " 2024", 2.0, 1.0)], "policy_no string, attached_year string, amount double, commission double")
    got = {r.policy_no: (r.premium_all, r.premium_current) for r in premiums.premiums(rows, 2023, ["policy_no"]).collect()}
    assert got == {"p": (5.0, 5.0), "q": (7.0, None), None: (2.0, 2.0)}


def test_merge_and_fill(spark):
    a = spark.createDataFrame([(1, "a", 1), (None, "b", 2), (3, "c", 3)], "k int, v string, x int")
    b = spark.createDataFrame([(1, None), (None, "n"), (4, "d")], "k int, v string")
    assert sorted(map(tuple, joins.merge_by(a, b, ["k"], "all").collect()), key=str) == sorted([(1, None, 1), (None, "n", 2), (3, "c", 3), (4, "d", None)], key=str)
    assert [tuple(r) for r in joins.merge_by(a, b, ["k"], "left_only").collect()] == [(3, "c", 3)]
    unique = joins.assert_unique(b, ["k"], null_safe=True)
    assert unique.count() == 3
    with pytest.raises(Exception, match="duplicate key"):
        joins.assert_unique(b.union(b), ["k"]).collect()


def test_as_of_floor(spark):
    ref = spark.createDataFrame([(202301, "a"), (202303, "b"), (202306, "c")], "period int, v string")
    assert [r.v for r in joins.as_of(ref, 202305).collect()] == ["b"]
    assert joins.as_of(ref, 202212).count() == 0
    assert [r.v for r in joins.as_of(ref, 202212, floor=202301).collect()] == ["b"]
    assert [r.v for r in joins.as_of(ref, 202304, floor=202301).collect()] == ["b"]


def test_keep_first_needs_order_and_is_stable(spark):
    df = spark.range(0, 1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id"))
    with pytest.raises(ValueError):
        dedup.keep_first(df, ["k"], [])
    assert dedup.keep_first(df, ["k"], ["id"]).filter("k = 0").first().id == 0


def test_finance_lines_and_parity(spark):
    sheet = spark.createDataFrame([("W", 1, 1.5, 1.0), ("W", 2, 2.5, 1.0), ("W", 3, 4.0, 2.0), (" ", 4, 9.0, 9.0), ("W", 5, None, 1.0), ("Z", 6, 1.0, 1.0)],
                                  "line string, position int, premium_all double, premium_current double")
    got = control.finance_premiums(sheet, {"W": ("A", "g")}, 202306).orderBy("network").collect()
    assert [(r.network, r.premium_all) for r in got] == [("1", 1500000.0), ("3", 2500000.0)]
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, 2.0)], "k int, v double")
    assert {r.column: r.same for r in control.parity_structure(a, b).collect()} == {"k": True, "v": False}
    many = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    sampled = control.parity_fields(many, many.withColumn("v", F.col("v") + 1), ["k"], fraction=0.2, seed=5).first()
    assert 100 < sampled.compared < 320 and sampled.differences == sampled.compared and sampled.one_sided == 0


def test_classification_order(spark):
    df = spark.createDataFrame([("ab",), ("b",), ("x",), (None,)], "v string")
    ordered = rules.classify_ordered(F.col("v"), [rules.Rule("contains", "A", "first"), rules.Rule("contains", "B", "second"), rules.Rule("codes", ("x",), "listed")], "none")
    assert [r.c for r in df.select(ordered.alias("c")).collect()] == ["first", "second", "listed", "none"]


def test_consolidated_rows_add_up(spark):
    main = spark.createDataFrame([("m",)], "policy_no string")
    old = spark.createDataFrame([("a",), ("b",)], "policy string")
    layouts = {"policy_no": "policy_no"}, {"policy_no": "policy"}
    assert consolidate.consolidate_book(main, old, Period.of(202306), *layouts).count() == 3
    assert consolidate.consolidate_book(main, old, Period.of(201210), *layouts).count() == 1


def test_layout_helpers(spark):
    df = spark.createDataFrame([("*12345", "a", 2), ("678", "b", 2), ("9", "c", 5)], "code string, temp string, n int")
    cleaned = consolidate.clean_codes(df, ["code"])
    assert [r.code for r in cleaned.collect()] == ["123", "678", "9"]
    assert setops.add_or_replace(df, {"temp": "code"}).columns == ["code", "n"]
    assert setops.add_or_replace(df, {"temp": "label"}).columns == ["code", "n", "label"]
    assert [r.code for r in setops.sort_by_count(df, "n").collect()] == ["9", "*12345", "678"]


def test_monthly_run_equals_its_parts(spark, tmp_path):
    from datetime import date

    from gristmill.plans import monthly
    from gristmill.queries import policy
    from gristmill.queries.base import Data

    d, asked = Data(spark, "/root/testdata/sf0.001"), []

    def load(name, source):
        asked.append((name, source))
        if name in ("1", "3"):
            return d.policies.filter(F.col("network") == name).drop("network")
        return d.legacy if name == "legacy" else policy._migrated(d)

    codes = monthly.MonthlyCodes(["1", "3"], policy.SCOPE, policy.CODES, policy.LEGACY, policy.MIGRATED_SINCE, policy._REASONS, "X")
    early, late = Period.of(199806), Period.of(201806)
    assert monthly.monthly_run(load, [early, late, late], date(2018, 7, 9), codes, str(tmp_path)) == [199806, 201806, 201806]
    assert asked[:2] == [("1", ("archive", 8 + (1998 - 2012) * 12 + 6)), ("3", ("archive", 8 + (1998 - 2012) * 12 + 6))]
    assert asked[2:6] == [(n, ("current", 201806)) for n in ("1", "3", "legacy", "migrated")] and len(asked) == 10
    written = spark.read.parquet(f"{tmp_path}/book")
    for period, n in ((early, None), (late, "legacy")):
        part = written.filter((F.col("year") == period.year) & (F.col("month") == period.month)).drop("year", "month")
        want = monthly.build_month(load, period, date(2018, 7, 9), codes)
        if n is None:
            assert part.filter("channel <> 'main'").isEmpty() and part.count() == want.count() > 0
        else:
            got = part.select(want.columns)
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not got.filter("channel = 'legacy'").isEmpty()
