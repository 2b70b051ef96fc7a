"""Scalar functions against independent Python statements of the same rules."""

import random
import re
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from gristmill.functions import dates, geo, missing, numbers, text
from gristmill.plans.city_check import similarity

PIECES = ["12", "59000", " ", "\t", " ", "rue", "Île", ".0", "-", ",5", "", "2B", "007", "e", "\n", "é59800", "_", "1234 "]


def samples(n=400, seed=7):
    rng = random.Random(seed)
    return [None] + ["".join(rng.choices(PIECES, k=rng.randint(0, 5))) for _ in range(n)]


def check(spark, column, model, values=None):
    values = values or samples()
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.x for r in rows.select("i", column(F.col("v")).alias("x")).collect()}
    wrong = [(v, got[i], model(v)) for i, v in enumerate(values) if got[i] != model(v)]
    assert not wrong, wrong[:5]


def test_strip_and_empty(spark):
    check(spark, text.safe_str, lambda v: (v or "").strip())
    check(spark, text.is_empty, lambda v: v is None or not v.strip())
    check(spark, text.is_filled, lambda v: bool(v and v.strip()))


def test_normalised_text(spark):
    check(spark, text.normalize_string, lambda v: " ".join((v or "").lower().split()))
    check(spark, text.normalize_country, lambda v: " ".join((v or "").split()).upper())


def test_keys_and_postal(spark):
    def whole(v):
        return v[:-2] if v.endswith(".0") and v[:-2].isdigit() else v

    def postal(v):
        code = whole((v or "").strip().upper().replace(" ", "").replace("-", ""))
        return code.zfill(8) if code.isdigit() else code

    check(spark, text.norm_key, lambda v: whole((v or "").strip()))
    check(spark, lambda c: text.normalize_postal(c, 8), postal)


def test_extraction(spark):
    def found(pattern, v, start=False):
        m = (re.match if start else re.search)(pattern, (v or "").strip())
        return m.group(1) if m else ""

    check(spark, text.extract_postal, lambda v: found(r"\b(\d{5})\b", v))
    check(spark, text.extract_street_no, lambda v: found(r"^(\d{1,4})\s", v, start=True))


def test_coordinates(spark):
    def model(v):
        try:
            value = float((v or "").strip().replace(",", "."))
        except ValueError:
            return None
        return value if -180 <= value <= 180 else None

    values = samples() + ["1,5", " 48.85 ", "1.0d", "1f", "-180", "180.0001", "nan", "inf", "1e1", ".5", "5.", "1,2,3", "0x1p3", "+7"]
    check(spark, lambda c: text.parse_coordinate(c, -180.0, 180.0), model, values)


def test_number_text_matches_python(spark):
    values = [0.0, 1.0, -2.35, 48.8566, 0.001, 0.0005, -0.000123, 0.00001, 1.5e-7, 179.999999, 12.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.x for r in rows.select(text.number_text(F.col("v")).alias("x")).collect()] == [str(v) for v in values]


def test_department(spark):
    def model(v):
        cp = (v or "").strip().zfill(5)
        if cp[:3] in geo.OVERSEAS:
            return cp[:3]
        if cp[:2] == "20":
            return "2A" if cp[2] in "012" else "2B"
        return cp[:2]

    check(spark, geo.department, model, ["75001", "1000", "20000", "20190", "20200", "20600", "97150", "97500", "97400", "123456", None, " 02100 "])


def test_similarity_is_matching_blocks(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcde ", k=rng.randint(0, 9))) for _ in range(60)]
    pairs = list(zip(words, reversed(words)))
    rows = spark.createDataFrame(pairs, "a string, b string")
    got = [r.s for r in rows.select(similarity("a", "b").alias("s")).collect()]
    assert got == [SequenceMatcher(None, a, b).ratio() * 100 for a, b in pairs]


def test_missing_sorts_first(spark):
    rows = spark.createDataFrame([(None, None), (None, 1), (1, None), (1, 1), (1, 2), (2, 1)], "a int, b int")
    rank = lambda v: (v is not None, v or 0)
    models = {
        missing.gt_m: lambda a, b: rank(a) > rank(b), missing.lt_m: lambda a, b: rank(a) < rank(b), missing.ge_m: lambda a, b: rank(a) >= rank(b),
        missing.le_m: lambda a, b: rank(a) <= rank(b), missing.eq_m: lambda a, b: a == b, missing.ne_m: lambda a, b: a != b,
    }
    for helper, model in models.items():
        for r in rows.select("a", "b", helper(F.col("a"), F.col("b")).alias("x"), helper(F.col("a"), 1).alias("y")).collect():
            assert (r.x, r.y) == (model(r.a, r.b), model(r.a, 1)), (helper.__name__, r)
    listed = rows.select("a", missing.in_m(F.col("a"), [1]).alias("i"), missing.notin_m(F.col("a"), [1]).alias("n"), missing.between_m(1, F.col("a"), 1).alias("b"))
    assert all((r.i, r.n, r.b) == (r.a == 1, r.a != 1, r.a == 1) for r in listed.collect())


def test_numbers(spark):
    rows = spark.createDataFrame([(None, None), (None, 2.0), (1.0, 2.0)], "a double, b double")
    got = rows.select(numbers.sum_m(F.col("a"), F.col("b")).alias("s"), (F.col("a") + F.col("b")).alias("p"), numbers.least_m(F.col("a"), F.col("b")).alias("l"),
                      numbers.greatest_m(F.col("a"), F.col("b")).alias("g")).collect()
    assert [tuple(r) for r in got] == [(None, None, None, None), (2.0, None, 2.0, 2.0), (3.0, 3.0, 1.0, 2.0)]
    halves = spark.createDataFrame([(2.5,), (-2.5,)], "v double").select(numbers.round_half_up(F.col("v")).alias("r")).collect()
    assert [r.r for r in halves] == [3.0, -3.0]
    shares = spark.createDataFrame([(10.0, None), (10.0, 0.0), (10.0, 40.0)], "v double, s double")
    assert [r.x for r in shares.select(numbers.to_full_share(F.col("v"), F.col("s")).alias("x")).collect()] == [10.0, 10.0, 25.0]


def test_labels_and_codes(spark):
    rows = spark.createDataFrame([(999,), (1024,), (1536,), (5 * 1024 * 1024,)], "n long")
    assert [r.x for r in rows.select(text.size_label(F.col("n")).alias("x")).collect()] == ["999 B", "1.0 KB", "1.5 KB", "5.0 MB"]
    big = spark.createDataFrame([(1234567,)], "n long").select(text.group_thousands(F.col("n")).alias("x"))
    assert big.first().x == "1 234 567"
    codes = spark.createDataFrame([("A-01, G-02 ,",), (None,)], "c string").select(text.split_codes(F.col("c")).alias("x")).collect()
    assert [r.x for r in codes] == [["A-01", "G-02"], []]


def test_period_constants():
    p = dates.Period.of(202302)
    assert (str(p.first_day), str(p.last_day), str(p.year_start), str(p.year_end)) == ("2023-02-01", "2023-02-28", "2023-01-01", "2023-12-31")
    assert str(p.rolling_start) == "2022-03-01" and str(dates.Period.of(202312).rolling_start) == "2023-01-01"
    assert p.previous().value == 202301 and dates.Period.of(202301).previous().value == 202212
    assert [q.value for q in dates.Period.span(202211, 202302)] == [202211, 202212, 202301, 202302]


def test_dates(spark):
    rows = spark.createDataFrame([("105",), ("1231",), ("0230",), ("0229",), (None,)], "m string")
    got = rows.select(dates.anniversary(F.col("m"), dates.date(2023, 6, 30)).cast("string").alias("a"), dates.anniversary_month(F.col("m")).alias("mm")).collect()
    assert [r.a for r in got] == ["2023-01-05", "2022-12-31", None, None, None]
    assert [r.mm for r in got] == [1, 12, 2, 2, None]
    stamp = spark.createDataFrame([("14MAY1991:00:00:00",), ("bad",), (None,)], "s string").select(dates.sas_date(F.col("s")).cast("string").alias("d")).collect()
    assert [r.d for r in stamp] == ["1991-05-14", None, None]
