"""Readers and writers on files made by the test."""

import gzip
import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from gristmill.functions.dates import Period
from gristmill.plans import consolidate, quality, schedule, site_rules
from gristmill.sources import delimited, references, sinks, tables
from gristmill.streaming.site_stream import check_sites_stream, follow_up_stream


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_separator_and_encoding(spark, tmp_path):
    assert tables.sniff_separator(spark, write(tmp_path / "a.csv", "a|b|c;d\n")) == "|"
    assert tables.sniff_separator(spark, write(tmp_path / "b.csv", "a;b,c\n")) == ";"
    assert tables.sniff_separator(spark, write(tmp_path / "c.csv", "a,b\n")) == ","
    assert tables.sniff_separator(spark, str(tmp_path / "missing.csv")) == ";"
    assert tables.sniff_encoding(spark, write(tmp_path / "u.csv", "é\n")) == "UTF-8"
    assert tables.sniff_encoding(spark, write(tmp_path / "l.csv", "é\n", "latin-1")) == "ISO-8859-1"
    assert tables.sniff_encoding(spark, write(tmp_path / "late.csv", "a\n" * 5000 + "é\n", "latin-1")) == "ISO-8859-1"


def test_strings_only(spark, tmp_path):
    path = write(tmp_path / "s.csv", 'b;a;extra\n007;"x; ""y""";1\nNA;;2\n', "latin-1")
    rows = tables.read_strings(spark, path, ["a", "b"])
    assert [tuple(r) for r in rows.collect()] == [('x; "y"', "007"), (None, None)]
    with pytest.raises(ValueError, match="zz"):
        tables.read_strings(spark, path, ["zz"])


def test_optional_and_union(spark, tmp_path):
    schema = "policy_no string, code string"
    there = write(tmp_path / "t.csv", "policy_no,code\np1,c\n,d\n")
    load = lambda p: (lambda: spark.read.option("header", True).csv(p))
    assert tables.read_optional(spark, load(str(tmp_path / "none.csv")), schema).columns == ["policy_no", "code"]
    got = consolidate.special_activity(spark, [load(there), load(str(tmp_path / "none.csv"))], schema)
    assert [tuple(r) for r in got.collect()] == [("p1", "c")]


def test_monthly_extracts(spark, tmp_path):
    folder = tmp_path / "2025" / "09"
    write(folder / "book_1.csv", "policy|label\n1|prix € œuvre\n", "iso8859-15")
    with gzip.open(folder / "book_2.csv.gz", "wb") as f:
        f.write("policy|label\n2|Š\n".encode("iso8859-15"))
    write(folder / "other.csv", "policy|label\n3|x\n")
    rows = tables.read_period(spark, str(tmp_path), Period.of(202509), "book_*.csv*").orderBy("policy").collect()
    assert [tuple(r) for r in rows] == [("1", "prix € œuvre"), ("2", "Š")]


def test_control_by_position(spark):
    sheet = spark.createDataFrame([("L", 1, 2.0)], "`a b` string, `x.y` int, z double")
    assert tables.read_control(sheet, {"line": 0, "premium": 2}).columns == ["line", "premium"]


def test_driver_tables_open(spark):
    opened = tables.load_tables(spark, "/root/testdata/sf0.001", ["region", "nation"])
    assert {name: df.count() for name, df in opened.items()} == {"region": 5, "nation": 25}


def test_blanks_become_null(spark):
    rows = tables.normalise_blanks(spark.createDataFrame([("a  ", "  ", 1), (" b", None, 2)], "k string, v string, n int"))
    assert [tuple(r) for r in rows.collect()] == [("a", None, 1), (" b", None, 2)]


def test_boxes_in_both_forms(spark, tmp_path):
    countries = write(tmp_path / "c.json", json.dumps({"France": {"name": "F", "bbox": [-5, 42.5, 9.5, 51]}, "B": [1.0, 2.0, 3.0, 4.0]}, indent=2))
    got = {r.country: (r.lon_min, r.lat_min, r.lon_max, r.lat_max) for r in references.load_country_boxes(spark, countries).collect()}
    assert got == {"FRANCE": (-5.0, 42.5, 9.5, 51.0), "B": (1.0, 2.0, 3.0, 4.0)}
    regions = references.load_region_boxes(spark, write(tmp_path / "r.json", json.dumps({"02": [1, 2, 3, 4], "2A": {"name": "x", "bbox": [5, 6, 7, 8]}})), "France")
    assert {(r.country, r.region_code, r.lon_max) for r in regions.collect()} == {("FRANCE", "02", 3.0), ("FRANCE", "2A", 7.0)}


def test_geojson_boxes(spark, tmp_path):
    def feature(props, kind, coordinates):
        return {"type": "Feature", "properties": props, "geometry": {"type": kind, "coordinates": coordinates}}

    square = [[[0.123456, 1], [2, 1], [2, 3.5], [0.123456, 1]]]
    data = {"features": [
        feature({"code": "01", "nom": "A"}, "Polygon", square), feature({"CODE": " 02 "}, "MultiPolygon", [square, [[[10, -4], [11, 9]]]]),
        feature({"nom": "no code"}, "Polygon", square), feature({"code": "03"}, "Point", [1, 2]), feature({"id": 7, "NAME": "seven"}, "Polygon", square),
    ]}
    got = references.region_bboxes(references.load_geojson(spark, write(tmp_path / "g.json", json.dumps(data))))
    assert {tuple(r) for r in got.collect()} == {("01", "A", 0.1235, 1.0, 2.0, 3.5), ("02", "", 0.1235, -4.0, 11.0, 9.0), ("7", "seven", 0.1235, 1.0, 2.0, 3.5)}


def test_countries_from_folders(spark, tmp_path):
    write(tmp_path / "refs" / "france" / "codes.csv", "x")
    write(tmp_path / "refs" / "Elbonia" / "deep" / "b.json", "{}")
    write(tmp_path / "refs" / "global.json", "{}")
    assert {r.country for r in references.discover_countries(spark, str(tmp_path / "refs")).collect()} == {"FRANCE", "ELBONIA"}


def test_postal_reference(spark):
    assert references.postal_columns(["#Code_postal", "Nom_de_la_commune"]) == ("#Code_postal", "Nom_de_la_commune")
    assert references.postal_columns(["cp", "Libellé"]) == ("cp", "Libellé") and references.postal_columns(["x", "y"]) == ("x", "y")
    rows = spark.createDataFrame([("F", "1000", "Bourg", 0), ("F", "01000", "Bourg ", 1), ("F", "2A004", "Ajaccio", 2), ("F", " ", "x", 3)], "c string, p string, v string, o int")
    got = sorted(tuple(r) for r in references.postal_cities(rows, "c", "p", "v", "o").collect())
    assert got == [("F", "01000", "bourg", 0), ("F", "2A004", "ajaccio", 2)]
    assert {(r.postal_code, r.city) for r in references.postal_map(rows.filter("p <> ' '"), "c", "v", "o").collect()} == {("F", "Ajaccio")}


def test_period_writes_are_repeatable(spark, tmp_path):
    base = str(tmp_path)
    for value, n in ((202301, 3), (202302, 5), (202301, 2)):
        sinks.write_period(spark.range(n).withColumn("v", F.lit(value)), base, "cube", Period.of(value))
    counts = {(r.year, r.month): r["count"] for r in spark.read.parquet(f"{base}/cube").groupBy("year", "month").count().collect()}
    assert counts == {(2023, 1): 2, (2023, 2): 5}


def test_backfill_and_routing(spark, tmp_path):
    done = schedule.backfill(
        Period.span(201112, 201202), lambda p: spark.range(p.month), str(tmp_path), "t", old=lambda p: spark.range(50), today=date(2022, 5, 1)
    )
    assert done == [201112, 201201, 201202]
    counts = {(r.year, r.month): r["count"] for r in spark.read.parquet(f"{tmp_path}/t").groupBy("year", "month").count().collect()}
    assert counts == {(2011, 12): 50, (2012, 1): 1, (2012, 2): 2}
    today = date(2023, 7, 3)
    assert schedule.source_period(Period.of(202306), today) == ("current", 202306)
    assert schedule.source_period(Period.of(202305), today) == ("archive", 8 + 11 * 12 + 5)
    special = {v: schedule.special_period(Period.of(v), today).value for v in (201302, 201703, 201803, 201809, 201901)}
    assert special == {201302: 201512, 201703: 201712, 201803: 201712, 201809: 201809, 201901: 201901}


def test_stream_equals_batch(spark, tmp_path):
    columns = tables.SITE_COLUMNS
    boxes = spark.createDataFrame([("FRANCE", -5.0, 42.0, 9.0, 51.0)], "country string, lon_min double, lat_min double, lon_max double, lat_max double")
    regions = spark.createDataFrame([("FRANCE", "59", 2.0, 50.0, 4.0, 51.0)], "country string, region_code string, lon_min double, lat_min double, lon_max double, lat_max double")
    rows = [{"ID_SITE": str(i), "NU_CNT": f"C{i}", "PAYS_SITE": ["france", "", "Elbonia"][i % 3], "COORD_X_SITE": ["NaN", "NA", "n/a", ""][i % 12 - 8] if i % 12 > 7 else str(i % 12), "COORD_Y_SITE": "45", "CP_SITE": "59000"} for i in range(60)]

    def export(name, part):
        lines = [";".join(columns)] + [";".join(r.get(c, "") for c in columns) for r in part]
        return write(tmp_path / "in" / name, "\n".join(lines) + "\n")

    export("a.csv", rows[:30])
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    run = lambda: check_sites_stream(spark, str(tmp_path / "in"), out, mark, boxes, regions).awaitTermination(120)
    run()
    assert spark.read.parquet(out).count() == 20
    export("b.csv", rows[30:])
    run()
    run()
    batch = tables.read_sites(spark, str(tmp_path / "in"), sep=";", encoding="UTF-8").withColumn("row_id", F.lit(0))
    expected = site_rules.evaluate_sites(site_rules.country_filter(batch), boxes, regions)
    pick = lambda df: sorted((r.ID_SITE, r._CONTROL_MODE, r._ISSUE_CODES) for r in df.collect())
    assert pick(spark.read.parquet(out)) == pick(expected) and len(pick(expected)) == 40


def test_stream_reads_by_name_rejects_and_repeats(spark, tmp_path):
    """Another column order, quoted line ends, broken rows, a file without a column, and a batch that runs twice."""
    columns = ["NU_CNT", "ID_SITE", *(c for c in tables.SITE_COLUMNS if c not in ("NU_CNT", "ID_SITE"))]
    boxes = spark.createDataFrame([("FRANCE", -5.0, 42.0, 9.0, 51.0)], "country string, lon_min double, lat_min double, lon_max double, lat_max double")
    regions = spark.createDataFrame([], "country string, region_code string, lon_min double, lat_min double, lon_max double, lat_max double")

    def line(i, order, **more):
        row = {"ID_SITE": str(i), "NU_CNT": f"C{i}", "PAYS_SITE": "France", "COORD_X_SITE": "2", "COORD_Y_SITE": "45", "NOM_SITE": f'"site\n""{i}"""', **more}
        return ";".join(row.get(c, "") for c in order)

    write(tmp_path / "in" / "a.csv", "\n".join([";".join(columns), *(line(i, columns) for i in range(5)), "too;few"]) + "\n")
    out, mark = tmp_path / "out", tmp_path / "mark"
    run = lambda: check_sites_stream(spark, str(tmp_path / "in"), str(out), str(mark), boxes, regions).awaitTermination(120)
    run()
    write(tmp_path / "in" / "b.csv", "\r\n".join([";".join(tables.SITE_COLUMNS), *(line(i, tables.SITE_COLUMNS) for i in range(5, 9))]) + "\r\n")
    write(tmp_path / "in" / "c.csv", "ID_SITE;NU_CNT\n9;C9\n")
    run()
    rows = lambda path: sorted(tuple(r) for r in spark.read.parquet(str(path)).select(*(["ID_SITE", "NU_CNT", "NOM_SITE", "_ISSUE_CODES"] if path == out else ["row"])).collect())
    first = rows(out)
    assert [r[:3] for r in first] == [(str(i), f"C{i}", f'site\n"{i}"') for i in range(9)]
    assert rows(tmp_path / "out_rejected") == [("9;C9",), ("too;few",)]
    commits = sorted((mark / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for p in (commits[-1], mark / "commits" / f".{commits[-1].name}.crc"):  # the last batch was written, but its end was not noted
        p.unlink(missing_ok=True)
    run()
    assert rows(out) == first and rows(tmp_path / "out_rejected") == [("9;C9",), ("too;few",)]


def test_follow_up_stream_equals_batch(spark, tmp_path):
    """Three months with a restart in between, then the last batch once more."""
    columns = tables.SITE_COLUMNS
    boxes = spark.createDataFrame([("FRANCE", -5.0, 42.0, 9.0, 51.0)], "country string, lon_min double, lat_min double, lon_max double, lat_max double")
    regions = spark.createDataFrame([], "country string, region_code string, lon_min double, lat_min double, lon_max double, lat_max double")
    paths = []

    def export(month):
        sites = [i for i in range(40) if (i + month) % 7]  # some are gone, some are back
        rows = [{"ID_SITE": str(i), "NU_CNT": f"C{i}", "PAYS_SITE": ["France", "", "Elbonia"][(i * month) % 3], "COORD_X_SITE": ["2", "50", ""][(i + month) % 3], "COORD_Y_SITE": "45"} for i in sites]
        paths.append(write(tmp_path / "in" / f"{month}.csv", "\n".join([";".join(columns), *(";".join(r.get(c, "") for c in columns) for r in rows)]) + "\n"))
        os.utime(paths[-1], (1_600_000_000 + month, 1_600_000_000 + month))

    out, state, mark = (str(tmp_path / n) for n in ("out", "state", "mark"))
    run = lambda: follow_up_stream(spark, str(tmp_path / "in"), out, state, mark, boxes, regions).awaitTermination(120)
    rows = lambda: sorted((r.batch, r.site_key, r.code, r.state) for r in spark.read.parquet(out).collect())
    export(1)
    export(2)
    run()
    export(3)
    run()

    def evaluated(path):
        sites = tables.read_sites(spark, path, sep=";", encoding="UTF-8").withColumn("row_id", F.lit(0))
        return site_rules.evaluate_sites(site_rules.country_filter(sites), boxes, regions)

    months = [evaluated(p) for p in paths]
    want = [(i, r.site_key, r.code, r.state) for i in range(3) for r in quality.follow_up(months[i - 1] if i else months[0].limit(0), months[i]).collect()]
    assert rows() == sorted(want) and {s for *_, s in want} == {"new", "open", "resolved"}
    (tmp_path / "mark" / "commits" / "2").unlink()
    (tmp_path / "mark" / "commits" / ".2.crc").unlink(missing_ok=True)
    run()
    assert rows() == sorted(want)


def test_monthly_extracts_with_line_ends_and_broken_rows(spark, tmp_path):
    folder = tmp_path / "2025" / "09"
    write(folder / "book_1.csv", 'policy|label\n1|"two\nlines €"\n2\n3|x|y\n4|z\n', "iso8859-15")
    write(folder / "book_2.csv", 'label|policy\n"Š"|5\n', "iso8859-15")
    period = Period.of(202509)
    good, bad = delimited.good_and_rejected(tables.read_period_rows(spark, str(tmp_path), period))
    assert sorted(tuple(r) for r in good.collect()) == [("1", "two\nlines €"), ("4", "z"), ("5", "Š")]
    assert sorted(r._corrupt for r in bad.collect()) == ["2", "3|x|y"]
    with pytest.raises(Exception, match="too few or too many fields"):
        tables.read_period(spark, str(tmp_path), period).collect()


def test_file_order_over_several_files(spark, tmp_path):
    for i, n in enumerate((400, 3, 90)):
        write(tmp_path / "in" / f"{i}.csv", "a;b\n" + "".join(f"{i};{k}\n" for k in range(n)))
    rows = tables.read_strings(spark, str(tmp_path / "in"), ["a", "b"], sep=";", encoding="UTF-8", ordinal="place").repartition(5).orderBy("place").collect()
    assert [(r.a, r.b) for r in rows] == [(str(i), str(k)) for i, n in enumerate((400, 3, 90)) for k in range(n)]


def test_quoted_line_ends_and_broken_rows(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a;b\n1;"two\nlines"\n2;x\n')
    assert [tuple(r) for r in tables.read_strings(spark, path, ["a", "b"]).orderBy("a").collect()] == [("1", "two\nlines"), ("2", "x")]
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_strings(spark, path, ["a", "b"], multiline=False).collect()


def test_empty_contracts_and_empty_support(spark):
    sites = spark.createDataFrame([("C1", "France"), ("C2", None)], "NU_CNT string, PAYS_SITE string")
    contracts = spark.createDataFrame([("C1", "G", "1", 0)], "NOPOL string, PTGST string, CDSITP string, ordinal int")
    assert [tuple(r) for r in site_rules.join_active(sites, contracts, ["ordinal"]).collect()] == [("C1", "France", "G")]
    assert sorted(tuple(r)[::2] for r in site_rules.join_active(sites, contracts.limit(0), ["ordinal"]).collect()) == [("C1", None), ("C2", None)]
    assert site_rules.country_filter(sites, []).isEmpty() and site_rules.country_filter(sites).count() == 2


def test_read_portions_are_bounded():
    from gristmill.sources.trees import _portions
    assert list(_portions([3, 3, 9, 1, 1, 1], 6)) == [(0, 2), (2, 1), (3, 3)] and list(_portions([])) == [] and list(_portions([None, 70], 6)) == [(0, 1), (1, 1)]


def test_quality_run_from_files(spark, tmp_path):
    def sites_row(**values):
        return ";".join(values.get(c, "") for c in tables.SITE_COLUMNS)

    export = write(tmp_path / "sites.csv", "\n".join([
        ";".join(tables.SITE_COLUMNS), sites_row(NU_CNT="C1", ID_SITE="1", COORD_X_SITE="2", COORD_Y_SITE="45", CP_SITE="59000"), sites_row(NU_CNT="C1", ID_SITE="2"),
        sites_row(NU_CNT="C2", ID_SITE="3"), sites_row(NU_CNT="C1", ID_SITE="4", PAYS_SITE="Elbonia"),
    ]) + "\n")
    contracts = write(tmp_path / "contracts.csv", "NOPOL;PTGST;CDSITP\nC1;G1;1\nC1;G2;1\nC2;G;3\n")
    write(tmp_path / "refs" / "FRANCE" / "regions.json", "{}")
    boxes = write(tmp_path / "boxes.json", json.dumps({"FRANCE": [-5, 42, 9, 51]}))
    regions = write(tmp_path / "regions.json", json.dumps({"59": [1, 44, 3, 46]}))
    result = quality.run_quality_files(spark, export, contracts, str(tmp_path / "refs"), boxes, {"FRANCE": regions}, str(tmp_path / "out"))
    assert sorted((r.ID_SITE, r.PTGST, r._CONTROL_MODE, r._ISSUE_CODES) for r in result["sites"].collect()) == [("1", "G1", "GPS_OK", ""), ("2", "G1", "INCOMPLET", "A-01")]
    assert spark.read.parquet(str(tmp_path / "out" / "detail")).count() == 1
    s = spark.read.option("header", True).csv(str(tmp_path / "out" / "summary")).first()
    assert (s.n_total, s.n_inactive, s.n_analysed) == ("4", "1", "2")


def test_quality_run_writes(spark, tmp_path):
    path = write(tmp_path / "sites.csv", ";".join(tables.SITE_COLUMNS) + "\n" + ";".join("C1" if c == "NU_CNT" else "1" if c == "ID_SITE" else "" for c in tables.SITE_COLUMNS) + "\n")
    sites = tables.read_sites(spark, path).withColumn("row_id", F.monotonically_increasing_id())
    contracts = spark.createDataFrame([("C1", "G", "1", 0)], "NOPOL string, PTGST string, CDSITP string, ordinal int")
    boxes = spark.createDataFrame([("FRANCE", -5.0, 42.0, 9.0, 51.0)], "country string, lon_min double, lat_min double, lon_max double, lat_max double")
    regions = spark.createDataFrame([], "country string, region_code string, lon_min double, lat_min double, lon_max double, lat_max double")
    result = quality.run_quality(sites, contracts, boxes, regions)
    sinks.write_quality(result["summary"], result["detail"], str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report" / "detail")).first().LIBELLE == "Adresse manquante"
    assert spark.read.option("header", True).csv(str(tmp_path / "report" / "summary")).first().n_total == "1"
