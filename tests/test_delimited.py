"""Delimited files with line ends in quotes: many byte ranges against one task and against a plain parser."""

from __future__ import annotations

import csv
import io

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gristmill.sources import delimited


@pytest.fixture
def ranges(spark):
    """Sets the size of a range."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


def content(rows, seed, end="\n", sep=";"):
    random = np.random.default_rng(seed)
    out = io.StringIO()
    writer = csv.writer(out, delimiter=sep, lineterminator=end)
    writer.writerow(["id", "note", "b c", "last"])
    pieces = ["x", "word ", '"', '""', "\n", "\n\n", sep, "é", " ", "'", f'{sep}"', f'"{sep}', "\n;;;\n", ""]
    want = []
    for i in range(rows):
        note, other = ("".join(random.choice(pieces, int(random.integers(0, 9)))) for _ in range(2))
        want.append((str(i), note, other, "end" if i % 3 else "two\nlines"))
        writer.writerow(want[-1])
    return out.getvalue(), want


def ordered(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("at").collect()]


@pytest.mark.parametrize("size", [1 << 20, 97, 13])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_ranges_give_the_same_rows(spark, tmp_path, ranges, size, end):
    text, want = content(150, 5, end)
    (tmp_path / "a.csv").write_bytes(text.encode())
    ranges(size)
    got = delimited.read_delimited(spark, str(tmp_path / "a.csv"), ["id", "note", "b c", "last"], ";", ordinal="at")
    parts = got.rdd.getNumPartitions()
    assert parts > len(text) / size / 2
    rows = ordered(got, "id", "note", "b c", "last", "_corrupt")
    assert [tuple(v or "" for v in r[:4]) for r in rows] == want and all(r[4] is None for r in rows)


def test_megabyte_ranges_equal_one_task(spark, tmp_path, ranges):
    text, _ = content(100_000, 6)
    path = str(tmp_path / "large.csv")
    (tmp_path / "large.csv").write_bytes(text.encode())
    assert len(text) > 3 << 20
    ranges(1 << 20)
    got = delimited.read_delimited(spark, path, None, ";", ordinal="at")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") and "CartesianProduct" not in plan and "NestedLoop" not in plan
    one = spark.read.option("header", True).option("sep", ";").option("escape", '"').option("multiLine", True).csv(path)
    assert ordered(got, "id", "note", "b c", "last") == [tuple(r) for r in one.collect()]


def test_stray_quotes_do_not_open_fields(spark, tmp_path, ranges):
    (tmp_path / "s.csv").write_text('a;b\n5" pipe;1\n6;"x;\n7"" y"\n8" 9" 10";"z"\n"q"tail;2\n')
    for size in (1 << 20, 7):
        ranges(size)
        rows = ordered(delimited.read_delimited(spark, str(tmp_path / "s.csv"), ["a", "b"], ";", ordinal="at"), "a", "b")
        assert [r for r in rows if r[0] != '"q"tail'] [:3] == [('5" pipe', "1"), ("6", 'x;\n7" y'), ('8" 9" 10"', "z")] and len(rows) == 4


def test_broken_rows_are_set_aside(spark, tmp_path, ranges):
    (tmp_path / "b.csv").write_text('a;b\n1;2\n\n3\n4;5;6\n7;"eight\nnine"\n\n10;11\n')
    ranges(9)
    rows = delimited.read_delimited(spark, str(tmp_path / "b.csv"), ["a", "b"], ";", ordinal="at")
    good, bad = delimited.good_and_rejected(rows)
    assert ordered(good, "a", "b") == [("1", "2"), ("7", "eight\nnine"), ("10", "11")]
    assert ordered(bad, "_corrupt") == [("3",), ("4;5;6",)] and good.count() + bad.count() == rows.count()
    with pytest.raises(PySparkException, match="too few or too many fields"):
        delimited.or_fail(rows).collect()
    assert delimited.or_fail(delimited.good_and_rejected(rows)[0].withColumn("_corrupt", F.lit(None).cast("string"))).count() == 3


def test_files_with_their_own_column_order_and_empty_files(spark, tmp_path):
    (tmp_path / "1.csv").write_bytes("a;b\nä;2\n".encode("latin-1"))
    (tmp_path / "2.csv").write_bytes('b;extra;a\n"4\r\n5";x;3\n'.encode("latin-1"))
    (tmp_path / "3.csv").write_bytes(b"a;b\n")
    (tmp_path / "4.csv").write_bytes(b"")
    rows = delimited.read_delimited(spark, str(tmp_path), ["a", "b"], ";", "ISO-8859-1", "at")
    assert ordered(rows, "a", "b") == [("ä", "2"), ("3", "4\r\n5")]
    with pytest.raises(ValueError, match="extra"):
        delimited.read_delimited(spark, str(tmp_path), ["a", "extra"], ";")


def test_states_run_through_lines():
    random = np.random.default_rng(1)
    for _ in range(200):
        n = int(random.integers(0, 12))
        out, inside = random.random(n) < 0.5, random.random(n) < 0.5
        for start in (False, True):
            want = [start]
            for a, b in zip(out, inside):
                want.append(bool(b if want[-1] else a))
            assert delimited.run_through(out, inside, start).tolist() == want
