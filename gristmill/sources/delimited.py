"""Delimited files with line ends inside quotes, read by many tasks.

Spark's text source cuts files into byte ranges at line ends, whatever stands between quotes. Whether a line begins inside a quoted field
depends on all lines before it, but a line only ever maps that state to another one, so each range is first reduced to what it makes of
either state. Running through the ranges of a file, one small row each, gives the state that every range starts in; then all are read in
parallel. Only records that reach over the border of a range are put together by a shuffle.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CORRUPT = "_corrupt"
#: Kinds of what a range gives: a whole record, and pieces of records that end, begin, or neither begin nor end in it.
WHOLE, TAIL, HEAD, MIDDLE = range(4)


def _line_states(value: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line leaves a quoted field open if it starts outside of one, and if it starts inside.

    A quote opens a field only where the field begins; inside, two quotes are one; what follows a closing quote up to the separator is part
    of the field. A line without quotes, the usual one, changes nothing.
    """
    s = re.escape(sep)
    inner, rest = '(?:[^"]|"")*+', f"[^{s}]*+"
    fields = f'(?:(?:"{inner}"{rest}|[^"{s}]{rest}|){s})*+'
    opened = f'{fields}"{inner}'
    quoted = value.contains('"')
    return (
        quoted & value.rlike(rf"\A{opened}\z"),
        ~quoted | value.rlike(rf'\A{inner}(?:\z|"{rest}{s}{opened}\z)'),
    )


def _lines(spark: SparkSession, path: str | list[str], sep: str, pattern: str | None) -> DataFrame:
    """(range, out, inside, value, file, start, length) of every physical line."""
    reader = spark.read.option("lineSep", "\n")
    raw = (reader.option("pathGlobFilter", pattern) if pattern else reader).text(path)
    place = [F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_block_start", "start"), ("file_block_length", "length"))]
    lines = raw.select(*place, F.col("value"))
    out, inside = _line_states(F.col("value"), sep)
    return lines.select("file", "start", "length", F.xxhash64("file", "start", "length").alias("range"), out.alias("out"), inside.alias("inside"), F.col("value").cast("binary").alias("value"))


def run_through(out: np.ndarray, inside: np.ndarray, state: bool) -> np.ndarray:
    """State before each line and behind the last, given what the lines make of either state.

    A line either sets the state, keeps it or turns it: the last line that set it counts, and how many have turned it since.
    """
    n = len(out)
    sets, turns = np.append(True, out == inside), np.append(False, out & ~inside)
    last = np.maximum.accumulate(np.where(sets, np.arange(n + 1), 0))
    turned = np.cumsum(turns)
    return np.append(state, out)[last] ^ ((turned - turned[last]) % 2 == 1)


STATES = "range long, file string, start long, out boolean, inside boolean, first binary"


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each range makes of either state, and the first line of a file."""
    states: dict[int, list] = {}
    for batch in batches:
        ranges, out, inside = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("range", "out", "inside"))
        for part in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(ranges)) + 1):
            if len(part):
                i, known = int(part[0]), states.get(int(ranges[part[0]]))
                file, start, before, first = known or (batch.column("file")[i].as_py(), batch.column("start")[i].as_py(), (False, True), batch.column("head")[i].as_py())
                states[int(ranges[i])] = [file, start, tuple(bool(run_through(out[part], inside[part], s)[-1]) for s in before), first]
    if states:
        file, start, behind, first = zip(*states.values())
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
        columns = (list(states), file, start, [s[0] for s in behind], [s[1] for s in behind], first)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], [c.split()[0] for c in STATES.split(", ")])


@dataclass(frozen=True)
class Range:
    """Where a range of bytes lies, whether it starts inside a quoted field, and which of the header lines its file has."""

    file: str
    start: int
    inside: bool
    layout: int


def measured_ranges(lines: DataFrame) -> tuple[dict[int, Range], list[bytes]]:
    """The ranges by their hash, and the different header lines. There is one for each split of the input, so they fit the driver."""
    head = F.when(F.col("start") == 0, F.col("value"))
    states = lines.select("range", "file", "start", "out", "inside", head.alias("head")).mapInArrow(_reduced, STATES)
    ranges, headers, state, layout = {}, {}, False, 0
    for r in sorted(states.collect(), key=lambda r: (r.file, r.start)):
        if r.start == 0:
            state = False
            layout = headers.setdefault(bytes(r["first"]).removeprefix(b"\xef\xbb\xbf").rstrip(b"\r"), len(headers))
        ranges[r["range"]] = Range(r.file, r.start, state, layout)
        state = r.inside if state else r.out
    return ranges, list(headers)


PIECES = "layout int, file_path string, file_block_start long, row long, kind int, value binary"


class _Records:
    """Records of the ranges that one task reads, in order: lines are joined where a quoted field holds their ends."""

    def __init__(self, ranges: dict[int, Range]) -> None:
        self.ranges, self.range, self.state, self.next, self.row, self.open, self.done = ranges, None, False, 0, -1, [], []

    def enter(self, range_: int) -> None:
        self.leave()
        if range_ not in self.ranges:
            raise RuntimeError("the input was split otherwise than when it was measured; read it again")
        self.range = self.ranges[range_]
        self.state, self.next, self.row = self.range.inside, 0, -1

    def leave(self) -> None:
        if self.open:
            self.put(MIDDLE if self.row < 0 else HEAD)

    def put(self, kind: int) -> None:
        self.done.append((self.row, kind, b"\n".join(self.open)))
        self.row, self.open = -1, []

    def batch(self, rows, kinds, values) -> pa.RecordBatch:
        n, r = len(values), self.range
        columns = [pa.array([r.layout] * n, pa.int32()), pa.array([r.file] * n), pa.array([r.start] * n, pa.int64()), pa.array(rows, pa.int64()), pa.array(kinds, pa.int32()), values]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

    def read(self, out: np.ndarray, inside: np.ndarray, value: pa.Array) -> Iterator[pa.RecordBatch]:
        """Lines of the range. A line that is a record, the usual one, is passed on as it stands."""
        states = run_through(out, inside, self.state)
        before, behind = states[:-1], states[1:]
        place = self.next - 1 + np.cumsum(~before)
        single = ~before & ~behind
        if single.any():
            yield self.batch(place[single], np.full(int(single.sum()), WHOLE), value.filter(pa.array(single)))
        for i in np.flatnonzero(~single).tolist():
            if not before[i]:
                self.row = int(place[i])
            self.open.append(value[i].as_py())
            if not behind[i]:
                self.put(TAIL if self.row < 0 else WHOLE)
        self.state, self.next = bool(states[-1]), int(place[-1]) + 1
        yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.done:
            rows, kinds, values = zip(*self.done)
            self.done = []
            yield self.batch(rows, kinds, pa.array(values, pa.binary()))


def _pieces(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, current = _Records(known.value), None
        for batch in batches:
            ranges, out, inside = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("range", "out", "inside"))
            for part in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(ranges)) + 1):
                if len(part):
                    if int(ranges[part[0]]) != current:
                        records.leave()
                        yield from records.flush()
                        current = int(ranges[part[0]])
                        records.enter(current)
                    yield from records.read(out[part], inside[part], batch.column("value").slice(int(part[0]), len(part)))
        records.leave()
        yield from records.flush()

    return run


def read_records(spark: SparkSession, path: str | list[str], sep: str, pattern: str | None = None) -> tuple[DataFrame, list[bytes]]:
    """(layout, file_path, file_block_start, row, value) of every record of delimited files, and the header lines that ``layout`` counts.

    Header lines and empty lines are left out. A record stands at the range and row where it begins, so the order of the three columns
    of its place is that of the files. Lines end with ``\\n`` or ``\\r\\n``; a header is one line. Measuring is a job of its own, which reads the files once.
    """
    lines = _lines(spark, path, sep, pattern)
    ranges, headers = measured_ranges(lines)
    known = spark.sparkContext.broadcast(ranges)
    pieces = lines.select("range", "out", "inside", "value").mapInArrow(_pieces(known), PIECES)
    # What reaches over a border is at most two pieces a range; each record is its head and what follows until the next one.
    over = pieces.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file_path").orderBy("file_block_start", "row")
    over = over.withColumn("chain", F.sum((F.col("kind") == HEAD).cast("int")).over(order))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("file_block_start", "row", "value"))), lambda p: p["value"])
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, F.lit(b"\n"), part), lambda done: F.substring(done, 2, 1 << 30))
    at = F.min(F.struct("file_block_start", "row", "layout")).alias("at")
    over = over.groupBy("file_path", "chain").agg(at, joined.alias("value")).select("at.layout", "file_path", "at.file_block_start", "at.row", "value")
    whole = pieces.where(F.col("kind") == WHOLE).drop("kind").unionByName(over)
    whole = whole.where(~((F.col("file_block_start") == 0) & (F.col("row") == 0)))
    return whole.where(~F.col("value").isin(b"", b"\r")), headers


def _names(header: bytes, sep: str, encoding: str) -> list[str]:
    return next(csv.reader([header.decode(encoding)], delimiter=sep), [])


def _chosen(places: list[int]):
    """The fields at these places as f0, f1 and so on."""
    return lambda parsed: F.struct(*(parsed[f"c{k}"].alias(f"f{i}") for i, k in enumerate(places)), parsed[CORRUPT].alias(CORRUPT))


def read_delimited(
    spark: SparkSession, path: str | list[str], columns: list[str] | None, sep: str, encoding: str = "UTF-8", ordinal: str | None = None, pattern: str | None = None,
    incomplete: str = "fail",
) -> DataFrame:
    """Chosen columns by name, or those of the first header, all as strings, with the place of each row if ``ordinal`` names it.

    Files may have their columns in different orders. The column ``_corrupt`` holds the text of records with too few or too many fields, which
    :func:`good_and_rejected` separates; it is null for good ones. A file without one of the columns is an error, or
    with ``incomplete="reject"`` all its records are rejected.
    """
    records, headers = read_records(spark, path, sep, pattern)
    layouts = [_names(h, sep, encoding) for h in headers]
    columns = (layouts[0] if layouts else []) if columns is None else columns
    absent = [c for c in columns if any(c not in names for names in layouts)]
    if absent and incomplete == "fail":
        raise ValueError(f"columns not found in {path}: {', '.join(absent)}")
    # A carriage return before the line end is no part of the last field.
    text = F.regexp_replace(F.decode("value", encoding), r"\r\z", "")
    options = {"sep": sep, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    row = F.lit(None)
    for k, names in enumerate(layouts):
        schema = ", ".join([*(f"c{i} string" for i in range(len(names))), f"{CORRUPT} string"])
        if set(columns) <= set(names):
            found = F.transform(F.array(F.from_csv(text, schema, options)), _chosen([names.index(c) for c in columns]))[0]
        else:
            found = F.struct(*(F.lit(None).cast("string").alias(f"f{i}") for i in range(len(columns))), text.alias(CORRUPT))
        row = F.when(F.col("layout") == k, found).otherwise(row)
    kind = ", ".join([*(f"f{i}: string" for i in range(len(columns))), f"{CORRUPT}: string"])
    place = F.struct("file_path", "file_block_start", "row")
    read = records.select(row.cast(f"struct<{kind}>").alias("r"), *([place.alias(ordinal)] if ordinal else []))
    return read.select(*(F.col(f"r.f{i}").alias(c) for i, c in enumerate(columns)), *([ordinal] if ordinal else []), f"r.{CORRUPT}")


def good_and_rejected(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with as many fields as their header, and the text of all others; every row is in one of them."""
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull())


def or_fail(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`read_delimited`; a record with too few or too many fields ends the job that meets it."""
    broken = F.raise_error(F.concat(F.lit("record with too few or too many fields: "), F.left(CORRUPT, F.lit(200))))
    return rows.where(F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(broken)).drop(CORRUPT)
