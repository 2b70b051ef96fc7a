"""Joins.

The joins themselves carry no broadcast hint: Spark compares the measured size of a side with
``spark.sql.autoBroadcastJoinThreshold`` (again at run time under AQE) and shuffles beyond it. A coarse key (a day, a
country, a product) must not deal out the large side: ``lookup`` measures the reference in bytes, broadcasts it within
a bound and salts the join beyond it. With ``salt`` the left rows of a key, null keys too, are spread over that many
sub-keys and the unique right row is repeated for each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.text import blank_to_null
from gristmill.operators.dedup import keep_first


def _pairs(on: list[str] | dict[str, str]) -> dict[str, str]:
    return on if isinstance(on, dict) else {name: name for name in on}


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _match(on: list[str] | dict[str, str], null_safe: bool = False) -> Column:
    def same(left: str, right: str) -> Column:
        a, b = F.col(f"l.{left}"), F.col(f"r.{right}")
        return a.eqNullSafe(b) if null_safe else a == b

    return _all([same(left, right) for left, right in _pairs(on).items()])


BROADCAST_BYTES = 8 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows written as text: a job over the reference, whose columns are pruned to those given."""
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate from the sizes of the files that ``df`` reads; it takes no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame | None:
    """``df`` to be broadcast, once it is known to hold about ``max_bytes`` at most; None for a larger one.

    Files that are an eighth of the bound or less may be broadcast as they are, since columnar files hold a table in some eighth of its
    size; anything else is measured first.
    """
    small = estimated_bytes(df) <= max_bytes // 8 or measured_bytes(df) <= max_bytes
    return F.broadcast(df) if small else None


def lookup(
    df: DataFrame, ref: DataFrame, on: list[str] | dict[str, str], cols: list[str] | dict[str, str], max_bytes: int = BROADCAST_BYTES, salt: int = 64
) -> DataFrame:
    """:func:`enrich` by a coarse key: the large side is not shuffled where the reference is small, and spread over ``salt`` where not."""
    pairs, added = _pairs(on), _pairs(cols)
    needed = assert_unique(ref.select(*dict.fromkeys([*pairs.values(), *added.keys()])), list(pairs.values()))
    small = bounded(needed, max_bytes)
    if small is not None:
        return enrich(df, small, on, cols, unique=True)
    return enrich(df, needed, on, cols, salt=salt, unique=True)


def enrich(
    df: DataFrame,
    ref: DataFrame,
    on: list[str] | dict[str, str],
    cols: list[str] | dict[str, str],
    condition: Column | None = None,
    order: list | None = None,
    salt: int | None = None,
    null_safe: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Left join that adds ``cols`` of a reference whose key is unique.

    ``order`` makes the key unique; ``unique`` says that it is by construction; else a repeated key fails the job
    instead of multiplying rows.
    ``condition`` is an extra predicate over the left columns, written with the alias ``l``; rows that fail it
    keep NULL in the added columns.
    """
    pairs, added = _pairs(on), _pairs(cols)
    if order:
        ref = keep_first(ref, list(pairs.values()), order)
    ref = ref.select(*dict.fromkeys([*pairs.values(), *added.keys()]))
    if not order and not unique:
        ref = assert_unique(ref, list(pairs.values()), null_safe)
    left, rule = df, _match(on, null_safe)
    if salt:
        left = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salt)).cast("int"))
        ref = ref.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        rule = rule & (F.col("l._salt") == F.col("r._salt"))
    if condition is not None:
        rule = rule & condition
    kept = [F.col(f"l.{c}") for c in df.columns if c not in added.values()]
    return left.alias("l").join(ref.alias("r"), rule, "left").select(
        *kept, *[F.col(f"r.{source}").alias(name) for source, name in added.items()]
    )


def lookup_keep(df: DataFrame, ref: DataFrame, on: list[str] | dict[str, str], cols: list[str] | dict[str, str]) -> DataFrame:
    """Inner variant of :func:`enrich`: the lookup also filters; a repeated key fails the job here too."""
    pairs, added = _pairs(on), _pairs(cols)
    ref = assert_unique(ref.select(*dict.fromkeys([*pairs.values(), *added.keys()])), list(pairs.values()))
    kept = [F.col(f"l.{c}") for c in df.columns if c not in added.values()]
    return df.alias("l").join(ref.alias("r"), _match(on), "inner").select(
        *kept, *[F.col(f"r.{source}").alias(name) for source, name in added.items()]
    )


def assert_unique(df: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Fail at run time, inside the job, if a key occurs twice; no separate counting pass on the driver.

    Rows with a null in their key match nothing and are left out, unless ``null_safe``.
    """
    whole = df if null_safe else df.dropna(subset=keys)
    counted = whole.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in df.columns if c not in keys])
    guard = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"duplicate key in reference: {', '.join(keys)}"))).otherwise(F.lit(True))
    return counted.filter(guard).select(*df.columns)


def priority_fill(
    df: DataFrame,
    refs: list[tuple[DataFrame, dict[str, str], str, str]],
    value: str,
    origin: str,
    condition: Column | None = None,
) -> DataFrame:
    """Value of the first reference (in list order) that has a non-blank match, and the tag it came from.

    Each reference is ``(table, {left key: right key}, value column, tag)``.
    """
    out = df
    for i, (ref, on, column, _) in enumerate(refs):
        out = enrich(out, ref, on, {column: f"_fill{i}"}, condition=condition)
    found = [blank_to_null(F.col(f"_fill{i}")) for i in range(len(refs))]
    tags = reduce(
        lambda case, item: case.when(item[0].isNotNull(), item[1]),
        zip(found[1:], [ref[3] for ref in refs[1:]]),
        F.when(found[0].isNotNull(), refs[0][3]),
    )
    return out.select(*df.columns, F.coalesce(*found).alias(value), tags.alias(origin))


def fill_missing(df: DataFrame, source: DataFrame, on: list[str] | dict[str, str], cols: dict[str, str]) -> DataFrame:
    """Complete ``{target: source column}`` only where the target is missing (null, or blank text)."""
    joined = enrich(df, source.select("*", *(F.col(src).alias(f"_src_{target}") for target, src in cols.items())), on, [f"_src_{target}" for target in cols])
    types = dict(df.dtypes)

    def completed(target: str) -> Column:
        found = [F.col(target), F.col(f"_src_{target}")]
        if types[target] == "string":
            found = [blank_to_null(c) for c in found]
        return F.coalesce(*found).alias(target)

    return joined.select(*[completed(c) if c in cols else F.col(c) for c in df.columns])


def join_valid_at(df: DataFrame, history: DataFrame, on: list[str] | dict[str, str], at, cols: list[str]) -> DataFrame:
    """History row valid at a constant day (``start <= day < end``): filtered first, then an equi join."""
    day = F.lit(at)
    current = history.filter((F.col("valid_from") <= day) & (F.col("valid_to") > day))
    return enrich(df, current, on, cols)


def _apart(history: DataFrame, keys: list[str]) -> DataFrame:
    """``history`` as it is; two intervals of a key that overlap fail the job."""
    before = F.max("valid_to").over(Window.partitionBy(*keys).orderBy("valid_from", "valid_to").rowsBetween(Window.unboundedPreceding, -1))
    guard = F.when(F.col("_before") > F.col("valid_from"), F.raise_error(F.lit(f"overlapping intervals in history: {', '.join(keys)}"))).otherwise(F.lit(True))
    return history.withColumn("_before", before).where(guard).drop("_before")


def join_valid_on(df: DataFrame, history: DataFrame, on: list[str] | dict[str, str], day: str, cols: list[str] | dict[str, str], bucket_days: int = 366) -> DataFrame:
    """History row valid on each row's own day (``valid_from <= day < valid_to``), by a left join; a null ``valid_to`` has no end.

    Both sides are cut into buckets of ``bucket_days``: a day lies in one, an interval is repeated for those that it meets, within the range of
    days that ``df`` has, so thirty years give thirty rows. Keys and buckets are joined by equality and only the rows of one key
    and bucket are compared. A key that is hot over a long time is thus divided; empty intervals and rows without key or day match nothing;
    overlapping intervals of a key fail the job.
    """
    pairs, added = _pairs(on), _pairs(cols)
    number = lambda c: F.floor(F.unix_date(F.col(c).cast("date")) / bucket_days)
    ends = df.agg(F.min(F.col(day).cast("date")).alias("low"), F.max(F.col(day).cast("date")).alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    known = history.select(*dict.fromkeys([*pairs.values(), *added]), F.col("valid_from").cast("date").alias("valid_from"), F.coalesce(F.col("valid_to").cast("date"), F.lit("9999-12-31").cast("date")).alias("valid_to"))
    known = _apart(known.dropna(subset=[*pairs.values(), "valid_from"]).where("valid_from < valid_to"), list(pairs.values()))
    known = known.where((F.col("valid_from") <= high) & (F.col("valid_to") > low))
    known = known.withColumns({"_first": F.greatest("valid_from", low), "_last": F.least(F.date_sub("valid_to", 1), high)})
    known = known.withColumn("_bucket", F.explode(F.sequence(number("_first"), number("_last")))).drop("_first", "_last")
    rule = _match(on) & (F.col("l._bucket") == F.col("r._bucket")) & (F.col("l._day") >= F.col("r.valid_from")) & (F.col("l._day") < F.col("r.valid_to"))
    left = df.withColumns({"_day": F.col(day).cast("date"), "_bucket": number(day)})
    kept = [F.col(f"l.{c}") for c in df.columns if c not in added.values()]
    return left.alias("l").join(known.alias("r"), rule, "left").select(*kept, *[F.col(f"r.{source}").alias(name) for source, name in added.items()])


def join_as_of(
    df: DataFrame, ref: DataFrame, on: list[str] | dict[str, str], at: str, ref_at: str, cols: list[str] | dict[str, str], order: list[str],
    width: int = 30 * 86_400, strict: bool = False,
) -> DataFrame:
    """Each row of ``df`` with the newest row of ``ref`` of its key that is not later (or, ``strict``, that is earlier); null where there is none.

    Of reference rows of one time the last by ``order`` counts. ``at`` and ``ref_at`` are timestamps or dates. Both sides are sorted
    together once and the last reference row is carried along, so no pairs are made. Each key is cut into slices of ``width`` seconds that
    are sorted apart; what a slice ends with is one row, carried over to the next slices. A hot key is as many tasks' work as it has slices.
    """
    pairs, added = _pairs(on), _pairs(cols)
    keys = [f"_k{i}" for i in range(len(pairs))]
    time = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    row, value = F.struct(*(F.col(c) for c in df.columns)), F.struct(*(F.col(c).alias(f"v{i}") for i, c in enumerate(added)))
    left = df.select(*(F.col(c).alias(k) for c, k in zip(pairs, keys)), time(at).alias("_t"), row.alias("_row"))
    kind = left.schema["_row"].dataType
    right = ref.dropna(subset=[*pairs.values(), ref_at]).select(
        *(F.col(c).alias(k) for c, k in zip(pairs.values(), keys)), time(ref_at).alias("_t"), F.struct(*order).alias("_order"), value.alias("_value")
    )
    whole = F.col("_t").isNotNull()
    for k in keys:
        whole &= F.col(k).isNotNull()
    nothing = left.where(~whole).select("_row", F.lit(None).cast(right.schema["_value"].dataType).alias("_value"))
    both = right.select(*keys, "_t", "_order", "_value", F.lit(None).cast(kind).alias("_row")).unionByName(
        left.where(whole).select(*keys, "_t", F.lit(None).cast(right.schema["_order"].dataType).alias("_order"), F.lit(None).cast(right.schema["_value"].dataType).alias("_value"), "_row")
    )
    both = both.withColumn("_slice", F.floor(F.col("_t") / (width * 1_000_000)))
    # Reference rows of one time come before the rows that may see them, and after those that may not.
    side = F.col("_row").isNotNull() != F.lit(strict)
    by = Window.partitionBy(*keys, "_slice").orderBy("_t", side, "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("_last", F.last("_value", ignorenulls=True).over(by)).where("_row IS NOT NULL")
    ends = right.withColumn("_slice", F.floor(F.col("_t") / (width * 1_000_000))).groupBy(*keys, "_slice").agg(F.max_by("_value", F.struct("_t", "_order")).alias("_end"))
    slices = ends.unionByName(left.where(whole).select(*keys, F.floor(F.col("_t") / (width * 1_000_000)).alias("_slice")).distinct(), allowMissingColumns=True)
    slices = slices.groupBy(*keys, "_slice").agg(F.max("_end").alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(*keys, "_slice", F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
    met = carried.join(slices, [*keys, "_slice"]).select("_row", F.coalesce("_last", "_before").alias("_value")).unionByName(nothing)
    kept = [F.col(f"_row.{c}").alias(c) for c in df.columns if c not in added.values()]
    return met.select(*kept, *(F.col(f"_value.v{i}").alias(name) for i, name in enumerate(added.values())))


def as_of(ref: DataFrame, period: int, floor: int | None = None, column: str = "period") -> DataFrame:
    """Newest snapshot not after ``period``; periods at or before ``floor`` use the snapshot after the floor.

    The newest period is a scalar subquery, so the scan of a table partitioned by period reads one partition.
    """
    eligible = ref.filter(F.col(column) <= period)
    if floor is not None and period <= floor:
        eligible = ref.filter(F.col(column) > floor)
        newest = eligible.agg(F.min(column).alias("p")).scalar()
    else:
        newest = eligible.agg(F.max(column).alias("p")).scalar()
    return eligible.filter(F.col(column) == newest)


def flag_exists(df: DataFrame, ref: DataFrame, on: list[str] | dict[str, str], name: str, present: int = 1) -> DataFrame:
    """1/0 column telling whether a key exists in ``ref`` (``present`` is the value for a hit)."""
    pairs = _pairs(on)
    marked = ref.select(*pairs.values()).distinct().withColumn("_hit", F.lit(True))
    joined = enrich(df, marked, on, ["_hit"], unique=True)
    hit = F.when(F.col("_hit"), present).otherwise(1 - present)
    return joined.withColumn(name, hit).drop("_hit")


def drop_existing(df: DataFrame, ref: DataFrame, on: list[str] | dict[str, str]) -> DataFrame:
    return df.alias("l").join(ref.alias("r"), _match(on), "left_anti")


def keep_existing(df: DataFrame, ref: DataFrame, on: list[str] | dict[str, str]) -> DataFrame:
    return df.alias("l").join(ref.alias("r"), _match(on), "left_semi")


def merge_by(a: DataFrame, b: DataFrame, on: list[str], keep: str = "left") -> DataFrame:
    """Sorted-merge semantics: columns present on both sides take the right value wherever the right side matched.

    ``keep`` is ``left``, ``both``, ``left_only``, ``right`` or ``all``; keys match also when missing. The right key
    must be unique.
    """
    how = {"left": "left", "both": "inner", "left_only": "left_anti", "right": "right", "all": "full"}[keep]
    rule = _match(on, null_safe=True)
    if how == "left_anti":
        return a.alias("l").join(b.alias("r"), rule, how)
    marked = b.withColumn("_right", F.lit(True))
    joined = a.alias("l").join(marked.alias("r"), rule, how)
    matched = F.col("r._right").isNotNull()
    shared = set(a.columns) & set(b.columns)

    def pick(c: str) -> Column:
        if c in shared:
            return F.when(matched, F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")).alias(c)
        return F.col(f"l.{c}" if c in a.columns else f"r.{c}").alias(c)

    return joined.select(*[pick(c) for c in dict.fromkeys([*a.columns, *b.columns])])


def coalesce_sources(df: DataFrame, sources: list[DataFrame], on: list[str] | dict[str, str], cols: list[str]) -> DataFrame:
    """Same columns looked up in several tables; the first table that has a value wins."""
    out = df
    for i, source in enumerate(sources):
        out = enrich(out, source, on, {c: f"_s{i}_{c}" for c in cols})
    picked = [F.coalesce(*[F.col(f"_s{i}_{c}") for i in range(len(sources))]).alias(c) for c in cols]
    return out.select(*[c for c in df.columns if c not in cols], *picked)
