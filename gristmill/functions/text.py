"""Text clean-up and extraction. Every function maps a column to a column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What Python's str.strip() removes; SQL trim() only removes the plain space.
SPACES = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_RUN_OF_SPACES = f"[{SPACES}]+"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def is_empty(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def is_filled(c: Column) -> Column:
    return ~is_empty(c)


def safe_str(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def _collapse(c: Column) -> Column:
    return F.regexp_replace(safe_str(c), _RUN_OF_SPACES, " ")


def normalize_string(c: Column) -> Column:
    return F.lower(_collapse(c))


def normalize_country(c: Column) -> Column:
    return F.upper(_collapse(c))


def drop_float_suffix(c: Column) -> Column:
    return F.regexp_replace(c, r"^(\d+)\.0$", "$1")


def zero_fill(c: Column, width: int | Column) -> Column:
    """Left-pad with zeros; unlike lpad a longer value is kept whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def normalize_postal(c: Column, width: int | Column | None = None) -> Column:
    code = drop_float_suffix(F.regexp_replace(F.upper(safe_str(c)), "[ -]", ""))
    if width is None:
        return code
    return F.when(code.rlike(r"^\d+$") & F.lit(width).isNotNull(), zero_fill(code, width)).otherwise(code)


def norm_key(c: Column) -> Column:
    """Contract key: stripped, without the ``.0`` that a float round trip leaves behind."""
    return drop_float_suffix(safe_str(c))


def extract_postal(c: Column) -> Column:
    return F.regexp_extract(safe_str(c), r"(?U)\b(\d{5})\b", 1)


def extract_street_no(c: Column) -> Column:
    return F.regexp_extract(safe_str(c), r"(?U)^(\d{1,4})\s", 1)


def to_number(c: Column) -> Column:
    """Double in Python's spelling; the cast alone would also take ``1.0d``."""
    raw = strip(c)
    return F.when(raw.rlike(_NUMBER), raw.try_cast("double"))


def parse_number(c: Column) -> Column:
    """Like :func:`to_number`, with a comma accepted as the decimal mark."""
    return to_number(F.replace(c, F.lit(","), F.lit(".")))


def in_range(value: Column, low: float, high: float) -> Column:
    return F.when(value.between(low, high), value)


def parse_coordinate(c: Column, low: float, high: float) -> Column:
    """Number inside the range, else null."""
    return in_range(parse_number(c), low, high)


def number_text(c: Column) -> Column:
    """A double as Python prints it: Spark switches to 1.0E-4 below 0.001, Python to 1e-05 below 0.0001."""
    plain = c.cast("string")
    digits = F.regexp_replace(F.regexp_extract(plain, r"^-?([\d.]+)E", 1), r"\.0$", "")
    exponent = F.regexp_extract(plain, r"E-(\d+)$", 1)
    sign = F.when(c < 0, "-").otherwise("")
    return (
        F.when((F.abs(c) >= 1e-3) | (c == 0), plain)
        .when(F.abs(c) >= 1e-4, F.concat(sign, F.lit("0.000"), F.replace(digits, F.lit("."), F.lit(""))))
        .otherwise(F.concat(sign, digits, F.lit("e-"), F.lpad(exponent, 2, "0")))
    )


def group_thousands(c: Column) -> Column:
    return F.replace(F.format_number(c, 0), F.lit(","), F.lit(" "))


def size_label(c: Column) -> Column:
    return (
        F.when(c < 1024, F.concat(c.cast("string"), F.lit(" B")))
        .when(c < 1024 * 1024, F.format_string("%.1f KB", c / 1024))
        .otherwise(F.format_string("%.1f MB", c / (1024 * 1024)))
    )


def split_codes(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip), lambda code: code != "")


def contains_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda left, right: left | right, (c.contains(word) for word in words), F.lit(False))


def coalesce_blank(first: Column, second: Column) -> Column:
    return F.coalesce(blank_to_null(first), second)


def strip_star(c: Column) -> Column:
    return F.when(c.startswith("*"), F.substring(c, 2, 3)).otherwise(c)


def strip_illegal(df: DataFrame, columns: list[str]) -> DataFrame:
    """Remove the control characters a spreadsheet refuses."""
    return df.withColumns({c: F.regexp_replace(F.col(c), _CONTROL, "") for c in columns})


def fix_accents(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Repair mis-encoded sequences in every string column; keys are plain text, tried in the given order."""
    def repair(c: Column) -> Column:
        return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), mapping.items(), c)

    strings = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({name: repair(F.col(name)) for name in strings})
