"""Delimited and columnar tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.dates import Period
from gristmill.functions.text import normalize_country
from gristmill.operators.dedup import with_ordinal
from gristmill.sources import delimited

# Spellings that the reference's CSV reader turns into a missing value.
NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
# The columns of the site export and of the contract table.
SITE_COLUMNS = [
    "ID_SITE", "NU_CNT", "NOM_SITE", "NOM_CLI", "STOCK", "DT_EFF_RESIL_CNT", "PAYS_SITE", "CP_SITE", "VILLE_SITE",
    "NUM_RUE_SITE", "RUE_SITE", "NUM_VOIE_SITE", "LIEU_DIT_SITE", "ADRESSE_SITE", "COORD_X_SITE", "COORD_Y_SITE",
    "QUALITE_GEOCODAGE", "CAPITAUX_MURS_BATIMENTS", "CAPITAUX_CONTENU", "CAPITAUX_MATERIEL", "CAPITAUX_MARCHANDISES",
    "CAPITAUX_TT", "CAPITAUX_ASS_MH_HLL_CARAV", "CAPITAUX_DEPENDANCE", "CAPITAUX_COMPL", "CAPITAUX_DD", "SURFACE",
    "SURFACE_DPDCE",
]
CONTRACT_COLUMNS = ["NOPOL", "PTGST", "CDSITP"]

SEPARATORS = [";", "|", ","]
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# The characters in which Latin-9 differs from Latin-1; reading Latin-1 and translating needs no charset setting.
_BYTES = [bytes([b]) for b in range(0xA0, 0x100)]
_LATIN_1 = "".join(b.decode("latin-1") for b in _BYTES if b.decode("latin-1") != b.decode("iso8859-15"))
_LATIN_9 = "".join(b.decode("iso8859-15") for b in _BYTES if b.decode("latin-1") != b.decode("iso8859-15"))


def sniff_separator(spark: SparkSession, path: str) -> str:
    """Most frequent candidate of the header line; ties go to the earlier candidate, an unreadable file to ``;``."""
    try:
        head = spark.read.text(path).first()
    except AnalysisException:
        return SEPARATORS[0]
    line = head[0] if head else ""
    return max(SEPARATORS, key=line.count)


def sniff_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 when every line decodes, else Latin-1. The search for a line that does not is distributed and stops at the first."""
    return "UTF-8" if spark.read.text(path).filter(~F.is_valid_utf8("value")).isEmpty() else "ISO-8859-1"


def missing_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Spellings of a missing value become null, in all columns or in ``columns``."""
    named = df.columns if columns is None else columns
    return df.select(*[F.when(~F.col(c).isin(NA_VALUES), F.col(c)).alias(c) if c in named else F.col(c) for c in df.columns])


def read_strings(
    spark: SparkSession,
    path: str,
    columns: list[str],
    sep: str | None = None,
    encoding: str | None = None,
    multiline: bool = True,
    ordinal: str | None = None,
) -> DataFrame:
    """Chosen columns of a delimited file, all as strings; an absent column is an error. ``ordinal`` adds the place in the file.

    A quoted field may hold line ends, and large files are read by many tasks all the same (:mod:`gristmill.sources.delimited`). A row with
    too few fields is filled with nulls and one with too many is cut. ``multiline=False`` spares the measuring pass for files that have no such
    field; a row with too few or too many fields then fails the read.
    """
    sep = sep or sniff_separator(spark, path)
    encoding = encoding or sniff_encoding(spark, path)
    if multiline:
        read = delimited.read_delimited(spark, path, columns, sep, encoding, ordinal)
        return missing_to_null(read.drop(delimited.CORRUPT), columns)
    raw = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("escape", '"').option("mode", "FAILFAST").csv(path)
    absent = [c for c in columns if c not in raw.columns]
    if absent:
        raise ValueError(f"columns not found in {path}: {', '.join(absent)}")
    if ordinal is None:
        return missing_to_null(raw.select(*columns))
    return missing_to_null(with_ordinal(raw, ordinal).select(*columns, ordinal), columns)


def clean_country(sites: DataFrame) -> DataFrame:
    return sites.withColumn("PAYS_SITE", F.nullif(normalize_country(F.col("PAYS_SITE")), F.lit("")))


def read_sites(spark: SparkSession, path: str, **options) -> DataFrame:
    return clean_country(read_strings(spark, path, SITE_COLUMNS, **options))


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_optional(spark: SparkSession, load: Callable[[], DataFrame], schema: T.StructType | str) -> DataFrame:
    """Result of ``load``, or an empty table of the given schema when its file does not exist."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_period_rows(spark: SparkSession, base: str, period: Period, pattern: str = "*.csv*") -> DataFrame:
    """Monthly pipe-separated Latin-9 extracts, plain or gzipped, chosen by file name, with the text of broken rows in ``_corrupt``.

    Fields may hold line ends; files may have their columns in different orders; :func:`delimited.good_and_rejected` divides the rows.
    """
    raw = delimited.read_delimited(spark, f"{base}/{period.year}/{period.month:02d}", None, "|", "ISO-8859-1", pattern=pattern)
    return raw.select(*[F.translate(F.col(f"`{c}`"), _LATIN_1, _LATIN_9).alias(c) for c in raw.columns])


def read_period(spark: SparkSession, base: str, period: Period, pattern: str = "*.csv*") -> DataFrame:
    """Rows of :func:`read_period_rows`; a broken one fails the read instead of passing as another or two."""
    return delimited.or_fail(read_period_rows(spark, base, period, pattern))


def union_existing(spark: SparkSession, loaders: list[Callable[[], DataFrame]], schema: T.StructType | str) -> DataFrame:
    """Union by name of the inputs that exist; the result always has the columns of ``schema``."""
    out = spark.createDataFrame([], schema)
    for load in loaders:
        out = out.unionByName(read_optional(spark, load, schema), allowMissingColumns=True)
    return out


def normalise_blanks(df: DataFrame) -> DataFrame:
    """Trailing spaces off every string, blanks to null: the state in which keys of the monthly jobs are joined."""
    strings = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: F.nullif(F.rtrim(F.col(c)), F.lit("")) for c in strings})


def read_control(df: DataFrame, by_position: dict[str, int]) -> DataFrame:
    """Pick columns of a control sheet by position and give them names."""
    return df.select(*[F.col(f"`{df.columns[i]}`").alias(name) for name, i in by_position.items()])


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_tables(spark: SparkSession, folder: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    return {name: load_table(spark, folder, name) for name in names or TABLES}
