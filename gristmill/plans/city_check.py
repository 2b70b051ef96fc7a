"""City name against postal code.

Exact matches are settled by a join. What is left is compared by matching-block ratio, on distinct pairs only. A ratio
of 70 needs a minimum overlap of characters, so candidates are found through shared rare characters (prefix
filtering on character multisets, rarest first, which loses no pair at or above the threshold) instead of pairing every
miss with every city of the code; the whole overlap is then counted before a pair is compared.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPO, DOUBTFUL = 90.0, 70.0
# ratio = 2M/(|a|+|b|) >= t and M <= min(|a|,|b|) give |b| >= |a|*t/(2-t), hence M >= |a|*t/(2-t).
_SHARE = (DOUBTFUL / 100) / (2 - DOUBTFUL / 100)


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-block ratio, 0 to 100."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() * 100 for x, y in zip(a, b)], dtype="float64")


def _tokens(c: Column) -> Column:
    """Characters numbered by occurrence (``e1, e2, ...``): overlap of two multisets becomes overlap of two sets."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    numbered = F.transform(
        chars, lambda x, i: F.concat(x, F.size(F.filter(F.slice(chars, 1, i + 1), lambda y: y == x)).cast("string"))
    )
    return numbered


def _prefix(tokens: Column, frequency: Column) -> Column:
    """The rarest tokens, as many as leave fewer behind than the least overlap needs."""
    ranked = F.array_sort(F.transform(tokens, lambda t: F.struct(F.coalesce(F.try_element_at(frequency, t), F.lit(0)).alias("n"), t.alias("t"))))
    needed = F.ceil(F.size(tokens) * F.lit(_SHARE) - F.lit(1e-9)).cast("int")
    return F.transform(F.slice(ranked, 1, F.size(tokens) - needed + 1), lambda r: r["t"])


def candidate_pairs(misses: DataFrame, cities: DataFrame) -> DataFrame:
    """Distinct ``(postal_code, city, candidate, ordinal, name)`` that can reach the lower threshold.

    The overlap of two numbered token sets is the most that matching blocks can cover, so its test is exact too.
    """
    known = cities.select("postal_code", F.col("city").alias("candidate"), "ordinal", "name", _tokens(F.col("city")).alias("tokens_b"))
    counts = known.select(F.explode("tokens_b").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    # One entry per character and occurrence number: bounded by the alphabet and the longest name.
    frequency = counts.agg(F.map_from_entries(F.collect_list(F.struct("t", "n"))).alias("f")).scalar()
    a = misses.withColumn("tokens_a", _tokens(F.col("city"))).withColumn("_f", frequency)
    a = a.withColumn("token", F.explode(_prefix(F.col("tokens_a"), F.col("_f")))).drop("_f")
    b = known.withColumn("_f", frequency)
    b = b.withColumn("token", F.explode(_prefix(F.col("tokens_b"), F.col("_f")))).drop("_f")
    la, lb = F.size("tokens_a"), F.size("tokens_b")
    fits = F.least(la, lb) >= F.greatest(la, lb) * _SHARE - 1e-9
    overlap = 2 * F.size(F.array_intersect("tokens_a", "tokens_b")) >= (la + lb) * (DOUBTFUL / 100) - 1e-9
    near = a.join(b, ["postal_code", "token"]).filter(fits).filter(overlap)
    return near.select("postal_code", "city", "candidate", "ordinal", "name").distinct()


def expected_cities(cities: DataFrame, n: int | None = None) -> DataFrame:
    """The cities of a code in file order, or the first ``n`` of them."""
    listed = F.array_sort(F.collect_list(F.struct("ordinal", "city", "name")))
    if n is not None:
        rank = F.row_number().over(Window.partitionBy("postal_code").orderBy("ordinal", "city"))
        cities = cities.withColumn("r", rank).filter(F.col("r") <= n)
    return cities.groupBy("postal_code").agg(listed.alias("c")).select("postal_code", F.col("c.name").alias("expected"))


def city_check(pairs: DataFrame, cities: DataFrame, n_expected: int | None = None) -> DataFrame:
    """Verdict for each distinct ``(postal_code, city)``, both already normalised.

    ``cities`` holds ``(postal_code, city, ordinal)`` and optionally ``name``, the spelling to show. The verdict is
    ``unknown_postal``, ``match``, ``typo`` (ratio from 90), ``doubtful`` (from 70) or ``mismatch``; the best city and
    its ratio are given for typo and doubtful, and for mismatch all expected cities, or the first ``n_expected``.
    """
    if "name" not in cities.columns:
        cities = cities.withColumn("name", F.col("city"))
    cities = cities.select("postal_code", "city", "ordinal", "name")
    asked = pairs.select("postal_code", "city").distinct()
    known = expected_cities(cities, n_expected)
    exact = cities.select("postal_code", "city").distinct().withColumn("_exact", F.lit(True))
    seen = asked.join(known, "postal_code", "left").join(exact, ["postal_code", "city"], "left")
    misses = seen.filter("expected IS NOT NULL AND _exact IS NULL AND city <> ''").select("postal_code", "city")
    scored = candidate_pairs(misses, cities).withColumn("score", similarity("city", "candidate"))
    best = (
        scored.filter(F.col("score") >= DOUBTFUL).groupBy("postal_code", "city")
        .agg(F.max_by(F.struct("name", "score"), F.struct(F.col("score"), -F.col("ordinal"))).alias("b"))
        .select("postal_code", "city", F.col("b.name").alias("best_city"), F.col("b.score").alias("score"))
    )
    verdict = (
        F.when(F.col("expected").isNull(), "unknown_postal")
        .when(F.col("_exact") | (F.col("city") == ""), "match")
        .when(F.col("score") >= TYPO, "typo").when(F.col("score") >= DOUBTFUL, "doubtful").otherwise("mismatch")
    )
    joined = seen.join(best, ["postal_code", "city"], "left").withColumn("verdict", verdict)
    shown = F.when(F.col("verdict") == "mismatch", F.col("expected"))
    return joined.select("postal_code", "city", "verdict", "best_city", "score", shown.alias("expected"))
