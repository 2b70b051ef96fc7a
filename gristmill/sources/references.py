"""Reference files: country and region boxes, GeoJSON, postal codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.geo import bbox, geo_points
from gristmill.functions.text import normalize_postal, normalize_string, safe_str
from gristmill.operators.joins import lookup

_OBJECTS = "map<string,struct<bbox:array<double>>>"
_ARRAYS = "map<string,array<double>>"
# Property names under which a GeoJSON feature may carry its code and its name, in order of trust.
CODE_PROPERTIES = ["code", "CODE", "id", "ID", "dep", "DEP", "num_dep"]
NAME_PROPERTIES = ["nom", "NOM", "name", "NAME", "libelle", "LIBELLE"]


def boxes_from_json(df: DataFrame, text: str, keys: list[str], name: str) -> DataFrame:
    """Explode a JSON object ``{key: box}``; a box is ``[4 numbers]`` or an object holding them under ``bbox``."""
    entries = F.from_json(text, "map<string,string>")
    exploded = df.select(*keys, F.explode(entries).alias(name, "_raw"))
    as_object = F.get_json_object("_raw", "$.bbox")
    coords = F.from_json(F.coalesce(as_object, F.col("_raw")), "array<double>")
    sides = [F.get(coords, F.lit(i)).alias(side) for i, side in enumerate(("lon_min", "lat_min", "lon_max", "lat_max"))]
    return exploded.select(*keys, name, *sides)


def load_country_boxes(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    return boxes_from_json(text, "value", [], "country").withColumn("country", F.upper("country"))


def load_region_boxes(spark: SparkSession, path: str, country: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True).select(F.lit(country.upper()).alias("country"), "value")
    return boxes_from_json(text, "value", ["country"], "region_code")


def discover_countries(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the sub-folders that hold at least one file."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    tail = F.element_at(F.split("path", f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/"), -1)
    return listed.filter(F.contains(tail, F.lit("/"))).select(F.upper(F.split_part(tail, F.lit("/"), F.lit(1))).alias("country")).distinct()


def _first_property(names: list[str]) -> Column:
    found = [F.nullif(F.trim(F.get_json_object("properties", f"$.{n}")), F.lit("")) for n in names]
    return F.coalesce(*found)


def region_bboxes(features: DataFrame, order: str = "ordinal") -> DataFrame:
    """Boxes of GeoJSON features given as ``(properties JSON, geometry JSON, order)``; the last feature of a code wins."""
    numbered = features.select(
        _first_property(CODE_PROPERTIES).alias("region_code"),
        F.coalesce(_first_property(NAME_PROPERTIES), F.lit("")).alias("name"), "geometry", F.col(order).alias("ordinal"),
    ).filter("region_code IS NOT NULL")
    boxes = bbox(geo_points(numbered, "geometry", ["region_code", "name", "ordinal"]), ["region_code", "name", "ordinal"])
    latest = F.max_by(F.struct("name", "lon_min", "lat_min", "lon_max", "lat_max"), "ordinal")
    return boxes.groupBy("region_code").agg(latest.alias("b")).select("region_code", "b.*")


def load_geojson(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    features = F.from_json(F.get_json_object("value", "$.features"), "array<struct<properties:string,geometry:string>>")
    return text.select(F.posexplode(features).alias("ordinal", "f")).select("ordinal", "f.*")


def postal_columns(columns: list[str]) -> tuple[str, str]:
    """Which columns hold the code and the city, by name, else the first two."""
    def clean(c: str) -> str:
        return c.lstrip("#").strip().lower()

    # Spellings under which a postal reference names its two columns.
    code_marks = ("code_postal", "code postal")
    city_marks = ("nom_de_la_commune", "nom de la commune", "nom_commune", "acheminement", "libellé", "libelle")
    code = next((c for c in columns if any(m in clean(c) for m in code_marks)), columns[0])
    city = next((c for c in columns if clean(c) == "commune" or any(m in clean(c) for m in city_marks)), None)
    if city is None:
        if len(columns) < 2:
            raise ValueError("no city column in postal reference")
        city = columns[1]
    return code, city


def postal_width(df: DataFrame, keys: list[str], code: str) -> DataFrame:
    """Longest all-digit code per country."""
    c = safe_str(F.col(code))
    return df.groupBy(*keys).agg(F.max(F.when(c.rlike(r"^\d+$"), F.length(c))).alias("width"))


def postal_cities(df: DataFrame, country: str, code: str, city: str, ordinal: str) -> DataFrame:
    """Distinct ``(country, postal_code, city)`` with the first position of each, codes padded to country width."""
    width = postal_width(df, [country], code)
    padded = df.join(width, country, "left")
    cleaned = padded.select(
        F.col(country).alias("country"), normalize_postal(F.col(code), F.col("width")).alias("postal_code"),
        normalize_string(F.col(city)).alias("city"), F.col(ordinal).alias("ordinal"),
    ).filter("postal_code <> '' AND city <> ''")
    return cleaned.groupBy("country", "postal_code", "city").agg(F.min("ordinal").alias("ordinal"))


def city_lists(cities: DataFrame) -> DataFrame:
    """``(country, postal_code, cities)``: the names of a code in file order; a code has as many as it has places."""
    listed = F.array_sort(F.collect_list(F.struct("ordinal", "city")))
    return cities.groupBy("country", "postal_code").agg(listed.alias("c")).select("country", "postal_code", F.col("c.city").alias("cities"))


def with_cities(sites: DataFrame, cities: DataFrame, country: str, postal: str, name: str = "known_cities") -> DataFrame:
    """Known cities of a site's postal code, an empty list where there are none.

    ``cities`` comes from :func:`postal_cities`; the code of a site is padded to the width of its country first.
    """
    lists = city_lists(cities)
    width = lists.filter(F.col("postal_code").rlike(r"^\d+$")).groupBy("country").agg(F.max(F.length("postal_code")).alias("_width"))
    wide = lookup(sites.withColumn("_country", F.upper(safe_str(F.col(country)))), width.withColumn("country", F.upper("country")), {"_country": "country"}, ["_width"])
    keyed = wide.withColumn("_code", normalize_postal(F.col(postal), F.col("_width")))
    found = lookup(keyed, lists.withColumn("country", F.upper("country")), {"_country": "country", "_code": "postal_code"}, {"cities": name})
    return found.withColumn(name, F.coalesce(F.col(name), F.array().cast("array<string>"))).drop("_country", "_width", "_code")


def postal_map(df: DataFrame, code: str = "code_postal", city: str = "nom_commune", ordinal: str = "ordinal") -> DataFrame:
    """One city per code, the last row of the file winning."""
    return df.groupBy(F.col(code).alias("postal_code")).agg(F.max_by(city, ordinal).alias("city"))


def support_level(countries: DataFrame, boxes: DataFrame, regions: DataFrame) -> DataFrame:
    """COMPLET with a country box and regions, PARTIEL with a box only, else NON_SUPPORTÉ."""
    boxed = boxes.select("country").distinct().withColumn("_box", F.lit(True))
    split = regions.select("country").distinct().withColumn("_regions", F.lit(True))
    level = (
        F.when(F.col("_box").isNull(), "NON_SUPPORTÉ").when(F.col("_regions").isNull(), "PARTIEL").otherwise("COMPLET")
    )
    return countries.join(boxed, "country", "left").join(split, "country", "left").select("country", level.alias("support_level"))
