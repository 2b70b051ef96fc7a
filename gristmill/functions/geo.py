"""Geographic helpers: administrative codes from postal codes, and bounding boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import normalize_country, safe_str, zero_fill

# Overseas departments use the first three characters of the postal code.
OVERSEAS = ["971", "972", "973", "974", "976"]
HOME_COUNTRY = "FRANCE"


def department(postal: Column) -> Column:
    code = zero_fill(safe_str(postal), 5)
    island_half = F.when(F.substring(code, 3, 1).isin("0", "1", "2"), "2A").otherwise("2B")
    return (
        F.when(F.substring(code, 1, 3).isin(OVERSEAS), F.substring(code, 1, 3))
        .when(F.substring(code, 1, 2) == "20", island_half)
        .otherwise(F.substring(code, 1, 2))
    )


def region_code(country: Column, postal: Column) -> Column:
    """Administrative code where the country has a rule, else an empty string."""
    return F.when(normalize_country(country) == HOME_COUNTRY, department(postal)).otherwise("")


def in_bbox(lon: Column, lat: Column, box: Column) -> Column:
    """Inclusive test against a struct (lon_min, lat_min, lon_max, lat_max); null when there is no box."""
    return lon.between(box["lon_min"], box["lon_max"]) & lat.between(box["lat_min"], box["lat_max"])


def box_struct(*sides: Column) -> Column:
    names = ("lon_min", "lat_min", "lon_max", "lat_max")
    return F.struct(*[side.alias(name) for side, name in zip(sides, names)])


_RING = "array<array<array<double>>>"


def geo_points(df: DataFrame, geometry: str, keys: list[str]) -> DataFrame:
    """One row per vertex of a GeoJSON geometry given as JSON text; other shapes give no rows."""
    kind = F.get_json_object(geometry, "$.type")
    raw = F.get_json_object(geometry, "$.coordinates")
    rings = (
        F.when(kind == "Polygon", F.from_json(raw, _RING))
        .when(kind == "MultiPolygon", F.flatten(F.from_json(raw, f"array<{_RING}>")))
    )
    points = df.select(*keys, F.explode(F.flatten(rings)).alias("point"))
    return points.select(*keys, F.get("point", F.lit(0)).alias("lon"), F.get("point", F.lit(1)).alias("lat"))


def bbox(points: DataFrame, keys: list[str]) -> DataFrame:
    """Bounding box per key, four decimals."""
    return points.groupBy(*keys).agg(
        F.round(F.min("lon"), 4).alias("lon_min"),
        F.round(F.min("lat"), 4).alias("lat_min"),
        F.round(F.max("lon"), 4).alias("lon_max"),
        F.round(F.max("lat"), 4).alias("lat_max"),
    )
