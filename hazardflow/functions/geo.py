"""Coordinates: validity, regions, distance to cities, grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from hazardflow import config
from hazardflow.functions.sql import case, literal

EARTH_RADIUS_KM = 6371.0


def coordinates_valid(lat: Column, lon: Column) -> Column:
    """True or false, never NULL."""
    inside = lat.between(*config.LATITUDE_RANGE) & lon.between(*config.LONGITUDE_RANGE)
    return F.coalesce(inside, F.lit(False))


def region_of(lat: str, lon: str, boxes=None, default: str = config.REGION_DEFAULT) -> Column:
    """Name of the last box in the list that holds the point.

    The boxes are a short fixed list, so a flat CASE inside the same codegen
    stage replaces a range join; the last box is tested first.
    """
    boxes = config.REGION_BOXES if boxes is None else boxes
    branches = [
        (
            f"{lon} BETWEEN {literal(min_lon)} AND {literal(max_lon)}"
            f" AND {lat} BETWEEN {literal(min_lat)} AND {literal(max_lat)}",
            name,
        )
        for name, min_lon, max_lon, min_lat, max_lat in reversed(boxes)
    ]
    return F.expr(case(branches, default))


def nearest_city_km(lat: str, lon: str, cities=None, mode: str = "planar") -> Column:
    """Distance to the nearest listed city; 999999 where a coordinate is NULL.

    ``planar`` is degrees times a constant, ``haversine`` the great circle.
    Both pick the minimum of a monotone quantity first, so the square root or
    arcsine is taken once per row and not once per city.
    """
    cities = config.CITIES if cities is None else cities
    terms = []
    for _, city_lat, city_lon in cities:
        dlat, dlon = f"({lat} - {literal(city_lat)})", f"({lon} - {literal(city_lon)})"
        if mode == "planar":
            terms.append(f"{dlat} * {dlat} + {dlon} * {dlon}")
        else:
            shrink = literal(math.cos(math.radians(city_lat)))
            terms.append(
                f"power(sin(radians({dlat}) / 2), 2)"
                f" + cos(radians({lat})) * {shrink} * power(sin(radians({dlon}) / 2), 2)"
            )
    nearest = f"least({', '.join(terms)})" if len(terms) > 1 else terms[0]
    if mode == "planar":
        km = f"sqrt({nearest}) * {literal(config.KM_PER_DEGREE)}"
    elif mode == "haversine":
        km = f"asin(sqrt(least({nearest}, 1D))) * {literal(2 * EARTH_RADIUS_KM)}"
        km = f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN {km} END"
    else:
        raise ValueError(f"unknown distance mode: {mode}")
    return F.expr(f"least({literal(config.NO_CITY_KM)}, {km})")


def population_risk(distance_km: str) -> Column:
    bands = [(f"{distance_km} <= {literal(bound)}", risk) for bound, risk in config.RISK_BANDS]
    return F.expr(case(bands, config.RISK_DEFAULT))


def grid_floor(coordinate: Column, degrees: float = config.GRID_DEGREES) -> Column:
    return F.floor(coordinate / F.lit(degrees)) * F.lit(degrees)


def grid_label(lat_grid: Column, lon_grid: Column) -> Column:
    return F.concat(lat_grid.cast("string"), F.lit("_"), lon_grid.cast("string"))


def max_grid_cells(degrees: float) -> int:
    """How many cells valid coordinates can fall into, edges included."""
    rows = math.floor(90 / degrees) - math.floor(-90 / degrees) + 1
    cols = math.floor(180 / degrees) - math.floor(-180 / degrees) + 1
    return rows * cols
