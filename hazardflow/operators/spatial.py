"""Regions and nearest cities from tables of any length.

``geo.region_of`` and ``geo.nearest_city_km`` write short fixed lists into an expression. Here the
lists are tables. An index tiles the plane with square cells, and each cell lists the few boxes or
cities that can decide for a point in it:

* a box is in the list of a cell it meets, unless a later box covers the whole cell;
* a city is in the list of a cell unless the one nearest to the middle of the cell is nearer to all
  its points, that is, unless the line halfway between the two cities stays outside the cell.

For great circles the plane is the surface of a cube around the globe, its six faces side by side.
There no cell is narrow, as cells of degrees are near the poles: one city at a pole is next to
every cell of degrees along the edge of the map.

A cell with more than ``LEAF`` candidates is split into 16, round by round. So a point has one
cell, found by an equality join, and compares itself with that cell's list only. Points are
neither grouped nor compared with all boxes or cities. Sides of joins are broadcast where they are
counted and small (``SMALL_CELLS``, ``SMALL_BYTES``), never by the size of a file, which says little of lists and
exploded rows; adaptive execution splits a hot cell in a shuffle by any number of tasks.

Cells of about seven metres are not split again; where more candidates than ``LEAF``
differ within one of them, its list is longer, and so it is around a pole with several cities.

Points with a null, a NaN or a coordinate beyond 256 degrees have no cell: they get the default
region, no city and ``config.NO_CITY_KM``. Cities at such places and boxes with a null or NaN bound decide
nothing; a bound may be infinite. Empty tables give an index that answers the same way. Equal
extents and equal places are reduced to the row that wins before the index is built.
"""

from __future__ import annotations

import functools
import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from hazardflow import config
from hazardflow.functions import geo
from hazardflow.functions.sql import literal
from hazardflow.functions.stats import computed_once
from hazardflow.workspace import stored

#: Points and cities are placed up to this many degrees, also the side of the cells at level 0 in a plane of degrees.
#: Halving is exact, so a point is never beside its cell.
ROOT = 256.0
#: A cell with more candidates is split.
LEAF = 16
#: Levels between a cell and its parts: two make 16 parts.
STEP = 2
#: Cells and their bounds, and bytes of lists, up to which they are broadcast.
SMALL_CELLS, SMALL_BYTES = 1 << 16, 4 << 20
_CELL = ["cell_x", "cell_y"]
_KEY = ["_cell_level", "_cell_x", "_cell_y"]
_LIST, _HIT, _PLACE = "_cell_list", "_cell_hit", "_cell_place"
_LOWEST = -(1 << 63)
#: Slack of the candidate rule, far above the rounding of squared distances.
SLACK = {"planar": 1e-9, "haversine": 4e-13}
MODES = tuple(SLACK)


class Tiling(NamedTuple):
    """Cells at level 0: their side and numbers. ``deepest`` is the last level."""

    root: float
    columns: range
    rows: range
    deepest: int

    def side(self, level: int) -> float:
        return self.root / (1 << level)


DEGREES = Tiling(ROOT, range(-1, 1), range(-1, 1), 22)
#: Face f has the x from 2 f to 2 f + 2 and the y from -1 to 1.
FACES = Tiling(1.0, range(0, 12), range(-1, 1), 20)
TILINGS = {"planar": DEGREES, "haversine": FACES}


def _split(rows: DataFrame, parts: int) -> DataFrame:
    """Each row once for each of parts x parts cells of its cell."""
    steps = ", ".join(map(str, range(parts)))
    return rows.selectExpr("*", f"explode(array({steps})) AS part_x").selectExpr(
        "*", f"explode(array({steps})) AS part_y").withColumns({
            "cell_x": F.expr(f"cell_x * {parts} + part_x"), "cell_y": F.expr(f"cell_y * {parts} + part_y"),
        }).drop("part_x", "part_y")


def _joined(rows: DataFrame, cells: DataFrame, count: int, how: str = "inner") -> DataFrame:
    """``rows`` with ``cells``, a table with one row a cell that has ``count`` rows or fewer."""
    return rows.join(cells.hint("broadcast" if count <= SMALL_CELLS else "merge"), _CELL, how)


def _tiled(entries: DataFrame, tiling: Tiling, listed: list[str], met, bounds, keeps, crowd: str = "count(*)") -> DataFrame:
    """(level, cell_x, cell_y, list) of cells that tile the plane; ``listed`` are the fields of a list.

    For the side of a cell, ``met`` filters rows of an entry and a cell or adds columns to them, ``bounds`` gives
    named aggregates for each cell and ``keeps`` a condition that may use both. ``crowd`` counts the candidates of a cell.
    """
    level, leaves = 0, []
    rows = entries
    for name, numbers in zip(_CELL, (tiling.columns, tiling.rows)):
        rows = rows.withColumn(name, F.explode(F.array(*map(F.lit, numbers)).cast("array<bigint>")))
    cells = len(tiling.columns) * len(tiling.rows)
    while True:
        side = tiling.side(level)
        judged = met(rows, side)
        found = judged.groupBy(*_CELL).agg(*(F.expr(e).alias(name) for name, e in bounds(side).items()))
        if cells > SMALL_CELLS:
            found = stored(found, "bounds")  # adaptive execution splits hot cells only between plain exchanges
        kept = stored(_joined(judged, found, cells).filter(keeps(side)).select(*rows.columns), "cells")
        crowded = stored(kept.groupBy(*_CELL).agg(F.expr(crowd).alias("n")).filter(F.col("n") > LEAF).select(*_CELL), "crowded")
        count = crowded.count()
        done = level == tiling.deepest or not count
        leaves.append((kept if done else _joined(kept, crowded, count, "left_anti")).withColumn("level", F.lit(level)))
        if done:
            break
        rows = _split(_joined(kept, crowded, count, "left_semi"), 1 << STEP)
        cells = count << (2 * STEP)
        level += STEP
    every = functools.reduce(DataFrame.unionByName, leaves)
    lists = every.groupBy("level", *_CELL).agg(F.collect_list(F.struct(*listed)).alias("list"))
    nowhere = entries.sparkSession.range(1).select(
        F.lit(-1).alias("level"), F.lit(0).cast("long").alias("cell_x"), F.lit(0).cast("long").alias("cell_y"),
        F.array().cast(lists.schema["list"].dataType).alias("list"))
    return stored(lists.unionByName(nowhere), "tiles")


def region_index(boxes: DataFrame, default: str = config.REGION_DEFAULT) -> DataFrame:
    """Index over (position, name, min_lon, max_lon, min_lat, max_lat).

    The box with the greatest position wins, of equal ones the one with the greater name.
    """
    sides = ["min_lon", "max_lon", "min_lat", "max_lat"]
    known = boxes.select(F.col("position").cast("long"), F.col("name").cast("string"), *(F.col(s).cast("double") for s in sides))
    for side in sides:
        known = known.filter(F.col(side).isNotNull() & ~F.isnan(side))
    latest = known.filter("min_lon <= max_lon AND min_lat <= max_lat AND position IS NOT NULL").groupBy(*sides).agg(
        F.max(F.struct("position", "name")).alias("top"))
    everywhere = known.sparkSession.range(1).select(
        F.lit(_LOWEST).alias("position"), F.lit(default).alias("name"),
        *(F.lit(sign * float("inf")).alias(s) for s, sign in zip(sides, (-1, 1, -1, 1))))
    entries = stored(latest.select("top.position", "top.name", *sides).unionByName(everywhere), "boxes")

    def met(rows: DataFrame, side: float) -> DataFrame:
        s = literal(side)
        return rows.filter(f"max_lon >= cell_x * {s} AND min_lon <= (cell_x + 1) * {s}"
                      f" AND max_lat >= cell_y * {s} AND min_lat <= (cell_y + 1) * {s}")

    def bounds(side: float) -> dict[str, str]:
        s = literal(side)
        return {"bound": f"max(CASE WHEN min_lon <= cell_x * {s} AND max_lon >= (cell_x + 1) * {s}"
                         f" AND min_lat <= cell_y * {s} AND max_lat >= (cell_y + 1) * {s} THEN position END)"}

    return _tiled(entries, DEGREES, entries.columns, met, bounds, lambda side: F.expr("position >= bound"))


def _term(mode: str, lat: str, lon: str, city_lat: str, city_lon: str) -> str:
    """A quantity that rises with the distance; the same as in ``geo.nearest_city_km``."""
    dlat, dlon = f"({lat} - {city_lat})", f"({lon} - {city_lon})"
    if mode == "planar":
        return f"({dlat} * {dlat} + {dlon} * {dlon})"
    return (f"(power(sin(radians({dlat}) / 2), 2)"
            f" + cos(radians({lat})) * cos(radians({city_lat})) * power(sin(radians({dlon}) / 2), 2))")


def _straight(mode: str, lat: str, lon: str) -> list[str]:
    """Coordinates of a place between which distances are straight: degrees, or through the globe of radius 1."""
    if mode == "planar":
        return [f"({lon})", f"({lat})"]
    a, b = f"radians({lat})", f"radians({lon})"
    return [f"(cos({a}) * cos({b}))", f"(cos({a}) * sin({b}))", f"sin({a})"]


def _with_middle(rows: DataFrame, mode: str, side: float) -> DataFrame:
    """Adds ``middle_0`` and so on, the straight coordinates of the middle of the cell, and ``reach``, a distance
    from it that no point of the cell exceeds."""
    s, half, diagonal = literal(side), literal(side / 2), literal(side * math.sqrt(0.5))
    x, y = f"(cell_x + 0.5D) * {s}", f"(cell_y + 0.5D) * {s}"
    if mode == "planar":
        return computed_once(rows, {"middle_0": F.expr(x), "middle_1": F.expr(y), "reach": F.expr(diagonal)})
    placed = computed_once(rows, {"face": F.expr(f"CAST(floor({x} / 2) AS INT)"), "x": F.expr(x), "v": F.expr(y)})
    faced = computed_once(placed, {"u": F.expr("x - 2 * face - 1"), "core": F.expr(
        "sqrt(1 + (x - 2 * face - 1) * (x - 2 * face - 1) + v * v)")})
    # A face touches the globe in its middle. A step on it is as long on the globe divided by the distance from the core.
    nearest = " + ".join(f"pow(greatest(abs({c}) - {half}, 0D), 2)" for c in "uv")
    return computed_once(faced, {
        "middle_0": F.expr("CASE face WHEN 0 THEN 1D WHEN 1 THEN -1D ELSE u END / core"),
        "middle_1": F.expr("CASE face WHEN 2 THEN 1D WHEN 3 THEN -1D ELSE IF(face < 2, u, v) END / core"),
        "middle_2": F.expr("CASE face WHEN 4 THEN 1D WHEN 5 THEN -1D ELSE v END / core"),
        "reach": F.expr(f"{diagonal} / sqrt(1 + {nearest})"),
    }).drop("face", "x", "u", "v", "core")


def _on_faces(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Adds ``_PLACE``: x and y of the point on the faces of the cube."""
    axes = "xyz"
    placed = computed_once(df, {f"_cell_{a}": F.expr(e) for a, e in zip(axes, _straight("haversine", lat, lon))})
    x, y, z = (f"_cell_{a}" for a in axes)
    most = f"greatest(abs({x}), abs({y}), abs({z}))"
    face = (f"CASE {most} WHEN abs({x}) THEN IF({x} > 0, 0, 1) WHEN abs({y}) THEN IF({y} > 0, 2, 3)"
            f" ELSE IF({z} > 0, 4, 5) END")
    faced = computed_once(placed, {"_cell_face": F.expr(face), "_cell_most": F.expr(most)})

    def inner(value: str) -> str:  # the far edge of a face belongs to it, not to the next one
        return f"least(greatest({value} / _cell_most, -1D), 1D - 1e-14D)"

    u, v = inner(f"IF(_cell_face < 2, {y}, {x})"), inner(f"IF(_cell_face < 4, {z}, {y})")
    place = F.expr(f"struct(2 * _cell_face + 1 + {u} AS x, {v} AS y)")
    return computed_once(faced, {_PLACE: place}).drop(x, y, z, "_cell_face", "_cell_most")


def city_index(cities: DataFrame, mode: str = "planar") -> DataFrame:
    """Index over (position, name, latitude, longitude) for one kind of distance.

    Of cities at one place the least position wins, then the lesser name.
    """
    if mode not in MODES:
        raise ValueError(f"unknown distance mode: {mode}")
    place = ["latitude", "longitude"]
    known = cities.select(F.col("position").cast("long"), F.col("name").cast("string"), *(F.col(c).cast("double") for c in place))
    for axis in place:
        known = known.filter(F.abs(axis) < ROOT)
    first = known.groupBy(*place).agg(F.min(F.struct("position", "name")).alias("top"))
    # every cell has an entry, also with an empty table; one without a place is never the nearest
    nobody = known.sparkSession.range(1).select(
        F.lit(None).cast("long").alias("position"), F.lit(None).cast("string").alias("name"),
        *(F.lit(None).cast("double").alias(c) for c in place))
    listed = ["position", "name", *place]
    axes = {f"axis_{i}": F.expr(e) for i, e in enumerate(_straight(mode, "latitude", "longitude"))}
    entries = stored(first.select("top.position", "top.name", *place).unionByName(nobody).withColumns(axes), "cities")

    best, middle = [f"bound_{a}" for a in axes], [f"middle_{i}" for i in range(len(axes))]

    def squares(start: list[str], end: list[str]) -> str:
        return "(" + " + ".join(f"({a} - {b}) * ({a} - {b})" for a, b in zip(start, end)) + ")"

    def met(rows: DataFrame, side: float) -> DataFrame:
        return computed_once(_with_middle(rows, mode, side), {"far": F.expr(squares(list(axes), middle))})

    def nearest(side: float) -> dict[str, str]:
        return {b: f"min_by({a}, far)" for a, b in zip(axes, best)}

    def keeps(side: float) -> Column:
        # The squares of the straight distances to two cities differ by a linear function of the point, whose slope
        # is twice the way between them.
        return F.expr(f"latitude IS NULL OR far - {squares(best, middle)}"
                      f" <= 2 * reach * sqrt({squares(list(axes), best)}) + {literal(SLACK[mode])}")

    # Cities at a pole have different longitudes and one place. Rounding decides between them, so all stay in the
    # list, but smaller cells would not part them.
    pole = " + ".join(f"coalesce(max(CAST(latitude = {p}D AS INT)), 0)" for p in (90, -90))
    crowd = "count(*)" if mode == "planar" else f"count_if(NOT abs(latitude) <=> 90D) + {pole}"
    return _tiled(entries, TILINGS[mode], listed, met, nearest, keeps, crowd)


def _with_lists(df: DataFrame, index: DataFrame, lat: str, lon: str, mode: str = "planar") -> DataFrame:
    """Each row of ``df`` once, with the list of its cell."""
    size = "sum(aggregate(list, 64L, (n, e) -> n + 64L + coalesce(octet_length(e.name), 0)))"
    sizes = index.groupBy("level").agg(F.expr(size)).collect()  # deepest level / STEP + 2 at most
    if mode == "planar":
        placed, x, y = df, lon, lat
    else:
        placed, x, y = _on_faces(df, lat, lon), f"{_PLACE}.x", f"{_PLACE}.y"
    cells = ", ".join(
        f"struct({level} AS l, floor({x} / {side}) AS x, floor({y} / {side}) AS y)"
        for level, side in sorted((level, literal(TILINGS[mode].side(level))) for level, _ in sizes if level >= 0))
    inside = " AND ".join(f"{c} >= {literal(-ROOT)} AND {c} < {literal(ROOT)}" for c in (lat, lon))
    nowhere = "array(struct(-1 AS l, CAST(0 AS BIGINT) AS x, CAST(0 AS BIGINT) AS y))"
    keyed = placed.select("*", F.expr(f"inline(CASE WHEN {inside} THEN array({cells}) ELSE {nowhere} END)").alias(*_KEY))
    tiles = index.toDF(*_KEY, _LIST).hint("broadcast" if sum(n for _, n in sizes) <= SMALL_BYTES else "merge")
    return keyed.join(tiles, _KEY).drop(*_KEY, _PLACE)


def add_region(df: DataFrame, index: DataFrame, lat: str = "latitude", lon: str = "longitude",
               default: str = config.REGION_DEFAULT) -> DataFrame:
    """Adds ``geographic_region``: the name of the last box that holds the point, edges included."""
    inside = f"{lon} BETWEEN e.min_lon AND e.max_lon AND {lat} BETWEEN e.min_lat AND e.max_lat"
    hit = F.expr(f"array_max(transform(filter({_LIST}, e -> {inside}), e -> struct(e.position, e.name)))")
    found = computed_once(_with_lists(df, index, lat, lon), {_HIT: hit})
    name = F.when(F.col(_HIT).isNull(), F.lit(default)).otherwise(F.col(f"{_HIT}.name"))
    return found.withColumn("geographic_region", name).drop(_LIST, _HIT)


def add_nearest_city(df: DataFrame, index: DataFrame, mode: str = "planar", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Adds ``nearest_city``, ``distance_to_major_city_km`` and ``population_impact_risk``.

    ``index`` must be of the same mode. Of cities equally far the least position wins.
    """
    if mode not in MODES:
        raise ValueError(f"unknown distance mode: {mode}")
    term = _term(mode, lat, lon, "e.latitude", "e.longitude")
    hit = F.expr(f"array_min(transform(filter({_LIST}, e -> e.latitude IS NOT NULL),"
                 f" e -> struct({term} AS term, e.position AS position, e.name AS name)))")
    found = computed_once(_with_lists(df, index, lat, lon, mode), {_HIT: hit})
    if mode == "planar":
        km = f"sqrt({_HIT}.term) * {literal(config.KM_PER_DEGREE)}"
    else:
        km = f"asin(sqrt(least(greatest({_HIT}.term, 0D), 1D))) * {literal(2 * geo.EARTH_RADIUS_KM)}"
        km = f"CASE WHEN {_HIT} IS NOT NULL THEN {km} END"
    return found.withColumns({
        "nearest_city": F.col(f"{_HIT}.name"),
        "distance_to_major_city_km": F.expr(f"least({literal(config.NO_CITY_KM)}, {km})"),
    }).withColumn("population_impact_risk", geo.population_risk("distance_to_major_city_km")).drop(_LIST, _HIT)
