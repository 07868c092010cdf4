"""Spatial index against brute force."""

import math

import numpy as np
import pandas as pd
import pytest

from hazardflow import config
from hazardflow.functions import geo
from hazardflow.operators import spatial

BOX = "position long, name string, min_lon double, max_lon double, min_lat double, max_lat double"
CITY = "position long, name string, latitude double, longitude double"
POINT = "n long, latitude double, longitude double"


def points(rnd, count):
    """Points of which a third lie in one small place."""
    lat, lon = rnd.uniform(-90, 90, count), rnd.uniform(-180, 180, count)
    lat[: count // 3], lon[: count // 3] = rnd.normal(35, 0.01, count // 3), rnd.normal(139, 0.01, count // 3)
    return pd.DataFrame({"n": np.arange(count), "latitude": lat, "longitude": lon})


def region_of(boxes, lat, lon):
    inside = (boxes.min_lon <= lon) & (lon <= boxes.max_lon) & (boxes.min_lat <= lat) & (lat <= boxes.max_lat)
    return boxes.name[boxes.position[inside].idxmax()] if inside.any() else "Other"


def distances(cities, lat, lon, mode):
    if mode == "planar":
        return np.sqrt((lat - cities.latitude) ** 2 + (lon - cities.longitude) ** 2) * 111
    a, b = np.radians(lat), np.radians(cities.latitude)
    term = np.sin((a - b) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lon - cities.longitude) / 2) ** 2
    return 2 * 6371 * np.arcsin(np.sqrt(np.clip(term, 0, 1)))


def random_boxes(rnd, count, widest):
    low = pd.DataFrame({"min_lon": rnd.uniform(-180, 180, count), "min_lat": rnd.uniform(-90, 90, count)})
    width = rnd.uniform(0, widest, (count, 2)) ** 2 / widest
    boxes = low.assign(max_lon=low.min_lon + width[:, 0], max_lat=low.min_lat + width[:, 1],
                       position=rnd.permutation(count), name=[f"b{i}" for i in range(count)])
    return boxes[[c.split()[0] for c in BOX.split(", ")]]


def random_cities(rnd, count):
    """Half of them crowded around one place."""
    lat, lon = rnd.uniform(-90, 90, count), rnd.uniform(-180, 180, count)
    lat[: count // 2], lon[: count // 2] = rnd.normal(35, 0.05, count // 2), rnd.normal(139, 0.05, count // 2)
    return pd.DataFrame({"position": np.arange(count), "name": [f"c{i}" for i in range(count)], "latitude": lat, "longitude": lon})


def regions(spark, frame, boxes):
    index = spatial.region_index(spark.createDataFrame(boxes, BOX))
    out = spatial.add_region(spark.createDataFrame(frame, POINT), index)
    return [r[0] for r in out.orderBy("n").select("geographic_region").collect()]


def nearest(spark, frame, cities, mode):
    index = spatial.city_index(spark.createDataFrame(cities, CITY), mode)
    out = spatial.add_nearest_city(spark.createDataFrame(frame, POINT), index, mode)
    return [tuple(r) for r in out.orderBy("n").select("nearest_city", "distance_to_major_city_km").collect()]


@pytest.mark.parametrize("count, widest", [(3000, 20), (400, 300)])
def test_regions_equal_brute_force(spark, count, widest):
    rnd = np.random.default_rng(count)
    frame, boxes = points(rnd, 1500), random_boxes(rnd, count, widest)
    expected = [region_of(boxes, lat, lon) for lat, lon in zip(frame.latitude, frame.longitude)]
    assert regions(spark, frame, boxes) == expected
    assert len(set(expected)) > 50


@pytest.mark.parametrize("mode", spatial.MODES)
def test_nearest_cities_equal_brute_force(spark, mode):
    rnd = np.random.default_rng(7)
    frame, cities = points(rnd, 1500), random_cities(rnd, 3000)
    for (name, km), lat, lon in zip(nearest(spark, frame, cities, mode), frame.latitude, frame.longitude):
        far = distances(cities, lat, lon, mode)
        assert km == pytest.approx(far.min(), rel=1e-9, abs=1e-6)
        assert far[int(name[1:])] == pytest.approx(far.min(), rel=1e-9, abs=1e-6)


def test_same_as_the_fixed_lists(spark):
    frame = spark.createDataFrame(points(np.random.default_rng(1), 2000), POINT)
    boxes = [(i, *box) for i, box in enumerate(config.REGION_BOXES)]
    cities = [(i, *city) for i, city in enumerate(config.CITIES)]
    out = spatial.add_region(frame, spatial.region_index(spark.createDataFrame(boxes, BOX)))
    out = out.withColumn("fixed", geo.region_of("latitude", "longitude"))
    assert out.filter("NOT geographic_region <=> fixed").count() == 0
    for mode in spatial.MODES:
        out = spatial.add_nearest_city(frame, spatial.city_index(spark.createDataFrame(cities, CITY), mode), mode)
        out = out.withColumn("fixed", geo.nearest_city_km("latitude", "longitude", mode=mode))
        assert out.filter("abs(distance_to_major_city_km - fixed) > 1e-6").count() == 0


ODD = [(None, 1.0), (1.0, None), (math.nan, 1.0), (1.0, math.inf), (300.0, 0.0), (0.0, -256.5), (0.0, 0.0), (1.0, 1.0)]


def odd_points():
    return [(n, *p) for n, p in enumerate(ODD)]


def test_points_without_a_cell_and_odd_boxes(spark):
    boxes = [
        (1, "edge", 0.0, 1.0, 0.0, 1.0), (2, None, 0.5, 1.0, 0.5, 1.0), (3, "nan", math.nan, 9.0, 0.0, 9.0),
        (4, "turned", 9.0, -9.0, -9.0, 9.0), (5, "null", None, 9.0, -9.0, 9.0), (None, "nowhere", -9.0, 9.0, -9.0, 9.0),
        (0, "same", 0.0, 1.0, 0.0, 1.0),
    ]
    assert regions(spark, odd_points(), boxes) == ["Other"] * 6 + ["edge", None]
    assert regions(spark, odd_points(), [(1, "all", -math.inf, math.inf, -math.inf, math.inf)]) == ["Other"] * 6 + ["all"] * 2


def test_points_without_a_cell_and_odd_cities(spark):
    cities = [(2, "b", 1.0, 1.0), (1, "a", 1.0, 1.0), (3, "null", None, 0.0), (4, "nan", 0.0, math.nan), (5, "far", 999.0, 0.0)]
    for mode in spatial.MODES:
        got = nearest(spark, odd_points(), cities, mode)
        assert got[:6] == [(None, config.NO_CITY_KM)] * 6
        assert [g[0] for g in got[6:]] == ["a", "a"] and got[7][1] == 0.0


def test_ties_go_to_the_least_position(spark):
    cities = [(3, "c", 0.0, 10.0), (1, "a", 0.0, -10.0), (2, "b", 0.0, 10.0)]
    assert [g[0] for g in nearest(spark, [(0, 0.0, 0.0), (1, 0.0, 1.0)], cities, "planar")] == ["a", "b"]


def test_empty_tables(spark):
    assert regions(spark, odd_points(), []) == ["Other"] * 8
    assert nearest(spark, odd_points(), [], "planar") == [(None, config.NO_CITY_KM)] * 8
    assert regions(spark, [], [(1, "x", 0.0, 1.0, 0.0, 1.0)]) == []


def test_across_the_antimeridian(spark):
    cities = [(1, "near", 0.0, -179.5), (2, "far", 0.0, 170.0)]
    assert nearest(spark, [(0, 0.0, 179.5)], cities, "haversine")[0][0] == "near"
    assert nearest(spark, [(0, 0.0, 179.5)], cities, "planar")[0][0] == "far"


def test_lists_are_short_and_cells_tile(spark):
    rnd = np.random.default_rng(2)
    for index in (
        spatial.region_index(spark.createDataFrame(random_boxes(rnd, 2000, 40), BOX)),
        spatial.city_index(spark.createDataFrame(random_cities(rnd, 2000), CITY)),
    ):
        assert index.selectExpr("max(size(list))").first()[0] <= spatial.LEAF
        area = index.filter("level >= 0").selectExpr(f"sum(pow({spatial.ROOT} / pow(2, level), 2))").first()[0]
        assert area == (2 * spatial.ROOT) ** 2


def test_only_counted_small_sides_are_broadcast(spark, monkeypatch):
    """Repeated values make small files of large rows, so a file's size must not decide."""
    plans, stored = [], spatial.stored

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    rnd = np.random.default_rng(5)
    cities = random_cities(rnd, 200).tail(100).assign(name="a long name " * 1000)
    frame = spark.createDataFrame(points(rnd, 100), POINT)
    monkeypatch.setattr(spatial, "stored", noted)
    monkeypatch.setattr(spatial, "SMALL_CELLS", 0, raising=False)
    index = spatial.city_index(spark.createDataFrame(cities, CITY))
    assert any("Join" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)
    out = spatial.add_nearest_city(frame, index)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    small = spatial.city_index(spark.createDataFrame(cities.assign(name="a"), CITY))
    near = spatial.add_nearest_city(frame, small)
    assert "BroadcastHashJoin" in near._jdf.queryExecution().executedPlan().toString()
    km = "distance_to_major_city_km"
    assert out.orderBy("n").select(km).collect() == near.orderBy("n").select(km).collect()


@pytest.mark.parametrize("at_pole", [12, 40])
def test_cities_around_the_poles(spark, at_pole):
    """Rows of cities around both poles, and several at them, which have one place and many longitudes."""
    places = [(sign * (90 - k / 100), lon) for sign in (-1, 1) for k in range(20)
              for lon in np.linspace(-180, 180, at_pole if k == 0 else 12, endpoint=False)]
    rnd = np.random.default_rng(3)
    places += list(zip(rnd.uniform(-89, 89, 300), rnd.uniform(-180, 180, 300)))
    cities = pd.DataFrame(places, columns=["latitude", "longitude"])
    cities = cities.assign(position=np.arange(len(cities)), name=[f"c{i}" for i in range(len(cities))])
    cities = cities[["position", "name", "latitude", "longitude"]]
    frame = pd.DataFrame({"n": np.arange(400), "latitude": np.repeat([1, -1], 200) * (90 - rnd.uniform(0, 0.3, 400)),
                          "longitude": rnd.uniform(-180, 180, 400)})
    index = spatial.city_index(spark.createDataFrame(cities, CITY), "haversine")
    assert index.count() < 5000
    out = spatial.add_nearest_city(spark.createDataFrame(frame, POINT), index, "haversine").orderBy("n")
    got = [tuple(r) for r in out.select("nearest_city", "distance_to_major_city_km").collect()]
    for (name, km), lat, lon in zip(got, frame.latitude, frame.longitude):
        far = distances(cities, lat, lon, "haversine")
        assert km == pytest.approx(far.min(), rel=1e-9, abs=1e-6)
        assert far[int(name[1:])] == pytest.approx(far.min(), rel=1e-9, abs=1e-6)


def test_impossible_mode(spark):
    with pytest.raises(ValueError):
        spatial.city_index(spark.createDataFrame([], CITY), "taxi")
