import math

import pytest
from pyspark.sql import functions as F

from conftest import at, column
from hazardflow import config
from hazardflow.functions import geo, text
from hazardflow.operators import enrich, grid


def test_magnitude_ladders(spark):
    cases = [(2.99, 0.1, "Micro"), (3.0, 0.2, "Minor"), (4.0, 0.4, "Light"), (5.0, 0.6, "Moderate"),
             (6.0, 0.8, "Strong"), (7.0, 0.9, "Major"), (8.0, 1.0, "Great"), (None, 0.1, "Micro")]
    df = spark.createDataFrame([(n, c[0]) for n, c in enumerate(cases)], "n int, magnitude double")
    out = enrich.add_quake_severity(df)
    assert column(out, "severity_score") == [c[1] for c in cases]
    assert column(out, "severity_category") == [c[2] for c in cases]


def test_weather_scores_of_all_pairs(spark):
    severities = {**config.WEATHER_SEVERITY_SCORES, "Unknown": 0.2, None: 0.2}
    urgencies = {**config.URGENCY_SCORES, "Past": 0.4, None: 0.4}
    pairs = [(s, u) for s in severities for u in urgencies]
    df = spark.createDataFrame([(n, *p) for n, p in enumerate(pairs)], "n int, severity string, urgency string")
    got = column(enrich.add_weather_scores(df), "combined_severity_score")
    want = [severities[s] * 0.7 + urgencies[u] * 0.3 for s, u in pairs]
    assert got == pytest.approx(want)


REGIONS = [
    (5.5, 120.0, "Philippines Region"), (5.5, 115.0, "Indonesia Region"),
    (32.0, -125.0, "North America - West Coast"), (49.0, -120.0, "North America - West Coast"),
    (30.0, 129.0, "Japan Region"), (46.0, 146.0, "Japan Region"), (0.0, 0.0, "Other"),
    (None, 120.0, "Other"), (5.0, None, "Other"), (72.01, -150.0, "Other"),
]


def test_regions(spark):
    df = spark.createDataFrame([(n, *r[:2]) for n, r in enumerate(REGIONS)], "n int, latitude double, longitude double")
    assert column(enrich.add_region(df), "geographic_region") == [r[2] for r in REGIONS]


def test_any_box_list_prefers_the_later_box(spark):
    boxes = [("first", 0.0, 10.0, 0.0, 10.0), ("it's second", 5.0, 10.0, 5.0, 10.0)]
    df = spark.createDataFrame([(0, 6.0, 6.0), (1, 1.0, 1.0), (2, 20.0, 1.0)], "n int, latitude double, longitude double")
    assert column(enrich.add_region(df, boxes), "geographic_region") == ["it's second", "first", "Other"]


def test_risk_bands(spark):
    cases = [(0.0, "High"), (50.0, "High"), (50.01, "Medium"), (200.0, "Medium"), (200.01, "Low"), (None, "Low")]
    df = spark.createDataFrame([(n, c[0]) for n, c in enumerate(cases)], "n int, km double")
    assert column(df.withColumn("risk", geo.population_risk("km")), "risk") == [c[1] for c in cases]


@pytest.mark.parametrize("mode", ["planar", "haversine"])
def test_missing_coordinates_are_far_away(spark, mode):
    df = spark.createDataFrame([(0, None, 1.0), (1, 35.6762, 139.6503)], "n int, latitude double, longitude double")
    out = enrich.add_city_distance(df, mode=mode)
    assert column(out, "distance_to_major_city_km") == [999999.0, 0.0]
    assert column(out, "population_impact_risk") == ["Low", "High"]


def test_haversine_crosses_the_antimeridian(spark):
    df = spark.createDataFrame([(0, 0.0, 179.5)], "n int, latitude double, longitude double")
    cities = [("Edge", 0.0, -179.5)]
    great = column(enrich.add_city_distance(df, cities, "haversine"), "distance_to_major_city_km")[0]
    flat = column(enrich.add_city_distance(df, cities), "distance_to_major_city_km")[0]
    assert great == pytest.approx(math.radians(1) * 6371, rel=1e-9)
    assert flat == pytest.approx(359 * 111)


def test_unknown_distance_mode():
    with pytest.raises(ValueError):
        geo.nearest_city_km("latitude", "longitude", mode="taxi")


AS_OF = "2024-01-10 00:00:00"


def test_weather_flags(spark):
    schema = ("n int, severity string, urgency string, effective_time timestamp, "
              "onset_time timestamp, expires_time timestamp")
    now = at(AS_OF)
    rows = [
        (0, "Minor", "Future", now, None, None),
        (1, "Minor", "Future", now, at("2024-01-01 00:00:00"), now),
        (2, "Severe", "Future", now, at("2024-01-10 06:00:00"), at("2024-01-10 00:00:01")),
        (3, "Severe", "Unknown", now, at("2024-01-10 06:00:01"), now),
        (4, "Extreme", None, None, None, now),
        (5, "Severe", "Immediate", now, None, at("2024-01-10 12:00:00")),
    ]
    df = spark.createDataFrame(rows, schema).transform(enrich.add_weather_scores)
    out = df.transform(enrich.add_weather_flags, AS_OF).transform(enrich.add_alert_duration)
    assert column(out, "is_active") == [True, False, True, False, False, True]
    assert column(out, "is_imminent") == [False, True, True, False, False, False]
    assert column(out, "requires_alert") == [False, False, True, False, True, True]
    assert column(out, "alert_duration_hours") == [None, 0.0, pytest.approx(1 / 3600), 0.0, None, 12.0]


def test_weather_categories(spark):
    cases = [("Tornado and Flood", "Severe Weather", "Severe Weather"), ("TYPHOON", "Tropical Cyclone", "Tropical Cyclone"),
             ("Public Notice", "Winter Weather", "Other"), ("Ice Storm", "Winter Weather", "Winter Weather"),
             ("Rewind", "High Wind", "Other"), (None, "Other", "Other")]
    df = spark.createDataFrame([(n, c[0]) for n, c in enumerate(cases)], "n int, event_type string")
    assert column(enrich.add_weather_category(df), "event_category") == [c[1] for c in cases]
    assert column(enrich.add_weather_category(df, True), "event_category") == [c[2] for c in cases]


def test_calendar_days_and_flags(spark):
    rows = [(0, at("2024-01-09 23:59:59"), 4.9, 599), (1, at("2024-01-03 00:00:00"), 5.0, 0),
            (2, at("2024-01-02 23:59:59"), 1.0, 600)]
    df = spark.createDataFrame(rows, "n int, event_time timestamp, magnitude double, significance bigint")
    out = df.withColumn("population_impact_risk", F.lit("High")).transform(enrich.add_event_calendar, AS_OF)
    out = out.transform(enrich.add_quake_flags)
    assert column(out, "days_since_event") == [1, 7, 8]
    assert column(out, "is_recent") == [True, True, False]
    assert column(out, "is_significant") == [False, True, True]
    assert column(out, "requires_alert") == [False, True, False]


def test_number_text_rounds_the_binary_value(spark):
    values = [6.25, 6.35, 2.35, 6.75, 0.04, -0.04, 1234.56, 5.0]
    df = spark.createDataFrame(list(enumerate(values)), "n int, x double")
    got = column(df.withColumn("t", text.fixed_decimals(F.col("x"), 1)), "t")
    assert got == [f"{v:.1f}" for v in values]
    four = column(df.withColumn("t", text.location_text(F.col("x"), -F.col("x"))), "t")
    assert four == [f"{v:.4f},{-v:.4f}" for v in values]


def test_iso_times(spark):
    cases = [("2024-01-01T10:00:00Z", at("2024-01-01 10:00:00")), ("2024-01-01T10:00:00-05:00", at("2024-01-01 15:00:00")),
             ("2024-01-01", at("2024-01-01 00:00:00")), ("", None), ("junk", None), ("10:30", None),
             ("2024", None), ("2024-13-01T00:00:00Z", None), (None, None)]
    df = spark.createDataFrame([(n, c[0]) for n, c in enumerate(cases)], "n int, x string")
    assert column(df.withColumn("t", text.parse_iso(F.col("x"))), "t") == [c[1] for c in cases]


def test_elapsed_text(spark):
    times = ["2024-01-09 23:59:31", "2024-01-09 23:01:00", "2024-01-09 23:00:00", "2024-01-09 00:00:01", "2024-01-08 00:00:00"]
    df = spark.createDataFrame([(n, at(t)) for n, t in enumerate(times)], "n int, t timestamp")
    got = column(df.withColumn("x", text.elapsed_text(F.col("t"), F.lit(AS_OF).cast("timestamp"))), "x")
    assert got == ["0 minutes ago", "59 minutes ago", "1 hours ago", "23 hours ago", "2 days ago"]


def test_grid_floors_toward_minus_infinity(spark):
    df = spark.createDataFrame([(0, -0.5, 0.5), (1, 35.0, 139.99), (2, -90.0, -180.0)], "n int, latitude double, longitude double")
    assert column(grid.add_cell(df), "grid_cell") == ["-1.0_0.0", "35.0_139.0", "-90.0_-180.0"]
    assert geo.max_grid_cells(1.0) == 181 * 361
