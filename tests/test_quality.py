import pytest
from pyspark.sql import functions as F

from conftest import at, column
from hazardflow.operators import dedup, quality

T0 = at("2024-01-01 00:00:00")


def quakes(spark, changes):
    base = {"event_id": "ev0001", "magnitude": 5.0, "depth_km": 10.0, "latitude": 0.0,
            "longitude": 0.0, "event_time": T0}
    names = list(base)
    rows = [(n, *[{**base, **change}[k] for k in names]) for n, change in enumerate(changes)]
    return spark.createDataFrame(rows, f"n int, event_id string, magnitude double, depth_km double, "
                                       "latitude double, longitude double, event_time timestamp")


COORDINATES = [
    ({"latitude": 90.0}, True), ({"latitude": -90.0}, True), ({"latitude": 90.01}, False),
    ({"latitude": -90.01}, False), ({"longitude": 180.0}, True), ({"longitude": -180.0}, True),
    ({"longitude": 180.01}, False), ({"longitude": -180.01}, False), ({"latitude": None}, False),
    ({"longitude": None}, False),
]
RULES = [
    ({"magnitude": 0.99}, False), ({"magnitude": 1.0}, True), ({"magnitude": 10.0}, True),
    ({"magnitude": 10.01}, False), ({"magnitude": None}, False), ({"depth_km": -10.01}, False),
    ({"depth_km": -10.0}, True), ({"depth_km": 1000.0}, True), ({"depth_km": 1000.01}, False),
    ({"depth_km": None}, False), ({"event_id": "ev001"}, False), ({"event_id": "ev0001"}, True),
    ({"event_id": None}, False), ({"event_time": None}, False),
]


def test_coordinate_bounds(spark):
    kept = column(quality.valid_coordinates(quakes(spark, [c for c, _ in COORDINATES])), "n")
    assert kept == [n for n, (_, ok) in enumerate(COORDINATES) if ok]


def test_quake_bounds(spark):
    kept = column(quality.valid_quakes(quakes(spark, [c for c, _ in RULES])), "n")
    assert kept == [n for n, (_, ok) in enumerate(RULES) if ok]


def test_quarantine_is_the_exact_complement(spark):
    changes = [c for c, _ in COORDINATES + RULES]
    df = quakes(spark, changes)
    good = df.transform(quality.valid_coordinates).transform(quality.valid_quakes)
    bad = quality.quarantine(df, quality.all_quake_rules())
    assert sorted(column(good, "n") + column(bad, "n")) == list(range(len(changes)))
    reasons = {row["n"]: row["reasons"] for row in bad.collect()}
    assert reasons[2] == ["coordinates"]
    two = quakes(spark, [{"latitude": 91.0, "magnitude": 0.5, "depth_km": None}])
    assert quality.quarantine(two, quality.all_quake_rules()).first()["reasons"] == [
        "coordinates", "magnitude", "depth"
    ]


def test_validation_report_of_an_empty_table(spark):
    row = quality.validation_report(quakes(spark, []), quality.all_quake_rules()).first()
    assert (row["rows_in"], row["rows_kept"], row["percent_kept"]) == (0, 0, None)


@pytest.mark.parametrize("alert_id, ok", [("wx001", False), ("wx0001", True), (None, False)])
def test_weather_rules(spark, alert_id, ok):
    df = spark.createDataFrame([(alert_id, "Flood", "Minor")], "alert_id string, event_type string, severity string")
    assert quality.valid_weather(df).count() == int(ok)


def test_latest_version_wins_and_ties_are_stable(spark):
    rows = [
        ("a", 1.0, at("2024-01-01 00:00:00"), at("2024-01-01 00:00:00")),
        ("a", 2.0, at("2024-01-02 00:00:00"), None),
        ("b", 3.0, at("2024-01-01 00:00:00"), None),
        ("b", 4.0, at("2024-01-01 00:00:00"), at("2023-01-01 00:00:00")),
        ("c", 5.0, at("2024-01-01 00:00:00"), None),
        ("c", 6.0, at("2024-01-01 00:00:00"), None),
    ]
    schema = "event_id string, magnitude double, ingestion_time timestamp, updated_time timestamp"
    results = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(order, schema).repartition(4)
        results.add(tuple(sorted((r["event_id"], r["magnitude"]) for r in dedup.latest_quakes(df).collect())))
    assert len(results) == 1
    best = dict(results.pop())
    assert best["a"] == 2.0 and best["b"] == 4.0 and best["c"] in (5.0, 6.0)


def test_hot_key_is_cut_before_the_exchange(spark):
    """A third of the rows share one id; each map task sends one of them."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("event_id"),
        F.timestamp_seconds("id").alias("ingestion_time"),
    )
    latest = dedup.latest_quakes(df)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:]
    rows = {r["event_id"]: r["ingestion_time"] for r in latest.collect()}
    assert len(rows) == 20_001
    assert rows["hot"] == at("1970-01-01 08:19:57")
