"""The given tables seen as earthquake and weather-alert feeds.

``events`` become earthquakes around twelve anchor points and ``orders`` become
weather alerts. The SQL twins are in ``oracles``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazardflow.functions.sql import literal
from hazardflow.functions.stats import computed_once
from hazardflow.operators.cluster import ClusterModel
from hazardflow.plans import silver
from hazardflow.sources import geojson
from hazardflow.workspace import fresh_path, prepare

AS_OF_QUAKES = "2024-01-31 00:00:00"
AS_OF_WEATHER = "2001-08-02 00:00:00"

# anchor number -> (latitude, longitude); the last one is the rest
ANCHORS = [
    (35.6762, 139.6503), (34.0522, -118.2437), (37.7749, -122.4194), (19.4326, -99.1332),
    (-6.2088, 106.8456), (14.5995, 120.9842), (-33.4489, -70.6693), (5.5, 120.0),
    (60.0, -150.0), (-40.0, 175.0), (0.0, -20.0), (89.0, 179.0),
]
WEATHER_EVENTS = [
    "Tornado Warning", "Hurricane Watch", "Flash Flood Warning", "Winter Storm Warning",
    "Excessive Heat Warning", "Red Flag Fire Warning", "High Wind Warning",
    "Rip Current Statement", "Public Notice",
]
FIXED_MODEL = ClusterModel(
    means=[4.0, 390.0, 10.0, 30.0, 500.0, 0.3, 12.0, 4.0, 500.0],
    stds=[2.0, 230.0, 35.0, 110.0, 290.0, 0.2, 7.0, 2.0, 400.0],
    centers=[
        [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0],
        [1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0],
        [-1.0, -1.0, -1.0, -1.0, -1.0, -1.0, -1.0, -1.0, -1.0],
        [1.0, -1.0, 1.0, -1.0, 1.0, -1.0, 1.0, -1.0, 1.0],
    ],
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def _anchor(part: int) -> str:
    whens = " ".join(f"WHEN {i} THEN {literal(point[part])}" for i, point in enumerate(ANCHORS[:-1]))
    return f"CASE user_id % 12 {whens} ELSE {literal(ANCHORS[-1][part])} END"


def quake_columns(events: DataFrame) -> DataFrame:
    """Works on a batch table and on a stream alike; keeps ``raw_id``."""
    placed = computed_once(events, {
        "latitude": F.expr(f"CAST((event_id * 7919) % 401 - 200 AS DOUBLE) / 100D + {_anchor(0)}"),
        "longitude": F.expr(f"CAST((event_id * 6257) % 401 - 200 AS DOUBLE) / 100D + {_anchor(1)}"),
    })
    return placed.selectExpr(
        "event_id AS raw_id",
        "concat('ev', lpad(CAST(event_id - event_id % 2 AS STRING), 12, '0')) AS event_id",
        "sqrt(value) * 0.44D AS magnitude",
        "CAST((user_id * 37 + event_id * 11) % 800 - 20 AS DOUBLE) AS depth_km",
        "latitude",
        "longitude",
        "CAST(get_json_object(props, '$.k') AS BIGINT) * 10 AS significance",
        "event_type AS place",
        "CAST(ts AS TIMESTAMP) AS event_time",
        "CAST(ts AS TIMESTAMP) + INTERVAL 2 MINUTES AS ingestion_time",
    )


def quakes(spark: SparkSession, sf: str) -> DataFrame:
    return quake_columns(table(spark, sf, "events")).drop("raw_id")


def quake_stream(spark: SparkSession, sf: str, files: int | None = None) -> DataFrame:
    """The same projection over ``events`` as a stream of files: as they are, or landed anew in
    ``files`` files, one for a batch, with the versions of an event spread over them."""
    rows = table(spark, sf, "events")
    schema = rows.schema
    if files:
        landing = fresh_path(spark, "landing")
        rows.repartition(files, "event_id").write.parquet(landing)
        reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        return quake_columns(reader.parquet(landing))
    # The file source needs a folder or a pattern, a plain file name is neither.
    return quake_columns(spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet"))


def sites(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as places all over the world."""
    return table(spark, sf, "customer").selectExpr(
        "c_custkey AS position", "c_name AS name",
        "CAST(c_custkey * 6257 % 18001 AS DOUBLE) / 100D - 90D AS latitude",
        "CAST(c_custkey * 7919 % 36001 AS DOUBLE) / 100D - 180D AS longitude")


def areas(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as boxes of one to sixteen degrees that overlap."""
    return sites(spark, sf).selectExpr(
        "position", "name", "longitude AS min_lon", "longitude + 1D + position % 16 AS max_lon",
        "latitude AS min_lat", "latitude + 1D + position * 7 % 16 AS max_lat")


def silver_quakes(spark: SparkSession, sf: str) -> DataFrame:
    return silver.quakes(quakes(spark, sf), AS_OF_QUAKES)


def weather_columns(spark: SparkSession, sf: str) -> DataFrame:
    events = ", ".join(literal(name) for name in WEATHER_EVENTS)
    event = f"get(array({events}), CAST(o_orderkey % {len(WEATHER_EVENTS)} AS INT))"
    sent = "CAST(o_orderdate AS TIMESTAMP)"
    later = sent + " + make_interval(0, 0, 0, 0, CAST({} AS INT))"
    nation = F.broadcast(table(spark, sf, "nation"))  # 25 rows at every scale
    return (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.expr("o_custkey = c_custkey"))
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "o_orderkey AS raw_id",
            "concat('wx', lpad(CAST(o_orderkey - o_orderkey % 3 AS STRING), 12, '0')) AS alert_id",
            f"{event} AS event_type",
            f"concat({event}, ' for ', n_name) AS headline",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'Extreme' WHEN '2-HIGH' THEN 'Severe'"
            " WHEN '3-MEDIUM' THEN 'Moderate' WHEN '5-LOW' THEN 'Minor' ELSE 'Unknown' END AS severity",
            "CASE o_orderstatus WHEN 'F' THEN 'Immediate' WHEN 'O' THEN 'Expected' ELSE 'Future' END"
            " AS urgency",
            "n_name AS area_desc",
            f"{sent} AS sent_time",
            f"{sent} AS effective_time",
            f"{later.format('o_orderkey % 24')} AS onset_time",
            f"CASE WHEN o_custkey % 10 != 0 THEN {later.format('1 + o_custkey % 72')} END AS expires_time",
            f"{later.format('o_orderkey % 3')} AS ingestion_time",
        )
    )


def weather(spark: SparkSession, sf: str) -> DataFrame:
    return weather_columns(spark, sf).drop("raw_id")


def silver_weather(spark: SparkSession, sf: str) -> DataFrame:
    return silver.weather(weather(spark, sf), AS_OF_WEATHER)


def _documents(features: DataFrame) -> DataFrame:
    """One FeatureCollection text per feature text, so that no document grows with the data."""
    return features.selectExpr(
        """concat('{"type":"FeatureCollection","features":[', feature, ']}') AS value"""
    )


def quake_documents(spark: SparkSession, sf: str) -> DataFrame:
    """GeoJSON texts of all events, some features malformed on purpose."""
    feature = """concat('{"type":"Feature","id":"', event_id, '","geometry":',
      CASE WHEN raw_id % 89 = 0 THEN 'null' ELSE concat('{"type":"Point","coordinates":[',
        longitude, ',', latitude, CASE WHEN raw_id % 97 = 0 THEN '' WHEN raw_id % 67 = 0 THEN ',null'
          ELSE concat(',', depth_km) END, ']}') END,
      ',"properties":{"mag":', CASE WHEN raw_id % 83 = 0 THEN '"n/a"' ELSE CAST(magnitude AS STRING) END,
      ',"time":', CASE WHEN raw_id % 73 = 0 THEN 0 ELSE unix_millis(event_time) END,
      ',"tsunami":', raw_id % 2,
      CASE WHEN raw_id % 79 = 0 THEN ',"sig":null' WHEN raw_id % 71 = 0 THEN ''
        ELSE concat(',"sig":', significance) END,
      CASE WHEN raw_id % 61 = 0 THEN '' ELSE concat(',"place":"', place, '"') END, '}}')"""
    rows = quake_columns(table(spark, sf, "events"))
    return _documents(rows.selectExpr(f"{feature} AS feature"))


def weather_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Weather alert texts of all orders, some times unreadable on purpose."""
    iso = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss\")"
    expires = f"concat('\"', {iso.format('expires_time')}, 'Z\"')"
    feature = f"""concat('{{"type":"Feature","geometry":',
      CASE WHEN raw_id % 2 = 0 THEN 'null' ELSE '{{"type":"Point"}}' END,
      ',"properties":{{"id":"', alert_id, '","event":"', event_type, '","headline":"', headline,
      '","severity":"', severity, '","urgency":"', urgency, '","areaDesc":"', area_desc,
      '","sent":"', {iso.format('sent_time')}, 'Z","onset":"', {iso.format('onset_time')},
      '-05:00","expires":', CASE WHEN raw_id % 13 = 0 THEN '"soon"' ELSE coalesce({expires}, 'null') END,
      ',"geocode":{{"SAME":["', raw_id, '"]}}}}}}')"""
    return _documents(weather_columns(spark, sf).selectExpr(f"{feature} AS feature"))


def broken_documents(spark: SparkSession, sf: str) -> DataFrame:
    """A document for every event: a good one, a broken one, or one with odd features."""
    return quake_columns(table(spark, sf, "events")).selectExpr("""CASE raw_id % 6
      WHEN 0 THEN concat('{"features":[{"id":"', event_id, '","properties":{"mag":1}}')
      WHEN 1 THEN concat('{"features":{"id":"', event_id, '"}}')
      WHEN 2 THEN concat('{"id":"', event_id, '"}')
      WHEN 3 THEN concat('{"features":[{"properties":{"id":"', event_id, '"}},"text",{"properties":{}}]}')
      WHEN 4 THEN concat('{"features":[null,{"id":7,"properties":{"id":"', event_id, '"}},{"properties":[1]}]}')
      ELSE concat('{"features":[{"properties":{"id":"', event_id, '"}}]}') END AS value""")


def parsed(spark: SparkSession, sf: str, parse, documents) -> DataFrame:
    return parse(geojson.from_text(documents(spark, sf), "value"))


parsed_quakes = functools.partial(parsed, documents=quake_documents)
parsed_broken = functools.partial(parsed, documents=broken_documents)
parsed_weather = functools.partial(
    parsed, documents=weather_documents
)
