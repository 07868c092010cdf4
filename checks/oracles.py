"""SQL twins of the registered queries, written against the given tables."""

from __future__ import annotations

from checks.projections import AS_OF_QUAKES, AS_OF_WEATHER, FIXED_MODEL
from hazardflow.config import CLUSTER_MAX_ITER, CLUSTERS
from hazardflow.operators.cluster import STILL as CLUSTER_STILL

Q = f"TIMESTAMP '{AS_OF_QUAKES}'"
W = f"TIMESTAMP '{AS_OF_WEATHER}'"

ORACLES: dict[str, str] = {}

# name -> (tables it needs, SELECT); each is emitted once, in this order
_CTES: dict[str, tuple[str, str]] = {}


def _cte(name: str, needs: str, body: str) -> None:
    _CTES[name] = (needs, body)


def _needed(names: str) -> set[str]:
    found: set[str] = set()
    for name in names.split():
        found |= {name} | _needed(_CTES[name][0])
    return found


def _oracle(key: str, needs: str, body: str, rounded: str = "") -> None:
    """``rounded`` names the double columns to round to six places."""
    wanted = _needed(needs)
    chain = ",\n".join(f"{name} AS ({_CTES[name][1]})" for name in _CTES if name in wanted)
    if rounded:
        fixes = ", ".join(f"round({c}, 6) AS {c}" for c in rounded.split())
        body = f"SELECT * REPLACE ({fixes}) FROM ({body})"
    ORACLES[key] = f"WITH RECURSIVE {chain}\n{body}" if chain else body


# --- the two feeds -----------------------------------------------------------
_cte("raw_quakes", "", """
SELECT a.event_id AS raw_id,
  concat('ev', lpad(CAST(a.event_id - a.event_id % 2 AS VARCHAR), 12, '0')) AS event_id,
  sqrt(a.value) * 0.44e0 AS magnitude,
  CAST((a.user_id * 37 + a.event_id * 11) % 800 - 20 AS DOUBLE) AS depth_km,
  CAST((a.event_id * 7919) % 401 - 200 AS DOUBLE) / 100e0 + CASE a.user_id % 12
    WHEN 0 THEN 35.6762e0 WHEN 1 THEN 34.0522e0 WHEN 2 THEN 37.7749e0 WHEN 3 THEN 19.4326e0
    WHEN 4 THEN -6.2088e0 WHEN 5 THEN 14.5995e0 WHEN 6 THEN -33.4489e0 WHEN 7 THEN 5.5e0
    WHEN 8 THEN 60e0 WHEN 9 THEN -40e0 WHEN 10 THEN 0e0 ELSE 89e0 END AS latitude,
  CAST((a.event_id * 6257) % 401 - 200 AS DOUBLE) / 100e0 + CASE a.user_id % 12
    WHEN 0 THEN 139.6503e0 WHEN 1 THEN -118.2437e0 WHEN 2 THEN -122.4194e0 WHEN 3 THEN -99.1332e0
    WHEN 4 THEN 106.8456e0 WHEN 5 THEN 120.9842e0 WHEN 6 THEN -70.6693e0 WHEN 7 THEN 120e0
    WHEN 8 THEN -150e0 WHEN 9 THEN 175e0 WHEN 10 THEN -20e0 ELSE 179e0 END AS longitude,
  CAST(json_extract_string(a.props, '$.k') AS BIGINT) * 10 AS significance,
  a.event_type AS place, a.ts AS event_time, a.ts + INTERVAL 2 MINUTES AS ingestion_time
FROM events a""")
_cte("quakes", "raw_quakes", "SELECT * EXCLUDE (raw_id) FROM raw_quakes")
_cte("valid_q", "quakes", """
SELECT * FROM quakes WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
  AND magnitude BETWEEN 1 AND 10 AND depth_km BETWEEN -10 AND 1000
  AND event_time IS NOT NULL AND length(event_id) > 5""")
_cte("latest_q", "valid_q", """
SELECT * FROM valid_q
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time DESC) = 1""")
_cte("boxes", "", """
SELECT * FROM (VALUES
 (1, 'North America - West Coast', -125e0, -120e0, 32e0, 49e0),
 (2, 'North America - East Coast', -80e0, -65e0, 25e0, 45e0),
 (3, 'North America - Central', -110e0, -90e0, 30e0, 50e0),
 (4, 'Japan Region', 129e0, 146e0, 30e0, 46e0),
 (5, 'Indonesia Region', 95e0, 141e0, -11e0, 6e0),
 (6, 'Philippines Region', 116e0, 127e0, 5e0, 21e0),
 (7, 'Chile Region', -76e0, -66e0, -56e0, -17e0),
 (8, 'New Zealand Region', 166e0, 179e0, -47e0, -34e0),
 (9, 'Alaska Region', -170e0, -130e0, 54e0, 72e0),
 (10, 'Mediterranean', -6e0, 37e0, 30e0, 47e0),
 (11, 'Mid-Atlantic Ridge', -35e0, -10e0, -60e0, 70e0)
) AS b(rank, name, min_lon, max_lon, min_lat, max_lat)""")
_cte("cities", "", """
SELECT * FROM (VALUES (35.6762e0, 139.6503e0), (34.0522e0, -118.2437e0), (37.7749e0, -122.4194e0),
 (19.4326e0, -99.1332e0), (-6.2088e0, 106.8456e0), (14.5995e0, 120.9842e0),
 (-33.4489e0, -70.6693e0)) AS c(lat, lon)""")
_cte("sites", "", """
SELECT c_custkey AS position, c_name AS name,
  CAST(c_custkey * 6257 % 18001 AS DOUBLE) / 100e0 - 90e0 AS lat,
  CAST(c_custkey * 7919 % 36001 AS DOUBLE) / 100e0 - 180e0 AS lon FROM customer""")
# Every distinct point once, with its region and its distances.
_cte("points", "quakes boxes cities", """
SELECT latitude, longitude,
  coalesce((SELECT arg_max(b.name, b.rank) FROM boxes b
    WHERE longitude BETWEEN b.min_lon AND b.max_lon AND latitude BETWEEN b.min_lat AND b.max_lat),
    'Other') AS geographic_region,
  (SELECT min(sqrt(power(latitude - c.lat, 2) + power(longitude - c.lon, 2)) * 111e0)
    FROM cities c) AS km,
  (SELECT min(2 * 6371e0 * asin(sqrt(power(sin(radians(latitude - c.lat) / 2), 2)
      + cos(radians(latitude)) * cos(radians(c.lat)) * power(sin(radians(longitude - c.lon) / 2), 2))))
    FROM cities c) AS great_circle_km
FROM (SELECT DISTINCT latitude, longitude FROM quakes)""")
_RISK = "CASE WHEN km <= 50 THEN 'High' WHEN km <= 200 THEN 'Medium' ELSE 'Low' END"
_SCORE = """CASE WHEN magnitude >= 8 THEN 1e0 WHEN magnitude >= 7 THEN 0.9e0
 WHEN magnitude >= 6 THEN 0.8e0 WHEN magnitude >= 5 THEN 0.6e0 WHEN magnitude >= 4 THEN 0.4e0
 WHEN magnitude >= 3 THEN 0.2e0 ELSE 0.1e0 END"""
_CATEGORY = """CASE WHEN magnitude >= 8 THEN 'Great' WHEN magnitude >= 7 THEN 'Major'
 WHEN magnitude >= 6 THEN 'Strong' WHEN magnitude >= 5 THEN 'Moderate'
 WHEN magnitude >= 4 THEN 'Light' WHEN magnitude >= 3 THEN 'Minor' ELSE 'Micro' END"""
_cte("silver_q", "latest_q points", f"""
SELECT q.*, {_SCORE} AS severity_score, {_CATEGORY} AS severity_category,
  p.geographic_region, p.km AS distance_to_major_city_km, {_RISK} AS population_impact_risk,
  significance >= 600 OR magnitude >= 5 AS is_significant,
  magnitude >= 5 AND km <= 200 AS requires_alert
FROM latest_q q JOIN points p ON q.latitude = p.latitude AND q.longitude = p.longitude""")

_cte("raw_weather", "", """
SELECT o_orderkey AS raw_id,
  concat('wx', lpad(CAST(o_orderkey - o_orderkey % 3 AS VARCHAR), 12, '0')) AS alert_id,
  CASE o_orderkey % 9 WHEN 0 THEN 'Tornado Warning' WHEN 1 THEN 'Hurricane Watch'
    WHEN 2 THEN 'Flash Flood Warning' WHEN 3 THEN 'Winter Storm Warning'
    WHEN 4 THEN 'Excessive Heat Warning' WHEN 5 THEN 'Red Flag Fire Warning'
    WHEN 6 THEN 'High Wind Warning' WHEN 7 THEN 'Rip Current Statement'
    ELSE 'Public Notice' END AS event_type,
  concat(event_type, ' for ', n_name) AS headline,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Extreme' WHEN '2-HIGH' THEN 'Severe'
    WHEN '3-MEDIUM' THEN 'Moderate' WHEN '5-LOW' THEN 'Minor' ELSE 'Unknown' END AS severity,
  CASE o_orderstatus WHEN 'F' THEN 'Immediate' WHEN 'O' THEN 'Expected' ELSE 'Future' END AS urgency,
  n_name AS area_desc, o_orderdate AS sent_time, o_orderdate AS effective_time,
  o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS onset_time,
  CASE WHEN o_custkey % 10 = 0 THEN NULL
    ELSE o_orderdate + to_hours(CAST(1 + o_custkey % 72 AS INTEGER)) END AS expires_time,
  o_orderdate + to_hours(CAST(o_orderkey % 3 AS INTEGER)) AS ingestion_time
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
_cte("weather", "raw_weather", "SELECT * EXCLUDE (raw_id) FROM raw_weather")
_cte("latest_w", "weather", """
SELECT * FROM weather WHERE length(alert_id) > 5 AND event_type IS NOT NULL AND severity IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY alert_id ORDER BY ingestion_time DESC) = 1""")
_cte("weather_scores", "", """
SELECT * FROM (VALUES ('Extreme', 1e0), ('Severe', 0.8e0), ('Moderate', 0.6e0), ('Minor', 0.4e0),
  ('Unknown', 0.2e0)) AS s(severity, severity_score)
CROSS JOIN (VALUES ('Immediate', 1e0), ('Expected', 0.8e0), ('Future', 0.6e0))
  AS u(urgency, urgency_score)""")
_WEATHER_CATEGORY = """CASE WHEN regexp_matches(event_type, 'tornado', 'i') THEN 'Severe Weather'
 WHEN regexp_matches(event_type, 'hurricane|typhoon|cyclone', 'i') THEN 'Tropical Cyclone'
 WHEN regexp_matches(event_type, 'flood', 'i') THEN 'Flood'
 WHEN regexp_matches(event_type, 'winter|snow|ice|blizzard', 'i') THEN 'Winter Weather'
 WHEN regexp_matches(event_type, 'heat|temperature', 'i') THEN 'Temperature Extreme'
 WHEN regexp_matches(event_type, 'fire', 'i') THEN 'Fire Weather'
 WHEN regexp_matches(event_type, 'wind', 'i') THEN 'High Wind' ELSE 'Other' END"""
_cte("silver_w", "latest_w weather_scores", f"""
SELECT *, combined_severity_score >= 0.7e0 OR severity = 'Extreme'
    OR (is_imminent AND severity IN ('Severe', 'Extreme')) AS requires_alert
FROM (SELECT w.*, s.severity_score, s.urgency_score,
    s.severity_score * 0.7e0 + s.urgency_score * 0.3e0 AS combined_severity_score,
    (epoch(expires_time) - epoch(effective_time)) / 3600 AS alert_duration_hours,
    expires_time IS NULL OR expires_time > {W} AS is_active,
    onset_time IS NOT NULL AND onset_time <= {W} + INTERVAL 6 HOURS AS is_imminent,
    {_WEATHER_CATEGORY} AS event_category
  FROM latest_w w JOIN weather_scores s ON w.severity = s.severity AND w.urgency = s.urgency)""")


def _seconds(column: str) -> str:
    return f"CAST(floor(epoch({column})) AS BIGINT)"


# --- anomaly building blocks -------------------------------------------------
_FEATURES = ["magnitude", "depth_km", "significance", "severity_score"]
_cte("moments", "silver_q", "SELECT " + ", ".join(
    f"avg({f}) AS {f}_mean, stddev_samp({f}) AS {f}_std" for f in _FEATURES) + " FROM silver_q")
_cte("zs", "silver_q moments", "SELECT s.*, " + ", ".join(
    f"abs({f} - {f}_mean) / {f}_std AS {f}_zscore, {f}_zscore > 3 AS {f}_anomaly" for f in _FEATURES
) + ", " + " OR ".join(f"{f}_anomaly" for f in _FEATURES)
    + " AS statistical_anomaly FROM silver_q s, moments")
_cte("hourly", "silver_q", """
SELECT geographic_region, date_trunc('hour', event_time) AS hour_window,
  count(*) AS earthquake_count, avg(magnitude) AS avg_magnitude, max(magnitude) AS max_magnitude
FROM silver_q GROUP BY ALL""")


def _baseline(frame: str) -> str:
    return f"""SELECT *, avg(earthquake_count) OVER w AS baseline_count_mean,
  stddev_samp(earthquake_count) OVER w AS baseline_count_std,
  avg(avg_magnitude) OVER w AS baseline_mag_mean
FROM hourly WINDOW w AS (PARTITION BY geographic_region ORDER BY hour_window {frame})"""


_cte("base_rows", "hourly", _baseline("ROWS BETWEEN 167 PRECEDING AND 1 PRECEDING"))
_cte("base_range", "hourly", _baseline(
    "RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 HOUR PRECEDING"))


def _frequency(source: str) -> str:
    return f"""SELECT *, frequency_anomaly OR magnitude_anomaly AS combined_anomaly FROM (
  SELECT *, coalesce((earthquake_count - baseline_count_mean)
      / nullif(baseline_count_std, 0), 0e0) AS frequency_zscore,
    frequency_zscore > 2 OR earthquake_count >= 10 AS frequency_anomaly,
    coalesce(max_magnitude - baseline_mag_mean > 1.5, false) AS magnitude_anomaly FROM {source})"""


def _cells(size: str) -> str:
    return f"""
SELECT lat_grid, lon_grid, concat(lat_grid, '_', lon_grid) AS grid_cell, count(*) AS event_count,
  avg(magnitude) AS avg_magnitude, max(magnitude) AS max_magnitude,
  stddev_samp(magnitude) AS magnitude_std, min(event_time) AS first_event,
  max(event_time) AS last_event,
  ({_seconds('max(event_time)')} - {_seconds('min(event_time)')}) / 3600 AS time_span_hours,
  CASE WHEN time_span_hours > 0 THEN count(*) / time_span_hours ELSE count(*) END
    AS event_rate_per_hour
FROM (SELECT *, floor(latitude / {size}) * {size} AS lat_grid,
  floor(longitude / {size}) * {size} AS lon_grid FROM silver_q) GROUP BY lat_grid, lon_grid"""


def _cell_flags(source: str) -> str:
    return f"""
SELECT *, high_activity_anomaly OR high_magnitude_anomaly OR rapid_succession_anomaly
    AS geographic_anomaly
FROM (SELECT c.*, (event_count - m) / s AS count_zscore, count_zscore > 2 AS high_activity_anomaly,
    avg_magnitude > g + 1 AS high_magnitude_anomaly,
    event_count >= 5 AND time_span_hours <= 24 AS rapid_succession_anomaly
  FROM {source} c, (SELECT avg(event_count) AS m, stddev_samp(event_count) AS s,
    avg(avg_magnitude) AS g FROM {source}))"""


_cte("grid", "silver_q", _cells("1e0"))
_cte("cells", "grid", _cell_flags("grid"))
_cte("fine_grid", "silver_q", _cells("0.25e0"))
_cte("fine_cells", "fine_grid", _cell_flags("fine_grid"))
_cte("patterns", "silver_w", f"""
SELECT event_type, severity, area_desc, count(*) AS alert_frequency,
  avg(combined_severity_score) AS avg_severity_score, count(DISTINCT alert_id) AS unique_alerts,
  min(sent_time) AS first_alert, max(sent_time) AS last_alert,
  ({_seconds('max(sent_time)')} - {_seconds('min(sent_time)')}) / 3600 AS time_span_hours,
  CASE WHEN time_span_hours > 0 THEN count(*) / time_span_hours ELSE count(*) END AS alerts_per_hour
FROM silver_w GROUP BY event_type, severity, area_desc""")
_cte("pattern_flags", "patterns", """
SELECT *, high_frequency_anomaly OR severe_weather_cluster AS weather_anomaly
FROM (SELECT p.*, (alert_frequency - m) / s AS frequency_zscore,
    frequency_zscore > 2 AS high_frequency_anomaly,
    severity = 'Extreme' AND alert_frequency >= 5 AS severe_weather_cluster
  FROM patterns p, (SELECT avg(alert_frequency) AS m, stddev_samp(alert_frequency) AS s FROM patterns))""")

_CLUSTER_FEATURES = {
    "magnitude": "magnitude", "depth_km": "depth_km", "latitude": "latitude",
    "longitude": "longitude", "significance": "significance", "severity": "severity_score",
    "hour_of_day": "hour(event_time)", "day_of_week": "dayofweek(event_time) + 1",
    "city_distance": "distance_to_major_city_km",
}


def _fixed(source: str) -> str:
    """Distance to each fixed centre, nearest centre, and the flag."""
    scaled = [
        f"({sql} - ({mean!r}e0)) / {std!r}e0"
        for sql, mean, std in zip(_CLUSTER_FEATURES.values(), FIXED_MODEL.means, FIXED_MODEL.stds, strict=True)
    ]
    centers = [
        "sqrt(" + " + ".join(f"power(f{i} - ({x!r}e0), 2)" for i, x in enumerate(c)) + ")"
        for c in FIXED_MODEL.centers
    ]
    columns = ", ".join(f"{s} AS f{i}" for i, s in enumerate(scaled))
    return f"""
SELECT *, coalesce(cluster_distance > limit_, false) AS clustering_anomaly,
  cluster_distance / limit_ AS clustering_anomaly_score
FROM (SELECT * EXCLUDE (d),
    CASE WHEN list_min(d) IS NOT NULL THEN list_position(d, list_min(d)) - 1 END AS cluster,
    list_min(d) AS cluster_distance,
    avg(list_min(d)) OVER () + 2 * stddev_samp(list_min(d)) OVER () AS limit_
  FROM (SELECT *, [{", ".join(centers)}] AS d FROM (SELECT *, {columns} FROM {source})))"""


def _fitted(name: str, source: str) -> None:
    """Tables ``name``_x (features), _m (moments), _p (points), _fit (rounds) and ``name``, the scored rows."""
    numbers, k = range(len(_CLUSTER_FEATURES)), CLUSTERS
    complete = " AND ".join(f"x{i} IS NOT NULL" for i in numbers)
    _cte(f"{name}_x", source, "SELECT *, " + ", ".join(
        f"CAST({sql} AS DOUBLE) AS x{i}" for i, sql in enumerate(_CLUSTER_FEATURES.values())) + f" FROM {source}")
    _cte(f"{name}_m", f"{name}_x", "SELECT " + ", ".join(
        f"CAST(sum(q{i}) AS DOUBLE) / count(*) / 1e6 AS m{i}, sqrt(CAST(count(*) * sum(q{i} * q{i}) - sum(q{i}) * sum(q{i})"
        f" AS DOUBLE) / (CAST(count(*) AS DOUBLE) * (count(*) - 1))) / 1e6 AS s{i}" for i in numbers)
        + " FROM (SELECT " + ", ".join(f"CAST(floor(x{i} * 1e6 + 0.5e0) AS HUGEINT) AS q{i}" for i in numbers)
        + f" FROM {name}_x WHERE {complete})")
    _cte(f"{name}_p", f"{name}_x {name}_m", "SELECT event_id, [" + ", ".join(
        f"CASE WHEN s{i} > 0 THEN CAST(floor((x{i} - m{i}) / s{i} * 1e4 + 0.5e0) AS BIGINT) ELSE 0 END" for i in numbers)
        + f"] AS p FROM {name}_x, {name}_m WHERE {complete}")
    means = ", ".join(f"CAST(floor((2e0 * sum(p[{i + 1}]) + count(*)) / (2e0 * count(*))) AS BIGINT)" for i in numbers)
    square = "list_sum(list_transform(list_zip({}, {}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    _cte(f"{name}_fit", f"{name}_p", f"""
SELECT 0 AS it, list(p ORDER BY md5(event_id), event_id) AS c, true AS moved
FROM (SELECT * FROM {name}_p ORDER BY md5(event_id), event_id LIMIT {k})
UNION ALL
SELECT it + 1, after, list_max(list_transform(list_zip(c, after), lambda y: {square.format('y[1]', 'y[2]')})) > {CLUSTER_STILL * CLUSTER_STILL}
FROM (SELECT it, c, list_transform(c, lambda x, i: coalesce(found[i], x)) AS after
  FROM (SELECT it, any_value(c) AS c, map_from_entries(list({{'k': j, 'v': centre}})) AS found
    FROM (SELECT it, any_value(c) AS c, j, [{means}] AS centre
      FROM (SELECT it, c, p, list_position(d, list_min(d)) AS j
        FROM (SELECT f.it, f.c, p.p, list_transform(f.c, lambda x: {square.format('x', 'p.p')}) AS d
          FROM {name}_fit f, {name}_p p WHERE f.moved AND f.it < {CLUSTER_MAX_ITER}))
      GROUP BY it, j) GROUP BY it))""")
    point = "[" + ", ".join(f"CASE WHEN s{i} > 0 THEN (x{i} - m{i}) / s{i} ELSE x{i} * 0 END" for i in numbers) + "]"
    _cte(name, f"{name}_x {name}_m {name}_fit", f"""
SELECT *, coalesce(cluster_distance > limit_, false) AS clustering_anomaly,
  cluster_distance / limit_ AS clustering_anomaly_score
FROM (SELECT * EXCLUDE (d),
    CASE WHEN list_min(d) IS NOT NULL THEN list_position(d, list_min(d)) - 1 END AS cluster,
    list_min(d) AS cluster_distance,
    avg(list_min(d)) OVER () + 2 * stddev_samp(list_min(d)) OVER () AS limit_
  FROM (SELECT a.*, CASE WHEN {complete} THEN list_transform(c, lambda x: sqrt(list_sum(list_transform(list_zip({point}, x),
      lambda z: (z[1] - z[2] / 1e4) * (z[1] - z[2] / 1e4))))) END AS d
    FROM {name}_x a, {name}_m, (SELECT c FROM {name}_fit ORDER BY it DESC LIMIT 1)))""")


_cte("clustered", "silver_q", _fixed("silver_q"))
_fitted("fitted", "silver_q")
for _name, _clusters in (("fused", "clustered"), ("fused_fit", "fitted")):
    _cte(_name, f"zs {_clusters} cells", f"""
SELECT z.*, c.clustering_anomaly, g.geographic_anomaly,
  z.statistical_anomaly OR c.clustering_anomaly OR g.geographic_anomaly AS is_anomaly,
  concat_ws(',', CASE WHEN z.statistical_anomaly THEN 'statistical' END,
    CASE WHEN c.clustering_anomaly THEN 'clustering' END,
    CASE WHEN g.geographic_anomaly THEN 'geographic' END) AS anomaly_types,
  greatest(z.magnitude_zscore / 3, c.clustering_anomaly_score,
    CASE WHEN g.geographic_anomaly THEN 1e0 ELSE 0e0 END) AS anomaly_score,
  {Q} AS detection_timestamp, 'batch-1' AS detection_batch_id
FROM zs z JOIN {_clusters} c USING (event_id)
JOIN cells g ON floor(z.latitude) = g.lat_grid AND floor(z.longitude) = g.lon_grid
WHERE z.event_time >= {Q} - INTERVAL 30 DAYS""")

# --- sources and sinks -------------------------------------------------------
_MILLIS = "date_trunc('millisecond', event_time)"
_cte("good_features", "raw_quakes", f"""
SELECT raw_id, event_id, latitude, longitude,
  CASE WHEN raw_id % 67 <> 0 THEN depth_km END AS depth_km, magnitude,
  CASE WHEN raw_id % 61 <> 0 THEN place ELSE '' END AS place,
  CASE WHEN raw_id % 71 <> 0 THEN significance ELSE 0 END AS significance,
  'earthquake' AS event_type, raw_id % 2 = 1 AS tsunami_warning,
  CASE WHEN raw_id % 73 <> 0 THEN {_MILLIS} END AS event_time,
  'usgs_api' AS data_source, 'batch-1' AS batch_id
FROM raw_quakes
WHERE raw_id % 97 <> 0 AND raw_id % 89 <> 0 AND raw_id % 83 <> 0 AND raw_id % 79 <> 0""")
_oracle("src_geojson_quakes", "good_features", "SELECT * EXCLUDE (raw_id) FROM good_features",
        "latitude longitude depth_km magnitude")
_oracle("src_geojson_rejected", "raw_quakes", """
SELECT event_id, concat_ws(',', CASE WHEN raw_id % 97 = 0 OR raw_id % 89 = 0 THEN 'coordinates' END,
  CASE WHEN raw_id % 79 = 0 THEN 'significance' END,
  CASE WHEN raw_id % 83 = 0 THEN 'magnitude' END) AS reasons
FROM raw_quakes WHERE raw_id % 97 = 0 OR raw_id % 89 = 0 OR raw_id % 83 = 0 OR raw_id % 79 = 0""")
_oracle("src_geojson_strict", "good_features", f"""
SELECT * EXCLUDE (raw_id) REPLACE (coalesce(depth_km, 0e0) AS depth_km,
    CASE place WHEN '' THEN 'Unknown' ELSE place END AS place,
    coalesce(event_time, {Q}) AS event_time),
  printf('%.4f,%.4f', latitude, longitude) AS location
FROM good_features WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
  AND magnitude BETWEEN 1 AND 10""", "latitude longitude depth_km magnitude")
_oracle("src_geojson_documents_rejected", "raw_quakes", """
SELECT CASE raw_id % 6 WHEN 0 THEN length(event_id) + 45 WHEN 1 THEN length(event_id) + 22 END AS document_length,
  CASE WHEN raw_id % 6 < 2 THEN 'unreadable' ELSE 'no features' END AS reason
FROM raw_quakes WHERE raw_id % 6 < 3""")
_oracle("src_geojson_weather_rejected", "raw_quakes", """
SELECT event_id AS alert_id, '' AS reasons FROM raw_quakes WHERE raw_id % 6 >= 3
UNION ALL SELECT '', '' FROM raw_quakes WHERE raw_id % 6 = 3
UNION ALL SELECT NULL, 'properties' FROM raw_quakes WHERE raw_id % 6 = 3
UNION ALL SELECT NULL, 'properties' FROM raw_quakes, range(2) WHERE raw_id % 6 = 4""")
_oracle("src_geojson_weather", "raw_weather", """
SELECT alert_id, event_type, headline, severity, urgency, '' AS certainty, area_desc,
  concat('{"SAME":["', raw_id, '"]}') AS geocode,
  CASE WHEN raw_id % 2 = 1 THEN '{"type":"Point"}' END AS geometry,
  sent_time, onset_time + INTERVAL 5 HOURS AS onset_time,
  CASE WHEN raw_id % 13 <> 0 THEN expires_time END AS expires_time,
  CAST(NULL AS TIMESTAMP) AS ends_time FROM raw_weather""")
_oracle("scan_parquet", "", "SELECT event_id, ts, round(value, 6) AS value FROM events")
_oracle("feed_recent", "quakes", """
SELECT event_id, event_time, magnitude FROM quakes
WHERE event_time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' AND magnitude >= 2.5""", "magnitude")
_oracle("feed_recent_page", "quakes", """
SELECT event_id, event_time, magnitude FROM quakes
WHERE event_time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' AND magnitude >= 2.5
ORDER BY event_time, event_id LIMIT 1000""", "magnitude")
_oracle("feed_recent_bbox", "quakes", """
SELECT event_id, event_time, magnitude, latitude, longitude FROM quakes
WHERE event_time BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-02-01' AND magnitude >= 2.5
  AND latitude BETWEEN 30 AND 46 AND longitude BETWEEN 129 AND 146""", "magnitude latitude longitude")
_oracle("feed_significant", "quakes", f"""
SELECT event_id, event_time, significance FROM quakes
WHERE event_time >= {Q} - INTERVAL 7 DAYS AND significance >= 600""")
_oracle("feed_significant_top", "quakes", f"""
SELECT event_id, event_time, significance FROM quakes
WHERE event_time >= {Q} - INTERVAL 7 DAYS AND significance >= 600
ORDER BY event_time DESC, event_id LIMIT 100""")
_oracle("feed_live", "quakes", f"""
SELECT f.feed, event_id, event_time FROM quakes, (VALUES ('significant_month', 720),
  ('4.5_month', 720), ('2.5_month', 720), ('all_hour', 1), ('all_day', 24)) AS f(feed, hours)
WHERE event_time > {Q} - to_hours(f.hours) AND event_time <= {Q}
  AND CASE f.feed WHEN 'significant_month' THEN significance >= 600
    WHEN '4.5_month' THEN magnitude >= 4.5 WHEN '2.5_month' THEN magnitude >= 2.5 ELSE true END""")
_oracle("feed_weather_active", "weather", f"""
SELECT alert_id, sent_time, expires_time FROM weather
WHERE expires_time IS NULL OR expires_time > {W}""")


def _parts(column: str) -> str:
    return (f"CAST(year({column}) AS INTEGER) AS year, CAST(month({column}) AS INTEGER) AS month, "
            f"CAST(day({column}) AS INTEGER) AS day")


_oracle("sink_append_partitioned", "quakes", f"""
SELECT {_parts('event_time')}, batch_id, count(*) AS rows, round(sum(magnitude), 3) AS magnitude_sum
FROM quakes, (VALUES ('batch-1'), ('batch-2')) AS b(batch_id)
WHERE CAST(event_time AS DATE) >= DATE '2024-01-10' GROUP BY ALL""")
_oracle("sink_overwrite_partitioned", "silver_q", f"""
SELECT {_parts('event_time')},
  CASE WHEN day(event_time) >= 16 THEN 'batch-2' ELSE 'batch' END AS silver_batch_id,
  count(*) AS rows, round(sum(magnitude), 3) AS magnitude_sum FROM silver_q GROUP BY ALL""")
_oracle("sink_batch", "grid", """
SELECT b AS detection_batch_id, count(*) AS cells, CAST(sum(event_count) AS BIGINT) AS events
FROM grid, (VALUES ('batch-1'), ('batch-2')) AS t(b) GROUP BY b""")
_oracle("sink_upsert", "silver_q",
        "SELECT event_id, event_time, magnitude, requires_alert FROM silver_q", "magnitude")
_oracle("add_lineage", "quakes", """
SELECT event_id, event_time, 'usgs_api' AS data_source, 'batch-1' AS ingestion_batch_id,
  '1.0' AS schema_version FROM quakes""")
_oracle("retention_removes", "quakes", f"""
SELECT event_id, event_time FROM quakes WHERE CAST(event_time AS DATE) >= CAST({Q} AS DATE) - 10""")
_oracle("retention_filter", "weather", f"""
SELECT alert_id, sent_time, CAST(sent_time AS DATE) AS event_date FROM weather
WHERE CAST(sent_time AS DATE) >= CAST({W} AS DATE) - 90""")

# --- projections, filters, predicates ---------------------------------------
_oracle("valid_coords", "quakes", """
SELECT event_id, event_time, latitude, longitude FROM quakes
WHERE abs(latitude) <= 90 AND abs(longitude) <= 180""", "latitude longitude")
_oracle("valid_quakes", "quakes", """
SELECT event_id, event_time, magnitude, depth_km FROM quakes WHERE magnitude >= 1 AND magnitude <= 10
  AND depth_km >= -10 AND depth_km <= 1000 AND length(event_id) > 5""", "magnitude depth_km")
_oracle("valid_weather", "weather",
        "SELECT alert_id, event_type, severity FROM weather WHERE length(alert_id) > 5")
_oracle("dq_validation_rate", "quakes valid_q weather", """
SELECT feed, rows_in, rows_kept, round(100e0 * rows_kept / rows_in, 1) AS percent_kept FROM (
  SELECT 'quakes' AS feed, (SELECT count(*) FROM quakes) AS rows_in,
    (SELECT count(*) FROM valid_q) AS rows_kept
  UNION ALL SELECT 'weather', (SELECT count(*) FROM weather),
    (SELECT count(*) FROM weather WHERE length(alert_id) > 5))""")
_oracle("dq_ingest_figures", "raw_quakes good_features", """
SELECT step, rows_in, rows_kept, rows_in - rows_kept AS rows_rejected FROM (
  SELECT 'ingest' AS step, (SELECT count(*) FROM raw_quakes) AS rows_in, (SELECT count(*) FROM good_features) AS rows_kept
  UNION ALL SELECT 'refresh', (SELECT count(*) FROM good_features), (SELECT count(*) FROM good_features
    WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND magnitude BETWEEN 1 AND 10
      AND depth_km BETWEEN -10 AND 1000 AND event_time IS NOT NULL AND length(event_id) > 5))""")
_oracle("quarantine", "quakes", """
SELECT * FROM (SELECT event_id, event_time, concat_ws(',',
  CASE WHEN abs(latitude) > 90 OR abs(longitude) > 180 THEN 'coordinates' END,
  CASE WHEN magnitude < 1 OR magnitude > 10 THEN 'magnitude' END,
  CASE WHEN depth_km < -10 OR depth_km > 1000 THEN 'depth' END) AS reasons FROM quakes)
WHERE reasons <> ''""")
_oracle("lookback_filter", "quakes", f"""
SELECT event_id, ingestion_time FROM quakes WHERE ingestion_time >= {Q} - INTERVAL 24 HOURS""")
_oracle("anomaly_lookback", "quakes weather", f"""
SELECT 'quakes' AS feed, event_id AS id, event_time AS at FROM quakes
WHERE event_time >= {Q} - INTERVAL 30 DAYS AND magnitude IS NOT NULL
UNION ALL SELECT 'weather', alert_id, sent_time FROM weather
WHERE sent_time >= {W} - INTERVAL 30 DAYS""")
_oracle("partition_cols", "quakes", f"""
SELECT event_id, event_time, {_parts('event_time')}, CAST(hour(event_time) AS INTEGER) AS hour
FROM quakes""")
_oracle("partition_cols_weather", "weather", f"""
SELECT alert_id, ingestion_time, {_parts('filed')}, CAST(hour(filed) AS INTEGER) AS hour
FROM (SELECT *, CASE WHEN dayofweek(sent_time) = 0 THEN ingestion_time ELSE sent_time END AS filed
  FROM weather)""")
_oracle("standardize_time", "quakes", f"""
SELECT event_id, event_time, CAST(event_time AS DATE) AS event_date,
  CAST(hour(event_time) AS INTEGER) AS event_hour,
  CAST(date_diff('day', event_time, {Q}) AS INTEGER) AS days_since_event,
  date_diff('day', event_time, {Q}) <= 7 AS is_recent FROM quakes""")
_oracle("flag_significant", "silver_q",
        "SELECT event_id, significance, magnitude, is_significant FROM silver_q", "magnitude")
_oracle("flag_requires_alert", "silver_q",
        "SELECT event_id, magnitude, population_impact_risk, requires_alert FROM silver_q", "magnitude")
_oracle("weather_active", "silver_w", "SELECT alert_id, expires_time, is_active FROM silver_w")
_oracle("weather_imminent", "silver_w", "SELECT alert_id, onset_time, is_imminent FROM silver_w")
_oracle("weather_requires_alert", "silver_w",
        "SELECT alert_id, severity, urgency, requires_alert FROM silver_w")

# --- windows -----------------------------------------------------------------
_oracle("dedup_quakes", "latest_q",
        "SELECT event_id, event_time, ingestion_time, magnitude FROM latest_q", "magnitude")
_oracle("dedup_weather", "latest_w",
        "SELECT alert_id, ingestion_time, event_type, severity FROM latest_w")
_BASE = "avg_magnitude max_magnitude baseline_count_mean baseline_count_std baseline_mag_mean"
_oracle("rolling_baseline_rows", "base_rows", "SELECT * FROM base_rows", _BASE)
_oracle("rolling_baseline_range", "base_range", "SELECT * FROM base_range", _BASE)

# --- joins and scalar enrichment ---------------------------------------------
_oracle("region_assign", "quakes points", """
SELECT event_id, event_time, latitude, longitude, geographic_region
FROM quakes JOIN points USING (latitude, longitude)
WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""", "latitude longitude")
_oracle("nearest_city", "quakes points", """
SELECT event_id, event_time, km AS distance_to_major_city_km
FROM quakes JOIN points USING (latitude, longitude)""", "distance_to_major_city_km")
_oracle("nearest_city_haversine", "quakes points", """
SELECT event_id, event_time, round(great_circle_km, 3) AS distance_to_major_city_km
FROM quakes JOIN points USING (latitude, longitude)""")
_oracle("region_join", "quakes sites", """
SELECT event_id, event_time, latitude, longitude, geographic_region FROM quakes JOIN (
  SELECT p.latitude, p.longitude, coalesce(arg_max(s.name, s.position), 'Other') AS geographic_region
  FROM (SELECT DISTINCT latitude, longitude FROM quakes) p LEFT JOIN sites s
    ON p.longitude BETWEEN s.lon AND s.lon + 1e0 + s.position % 16
    AND p.latitude BETWEEN s.lat AND s.lat + 1e0 + s.position * 7 % 16
  GROUP BY ALL) USING (latitude, longitude)""", "latitude longitude")
for _mode, _km in {
    "": "sqrt(power(p.latitude - s.lat, 2) + power(p.longitude - s.lon, 2)) * 111e0",
    "_haversine": "2 * 6371e0 * asin(sqrt(power(sin(radians(p.latitude - s.lat) / 2), 2)"
    " + cos(radians(p.latitude)) * cos(radians(s.lat)) * power(sin(radians(p.longitude - s.lon) / 2), 2)))",
}.items():
    _oracle(f"nearest_site{_mode}", "quakes sites", f"""
SELECT event_id, event_time, nearest_city, round(km, 3) AS distance_to_major_city_km,
  {_RISK} AS population_impact_risk
FROM quakes JOIN (
  SELECT p.latitude, p.longitude, min({_km}) AS km, arg_min(s.name, ({_km}, s.position)) AS nearest_city
  FROM (SELECT DISTINCT latitude, longitude FROM quakes) p, sites s GROUP BY ALL) USING (latitude, longitude)""")
_oracle("population_risk", "quakes points", f"""
SELECT event_id, event_time, {_RISK} AS population_impact_risk
FROM quakes JOIN points USING (latitude, longitude)""")
_oracle("quake_severity", "quakes", f"""
SELECT event_id, event_time, magnitude, {_SCORE} AS severity_score, {_CATEGORY} AS severity_category
FROM quakes""", "magnitude")
_oracle("weather_severity", "weather weather_scores", """
SELECT alert_id, ingestion_time, severity_score, urgency_score,
  severity_score * 0.7e0 + urgency_score * 0.3e0 AS combined_severity_score
FROM weather JOIN weather_scores USING (severity, urgency)""", "combined_severity_score")
_oracle("weather_duration", "weather", """
SELECT alert_id, ingestion_time, (epoch(expires_time) - epoch(effective_time)) / 3600
  AS alert_duration_hours FROM weather""", "alert_duration_hours")
_oracle("weather_category", "weather", f"""
SELECT alert_id, ingestion_time, event_type, {_WEATHER_CATEGORY} AS event_category FROM weather""")
_oracle("weather_category_words", "weather", f"""
SELECT alert_id, ingestion_time, event_type, CASE WHEN event_type = 'Public Notice' THEN 'Other'
  ELSE {_WEATHER_CATEGORY} END AS event_category FROM weather""")
_oracle("grid_cell", "quakes", """
SELECT event_id, event_time, floor(latitude) AS lat_grid, floor(longitude) AS lon_grid,
  concat(floor(latitude), '_', floor(longitude)) AS grid_cell FROM quakes""")
_oracle("time_features", "quakes", """
SELECT event_id, event_time, date_trunc('hour', event_time) AS hour_window,
  CAST(hour(event_time) AS INTEGER) AS hour_of_day,
  CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week FROM quakes""")
_oracle("parse_iso", "", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S-05:00')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN '' ELSE 'junk' END AS raw,
  CASE o_orderkey % 5 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate + INTERVAL 5 HOURS
    WHEN 2 THEN date_trunc('day', o_orderdate) END AS parsed FROM orders""")
_oracle("location_text", "quakes", """
SELECT event_id, event_time, printf('%.4f,%.4f', latitude, longitude) AS location FROM quakes""")

# --- aggregations ------------------------------------------------------------
_oracle("layer_counts", "quakes weather latest_q latest_w", """
SELECT 'bronze_quakes' AS layer, count(*) AS rows FROM quakes
UNION ALL SELECT 'bronze_weather', count(*) FROM weather
UNION ALL SELECT 'silver_quakes', count(*) FROM latest_q
UNION ALL SELECT 'silver_weather', count(*) FROM latest_w""")
_oracle("freshness", "quakes", "SELECT max(ingestion_time) AS latest_ingestion FROM quakes")
_oracle("dist_severity", "silver_q", """
SELECT severity_category, count(*) AS count, round(avg(magnitude), 2) AS avg_magnitude
FROM silver_q GROUP BY severity_category""")
_oracle("dist_region", "silver_q",
        "SELECT geographic_region, count(*) AS count FROM silver_q GROUP BY geographic_region")
_oracle("dist_weather", "silver_w", """
SELECT severity, event_category, count(*) AS count FROM silver_w GROUP BY severity, event_category""")


def _rate(flag: str) -> str:
    return (f"count(*) FILTER ({flag}) AS {flag}_count, "
            f"round(100e0 * count(*) FILTER ({flag}) / count(*), 1) AS {flag}_percent")


_oracle("flag_rates", "silver_q silver_w", f"""
SELECT 'quakes' AS feed, count(*) AS total, {_rate('requires_alert')},
  CAST(NULL AS BIGINT) AS is_active_count, CAST(NULL AS DOUBLE) AS is_active_percent FROM silver_q
UNION ALL BY NAME
SELECT 'weather' AS feed, count(*) AS total, {_rate('requires_alert')}, {_rate('is_active')}
FROM silver_w""")
_oracle("hourly_region", "hourly", "SELECT * FROM hourly", "avg_magnitude max_magnitude")
_oracle("feature_stats", "moments", "SELECT * FROM moments",
        " ".join(f"{f}_mean {f}_std" for f in _FEATURES))
_oracle("grid_profile", "grid", "SELECT * FROM grid",
        "avg_magnitude max_magnitude magnitude_std time_span_hours event_rate_per_hour")
_oracle("grid_stats", "grid", """
SELECT avg(event_count) AS global_avg_count, stddev_samp(event_count) AS global_std_count,
  avg(avg_magnitude) AS global_avg_magnitude, avg(event_rate_per_hour) AS global_avg_rate
FROM grid""", "global_avg_count global_std_count global_avg_magnitude global_avg_rate")
_oracle("grid_anomaly", "cells", """
SELECT grid_cell, event_count, count_zscore, high_activity_anomaly, high_magnitude_anomaly,
  rapid_succession_anomaly, geographic_anomaly FROM cells""", "count_zscore")
_oracle("weather_patterns", "patterns", "SELECT * FROM patterns",
        "avg_severity_score time_span_hours alerts_per_hour")
_oracle("weather_anomaly", "pattern_flags", """
SELECT event_type, severity, area_desc, alert_frequency, frequency_zscore, high_frequency_anomaly,
  severe_weather_cluster, weather_anomaly FROM pattern_flags""", "frequency_zscore")
_oracle("weather_anomaly_job", "pattern_flags", f"""
SELECT event_type, severity, area_desc, alert_frequency, weather_anomaly,
  {W} AS detection_timestamp, 'batch-1' AS detection_batch_id FROM pattern_flags""")
_oracle("weather_anomaly_summary", "pattern_flags", """
SELECT count(*) AS total_patterns, count(*) FILTER (weather_anomaly) AS anomalous_patterns
FROM pattern_flags""")
_oracle("top_weather_patterns_brief", "pattern_flags", """
SELECT event_type, severity, alert_frequency FROM pattern_flags WHERE weather_anomaly
ORDER BY alert_frequency DESC, event_type, severity, area_desc LIMIT 5""")
_oracle("top_weather_patterns", "pattern_flags", """
SELECT event_type, severity, area_desc, alert_frequency, avg_severity_score, alerts_per_hour
FROM pattern_flags WHERE weather_anomaly
ORDER BY alert_frequency DESC, event_type, severity, area_desc LIMIT 10""",
        "avg_severity_score alerts_per_hour")

# --- anomaly operators -------------------------------------------------------
_oracle("zscore_flags", "zs", "SELECT event_id, " + ", ".join(
    f"{f}_zscore, {f}_anomaly" for f in _FEATURES) + ", statistical_anomaly FROM zs",
    " ".join(f"{f}_zscore" for f in _FEATURES))
_cte("recent_hours", "silver_q", f"""
SELECT * FROM silver_q WHERE event_time >= {Q} - INTERVAL 30 DAYS""")
_oracle("frequency_anomaly", "base_rows", _frequency("base_rows"), _BASE + " frequency_zscore")
_oracle("frequency_anomaly_range", "base_range", _frequency("base_range"), _BASE + " frequency_zscore")
_cte("cluster_inputs", "silver_q", "SELECT event_id, " + ", ".join(
    f"CAST({sql} AS DOUBLE) AS {name}" for name, sql in _CLUSTER_FEATURES.items()) + " FROM silver_q")
_oracle("cluster_features", "cluster_inputs", "SELECT event_id, " + ", ".join(
    f"({n} - avg({n}) OVER ()) / stddev_samp({n}) OVER () AS {n}_scaled" for n in _CLUSTER_FEATURES)
    + " FROM cluster_inputs", " ".join(f"{n}_scaled" for n in _CLUSTER_FEATURES))
_oracle("cluster_invariants", "silver_q", """
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS bad_ids, CAST(0 AS BIGINT) AS bad_distances,
  CAST(0 AS BIGINT) AS bad_flags FROM silver_q""")
for _key, _source in (("cluster_anomaly", "fitted"), ("cluster_score_fixed", "clustered")):
    _oracle(_key, _source, f"""
SELECT event_id, CAST(cluster AS INTEGER) AS cluster, cluster_distance, clustering_anomaly,
  clustering_anomaly_score FROM {_source}""", "cluster_distance clustering_anomaly_score")
for _key, _source in (("cluster_profile", "fitted"), ("cluster_profile_fixed", "clustered")):
    _oracle(_key, _source, f"""
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS count, avg(magnitude) AS avg_magnitude,
  count(*) FILTER (clustering_anomaly) AS anomalies FROM {_source} GROUP BY cluster""", "avg_magnitude")
_oracle("fuse_statistical", "zs", """
SELECT event_id, magnitude, magnitude_zscore, depth_km_zscore, statistical_anomaly FROM zs""",
        "magnitude magnitude_zscore depth_km_zscore")
_cte("holed", "silver_q", """
SELECT * REPLACE (CASE WHEN place <> 'error' THEN depth_km END AS depth_km) FROM silver_q""")
_cte("holed_clustered", "holed", _fixed("(SELECT * FROM holed WHERE depth_km IS NOT NULL)"))
_oracle("fuse_cluster_fixed", "holed holed_clustered", """
SELECT event_id, CAST(c.cluster AS INTEGER) AS cluster, c.cluster_distance,
  coalesce(c.clustering_anomaly, false) AS clustering_anomaly
FROM holed LEFT JOIN holed_clustered c USING (event_id)""", "cluster_distance")
_fitted("holed_fitted", "holed")
_oracle("fuse_cluster", "holed_fitted", """
SELECT event_id, CAST(cluster AS INTEGER) AS cluster, clustering_anomaly FROM holed_fitted""")
for _key, _source, _size in (("fuse_grid", "cells", "1e0"), ("fuse_grid_fine", "fine_cells", "0.25e0")):
    _oracle(_key, f"silver_q {_source}", f"""
SELECT event_id, grid_cell, geographic_anomaly, high_activity_anomaly, rapid_succession_anomaly
FROM silver_q LEFT JOIN {_source} ON floor(latitude / {_size}) * {_size} = lat_grid
  AND floor(longitude / {_size}) * {_size} = lon_grid""")
_oracle("anomaly_fusion", "fused", """
SELECT event_id, statistical_anomaly, clustering_anomaly, geographic_anomaly, is_anomaly,
  anomaly_types, anomaly_score, detection_timestamp, detection_batch_id FROM fused""", "anomaly_score")
_oracle("anomaly_job", "fused_fit", "SELECT event_id, is_anomaly, anomaly_types, anomaly_score FROM fused_fit", "anomaly_score")
_oracle("anomaly_gate", "silver_q", """
SELECT least AS least_magnitude, (SELECT count(*) FROM silver_q WHERE magnitude >= least) AS rows
FROM (VALUES (0e0), (7.5e0)) AS t(least)""")
_oracle("anomaly_summary", "fused", f"""
SELECT count(*) AS total_events, count(*) FILTER (is_anomaly) AS total_anomalies,
  round(100e0 * count(*) FILTER (is_anomaly) / count(*), 2) AS anomaly_rate,
  count(*) FILTER (is_anomaly AND anomaly_score > 0.8) AS high_risk,
  count(*) FILTER (is_anomaly AND event_time > {Q} - INTERVAL 24 HOURS) AS recent FROM fused""")
_cte("typed", "fused", """
SELECT geographic_region, unnest(string_split(anomaly_types, ',')) AS anomaly_type
FROM fused WHERE is_anomaly""")
_oracle("anomaly_by_type", "typed", """
SELECT anomaly_type AS anomaly_type_exploded, count(*) AS count FROM typed GROUP BY anomaly_type""")
_oracle("top_hotspots", "cells", """
SELECT grid_cell, lat_grid, lon_grid, event_count, avg_magnitude, event_rate_per_hour FROM cells
WHERE geographic_anomaly ORDER BY event_count DESC, grid_cell LIMIT 10""",
        "avg_magnitude event_rate_per_hour")
_oracle("top_anomalies", "fused", """
SELECT event_id, magnitude, place, anomaly_types, anomaly_score, event_time FROM fused
WHERE is_anomaly ORDER BY anomaly_score DESC, event_id LIMIT 10""", "magnitude anomaly_score")

# --- alerts ------------------------------------------------------------------
_LEVEL = """CASE WHEN magnitude >= 7 THEN 'Critical' WHEN magnitude >= 6 THEN 'High'
 WHEN magnitude >= 5 THEN 'Medium' ELSE 'Low' END"""
_WEATHER_LEVEL = """CASE severity WHEN 'Extreme' THEN 'Critical' WHEN 'Severe' THEN 'High'
 WHEN 'Moderate' THEN 'Medium' ELSE 'Low' END"""
_cte("alerts_q", "silver_q", f"""
SELECT printf('Earthquake Alert - Magnitude %.1f', magnitude) AS title,
  printf('A magnitude %.1f earthquake has been detected near %s.', magnitude, place) AS message,
  {_LEVEL} AS severity, 'earthquake' AS event_type, place AS location, magnitude,
  event_time AS timestamp, event_id FROM silver_q""")
_cte("alerts_w", "silver_w", f"""
SELECT concat('Weather Alert - ', event_type) AS title,
  concat(headline, ' affecting ', area_desc) AS message, {_WEATHER_LEVEL} AS severity,
  'weather' AS event_type, area_desc AS location, {W} AS timestamp, alert_id AS event_id
FROM silver_w""")
_cte("routed", "alerts_q", """
SELECT *, unnest(CASE WHEN severity IN ('Critical', 'High') THEN ['teams', 'sms']
  ELSE ['teams'] END) AS channel FROM alerts_q""")
_cte("sent", "routed", """
SELECT r.*, c.recipient FROM routed r LEFT JOIN (VALUES ('sms', '+10000000001'),
  ('sms', '+10000000002')) AS c(channel, recipient) ON r.channel = c.channel""")
_oracle("alert_quake", "alerts_q", "SELECT * FROM alerts_q", "magnitude")
_oracle("alert_weather", "alerts_w", "SELECT * FROM alerts_w")
_oracle("alert_anomaly", "fused", f"""
SELECT concat('Anomaly Detected - ', anomaly_types) AS title,
  printf('Anomaly score %.2f for event %s', anomaly_score, event_id) AS message,
  'Medium' AS severity, 'anomaly' AS event_type, place AS location, {Q} AS timestamp, event_id
FROM fused WHERE is_anomaly""")
_oracle("alert_routing", "routed", "SELECT event_id, severity, channel FROM routed")
_oracle("alert_sms_text", "alerts_q alerts_w", """
SELECT event_id, CASE WHEN length(t) > 160 THEN concat(substring(t, 1, 157), '...') ELSE t END AS sms
FROM (SELECT event_id, concat('🌍 ', upper(severity), ' | ', title, ' | Location: ', location,
    printf(' | Mag: %.1f', magnitude)) AS t FROM alerts_q
  UNION ALL SELECT event_id, concat('⛈️ ', upper(severity), ' | ', title, ' | Location: ', location)
  FROM alerts_w)""")
_oracle("alert_card_json", "alerts_q", """
SELECT event_id, concat('{"type":"message","attachments":[{"contentType":',
  '"application/vnd.microsoft.card.adaptive","content":{"type":"AdaptiveCard","version":"1.4",',
  '"body":[{"type":"Container","style":"emphasis","items":[{"type":"TextBlock","text":"🌍 ', title,
  '","size":"Large","weight":"Bolder","color":"',
  CASE WHEN severity IN ('Critical', 'High') THEN 'Attention' ELSE 'Default' END,
  '"},{"type":"TextBlock","text":"**Severity:** ', severity,
  '","size":"Medium","weight":"Bolder","color":"',
  CASE WHEN severity = 'Critical' THEN 'Attention' ELSE 'Default' END,
  '"}]},{"type":"Container","items":[{"type":"TextBlock","text":"', message,
  '","wrap":true,"size":"Medium"}]},{"type":"FactSet","facts":[{"title":"Location:","value":"',
  location, '"}]},{"type":"FactSet","facts":[{"title":"Magnitude:","value":"',
  printf('%.1f', magnitude), '"},{"title":"Time:","value":"',
  strftime(timestamp, '%Y-%m-%d %H:%M:%S UTC'), '"},{"title":"Event ID:","value":"', event_id,
  '"}]}]', CASE WHEN severity = 'Critical' THEN concat(',"actions":[{"type":"Action.OpenUrl",',
    '"title":"View Dashboard","url":"https://dashboard.example.com/"},{"type":"Action.OpenUrl",',
    '"title":"Emergency Procedures","url":"https://emergency.example.com/procedures"}]')
    ELSE '' END, '}}]}') AS card FROM alerts_q""")
_oracle("alert_recipients", "sent", "SELECT event_id, channel, recipient FROM sent")
_oracle("alert_delivery_rollup", "sent silver_q", """
SELECT event_id, channel, count(*) AS attempts, count(*) FILTER (ok) AS delivered,
  bool_or(ok) AS success
FROM (SELECT s.event_id, s.channel, CASE WHEN s.recipient = '+10000000002' THEN e.depth_km < 70
    ELSE e.depth_km < 300 END AS ok FROM sent s JOIN silver_q e USING (event_id))
GROUP BY event_id, channel""")
_oracle("alert_rules", "silver_q silver_w fused", """
SELECT 'quakes' AS source, event_id, 'Major Earthquake Alert' AS rule, 'teams,sms' AS channels,
  'critical_contacts' AS recipient_group FROM silver_q WHERE magnitude >= 6
UNION ALL SELECT 'weather', alert_id, 'Severe Weather Alert', 'teams', 'weather_team'
FROM silver_w WHERE severity = 'Extreme'
UNION ALL SELECT 'anomalies', event_id, 'Anomaly Detection Alert', 'teams', 'data_team'
FROM fused WHERE anomaly_score > 0.8""")

_oracle("alert_rules_outbox", "silver_q alerts_q", """
SELECT e.event_id, 'Major Earthquake Alert' AS rule, c.channel, c.recipient, a.title
FROM silver_q e JOIN alerts_q a USING (event_id), (VALUES ('teams', NULL),
  ('sms', '+10000000001'), ('sms', '+10000000002')) AS c(channel, recipient)
WHERE e.magnitude >= 6""")


# --- dashboard products ------------------------------------------------------
def _trend(at: str, as_of: str, name: str, trend: str, where: str = "true") -> str:
    last = f"count(*) FILTER ({where} AND {at} > {as_of} - INTERVAL 24 HOURS AND {at} <= {as_of})"
    week = (f"count(*) FILTER ({where} AND {at} > {as_of} - INTERVAL 192 HOURS "
            f"AND {at} <= {as_of} - INTERVAL 24 HOURS)")
    return f"{last} AS {name}, round({last} * 7e0 / nullif({week}, 0) - 1, 4) AS {trend}"


_oracle("kpi_quakes", "silver_q", "SELECT " + _trend(
    "event_time", Q, "earthquake_count_24h", "earthquake_trend_7d") + " FROM silver_q")
_oracle("kpi_weather", "silver_w", "SELECT count(*) FILTER (is_active) AS weather_alerts_active, "
        + _trend("sent_time", W, "weather_alerts_24h", "weather_alert_trend") + " FROM silver_w")
_oracle("kpi_anomalies", "fused", "SELECT " + _trend(
    "event_time", Q, "anomalies_detected_24h", "anomaly_trend", "is_anomaly") + " FROM fused")
_oracle("kpi_health", "quakes", f"""
SELECT max(ingestion_time) AS latest_ingestion, round(100 * greatest(0e0,
  1 - ({_seconds(Q)} - {_seconds('max(ingestion_time)')}) / 3600), 2) AS system_health_score,
  round(round(100 * greatest(0e0, 1 - ({_seconds(Q)} - {_seconds('max(ingestion_time)')}) / 3600), 2)
    - round(100 * greatest(0e0, 1 - ({_seconds(Q)} - 86400 - {_seconds(f"max(ingestion_time) FILTER (ingestion_time <= {Q} - INTERVAL 24 HOURS)")}) / 3600), 2), 2) AS health_trend
FROM quakes""")
_oracle("map_feed", "silver_q", f"""
SELECT event_id, latitude, longitude, magnitude, severity_category, place, event_time, depth_km,
  concat(printf('Magnitude %.1f • %s<br/>Time: ', magnitude, coalesce(place, 'an unknown place')),
    strftime(event_time, '%Y-%m-%d %H:%M:%S'), printf('<br/>Depth: %.1f km', depth_km)) AS tooltip
FROM silver_q WHERE event_time >= {Q} - INTERVAL 7 DAYS AND magnitude >= 2.5""",
        "latitude longitude magnitude depth_km")
_oracle("recent_alerts", "silver_q silver_w", f"""
SELECT headline, location, alert_time, severity_level, event_id,
  CASE WHEN minutes < 60 THEN concat(minutes, ' minutes ago')
    WHEN minutes < 1440 THEN concat(minutes // 60, ' hours ago')
    ELSE concat(minutes // 1440, ' days ago') END AS time_ago
FROM (SELECT *, ({_seconds(Q)} - {_seconds('alert_time')}) // 60 AS minutes FROM (
  SELECT printf('Earthquake Alert - Magnitude %.1f', magnitude) AS headline, place AS location,
    event_time AS alert_time, {_LEVEL} AS severity_level, event_id FROM silver_q WHERE requires_alert
  UNION ALL SELECT concat('Weather Alert - ', event_type), area_desc, sent_time, {_WEATHER_LEVEL},
    alert_id FROM silver_w WHERE requires_alert)
  ORDER BY alert_time DESC, event_id LIMIT 8)""")
_oracle("hourly_stats", "silver_q", f"""
SELECT date_trunc('hour', event_time) AS hour_window, avg(magnitude) AS avg_magnitude,
  count(*) AS earthquake_count FROM silver_q WHERE event_time >= {Q} - INTERVAL 7 DAYS
GROUP BY hour_window""", "avg_magnitude")
_oracle("weather_breakdown", "silver_w", """
SELECT severity, count(*) AS alert_count, (SELECT count(*) FROM silver_w) AS total_alerts
FROM silver_w GROUP BY severity""")
_oracle("anomaly_heatmap", "typed", """
SELECT geographic_region, count(*) FILTER (anomaly_type = 'statistical') AS statistical,
  count(*) FILTER (anomaly_type = 'clustering') AS clustering,
  count(*) FILTER (anomaly_type = 'geographic') AS geographic FROM typed GROUP BY geographic_region""")
_TIMELINE = """
SELECT event_time, 'earthquake' AS event_type, severity_score, 'earthquake' AS event_category
FROM silver_q
UNION ALL SELECT sent_time, event_type, combined_severity_score, 'weather' FROM silver_w
UNION ALL SELECT event_time, anomaly_types, anomaly_score, 'anomaly' FROM fused WHERE is_anomaly"""
_oracle("events_timeline", "silver_q silver_w fused", _TIMELINE, "severity_score")
_oracle("events_timeline_24h", "silver_q silver_w fused", f"""
SELECT * FROM ({_TIMELINE}) WHERE event_time > {Q} - INTERVAL 24 HOURS""", "severity_score")
_oracle("global_filter", "silver_q", f"""
SELECT event_id, event_time, geographic_region, magnitude FROM silver_q
WHERE event_time BETWEEN {Q} - INTERVAL 7 DAYS AND {Q} AND magnitude BETWEEN 2.5 AND 10
  AND geographic_region IN ('Japan Region', 'Philippines Region', 'Alaska Region')""", "magnitude")
_oracle("bookmark_ring", "silver_q", """
SELECT event_id, geographic_region, magnitude FROM silver_q WHERE magnitude BETWEEN 4 AND 10
  AND geographic_region IN ('Japan Region', 'Indonesia Region', 'Chile Region')""", "magnitude")
_oracle("bookmark_critical", "silver_q", f"""
SELECT event_id, event_time, magnitude FROM silver_q
WHERE magnitude >= 6 AND event_time >= {Q} - INTERVAL 24 HOURS""", "magnitude")
for _key, _level, _time, _id in (
    ("cap_points", "event", "event_time", "event_id"),
    ("cap_points_hourly", "hour", "date_trunc('hour', event_time)", "CAST(NULL AS VARCHAR)"),
    ("cap_points_daily", "day", "CAST(date_trunc('day', event_time) AS TIMESTAMP)", "CAST(NULL AS VARCHAR)"),
):
    _oracle(_key, "silver_q", f"""
SELECT '{_level}' AS level, {_time} AS point_time, {_id} AS event_id, count(*) AS event_count,
  avg(magnitude) AS avg_magnitude, max(magnitude) AS max_magnitude
FROM silver_q GROUP BY ALL""", "avg_magnitude max_magnitude")
_oracle("cap_points_reduced", "silver_q", """
SELECT bucket, event_id, event_time, magnitude FROM (SELECT bucket, event_id, event_time, magnitude,
    row_number() OVER (PARTITION BY bucket ORDER BY event_time, event_id) AS a,
    row_number() OVER (PARTITION BY bucket ORDER BY event_time DESC, event_id DESC) AS b,
    row_number() OVER (PARTITION BY bucket ORDER BY magnitude, event_time, event_id) AS c,
    row_number() OVER (PARTITION BY bucket ORDER BY magnitude DESC, event_time DESC, event_id DESC) AS d
  FROM (SELECT *, make_timestamp(CAST(floor(epoch(event_time) / 21600) AS BIGINT) * 21600000000) AS bucket FROM silver_q))
WHERE 1 IN (a, b, c, d)""", "magnitude")
_oracle("drill_alert", "silver_w", """
SELECT alert_id, event_type, severity, area_desc, sent_time FROM silver_w
ORDER BY sent_time DESC, alert_id DESC LIMIT 1""")
_oracle("drill_event", "silver_q", """
SELECT event_id, event_time, magnitude, geographic_region, population_impact_risk FROM silver_q
ORDER BY magnitude DESC, event_id DESC LIMIT 1""", "magnitude")

# --- streams -----------------------------------------------------------------
ORACLES["stream_ingest"] = ORACLES["src_geojson_quakes"]
ORACLES["stream_dedup"] = ORACLES["dedup_quakes"]
_oracle("stream_hourly", "hourly", "SELECT * FROM hourly", "avg_magnitude max_magnitude")
_oracle("stream_frequency_alert", "hourly", f"""
SELECT geographic_region, hour_window, earthquake_count, frequency_zscore, frequency_anomaly,
  magnitude_anomaly, combined_anomaly
FROM ({_frequency(f'''(SELECT * FROM hourly LEFT JOIN (SELECT geographic_region,
    avg(earthquake_count) AS baseline_count_mean, stddev_samp(earthquake_count) AS baseline_count_std,
    avg(avg_magnitude) AS baseline_mag_mean FROM hourly
  WHERE hour_window >= {Q} - INTERVAL 168 HOURS GROUP BY geographic_region)
  USING (geographic_region))''')})""", "frequency_zscore")
_oracle("stream_rapid_succession", "silver_q", """
SELECT * FROM (SELECT concat(floor(latitude), '_', floor(longitude)) AS grid_cell, event_id,
    min(event_time) OVER w AS window_start, event_time AS window_end, count(*) OVER w AS event_count
  FROM silver_q WINDOW w AS (PARTITION BY floor(latitude), floor(longitude) ORDER BY event_time
    RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)) WHERE event_count >= 5""")
_oracle("stream_late", "raw_quakes", """
SELECT event_id, event_time, ingestion_time, ingestion_time - event_time > INTERVAL 24 HOURS AS late
FROM (SELECT * REPLACE (ingestion_time + to_hours(CAST(raw_id % 48 AS INTEGER)) AS ingestion_time)
  FROM raw_quakes)""")
_oracle("stream_outbox", "sent silver_q", """
SELECT s.event_id, s.severity, s.channel, s.recipient, s.title
FROM sent s JOIN silver_q e USING (event_id) WHERE e.requires_alert""")
