"""One query per operator, over the given tables. ``oracles`` holds the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks import projections as P
from hazardflow import config, schemas
from hazardflow.functions import geo, text
from hazardflow.functions.time import days_before, time_features
from hazardflow.operators import (
    alerts, cluster, dedup, enrich, frequency, fusion, grid, quality, spatial, statistical, weather_patterns,
)
from hazardflow.plans import bronze, dashboard, gold, reports, silver
from hazardflow.sources import feeds, geojson, tables
from hazardflow.streaming import ingest, live
from hazardflow.workspace import fresh_path, prepare, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
Q, W = P.AS_OF_QUAKES, P.AS_OF_WEATHER
BATCH = "batch-1"


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, so that two engines agree on summation order."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(name, 6) for name in doubles}) if doubles else df


def query(function: Query, name: str | None = None) -> Query:
    """Register under the function's name, or the one given."""
    QUERIES[name or function.__name__] = lambda spark, sf: rounded(function(prepare(spark), sf))
    return function


def named(name: str) -> Callable[[Query], Query]:
    """For names that a module of this package already has here."""
    return lambda function: query(function, name)


def _silver_table(spark, sf) -> DataFrame:
    """Silver written to the shared folder, for queries that read it several times."""
    return stored(P.silver_quakes(spark, sf), "silver")


# --- sources and sinks -------------------------------------------------------
QUAKE_COLUMNS = [
    "event_id", "latitude", "longitude", "depth_km", "magnitude", "place", "significance",
    "event_type", "tsunami_warning", "event_time", "data_source", "batch_id",
]


@query
def src_geojson_quakes(spark, sf):
    rows = P.parsed_quakes(spark, sf, lambda docs: geojson.parse_quakes(docs, Q, BATCH))
    return rows.select(*QUAKE_COLUMNS)


@query
def src_geojson_rejected(spark, sf):
    rows = P.parsed_quakes(spark, sf, lambda docs: geojson.rejected_quakes(docs, Q, BATCH))
    return rows.select("event_id", F.array_join("reasons", ",").alias("reasons"))


@query
def src_geojson_strict(spark, sf):
    rows = P.parsed_quakes(spark, sf, lambda docs: geojson.parse_quakes_strict(docs, Q, BATCH))
    return rows.select(*QUAKE_COLUMNS, "location")


@query
def src_geojson_documents_rejected(spark, sf):
    """Documents without a list of features, by reason."""
    rows = P.parsed_broken(spark, sf, geojson.rejected_documents)
    return rows.select(F.length("document").alias("document_length"), "reason")


@query
def src_geojson_weather_rejected(spark, sf):
    """Features without properties next to good ones of the same document; none is lost."""
    bad = P.parsed_broken(spark, sf, geojson.rejected_weather)
    good = P.parsed_broken(spark, sf, lambda docs: geojson.parse_weather(docs, W, BATCH))
    return bad.select(
        F.lit(None).cast("string").alias("alert_id"), F.array_join("reasons", ",").alias("reasons")
    ).unionByName(good.select("alert_id", F.lit("").alias("reasons")))


@query
def src_geojson_weather(spark, sf):
    rows = P.parsed_weather(spark, sf, lambda docs: geojson.parse_weather(docs, W, BATCH))
    return rows.select(
        "alert_id", "event_type", "headline", "severity", "urgency", "certainty", "area_desc",
        "geocode", "geometry", "sent_time", "onset_time", "expires_time", "ends_time",
    )


@query
def scan_parquet(spark, sf):
    schema = P.table(spark, sf, "events").schema
    return tables.scan(spark, f"{sf}/events.parquet", schema).select("event_id", "ts", "value")


@query
def feed_recent(spark, sf):
    return feeds.recent_quakes(P.quakes(spark, sf), "2024-01-10", "2024-01-20").select(
        "event_id", "event_time", "magnitude"
    )


@query
def feed_recent_page(spark, sf):
    """The first page of the feed, as asked for."""
    rows = feeds.recent_quakes(P.quakes(spark, sf), "2024-01-10", "2024-01-20", limit=config.FEED_PAGE)
    return rows.select("event_id", "event_time", "magnitude")


@query
def feed_recent_bbox(spark, sf):
    box = {"min_lat": 30.0, "max_lat": 46.0, "min_lon": 129.0, "max_lon": 146.0}
    chosen = feeds.recent_quakes(P.quakes(spark, sf), "2024-01-01", "2024-02-01", bbox=box)
    return chosen.select("event_id", "event_time", "magnitude", "latitude", "longitude")


@query
def feed_significant(spark, sf):
    return feeds.significant_quakes(P.quakes(spark, sf), Q).select(
        "event_id", "event_time", "significance"
    )


@query
def feed_significant_top(spark, sf):
    limit = config.SIGNIFICANT_FEED["limit"]
    rows = feeds.significant_quakes(P.quakes(spark, sf), Q, limit=limit)
    return rows.select("event_id", "event_time", "significance")


@query
def feed_live(spark, sf):
    """All named feeds; each row says which feed it came from."""
    rows = P.quakes(spark, sf)
    parts = [
        feeds.live_feed(rows, Q, name).select(F.lit(name).alias("feed"), "event_id", "event_time")
        for name in config.LIVE_FEEDS
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def feed_weather_active(spark, sf):
    return feeds.active_weather(P.weather(spark, sf), W).select("alert_id", "sent_time", "expires_time")


def _day_counts(df: DataFrame, *extra: str) -> DataFrame:
    return df.groupBy(*schemas.PARTITION_COLUMNS, *extra).agg(
        F.count("*").alias("rows"), F.round(F.sum("magnitude"), 3).alias("magnitude_sum")
    )


@query
def sink_append_partitioned(spark, sf):
    """Two ingested batches in one table root, read back by partition."""
    root = fresh_path(spark, "bronze")
    rows = P.quakes(spark, sf).transform(enrich.add_quake_partitions, hour=True)
    for batch in ("batch-1", "batch-2"):
        tables.append(rows.transform(enrich.add_lineage, batch_id=batch), root)
    return _day_counts(tables.scan(spark, root, since="2024-01-10"), "batch_id")


@query
def sink_overwrite_partitioned(spark, sf):
    """A second run replaces the days from the 16th on and leaves the others."""
    root = fresh_path(spark, "silver")
    rows = P.silver_quakes(spark, sf)
    tables.overwrite_partitions(rows, root)
    rerun = rows.filter("day >= 16").withColumn("silver_batch_id", F.lit("batch-2"))
    tables.overwrite_partitions(rerun, root)
    return _day_counts(spark.read.parquet(root), "silver_batch_id")


@query
def sink_batch(spark, sf):
    """Two detection batches, the first one written twice."""
    root = fresh_path(spark, "gold")
    cells = stored(grid.geographic_anomalies(P.silver_quakes(spark, sf)), "cells")
    for batch in ("batch-1", "batch-2", "batch-1"):
        tables.write_batch(fusion.stamp_detection(cells, Q, batch), root)
    return (
        spark.read.parquet(root)
        .groupBy(F.col("detection_batch_id").cast("string").alias("detection_batch_id"))
        .agg(F.count("*").alias("cells"), F.sum("event_count").alias("events"))
    )


@query
def sink_upsert(spark, sf):
    """Silver refreshed in two rounds ends with the latest version of every event."""
    root = fresh_path(spark, "silver")
    rows = P.quake_columns(P.table(spark, sf, "events"))
    version = F.col("raw_id") % 2  # every event comes as a first and a second version
    for number in (0, 1):
        part = silver.quakes(rows.filter(version == number).drop("raw_id"), Q, f"round-{number}")
        tables.upsert_days(part, root, dedup.latest_quakes, ["event_id"])
    return spark.read.parquet(root).select("event_id", "event_time", "magnitude", "requires_alert")


@query
def add_lineage(spark, sf):
    return (
        P.quakes(spark, sf)
        .transform(enrich.add_lineage, data_source="usgs_api", ingestion_batch_id=BATCH, schema_version="1.0")
        .select("event_id", "event_time", "data_source", "ingestion_batch_id", "schema_version")
    )


@query
def retention_removes(spark, sf):
    """A layer kept for ten days, after its expired days are deleted."""
    root = fresh_path(spark, "bronze")
    tables.append(P.quakes(spark, sf).transform(enrich.add_quake_partitions), root)
    tables.drop_expired(spark, root, Q, 10)
    return spark.read.parquet(root).select("event_id", "event_time")


@query
def retention_filter(spark, sf):
    """Raw alerts of the last 90 days."""
    rows = P.weather(spark, sf).withColumn("event_date", F.to_date("sent_time"))
    return tables.retain(rows, W, config.RAW_RETENTION_DAYS).select("alert_id", "sent_time", "event_date")


# --- projections, filters, predicates ---------------------------------------
@query
def valid_coords(spark, sf):
    return quality.valid_coordinates(P.quakes(spark, sf)).select(
        "event_id", "event_time", "latitude", "longitude"
    )


@query
def valid_quakes(spark, sf):
    return quality.valid_quakes(P.quakes(spark, sf)).select(
        "event_id", "event_time", "magnitude", "depth_km"
    )


@query
def valid_weather(spark, sf):
    return quality.valid_weather(P.weather(spark, sf)).select("alert_id", "event_type", "severity")


@query
def dq_validation_rate(spark, sf):
    quakes = quality.validation_report(P.quakes(spark, sf), quality.all_quake_rules())
    weather = quality.validation_report(P.weather(spark, sf), quality.weather_rules())
    return quakes.withColumn("feed", F.lit("quakes")).unionByName(
        weather.withColumn("feed", F.lit("weather"))
    )


@query
def quarantine(spark, sf):
    rejected = quality.quarantine(P.quakes(spark, sf), quality.all_quake_rules())
    return rejected.select("event_id", "event_time", F.array_join("reasons", ",").alias("reasons"))


@query
def lookback_filter(spark, sf):
    return quality.ingested_since(P.quakes(spark, sf), Q).select("event_id", "ingestion_time")


@query
def anomaly_lookback(spark, sf):
    quakes = quality.anomaly_window(P.quakes(spark, sf), Q).select(
        F.lit("quakes").alias("feed"), F.col("event_id").alias("id"), F.col("event_time").alias("at")
    )
    weather = quality.weather_window(P.weather(spark, sf), W).select(
        F.lit("weather").alias("feed"), F.col("alert_id").alias("id"), F.col("sent_time").alias("at")
    )
    return quakes.unionByName(weather)


@query
def partition_cols(spark, sf):
    rows = P.quakes(spark, sf).transform(enrich.add_quake_partitions, hour=True)
    return rows.select("event_id", "event_time", "year", "month", "day", "hour")


@query
def partition_cols_weather(spark, sf):
    """Alerts sent on a Sunday lose their sent time, so ingestion time decides."""
    sent = F.when(F.dayofweek("sent_time") != 1, F.col("sent_time"))
    rows = P.weather(spark, sf).withColumn("sent_time", sent)
    return rows.transform(enrich.add_weather_partitions, hour=True).select(
        "alert_id", "ingestion_time", "year", "month", "day", "hour"
    )


@query
def standardize_time(spark, sf):
    rows = P.quakes(spark, sf).transform(enrich.add_event_calendar, Q)
    return rows.select(
        "event_id", "event_time", "event_date", "event_hour", "days_since_event", "is_recent"
    )


@query
def flag_significant(spark, sf):
    return P.silver_quakes(spark, sf).select("event_id", "significance", "magnitude", "is_significant")


@query
def flag_requires_alert(spark, sf):
    return P.silver_quakes(spark, sf).select(
        "event_id", "magnitude", "population_impact_risk", "requires_alert"
    )


@query
def weather_active(spark, sf):
    return P.silver_weather(spark, sf).select("alert_id", "expires_time", "is_active")


@query
def weather_imminent(spark, sf):
    return P.silver_weather(spark, sf).select("alert_id", "onset_time", "is_imminent")


@query
def weather_requires_alert(spark, sf):
    return P.silver_weather(spark, sf).select("alert_id", "severity", "urgency", "requires_alert")


# --- windows -----------------------------------------------------------------
@query
def dedup_quakes(spark, sf):
    return silver.clean_quakes(P.quakes(spark, sf)).select(
        "event_id", "event_time", "ingestion_time", "magnitude"
    )


@query
def dedup_weather(spark, sf):
    return silver.clean_weather(P.weather(spark, sf)).select(
        "alert_id", "ingestion_time", "event_type", "severity"
    )


@query
def rolling_baseline_rows(spark, sf):
    return frequency.rolling_baseline(frequency.hourly_activity(P.silver_quakes(spark, sf)), "rows")


@query
def rolling_baseline_range(spark, sf):
    return frequency.rolling_baseline(frequency.hourly_activity(P.silver_quakes(spark, sf)), "range")


# --- joins and scalar enrichment ---------------------------------------------
@query
def region_assign(spark, sf):
    rows = quality.valid_coordinates(P.quakes(spark, sf)).transform(enrich.add_region)
    return rows.select("event_id", "event_time", "latitude", "longitude", "geographic_region")


@query
def nearest_city(spark, sf):
    rows = P.quakes(spark, sf).transform(enrich.add_city_distance)
    return rows.select("event_id", "event_time", "distance_to_major_city_km")


@query
def nearest_city_haversine(spark, sf):
    rows = P.quakes(spark, sf).transform(enrich.add_city_distance, mode="haversine")
    return rows.select(
        "event_id", "event_time", F.round("distance_to_major_city_km", 3).alias("distance_to_major_city_km")
    )


@query
def region_join(spark, sf):
    """Regions from a table of boxes."""
    index = spatial.region_index(P.areas(spark, sf))
    rows = spatial.add_region(P.quakes(spark, sf), index)
    return rows.select("event_id", "event_time", "latitude", "longitude", "geographic_region")


def _nearest_site(spark, sf, mode):
    index = spatial.city_index(P.sites(spark, sf), mode)
    rows = spatial.add_nearest_city(P.quakes(spark, sf), index, mode)
    km = F.round("distance_to_major_city_km", 3).alias("distance_to_major_city_km")
    return rows.select("event_id", "event_time", "nearest_city", km, "population_impact_risk")


@query
def nearest_site(spark, sf):
    """Nearest of a table of cities."""
    return _nearest_site(spark, sf, "planar")


@query
def nearest_site_haversine(spark, sf):
    return _nearest_site(spark, sf, "haversine")


@query
def population_risk(spark, sf):
    rows = P.quakes(spark, sf).transform(enrich.add_city_distance)
    return rows.select("event_id", "event_time", "population_impact_risk")


@query
def quake_severity(spark, sf):
    rows = P.quakes(spark, sf).transform(enrich.add_quake_severity)
    return rows.select("event_id", "event_time", "magnitude", "severity_score", "severity_category")


@query
def weather_severity(spark, sf):
    rows = P.weather(spark, sf).transform(enrich.add_weather_scores)
    return rows.select(
        "alert_id", "ingestion_time", "severity_score", "urgency_score", "combined_severity_score"
    )


@query
def weather_duration(spark, sf):
    rows = P.weather(spark, sf).transform(enrich.add_alert_duration)
    return rows.select("alert_id", "ingestion_time", "alert_duration_hours")


@query
def weather_category(spark, sf):
    rows = P.weather(spark, sf).transform(enrich.add_weather_category)
    return rows.select("alert_id", "ingestion_time", "event_type", "event_category")


@query
def weather_category_words(spark, sf):
    rows = P.weather(spark, sf).transform(enrich.add_weather_category, whole_words=True)
    return rows.select("alert_id", "ingestion_time", "event_type", "event_category")


@query
def grid_cell(spark, sf):
    rows = P.quakes(spark, sf).transform(grid.add_cell)
    return rows.select("event_id", "event_time", "lat_grid", "lon_grid", "grid_cell")


@named("time_features")
def calendar_features(spark, sf):
    rows = P.quakes(spark, sf)
    return rows.select("event_id", "event_time").withColumns(time_features(F.col("event_time")))


@query
def parse_iso(spark, sf):
    """ISO texts of five kinds, two of them unreadable."""
    at, kind = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey") % 5
    raw = (
        F.when(kind == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'-05:00'"))
        .when(kind == 2, F.date_format(at, "yyyy-MM-dd"))
        .when(kind == 3, F.lit(""))
        .otherwise(F.lit("junk"))
    )
    rows = P.table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.withColumn("parsed", text.parse_iso(F.col("raw")))


@query
def location_text(spark, sf):
    rows = P.quakes(spark, sf).transform(enrich.add_location_text)
    return rows.select("event_id", "event_time", "location")


# --- aggregations ------------------------------------------------------------
@query
def layer_counts(spark, sf):
    quakes, weather = P.quakes(spark, sf), P.weather(spark, sf)
    return reports.layer_counts({
        "bronze_quakes": quakes,
        "bronze_weather": weather,
        "silver_quakes": silver.clean_quakes(quakes),
        "silver_weather": silver.clean_weather(weather),
    })


@query
def freshness(spark, sf):
    return reports.freshness(P.quakes(spark, sf))


@query
def dist_severity(spark, sf):
    return reports.severity_distribution(P.silver_quakes(spark, sf))


@query
def dist_region(spark, sf):
    return reports.region_distribution(P.silver_quakes(spark, sf))


@query
def dist_weather(spark, sf):
    return reports.weather_distribution(P.silver_weather(spark, sf))


@query
def flag_rates(spark, sf):
    quakes = reports.flag_rates(P.silver_quakes(spark, sf), ["requires_alert"])
    weather = reports.flag_rates(P.silver_weather(spark, sf), ["is_active", "requires_alert"])
    return quakes.withColumn("feed", F.lit("quakes")).unionByName(
        weather.withColumn("feed", F.lit("weather")), allowMissingColumns=True
    )


@query
def hourly_region(spark, sf):
    return frequency.hourly_activity(P.silver_quakes(spark, sf))


@query
def feature_stats(spark, sf):
    return statistical.feature_statistics(P.silver_quakes(spark, sf))


@query
def grid_profile(spark, sf):
    return grid.grid_profile(P.silver_quakes(spark, sf))


@query
def grid_stats(spark, sf):
    return grid.grid_global_statistics(grid.grid_profile(P.silver_quakes(spark, sf)))


@query
def grid_anomaly(spark, sf):
    return grid.geographic_anomalies(_silver_table(spark, sf)).select(
        "grid_cell", "event_count", "count_zscore", "high_activity_anomaly",
        "high_magnitude_anomaly", "rapid_succession_anomaly", "geographic_anomaly",
    )


@named("weather_patterns")
def pattern_profile(spark, sf):
    return weather_patterns.pattern_profile(P.silver_weather(spark, sf))


def _weather_flags(spark, sf) -> DataFrame:
    return weather_patterns.flag_patterns(weather_patterns.pattern_profile(P.silver_weather(spark, sf)))


@query
def weather_anomaly(spark, sf):
    return _weather_flags(spark, sf).select(
        "event_type", "severity", "area_desc", "alert_frequency", "frequency_zscore",
        "high_frequency_anomaly", "severe_weather_cluster", "weather_anomaly",
    )


@query
def weather_anomaly_job(spark, sf):
    """The whole job with seven years of look-back."""
    return gold.weather_anomalies(P.silver_weather(spark, sf), W, BATCH, days=7 * 365).select(
        "event_type", "severity", "area_desc", "alert_frequency", "weather_anomaly",
        "detection_timestamp", "detection_batch_id",
    )


@query
def weather_anomaly_summary(spark, sf):
    return reports.weather_anomaly_summary(_weather_flags(spark, sf))


@query
def top_weather_patterns_brief(spark, sf):
    return reports.top_weather_patterns_brief(_weather_flags(spark, sf))


@query
def top_weather_patterns(spark, sf):
    return reports.top_weather_patterns(_weather_flags(spark, sf))


# --- anomaly operators -------------------------------------------------------
@query
def zscore_flags(spark, sf):
    flags = statistical.flag_outliers(P.silver_quakes(spark, sf))
    names = [f"{name}_{kind}" for name in config.STAT_FEATURES for kind in ("zscore", "anomaly")]
    return flags.select("event_id", *names, "statistical_anomaly")


@query
def frequency_anomaly(spark, sf):
    return gold.quake_frequency(P.silver_quakes(spark, sf), Q)


@query
def frequency_anomaly_range(spark, sf):
    return gold.quake_frequency(P.silver_quakes(spark, sf), Q, "range")


@query
def cluster_features(spark, sf):
    return cluster.scaled_features(P.silver_quakes(spark, sf))


def _fitted(spark, sf) -> DataFrame:
    events = _silver_table(spark, sf)
    model = cluster.fit_clusters(events, checkpoint=False)
    return cluster.cluster_anomalies(events, model)


@query
def cluster_anomaly(spark, sf):
    return _fitted(spark, sf).select(
        "event_id", "cluster", "cluster_distance", "clustering_anomaly", "clustering_anomaly_score"
    )


@query
def cluster_profile(spark, sf):
    return cluster.cluster_profile(_fitted(spark, sf))


@query
def cluster_invariants(spark, sf):
    """What must hold for any fit: all rows kept, ids in range, the flag follows the score."""
    rows = _fitted(spark, sf)
    in_range = F.col("cluster").between(0, config.CLUSTERS - 1)
    agrees = F.col("clustering_anomaly") == (F.col("clustering_anomaly_score") > 1)
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(~F.coalesce(in_range, F.lit(False))).alias("bad_ids"),
        F.count_if(~F.coalesce(F.col("cluster_distance") >= 0, F.lit(False))).alias("bad_distances"),
        F.count_if(~F.coalesce(agrees, F.lit(False))).alias("bad_flags"),
    )


def _fixed(spark, sf) -> DataFrame:
    return cluster.cluster_anomalies(_silver_table(spark, sf), P.FIXED_MODEL)


@query
def cluster_score_fixed(spark, sf):
    return _fixed(spark, sf).select(
        "event_id", "cluster", "cluster_distance", "clustering_anomaly", "clustering_anomaly_score"
    )


@query
def cluster_profile_fixed(spark, sf):
    return cluster.cluster_profile(_fixed(spark, sf))


@query
def fuse_statistical(spark, sf):
    flags = statistical.flag_outliers(P.silver_quakes(spark, sf))
    return flags.select("event_id", "magnitude", "magnitude_zscore", "depth_km_zscore", "statistical_anomaly")


@query
def fuse_cluster(spark, sf):
    """Cluster flags on all events; some miss a feature and stay without a cluster."""
    events = P.silver_quakes(spark, sf).withColumn(
        "depth_km", F.when(F.col("place") != "error", F.col("depth_km"))
    )
    model = cluster.fit_clusters(events)  # with its checkpoint
    return cluster.cluster_anomalies(events, model).select("event_id", "cluster", "clustering_anomaly")


@query
def fuse_cluster_fixed(spark, sf):
    events = P.silver_quakes(spark, sf).withColumn(
        "depth_km", F.when(F.col("place") != "error", F.col("depth_km"))
    )
    return cluster.cluster_anomalies(events, P.FIXED_MODEL).select(
        "event_id", "cluster", "cluster_distance", "clustering_anomaly"
    )


@query
def fuse_grid(spark, sf):
    events = _silver_table(spark, sf)
    return grid.attach_cell_flags(events, grid.geographic_anomalies(events)).select(
        "event_id", "grid_cell", *grid.CELL_FLAGS
    )


@query
def fuse_grid_fine(spark, sf):
    """Cells of a quarter degree: too many to broadcast, so the join is salted."""
    events, degrees = _silver_table(spark, sf), 0.25
    cells = grid.geographic_anomalies(events, degrees)
    return grid.attach_cell_flags(events, cells, degrees).select("event_id", "grid_cell", *grid.CELL_FLAGS)


def _fused(spark, sf, events: DataFrame | None = None) -> DataFrame:
    """Fused verdicts with the fixed cluster model, so that SQL can follow."""
    events = _silver_table(spark, sf) if events is None else events
    return gold.quake_anomalies(events, Q, BATCH, model=P.FIXED_MODEL)


@query
def anomaly_fusion(spark, sf):
    return _fused(spark, sf).select(
        "event_id", "statistical_anomaly", "clustering_anomaly", "geographic_anomaly",
        "is_anomaly", "anomaly_types", "anomaly_score", "detection_timestamp", "detection_batch_id",
    )


@query
def anomaly_job(spark, sf):
    """The whole job with its own k-means fit."""
    return gold.quake_anomalies(_silver_table(spark, sf), Q, BATCH).select(
        "event_id", "is_anomaly", "anomaly_types", "anomaly_score"
    )


@query
def anomaly_gate(spark, sf):
    """No gate: every event of the look-back gets a verdict, of a large table and a small one."""
    events = _silver_table(spark, sf)
    kept = [
        _fused(spark, sf, events.filter(F.col("magnitude") >= least)).agg(
            F.lit(least).alias("least_magnitude"), F.count("is_anomaly").alias("rows")
        )
        for least in (0.0, 7.5)
    ]
    return kept[0].unionByName(kept[1])


@query
def anomaly_summary(spark, sf):
    return reports.anomaly_summary(_fused(spark, sf), Q)


@query
def anomaly_by_type(spark, sf):
    return reports.anomalies_by_type(_fused(spark, sf))


@query
def top_hotspots(spark, sf):
    return reports.top_hotspots(grid.geographic_anomalies(_silver_table(spark, sf)))


@query
def top_anomalies(spark, sf):
    return reports.top_anomalies(_fused(spark, sf))


# --- alerts ------------------------------------------------------------------
def _quake_alerts(spark, sf) -> DataFrame:
    return alerts.quake_alerts(P.silver_quakes(spark, sf))


def _weather_alerts(spark, sf) -> DataFrame:
    return alerts.weather_alerts(P.silver_weather(spark, sf), W)


@query
def alert_quake(spark, sf):
    return _quake_alerts(spark, sf)


@query
def alert_weather(spark, sf):
    return _weather_alerts(spark, sf).drop("magnitude")


@query
def alert_anomaly(spark, sf):
    return alerts.anomaly_alerts(_fused(spark, sf), Q).drop("magnitude")


@query
def alert_routing(spark, sf):
    return alerts.route(_quake_alerts(spark, sf)).select("event_id", "severity", "channel")


@query
def alert_sms_text(spark, sf):
    both = _quake_alerts(spark, sf).unionByName(_weather_alerts(spark, sf))
    return both.select("event_id", alerts.sms_text().alias("sms"))


@query
def alert_card_json(spark, sf):
    return _quake_alerts(spark, sf).select("event_id", alerts.card_json().alias("card"))


@query
def alert_recipients(spark, sf):
    return alerts.outbox(_quake_alerts(spark, sf)).select("event_id", "channel", "recipient")


@query
def alert_delivery_rollup(spark, sf):
    """Results per recipient; the second contact is reached for shallow events only."""
    events = P.silver_quakes(spark, sf)
    depth = events.select("event_id", "depth_km")
    rows = alerts.with_recipients(alerts.route(alerts.quake_alerts(events)))
    reached = F.when(F.col("recipient") == "+10000000002", F.col("depth_km") < 70).otherwise(
        F.col("depth_km") < 300
    )
    return alerts.delivery_rollup(rows.join(depth, "event_id").withColumn("success", reached))


@query
def alert_rules(spark, sf):
    events = _silver_table(spark, sf)
    quakes = alerts.apply_rules(events, "quakes", "event_id")
    weather = alerts.apply_rules(P.silver_weather(spark, sf), "weather", "alert_id")
    fused = alerts.apply_rules(_fused(spark, sf, events), "anomalies", "event_id")
    return quakes.unionByName(weather).unionByName(fused)


@query
def alert_rules_outbox(spark, sf):
    """Fired earthquake rules as deliveries to the contacts of their groups."""
    events = _silver_table(spark, sf)
    fired = alerts.apply_rules(events, "quakes", "event_id")
    sent = alerts.rule_outbox(fired, alerts.quake_alerts(events))
    return sent.select("event_id", "rule", "channel", "recipient", "title")


# --- dashboard products ------------------------------------------------------
@query
def kpi_quakes(spark, sf):
    return dashboard.quake_kpi(P.silver_quakes(spark, sf), Q)


@query
def kpi_weather(spark, sf):
    return dashboard.weather_kpi(P.silver_weather(spark, sf), W)


@query
def kpi_anomalies(spark, sf):
    return dashboard.anomaly_kpi(_fused(spark, sf), Q)


@query
def kpi_health(spark, sf):
    return dashboard.health_kpi(P.quakes(spark, sf), Q)


@query
def map_feed(spark, sf):
    return dashboard.map_feed(P.silver_quakes(spark, sf), Q)


@query
def recent_alerts(spark, sf):
    return dashboard.recent_alerts(P.silver_quakes(spark, sf), P.silver_weather(spark, sf), Q)


@query
def hourly_stats(spark, sf):
    return dashboard.hourly_stats(P.silver_quakes(spark, sf), Q)


@query
def weather_breakdown(spark, sf):
    return dashboard.weather_breakdown(P.silver_weather(spark, sf))


@query
def anomaly_heatmap(spark, sf):
    return dashboard.anomaly_heatmap(_fused(spark, sf))


def _timeline(spark, sf, hours):
    events = _silver_table(spark, sf)
    return dashboard.events_timeline(
        events, P.silver_weather(spark, sf), _fused(spark, sf, events), Q, hours
    )


@query
def events_timeline(spark, sf):
    return _timeline(spark, sf, None)


@query
def events_timeline_24h(spark, sf):
    return _timeline(spark, sf, 24)


@query
def global_filter(spark, sf):
    chosen = dashboard.global_filter(
        P.silver_quakes(spark, sf), days_before(Q, 7), Q,
        ["Japan Region", "Philippines Region", "Alaska Region"], (2.5, 10.0),
    )
    return chosen.select("event_id", "event_time", "geographic_region", "magnitude")


@query
def bookmark_ring(spark, sf):
    return dashboard.bookmark(P.silver_quakes(spark, sf), "Pacific Ring of Fire", Q).select(
        "event_id", "geographic_region", "magnitude"
    )


@query
def bookmark_critical(spark, sf):
    return dashboard.bookmark(P.silver_quakes(spark, sf), "Critical Events", Q).select(
        "event_id", "event_time", "magnitude"
    )


@query
def cap_points(spark, sf):
    return dashboard.chart_points(P.silver_quakes(spark, sf), "event")


@query
def cap_points_reduced(spark, sf):
    """First, last, least and greatest event of every six hours."""
    return dashboard.reduced_points(P.silver_quakes(spark, sf), 6 * 3600)


@query
def cap_points_hourly(spark, sf):
    return dashboard.chart_points(P.silver_quakes(spark, sf), "hour")


@query
def cap_points_daily(spark, sf):
    return dashboard.chart_points(P.silver_quakes(spark, sf), "day")


@query
def drill_alert(spark, sf):
    """Detail row of the newest alert of the feed."""
    rows = P.silver_weather(spark, sf)
    newest = rows.agg(F.max_by("alert_id", F.struct("sent_time", "alert_id"))).scalar()
    return dashboard.drill_through(rows, "alert_id", newest).select(
        "alert_id", "event_type", "severity", "area_desc", "sent_time"
    )


@query
def drill_event(spark, sf):
    """Detail of the strongest event."""
    events = P.silver_quakes(spark, sf)
    strongest = events.agg(F.max_by("event_id", F.struct("magnitude", "event_id"))).scalar()
    return dashboard.drill_through(events, "event_id", strongest).select(
        "event_id", "event_time", "magnitude", "geographic_region", "population_impact_risk"
    )


# --- streams, drained once ---------------------------------------------------
LIVE_BATCHES = 3


def _drain(writer) -> None:
    ingest.start(writer, available_now=True).awaitTermination()


@query
def stream_ingest(spark, sf):
    """Documents landed as JSON lines, streamed to the bronze table."""
    landing, root = fresh_path(spark, "landing"), fresh_path(spark, "bronze")
    P.quake_documents(spark, sf).write.text(landing)
    documents = ingest.landed_documents(spark, landing)
    rows = geojson.parse_quakes(documents, Q, BATCH).transform(enrich.add_quake_partitions, hour=True)
    _drain(ingest.append_table(rows, root, fresh_path(spark, "stream")))
    return spark.read.schema(rows.schema).parquet(root).select(*QUAKE_COLUMNS)


@query
def dq_ingest_figures(spark, sf):
    """Features read, kept and rejected by an ingestion, and rows by the refresh after it, as the writes count them."""
    landing, root = fresh_path(spark, "landing"), fresh_path(spark, "bronze")
    P.quake_documents(spark, sf).write.text(landing)
    ingested = bronze.ingest_quakes(spark, landing, root, Q, BATCH)
    refreshed = silver.refresh_quakes(spark, root, fresh_path(spark, "silver"), Q, BATCH)
    rows = [(step, found["rows_in"], found["rows_kept"], found["rows_rejected"]) for step, found in (("ingest", ingested), ("refresh", refreshed))]
    return spark.createDataFrame(rows, "step string, rows_in bigint, rows_kept bigint, rows_rejected bigint")


@query
def stream_dedup(spark, sf):
    root = fresh_path(spark, "silver")
    rows = P.quake_stream(spark, sf, files=LIVE_BATCHES).drop("raw_id")
    _drain(ingest.upsert_table(
        rows, root, fresh_path(spark, "stream"), prepare=lambda batch, number: silver.quakes(batch, Q, f"batch-{number}")
    ))
    return spark.read.parquet(root).select("event_id", "event_time", "ingestion_time", "magnitude")


def _live_silver(spark, sf, then) -> None:
    """Silver kept by a stream of several batches; ``then`` gets its path, the touched days and the batch's number."""
    root = fresh_path(spark, "silver")
    rows = P.quake_stream(spark, sf, files=LIVE_BATCHES).drop("raw_id")
    _drain(ingest.upsert_table(
        rows, root, fresh_path(spark, "stream"), prepare=lambda batch, number: silver.quakes(batch, Q, f"batch-{number}"),
        then=lambda touched, number: then(root, touched, number),
    ))


@query
def stream_hourly(spark, sf):
    """Hourly counts kept up to date by the silver stream."""
    hours = fresh_path(spark, "hourly")
    _live_silver(spark, sf, lambda root, touched, number: live.log_hours(touched, hours, number))
    return live.hourly_table(spark, hours)


@query
def stream_frequency_alert(spark, sf):
    """Each batch flags the hours it touched against the stored baseline."""
    baseline = live.region_baseline(_silver_table(spark, sf), Q)
    hours, found = fresh_path(spark, "hourly"), fresh_path(spark, "alerts")

    def flag(root, touched, number) -> None:
        live.log_hours(touched, hours, number)
        live.log_alerts(touched, hours, baseline, found, number)

    _live_silver(spark, sf, flag)
    return live.alert_table(spark, found, baseline).select(
        *frequency.REGION_HOUR, "earthquake_count", "frequency_zscore", "frequency_anomaly",
        "magnitude_anomaly", "combined_anomaly",
    )


@query
def stream_rapid_succession(spark, sf):
    found = fresh_path(spark, "succession")
    _live_silver(spark, sf, lambda root, touched, number: live.refresh_succession(spark, root, found, touched))
    schema = live.rapid_succession(P.silver_quakes(spark, sf)).schema  # there may be no burst at all
    return spark.read.schema(schema).parquet(found).drop(*schemas.PARTITION_COLUMNS)


@query
def stream_late(spark, sf):
    """Ingestion lags up to two days; rows beyond the horizon go to the quarantine."""
    good, bad = fresh_path(spark, "on_time"), fresh_path(spark, "late")
    lag = F.make_interval(hours=(F.col("raw_id") % 48).cast("int"))
    rows = P.quake_stream(spark, sf).withColumn("ingestion_time", F.col("ingestion_time") + lag)

    def split(batch: DataFrame, number: int) -> None:
        on_time, late = live.split_late(batch)
        on_time.write.mode("overwrite").parquet(f"{good}/batch={number}")
        late.write.mode("overwrite").parquet(f"{bad}/batch={number}")

    writer = rows.writeStream.foreachBatch(split)
    _drain(writer.option("checkpointLocation", fresh_path(spark, "stream")))
    parts = [
        spark.read.schema(rows.schema).parquet(f"{root}/batch=*").withColumn("late", F.lit(flag))
        for root, flag in ((good, False), (bad, True))
    ]
    return parts[0].unionByName(parts[1]).select("event_id", "event_time", "ingestion_time", "late")


@query
def stream_outbox(spark, sf):
    """Alerts queued once per event, channel and recipient."""
    root = fresh_path(spark, "outbox")
    rows = P.quake_stream(spark, sf).drop("raw_id")
    _drain(ingest.upsert_table(
        rows, root, fresh_path(spark, "stream"), merge=live.first_per_delivery, key="outbox_key",
        prepare=lambda batch, number: live.outbox_rows(silver.quakes(batch, Q), number),
    ))
    return spark.read.parquet(root).select("event_id", "severity", "channel", "recipient", "title")
