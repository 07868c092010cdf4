"""Bronze to silver: validate, keep the latest version, enrich, flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from hazardflow import config
from hazardflow.functions.time import hours_before
from hazardflow.operators import dedup, enrich, quality
from hazardflow.sources import tables
from hazardflow.workspace import path_exists


def clean_quakes(bronze: DataFrame) -> DataFrame:
    """Valid rows, one per event."""
    return (
        bronze.transform(quality.valid_coordinates)
        .transform(quality.valid_quakes)
        .transform(dedup.latest_quakes)
    )


def enrich_quakes(clean: DataFrame, as_of, distance: str = "planar") -> DataFrame:
    return (
        clean.transform(enrich.add_quake_severity)
        .transform(enrich.add_region)
        .transform(enrich.add_city_distance, mode=distance)
        .transform(enrich.add_event_calendar, as_of)
        .transform(enrich.add_quake_flags)
    )


def quakes(bronze: DataFrame, as_of, batch_id: str = "batch", distance: str = "planar") -> DataFrame:
    """The silver earthquake table, with its partition columns."""
    return (
        bronze.transform(clean_quakes)
        .transform(enrich_quakes, as_of, distance)
        .transform(enrich.add_processing_stamp, as_of, batch_id)
        .transform(enrich.add_quake_partitions)
    )


def clean_weather(bronze: DataFrame) -> DataFrame:
    return bronze.transform(quality.valid_weather).transform(dedup.latest_alerts)


def enrich_weather(clean: DataFrame, as_of, whole_words: bool = False) -> DataFrame:
    return (
        clean.transform(enrich.add_weather_scores)
        .transform(enrich.add_alert_duration)
        .transform(enrich.add_weather_flags, as_of)
        .transform(enrich.add_weather_category, whole_words)
    )


def weather(bronze: DataFrame, as_of, batch_id: str = "batch", whole_words: bool = False) -> DataFrame:
    """The silver weather table, with its partition columns."""
    return (
        bronze.transform(clean_weather)
        .transform(enrich_weather, as_of, whole_words)
        .transform(enrich.add_processing_stamp, as_of, batch_id)
        .transform(enrich.add_weather_partitions)
    )


def recent_bronze(spark: SparkSession, bronze_root: str, as_of) -> DataFrame:
    """Bronze rows ingested in the look-back; older days of ingestion are not opened."""
    since = hours_before(as_of, config.DEDUP_HORIZON_HOURS)
    return quality.ingested_since(tables.scan(spark, bronze_root, ingested_since=since), as_of)


def _refresh(spark, bronze_root, root, as_of, batch_id, rules, make, merge, key) -> dict[str, int] | None:
    figures, stage = Observation(), f"{root}__stage_{batch_id}"
    done = path_exists(spark, f"{stage}/updates/_SUCCESS")
    recent = quality.observed(recent_bronze(spark, bronze_root, as_of), rules, figures)
    tables.upsert_days(make(recent, as_of, batch_id), root, merge, [key], stage)
    if done:
        return None
    found = figures.get
    return {**found, "rows_rejected": found["rows_in"] - found["rows_kept"]}


def refresh_quakes(spark: SparkSession, bronze_root: str, root: str, as_of, batch_id: str) -> dict[str, int] | None:
    """Merge what was ingested in the look-back into the kept silver rows.

    Returns rows_in, rows_kept and rows_rejected, counted in the pass that writes; None on a retry
    that found them written.
    """
    return _refresh(spark, bronze_root, root, as_of, batch_id, quality.all_quake_rules(), quakes, dedup.latest_quakes, "event_id")


def refresh_weather(spark: SparkSession, bronze_root: str, root: str, as_of, batch_id: str) -> dict[str, int] | None:
    """As ``refresh_quakes``, for alerts."""
    return _refresh(spark, bronze_root, root, as_of, batch_id, quality.weather_rules(), weather, dedup.latest_alerts, "alert_id")
