"""Severity, region, distance, flags, lineage and partition columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazardflow import config
from hazardflow.functions import geo, severity, text
from hazardflow.functions.time import date_parts, moment, span_hours


def add_quake_severity(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "severity_score": severity.magnitude_score("magnitude"),
        "severity_category": severity.magnitude_category("magnitude"),
    })


def add_region(df: DataFrame, boxes=None) -> DataFrame:
    return df.withColumn("geographic_region", geo.region_of("latitude", "longitude", boxes))


def add_city_distance(df: DataFrame, cities=None, mode: str = "planar") -> DataFrame:
    km = geo.nearest_city_km("latitude", "longitude", cities, mode)
    return df.withColumn("distance_to_major_city_km", km).withColumn(
        "population_impact_risk", geo.population_risk("distance_to_major_city_km")
    )


def add_event_calendar(df: DataFrame, as_of) -> DataFrame:
    """Date, hour, age in calendar days, and the recent flag."""
    return df.withColumns({
        "event_date": F.to_date("event_time"),
        "event_hour": F.hour("event_time"),
        "days_since_event": F.datediff(moment(as_of), F.col("event_time")),
    }).withColumn("is_recent", F.col("days_since_event") <= config.RECENT_DAYS)


def add_quake_flags(df: DataFrame) -> DataFrame:
    strong = F.col("magnitude") >= config.ALERT_MAGNITUDE
    return df.withColumns({
        "is_significant": (F.col("significance") >= config.SIGNIFICANT_SCORE) | strong,
        "requires_alert": strong & F.col("population_impact_risk").isin(*config.ALERT_RISKS),
    })


def add_weather_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "severity_score": severity.weather_score("severity"),
        "urgency_score": severity.urgency_score("urgency"),
    }).withColumn(
        "combined_severity_score",
        severity.combined_score("severity_score", "urgency_score"),
    )


def add_alert_duration(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "alert_duration_hours", span_hours(F.col("effective_time"), F.col("expires_time"))
    )


def add_weather_flags(df: DataFrame, as_of) -> DataFrame:
    """Active, imminent (past onsets count) and requires-alert flags."""
    now = moment(as_of)
    soon = now + F.expr(f"INTERVAL {config.IMMINENT_HOURS} HOURS")
    level = F.col("severity")
    return df.withColumns({
        "is_active": F.col("expires_time").isNull() | (F.col("expires_time") > now),
        "is_imminent": F.col("onset_time").isNotNull() & (F.col("onset_time") <= soon),
    }).withColumn(
        "requires_alert",
        (F.col("combined_severity_score") >= config.WEATHER_ALERT_SCORE)
        | (level == "Extreme")
        | (F.col("is_imminent") & level.isin("Severe", "Extreme")),
    )


def add_weather_category(df: DataFrame, whole_words: bool = False) -> DataFrame:
    return df.withColumn("event_category", severity.weather_category("event_type", whole_words))


def add_location_text(df: DataFrame) -> DataFrame:
    return df.withColumn("location", text.location_text(F.col("latitude"), F.col("longitude")))


def add_lineage(df: DataFrame, **labels: str) -> DataFrame:
    """Constant columns such as ``batch_id``, ``data_source``, ``schema_version``."""
    return df.withColumns({name: F.lit(value) for name, value in labels.items()})


def add_processing_stamp(df: DataFrame, as_of, batch_id: str) -> DataFrame:
    return df.withColumns({"processed_time": moment(as_of), "silver_batch_id": F.lit(batch_id)})


def add_quake_partitions(df: DataFrame, hour: bool = False) -> DataFrame:
    parts = date_parts(F.col("event_time"))
    return df.withColumns({k: v for k, v in parts.items() if hour or k != "hour"})


def add_weather_partitions(df: DataFrame, hour: bool = False) -> DataFrame:
    """Partitions by sent time, or ingestion time where the alert has none."""
    parts = date_parts(F.coalesce("sent_time", "ingestion_time"))
    return df.withColumns({k: v for k, v in parts.items() if hour or k != "hour"})
