"""Validity rules, the quarantine of rejected rows, and look-back filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from hazardflow import config
from hazardflow.functions import geo
from hazardflow.functions.time import days_before, hours_before


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def coordinate_rules(lat: str = "latitude", lon: str = "longitude") -> dict[str, Column]:
    return {"coordinates": geo.coordinates_valid(F.col(lat), F.col(lon))}


def quake_rules() -> dict[str, Column]:
    return {
        "magnitude": _holds(F.col("magnitude").between(*config.MAGNITUDE_RANGE)),
        "depth": _holds(F.col("depth_km").between(*config.DEPTH_RANGE_KM)),
        "event_time": F.col("event_time").isNotNull(),
        "event_id": _holds(F.length("event_id") > config.MIN_ID_LENGTH),
    }


def weather_rules() -> dict[str, Column]:
    return {
        "alert_id": _holds(F.length("alert_id") > config.MIN_ID_LENGTH),
        "event_type": F.col("event_type").isNotNull(),
        "severity": F.col("severity").isNotNull(),
    }


def all_quake_rules() -> dict[str, Column]:
    return {**coordinate_rules(), **quake_rules()}


def passes(rules: dict[str, Column]) -> Column:
    result = F.lit(True)
    for rule in rules.values():
        result = result & rule
    return result


def valid_coordinates(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.filter(
        F.col(lat).between(*config.LATITUDE_RANGE) & F.col(lon).between(*config.LONGITUDE_RANGE)
    )


def valid_quakes(df: DataFrame) -> DataFrame:
    """Plain range predicates, so that they reach the Parquet scan."""
    return df.filter(
        F.col("magnitude").between(*config.MAGNITUDE_RANGE)
        & F.col("depth_km").between(*config.DEPTH_RANGE_KM)
        & F.col("event_time").isNotNull()
        & (F.length("event_id") > config.MIN_ID_LENGTH)
    )


def valid_weather(df: DataFrame) -> DataFrame:
    return df.filter(
        (F.length("alert_id") > config.MIN_ID_LENGTH)
        & F.col("event_type").isNotNull()
        & F.col("severity").isNotNull()
    )


def quarantine(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows a filter would drop, with the names of all rules they break."""
    broken = [F.when(~rule, F.lit(name)) for name, rule in rules.items()]
    return df.filter(~passes(rules)).withColumn("reasons", F.array_compact(F.array(*broken)))


def validation_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows in, rows kept and percent kept, in one pass."""
    kept = F.count_if(passes(rules))
    return df.agg(
        F.count("*").alias("rows_in"),
        kept.alias("rows_kept"),
        F.round(kept * 100.0 / F.nullif(F.count("*"), F.lit(0)), 1).alias("percent_kept"),
    )


def observed(df: DataFrame, rules: dict[str, Column], figures: Observation) -> DataFrame:
    """The same rows; ``figures`` gets rows_in and rows_kept when a job has read them, without a pass of its own."""
    return df.observe(figures, F.count("*").alias("rows_in"), F.count_if(passes(rules)).alias("rows_kept"))


def ingested_since(df: DataFrame, as_of, hours: int = config.DEDUP_HORIZON_HOURS) -> DataFrame:
    return df.filter(F.col("ingestion_time") >= hours_before(as_of, hours))


def _days_since(df: DataFrame, since) -> DataFrame:
    """Day partitions that can hold rows since a moment, where the table has them."""
    if not {"year", "month", "day"} <= set(df.columns):
        return df
    return df.filter(F.expr("make_date(year, month, day)") >= F.to_date(since))


def anomaly_window(df: DataFrame, as_of, days: int = config.ANOMALY_LOOKBACK_DAYS) -> DataFrame:
    """Events of the last days that have a magnitude; prunes a silver table to those days."""
    return _days_since(df, days_before(as_of, days)).filter(
        (F.col("event_time") >= days_before(as_of, days)) & F.col("magnitude").isNotNull()
    )


def weather_window(df: DataFrame, as_of, days: int = config.ANOMALY_LOOKBACK_DAYS) -> DataFrame:
    since = days_before(as_of, days)
    return _days_since(df, since).filter(F.col("sent_time") >= since)
