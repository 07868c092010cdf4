"""Counts, distributions, rates, summaries and top lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from hazardflow import config
from hazardflow.functions.time import hours_before

TOP = 10


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def freshness(df: DataFrame) -> DataFrame:
    return df.agg(F.max("ingestion_time").alias("latest_ingestion"))


def severity_distribution(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("severity_category")
        .agg(F.count("*").alias("count"), F.round(F.avg("magnitude"), 2).alias("avg_magnitude"))
        .orderBy(F.col("count").desc(), "severity_category")
    )


def region_distribution(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("geographic_region")
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "geographic_region")
    )


def weather_distribution(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("severity", "event_category")
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "severity", "event_category")
    )


def flag_rates(silver: DataFrame, flags: list[str]) -> DataFrame:
    """Count and percent of each flag, in one pass."""
    columns = [F.count("*").alias("total")]
    for flag in flags:
        columns.append(F.count_if(flag).alias(f"{flag}_count"))
        columns.append(F.round(F.avg(F.col(flag).cast("int")) * 100, 1).alias(f"{flag}_percent"))
    return silver.agg(*columns)


def top_hotspots(cells: DataFrame, n: int = TOP) -> DataFrame:
    return (
        cells.filter("geographic_anomaly")
        .select(
            "grid_cell", "lat_grid", "lon_grid", "event_count", "avg_magnitude",
            "event_rate_per_hour",
        )
        .orderBy(F.col("event_count").desc(), "grid_cell")
        .limit(n)
    )


def top_anomalies(fused: DataFrame, n: int = TOP) -> DataFrame:
    return (
        fused.filter("is_anomaly")
        .select("event_id", "magnitude", "place", "anomaly_types", "anomaly_score", "event_time")
        .orderBy(F.col("anomaly_score").desc(), "event_id")
        .limit(n)
    )


def top_weather_patterns(patterns: DataFrame, n: int = TOP) -> DataFrame:
    return (
        patterns.filter("weather_anomaly")
        .select(
            "event_type", "severity", "area_desc", "alert_frequency", "avg_severity_score",
            "alerts_per_hour",
        )
        .orderBy(F.col("alert_frequency").desc(), "event_type", "severity", "area_desc")
        .limit(n)
    )


def top_weather_patterns_brief(patterns: DataFrame, n: int = 5) -> DataFrame:
    """The short form of the run's summary: five patterns, three columns."""
    return top_weather_patterns(patterns, n).select("event_type", "severity", "alert_frequency")


def anomaly_summary(fused: DataFrame, as_of) -> DataFrame:
    """Totals, rate, high-risk and last-day counts, in one pass."""
    hit = F.col("is_anomaly")
    rate = F.count_if(hit) * 100.0 / F.nullif(F.count("*"), F.lit(0))
    return fused.agg(
        F.count("*").alias("total_events"),
        F.count_if(hit).alias("total_anomalies"),
        F.round(rate, 2).alias("anomaly_rate"),
        F.count_if(hit & (F.col("anomaly_score") > config.HIGH_RISK_SCORE)).alias("high_risk"),
        F.count_if(hit & (F.col("event_time") > hours_before(as_of, 24))).alias("recent"),
    )


def anomalies_by_type(fused: DataFrame) -> DataFrame:
    return (
        fused.filter("is_anomaly")
        .select(F.explode(F.split("anomaly_types", ",")).alias("anomaly_type_exploded"))
        .groupBy("anomaly_type_exploded")
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "anomaly_type_exploded")
    )


def weather_anomaly_summary(patterns: DataFrame) -> DataFrame:
    return patterns.agg(
        F.count("*").alias("total_patterns"),
        F.count_if("weather_anomaly").alias("anomalous_patterns"),
    )
