"""Recurring weather alerts by type, severity and area."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazardflow import config
from hazardflow.functions.stats import over, with_statistics, zscore
from hazardflow.functions.time import span_hours

PATTERN_KEYS = ["event_type", "severity", "area_desc"]


def pattern_profile(df: DataFrame) -> DataFrame:
    """Frequency, mean score, distinct alerts, span and rate per pattern.

    Silver alerts are unique by id, so the distinct count is spread over
    (pattern, id) before the final merge and a hot pattern stays split.
    """
    span = F.col("time_span_hours")
    return (
        df.groupBy(*PATTERN_KEYS)
        .agg(
            F.count("*").alias("alert_frequency"),
            F.avg("combined_severity_score").alias("avg_severity_score"),
            F.count("alert_id").alias("unique_alerts"),  # silver has one row per alert
            F.min("sent_time").alias("first_alert"),
            F.max("sent_time").alias("last_alert"),
        )
        .withColumn("time_span_hours", span_hours(F.col("first_alert"), F.col("last_alert")))
        .withColumn(
            "alerts_per_hour",
            F.when(span > 0, F.col("alert_frequency") / span).otherwise(F.col("alert_frequency")),
        )
    )


def flag_patterns(profile: DataFrame) -> DataFrame:
    """Unusually frequent patterns, or five and more extreme alerts."""
    stats = {"avg_count": F.avg("alert_frequency"), "std_count": F.stddev("alert_frequency")}
    scored = with_statistics(profile, stats, profile, "_patterns").withColumn(
        "frequency_zscore",
        zscore(
            F.col("alert_frequency"), F.col("_patterns.avg_count"), F.col("_patterns.std_count")
        ),
    )
    return (
        scored.withColumns({
            "high_frequency_anomaly": over(F.col("frequency_zscore"), config.PATTERN_ZSCORE_LIMIT),
            "severe_weather_cluster": F.coalesce(
                (F.col("severity") == "Extreme")
                & (F.col("alert_frequency") >= config.PATTERN_EXTREME_COUNT),
                F.lit(False),
            ),
        })
        .withColumn(
            "weather_anomaly", F.col("high_frequency_anomaly") | F.col("severe_weather_cluster")
        )
        .drop("_patterns")
    )
