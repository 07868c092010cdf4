"""Hourly activity by region against a rolling baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazardflow import config
from hazardflow.functions.stats import over, zscore

REGION_HOUR = ["geographic_region", "hour_window"]


def hourly_activity(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Count, mean and largest magnitude per region and hour."""
    keys = REGION_HOUR if keys is None else keys
    return (
        df.withColumn("hour_window", F.date_trunc("hour", "event_time"))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("earthquake_count"),
            F.avg("magnitude").alias("avg_magnitude"),
            F.max("magnitude").alias("max_magnitude"),
        )
    )


def rolling_baseline(hourly: DataFrame, mode: str = "rows") -> DataFrame:
    """Baseline of the hours before the current one, per region.

    ``rows`` looks at the previous 167 active hours, ``range`` at the previous
    168 clock hours. The window runs on the hourly table: one region has at
    most 8,784 rows a year, however many events those hours hold.
    """
    regions = Window.partitionBy("geographic_region")
    if mode == "rows":
        before = regions.orderBy("hour_window").rowsBetween(-config.BASELINE_ROWS, -1)
    elif mode == "range":
        before = regions.orderBy(F.unix_timestamp("hour_window")).rangeBetween(
            -config.BASELINE_HOURS * 3600, -1
        )
    else:
        raise ValueError(f"unknown baseline mode: {mode}")
    return hourly.withColumns({
        "baseline_count_mean": F.avg("earthquake_count").over(before),
        "baseline_count_std": F.stddev("earthquake_count").over(before),
        "baseline_mag_mean": F.avg("avg_magnitude").over(before),
    })


def frequency_flags() -> dict[str, Column]:
    """Flag columns over an hourly row that has its baseline columns."""
    count = F.col("earthquake_count")
    jump = F.col("max_magnitude") - F.col("baseline_mag_mean")
    return {
        "frequency_anomaly": over(F.col("frequency_zscore"), config.FREQUENCY_ZSCORE_LIMIT)
        | (count >= config.FREQUENCY_COUNT_LIMIT),
        "magnitude_anomaly": over(jump, config.MAGNITUDE_JUMP),
    }


def flag_frequency(with_baseline: DataFrame) -> DataFrame:
    """z over 2 or 10 events an hour; largest magnitude 1.5 above baseline."""
    scored = with_baseline.withColumn(
        "frequency_zscore",
        zscore(F.col("earthquake_count"), F.col("baseline_count_mean"), F.col("baseline_count_std")),
    )
    return scored.withColumns(frequency_flags()).withColumn(
        "combined_anomaly", F.col("frequency_anomaly") | F.col("magnitude_anomaly")
    )


def frequency_anomalies(df: DataFrame, mode: str = "rows") -> DataFrame:
    return flag_frequency(rolling_baseline(hourly_activity(df), mode))
